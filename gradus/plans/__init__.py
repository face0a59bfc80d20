"""Whole runs composed of operators, and the specifications of input tables."""
