"""Tabular modelling operators for Spark DataFrames.

Sub-packages
------------
functions   column expressions (arrays, ids, hashing, guards)
sources     table reading, replacing, exporting and build-log look-ups
operators   the DataFrame operators: assembly, preparation, models, evaluation
plans       whole runs composed of operators, and the builder specs
queries     the registered queries with the SQL that checks them
"""

import sys

from pyspark import cloudpickle

# Task functions travel whole, so that executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
