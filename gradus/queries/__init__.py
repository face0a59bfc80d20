"""Registered queries; importing this package fills the registry."""

from gradus.queries import assembly, causal, clauses, evaluation, lists, models, preparation, trees  # noqa: F401
from gradus.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
