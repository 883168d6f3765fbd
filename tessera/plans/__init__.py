"""All registered queries."""

from . import administration, aggregates, changes, documents, joins, scalars, shapes
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "changes", "documents", "joins", "scalars", "shapes"]
