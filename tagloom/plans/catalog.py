"""All registered queries."""

from tagloom.plans import model_queries, stream_queries, table_queries, text_queries  # noqa: F401
from tagloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
