"""All registered queries."""

from docloom.plans import search_queries, stream_queries, table_queries, text_queries  # noqa: F401
from docloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
