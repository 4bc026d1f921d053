"""Feeds derived from the tables, and every query over them."""

from tidemart.plans import (  # noqa: F401
    catalog_queries, change_queries, function_queries, log_queries, stream_queries, table_queries,
)
from tidemart.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
