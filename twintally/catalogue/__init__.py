"""The registered queries and their SQL counterparts."""

from twintally.catalogue import content_queries, count_queries, run_queries, source_queries, time_queries
from twintally.catalogue.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "content_queries", "count_queries", "run_queries", "source_queries", "time_queries"]
