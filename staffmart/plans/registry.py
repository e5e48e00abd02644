"""All queries over the driver's tables, and their SQL."""

from __future__ import annotations

from staffmart.plans import lake_queries, queries

QUERIES = queries.QUERIES | lake_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | lake_queries.ORACLE_SQL
