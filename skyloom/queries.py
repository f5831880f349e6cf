"""All core queries by name, and their SQL."""

from __future__ import annotations

from skyloom.plans import catalog_queries, problem_queries

QUERIES = catalog_queries.QUERIES | problem_queries.QUERIES
SQL = catalog_queries.SQL | problem_queries.SQL
