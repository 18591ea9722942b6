"""All queries over the test tables, and their SQL."""

from __future__ import annotations

from . import file_queries, job_queries, mosaic_queries, panel_queries, sequence_queries, table_queries

QUERIES = table_queries.QUERIES | panel_queries.QUERIES | mosaic_queries.QUERIES | file_queries.QUERIES | job_queries.QUERIES | sequence_queries.QUERIES
SQL = table_queries.SQL | panel_queries.SQL | mosaic_queries.SQL | file_queries.SQL | job_queries.SQL | sequence_queries.SQL
