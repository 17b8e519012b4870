"""Queries on the driver's tables, each with the SQL that must agree with it."""

from checks import gold_serve, ingest, upkeep  # noqa: F401  (they register their queries)
from checks.registry import QUERIES, SQL


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(SQL)
