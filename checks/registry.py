"""Registration of a query together with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
# The tables a query reads, as its SQL names them.
INPUTS: dict[str, list[str]] = {}
_TABLES = ("lineitem", "orders", "events", "customer", "part", "supplier")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
            INPUTS[function.__name__] = [t for t in _TABLES if re.search(rf"\b{t}\b", sql)]
        return function

    return register
