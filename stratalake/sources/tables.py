"""SQL table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, **extra: str
) -> dict[str, str]:
    """Connection options; the caller supplies the credentials."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        **extra,
    }


def split_options(column: str, lower: str, upper: str, parts: int) -> dict[str, str]:
    """Options that read a table in ``parts`` parallel ranges of ``column``.

    Rows outside the bounds are still read, by the first and last range.
    """
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(parts),
    }


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    split: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """JDBC table; filters and column choice on the result reach the database."""
    df = spark.read.format("jdbc").options(**options, **(split or {})).load()
    return df.orderBy(*order_by) if order_by else df


def read_table(spark: SparkSession, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Catalog table, in order if asked."""
    df = spark.table(name)
    return df.orderBy(*order_by) if order_by else df
