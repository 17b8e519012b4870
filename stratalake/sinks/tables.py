"""SQL tables as sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_jdbc(
    df: DataFrame, options: Mapping[str, str], connections: int = 8
) -> None:
    """Replace the rows of a database table, over a bounded number of connections.

    The table is truncated, not dropped, so its definition and grants stay.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("truncate", "true")
        .option("numPartitions", str(connections))
        .mode("overwrite")
        .save()
    )


def replace_table(
    df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Replace a catalog table, kept at ``path`` if given, and return it."""
    writer = df.write.format(fmt).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def publish_version(
    df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> DataFrame:
    """Replace what the catalog shows as ``name``, without a moment in between.

    Rows go to a new folder under ``path``. Only when all are there is the view
    ``name`` set to that folder, in one step of the catalog, so a job that fails leaves
    the former rows in place and no reader meets half of them. Folders of former
    versions stay for readers that are still at work; delete them when none is.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/versao-{uuid.uuid4().hex}"
    writer = df.hint("rebalance", *partition_by).write.format(fmt).mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{folder}`")
    return spark.table(name)


def write_bucketed(
    df: DataFrame, name: str, by: str, buckets: int, path: str | None = None
) -> DataFrame:
    """A catalog table dealt to ``buckets`` by a hash of ``by`` and sorted by it within.

    Tables of as many buckets are joined on ``by`` where they lie, without a shuffle.
    A bucket is a task of such a join, so this is for tables with few rows per value,
    as daily gold; a value with much of the rows is better left to adaptive execution.
    """
    writer = (
        df.repartition(buckets, F.col(by))
        .write.format("parquet").mode("overwrite").bucketBy(buckets, by).sortBy(by)
    )
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
