"""Tables of files: overwritten whole, by partition, or batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratalake.schemas import BATCH
from stratalake.session import path_exists


def _write(
    df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], mode: str
) -> None:
    """The rows are rebalanced before the write, which gives each partition value
    few files, and a value with a large share of the rows several tasks."""
    writer = df.hint("rebalance", *partition_by).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def overwrite(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Replace what is at ``path`` and return it as read back.

    Further sinks should take the returned frame: the plan behind ``df`` then
    runs once.
    """
    _write(df, path, fmt, partition_by, "overwrite")
    return df.sparkSession.read.format(fmt).load(path)


def append(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    _write(df, path, fmt, partition_by, "append")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of; files of the others stay.

    All rows are written beside the table before the first partition is replaced.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def write_batch(df: DataFrame, path: str, number: int, partition_by: Sequence[str] = ()) -> None:
    """The rows of a stream's batch, in a folder of its number.

    A batch that is tried again replaces its folder, so it is there once. A table that
    a streaming sink keeps can't be written like this: its log would hide the rows.
    """
    if path_exists(df.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is kept by a streaming sink, whose log decides on its files")
    _write(df, f"{path}/{BATCH}={number}", "parquet", partition_by, "overwrite")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches' rows, without their numbers."""
    return spark.read.parquet(path).drop(BATCH)
