"""Append queries with a checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# --- fixed value: how often a long-running query takes a batch ----------------
BATCH_INTERVAL = "2 minutes"


def _gathered(df: DataFrame, by: Sequence[str], spread: int) -> DataFrame:
    share = F.pmod(F.spark_partition_id(), F.lit(spread))
    return df.withColumn("_share", share).repartition(*by, "_share").drop("_share")


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    interval: str | None = BATCH_INTERVAL,
    name: str | None = None,
    spread: int | None = None,
    gather: bool = True,
) -> StreamingQuery:
    """Append ``df`` to files under ``path``, exactly once.

    Progress is in ``checkpoint``, so a restarted query goes on where it was.
    With ``interval=None`` it takes all there is, in as many batches as the
    source's limits ask for, and ends.

    A partitioned sink gathers each partition's rows in at most ``spread`` tasks
    before it writes, by default as many as there are shuffle partitions. A batch
    thus adds that many files to a partition at most, and a date with a third of the rows
    is not left to a single task. With ``gather=False`` nothing is shuffled, and
    each task of the source writes what it has read.
    """
    if partition_by and gather:
        conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        df = _gathered(df, partition_by, spread or int(conf))
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_to_end(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    gather: bool = True,
) -> StreamingQuery:
    """Append all there is now and return the finished query."""
    query = start_append(
        df, path, checkpoint, partition_by, fmt, interval=None, gather=gather
    )
    query.awaitTermination()
    return query
