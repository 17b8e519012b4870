"""The newest row of each key, kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.filters import in_partitions
from stratalake.operators.quality import drop_replays
from stratalake.schemas import BATCH, INGEST_TIME
from stratalake.session import path_exists
from stratalake.sinks.files import overwrite, overwrite_partitions
from stratalake.streaming.queries import BATCH_INTERVAL


def merge_batch(
    batch: DataFrame,
    number: int,
    path: str,
    staging: str,
    key: Sequence[str],
    newest_by: str,
    partition_by: Sequence[str],
) -> None:
    """Merge a batch into the table at ``path``: of each key the newest row stays.

    ``partition_by`` must follow from the key, so that a key's rows are in one
    partition. Only partitions that the batch has rows of are read and replaced. The
    merged partitions are first written under ``staging``, in a folder of the batch's
    number, and the table takes them from there. A batch that is tried again after they
    are complete does not read the table, which may have lost a partition halfway
    through; one that is tried again earlier finds the table as it was.
    """
    spark = batch.sparkSession
    staged = f"{staging.rstrip('/')}/{BATCH}={number}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        fresh = drop_replays(batch, key, newest_by).persist()
        if fresh.isEmpty():
            return
        rows = fresh
        if path_exists(spark, path):
            touched = fresh.select(*partition_by).distinct()
            stored = spark.read.schema(batch.schema).parquet(path)
            old = in_partitions(stored, touched, partition_by).select(*fresh.columns)
            rows = drop_replays(old.unionByName(fresh), key, newest_by)
        overwrite(rows, staged, partition_by=partition_by)
        fresh.unpersist()
    merged = spark.read.schema(batch.schema).parquet(staged)
    overwrite_partitions(merged, path, partition_by)


def start_merge(
    df: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    partition_by: Sequence[str],
    newest_by: str = INGEST_TIME,
    interval: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """A query that keeps the newest row of each key at ``path``.

    Corrections replace what they correct, in whatever batch they come, and replays
    change nothing. ``newest_by`` is added as the batch's clock if absent; of rows of
    one time the greatest stays. A null in the key matches nothing, so such rows go
    only as equal copies. Staged partitions lie beside ``checkpoint``, those of one
    batch at a time. ``interval=None`` takes all there is and ends.
    """
    if newest_by not in df.columns:
        df = df.withColumn(newest_by, F.current_timestamp())
    take = into_newest(path, checkpoint, key, partition_by, newest_by)
    writer = df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def into_newest(
    path: str,
    checkpoint: str,
    key: Sequence[str],
    partition_by: Sequence[str],
    newest_by: str = INGEST_TIME,
) -> Callable[[DataFrame, int], None]:
    """What a query does with each batch to keep the newest rows at ``path``."""
    staging = f"{checkpoint.rstrip('/')}-staging"

    def take(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, path, staging, key, newest_by, partition_by)
        _drop_before(batch, staging, number)

    return take


def _drop_before(batch: DataFrame, staging: str, number: int) -> None:
    """Delete the staged partitions of batches that are done for good."""
    spark = batch.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(staging)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) < number:
            system.delete(status.getPath(), True)
