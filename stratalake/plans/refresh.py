"""Gold of the dates that changed.

A query follows silver and hands over the days or months of the rows that came in
since its last run; its checkpoint remembers how far it was. Only these periods are
read from silver again, as a whole, and only their partitions of gold are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.filters import in_periods, period_of
from stratalake.schemas import BATCH
from stratalake.session import path_exists
from stratalake.sinks.files import overwrite_partitions


@dataclass(frozen=True)
class Periods:
    """Which rows of silver make which partition of gold: those of one day or month.

    ``column`` is silver's date or timestamp, ``unit`` is ``day`` or ``month``, and
    ``partition_by`` are the columns of gold that tell the period.
    """

    column: str
    unit: str
    partition_by: tuple[str, ...]


def read_silver(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).drop(BATCH)


def refresh_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
    periods: Periods,
) -> int:
    """Bring ``gold`` up to date with ``silver``; the number of periods rebuilt.

    ``build`` makes gold of silver rows, each period from its own rows alone. A run
    that fails is repeated by the next one with the same periods, and a period that is
    built twice is the same. The first run builds all there is. The periods are read
    by the driver: there are as many as the calendar has, whatever the rows. Rows that
    came in while a run was at work are in it or in the next. Files that a merge has
    replaced meanwhile are skipped, as the files that replaced them come next.
    """
    schema = spark.read.parquet(silver).schema
    arrived = (
        spark.readStream.schema(schema).option("ignoreMissingFiles", True).parquet(silver)
        .select(period_of(periods.column, periods.unit).alias("period"))
    )
    rebuilt = 0

    def rebuild(batch: DataFrame, number: int) -> None:
        nonlocal rebuilt
        changed = [row["period"] for row in batch.distinct().collect()]
        if not changed:
            return
        rows = read_silver(spark, silver, schema)
        if path_exists(spark, gold):
            rows = in_periods(rows, periods.column, changed, periods.unit)
        overwrite_partitions(build(rows), gold, periods.partition_by)
        rebuilt += len(changed)

    query = (
        arrived.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rebuilt


def read_gold(spark: SparkSession, gold: str, columns: Sequence[str]) -> DataFrame:
    """Gold with its columns in order; those of its partitions stand last in the files."""
    return spark.read.parquet(gold).select(*[F.col(c) for c in columns])
