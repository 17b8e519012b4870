"""Streaming sources.

A file stream reads all files under its path, whatever folders they are in: the
``yyyy/MM/dd`` folders of message savers and the ``ingest_year=…`` folders that
landing writes. Where a streaming sink wrote the path, its commit log decides
which files count. A glob reads only the matching files and skips that log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from stratalake.schemas import CORRUPT

# year / month / day / message file
BRONZE_GLOB = "*/*/*/*"


def _file_reader(spark: SparkSession, max_files: int | None) -> DataStreamReader:
    reader = spark.readStream.option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def json_stream(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    max_files: int | None = None,
    keep_corrupt: bool = True,
) -> DataFrame:
    """JSON files as they arrive. A line holding an array gives a row per element.

    ``NaN`` tokens are read. A line that is no JSON gives a row of nulls whose
    text is in ``_corrupt_record``.
    """
    schema = T.StructType(list(record.fields))
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
    return (
        _file_reader(spark, max_files)
        .schema(schema)
        .option("allowNonNumericNumbers", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Text files as they arrive, one row per line in ``value``."""
    return _file_reader(spark, max_files).format("text").load(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files as they arrive, such as landed bronze messages."""
    return _file_reader(spark, max_files).schema(schema).parquet(path)


def replay_feed(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """One packed day per micro-batch, from a feed sent day by day.

    The sender (:func:`stratalake.sinks.messages.send_in_order`) waits after each day, and the
    query is run to the end of what is there: a run is a batch, all files of that
    day are in it, and the checkpoint numbers the batches on.
    """
    return json_stream(spark, path, record)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages of one topic. Progress is kept in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()
