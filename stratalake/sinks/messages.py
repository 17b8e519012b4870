"""JSON messages to a topic or to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import drop_path, work_path

# Beside key and value: which part of its group a message is.
PART_COLUMNS = ("parte", "partes", "linhas")


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``key`` and ``value`` to a Kafka topic, part numbers as headers."""
    sent = [F.col("key").cast("string"), F.col("value").cast("string")]
    numbers = [name for name in PART_COLUMNS if name in messages.columns]
    if numbers:
        headers = F.array(
            *[
                F.struct(
                    F.lit(name).alias("key"),
                    F.col(name).cast("string").cast("binary").alias("value"),
                )
                for name in numbers
            ]
        )
        sent.append(headers.alias("headers"))
    (
        messages.select(*sent)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_lines(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Each message as a line of a text file.

    A line is the message alone; where groups come in several parts, use
    :func:`write_table`, which keeps their numbers.
    """
    messages.selectExpr("cast(value as string) value").write.mode(mode).text(path)


def write_table(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as Parquet, with key and part numbers as columns."""
    messages.write.mode(mode).parquet(path)


def send_in_order(
    messages: DataFrame, path: str, after_each: Callable[[str], None] | None = None
) -> list[str]:
    """Messages to text files under ``path``, key after key in ascending order.

    All messages of a key are there before the next key's, and ``after_each`` is
    called in between. The keys of a feed are its days, so there are few of them.
    The messages are made once, as a work table parted by key, and sent from there.
    """
    spark = messages.sparkSession
    stored = work_path(spark, "messages-in-order")
    slot = F.xxhash64(F.col("key").cast("string"))
    messages.select(F.col("key").cast("string"), F.col("value").cast("string"), slot.alias("_slot")).write.partitionBy(
        "_slot"
    ).parquet(stored)
    made = spark.read.schema("key string, value string, _slot long").parquet(stored)
    keys = made.select("_slot", "key").distinct().orderBy("key").collect()
    for number, key in keys:
        day = made.filter((F.col("_slot") == number) & F.col("key").eqNullSafe(F.lit(key)))
        write_lines(day.hint("rebalance"), path)  # no empty files
        if after_each is not None:
            after_each(key)
    drop_path(spark, stored)
    return [key for _, key in keys]
