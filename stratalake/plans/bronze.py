"""Tables to JSON messages, and messages to bronze, unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import day_first_date, iso_timestamp
from stratalake.functions.messages import record_json, records_json
from stratalake.operators.ordering import sort_rows
from stratalake.operators.packing import pack
from stratalake.schemas import (
    CLIMATE_TABLE_KEY,
    PRODUCTION_CSV_COLUMNS,
    PRODUCTION_TABLE_KEY,
)

# Directory levels of bronze, by the day on which a message came in.
INGEST_PARTS = ("ingest_year", "ingest_month", "ingest_day")


def day_messages(
    df: DataFrame,
    by: str,
    unique_on: Sequence[str] | None = None,
    parts: int = 1,
    ordered: bool = False,
) -> DataFrame:
    """``key`` and ``value``: all rows of a date as one JSON array.

    With ``parts`` every date comes as so many arrays, and ``parte``, ``partes``
    and ``linhas`` say which one a message is. ``ordered`` sorts by date.
    """
    packed = pack(df, [by], unique_on=unique_on, parts=parts)
    sent = packed.select(
        F.col(by).cast("string").alias("key"),
        records_json("registros").alias("value"),
        "parte",
        "partes",
        "linhas",
    )
    return sort_rows(sent, ["key", "parte"]) if ordered else sent


def production_messages(
    table: DataFrame,
    parts: int = 1,
    unique_on: Sequence[str] | None = PRODUCTION_TABLE_KEY,
    ordered: bool = False,
) -> DataFrame:
    """A month's production of all states per message."""
    dated = table.withColumn("data", iso_timestamp(F.col("data")))
    return day_messages(
        dated.select(*PRODUCTION_CSV_COLUMNS), "data", unique_on, parts, ordered
    )


def climate_messages(
    table: DataFrame, parts: int = 1, ordered: bool = False
) -> DataFrame:
    """A day's rain at all hubs per message."""
    return day_messages(table, "date", CLIMATE_TABLE_KEY, parts, ordered)


def price_table(csv: DataFrame, ascending: bool = True, ordered: bool = True) -> DataFrame:
    """Price rows with ``data`` parsed day first, oldest or newest first."""
    dated = csv.withColumn("data", day_first_date(F.col("data")).cast("timestamp"))
    return sort_rows(dated, ["data"], ascending=ascending) if ordered else dated


def price_messages(prices: DataFrame) -> DataFrame:
    """One JSON object per price row, all columns in it."""
    columns: list[Column] = [F.col(f"`{name}`") for name in prices.columns]
    return prices.select(
        F.date_format("data", "yyyy-MM-dd").alias("key"),
        record_json(*columns).alias("value"),
    )


def _is_line() -> Column:
    text = F.col("value").cast("string")
    return F.coalesce(F.is_valid_utf8(text) & ~text.rlike(r"[\r\n]"), F.lit(False))


def not_text(messages: DataFrame) -> DataFrame:
    """The messages that landing as text cannot keep as they are."""
    return messages.filter(~_is_line())


def landed(
    messages: DataFrame, arrived: Column | None = None, as_text: bool = False
) -> DataFrame:
    """Messages with the day of their arrival, for a sink partitioned by it.

    The payload is not parsed or changed. With ``as_text`` only its text stays,
    one line per message, as the text sink wants; otherwise topic, partition,
    offset and the like stay beside it. A text file cannot hold a payload with a
    line break, a null or bytes that are no UTF-8: with ``as_text`` those are left
    to :func:`not_text`, and only Parquet keeps every payload.
    """
    if as_text:
        messages = messages.filter(_is_line())
    when = F.current_timestamp() if arrived is None else arrived
    value = F.col("value").cast("string") if as_text else F.col("value")
    kept = [] if as_text else [F.col(n) for n in messages.columns if n != "value"]
    return messages.select(
        value.alias("value"),
        *kept,
        F.date_format(when, "yyyy").alias(INGEST_PARTS[0]),
        F.date_format(when, "MM").alias(INGEST_PARTS[1]),
        F.date_format(when, "dd").alias(INGEST_PARTS[2]),
    )
