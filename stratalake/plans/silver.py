"""Bronze to silver. Each function serves a batch and a stream alike.

``also`` names raw columns that a silver row keeps, such as the message and the
fields' texts from :func:`checked_records`, by which bad rows go to quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.dates import (
    date_text,
    iso_date,
    month_label_date,
    price_timestamp,
)
from stratalake.functions.messages import parse_records
from stratalake.functions.numbers import decimal_comma, numeric
from stratalake.functions.states import state_code
from stratalake.operators.packing import unpack
from stratalake.operators.quality import drop_incomplete
from stratalake.schemas import (
    CORRUPT,
    PRICE_TIMESTAMP_FORMAT,
    PRODUCTION_CSV_COLUMNS,
    PRODUCTION_RECORD,
)


def clean_production_csv(csv: DataFrame) -> DataFrame:
    """Rows with a good month label and amount; ``data`` is the month's first day."""
    state = "unidade_federativa"
    parsed = drop_incomplete(csv, PRODUCTION_CSV_COLUMNS).select(
        month_label_date(F.col("data")).alias("data"),
        state,
        numeric(F.col("producao")).alias("producao"),
    )
    return drop_incomplete(parsed, ("data", "producao"))


def climate(raw: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        iso_date(F.col("date")).alias("data"),
        F.col("hub").alias("cidade"),
        F.col("state").alias("estado"),
        F.col("precipitation_mm").alias("precipitacao_mm"),
        *also,
    )


def prices(
    raw: DataFrame,
    also: Sequence[str] = (),
    grouped: bool = False,
    fmt: str = PRICE_TIMESTAMP_FORMAT,
    dated: bool = False,
) -> DataFrame:
    """``timestamp, preco``, and with ``dated`` also ``data`` to partition by.

    Partitioned by the timestamp itself, silver would get a folder per instant.
    """
    stamped = raw.select(
        price_timestamp(F.col("data"), fmt).alias("timestamp"),
        decimal_comma(F.col("último"), grouped).alias("preco"),
        *also,
    )
    return stamped.withColumn("data", F.to_date("timestamp")) if dated else stamped


def records(messages: DataFrame, record: T.StructType) -> DataFrame:
    """The records in the messages' ``value``, text or bytes, one per row."""
    parsed = parse_records(F.col("value").cast("string"), record)
    return unpack(messages.select(parsed.alias("registros")))


def checked_records(messages: DataFrame, record: T.StructType) -> DataFrame:
    """Like :func:`records`, with ``value``, the message as it was sent, and
    ``_texts``, each field as text. A message that is no JSON is one row of nulls,
    so nothing that came in is missing."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in record.fields])
    value = F.col("value").cast("string")
    both = messages.select(
        value.alias("value"),
        parse_records(value, record).alias("_typed"),
        parse_records(value, texts).alias("_said"),
    )
    pairs = F.when(
        F.col("_typed").isNotNull() & F.col("_said").isNotNull(),
        F.arrays_zip("_typed", "_said"),
    ).otherwise(F.array(F.struct(
        F.lit(None).cast(record).alias("_typed"), F.lit(None).cast(texts).alias("_said")
    )))
    rows = both.select("value", F.explode(pairs).alias("_pair"))
    return rows.select("_pair._typed.*", "value", F.col("_pair._said").alias("_texts"))


def numbered_records(messages: DataFrame, record: T.StructType) -> DataFrame:
    """Like :func:`checked_records`, with ``_mensagem`` and ``_numero``: which message of
    its batch a record came in, and as which of its records (from 1). The first
    of them tells apart messages that say the same. For plans of one batch, as a
    stream's sink gets them, and for batch reads.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in record.fields])
    value = F.col("value").cast("string")
    both = messages.select(
        F.monotonically_increasing_id().alias("_mensagem"),
        value.alias("value"),
        parse_records(value, record).alias("_typed"),
        parse_records(value, texts).alias("_said"),
    )
    readable = F.col("_typed").isNotNull() & F.col("_said").isNotNull()
    nothing = F.array(
        F.struct(F.lit(None).cast(record).alias("_typed"), F.lit(None).cast(texts).alias("_said"))
    )
    pairs = F.when(readable, F.arrays_zip("_typed", "_said")).otherwise(nothing)
    return both.select(
        "_mensagem", "value", F.posexplode(pairs).alias("_at", "_pair")
    ).select(
        "_pair._typed.*",
        "_mensagem",
        (F.col("_at") + 1).alias("_numero"),
        "value",
        F.col("_pair._said").alias("_texts"),
    )


def numbered_json(raw: DataFrame) -> DataFrame:
    """Rows of the JSON source with the columns of :func:`numbered_records`.

    The source keeps the text of a line that it could not read, or not in full, so a
    row with such text counts as unreadable as a whole, and is number 1.
    """
    fields = [F.col(f"`{name}`") for name in raw.columns if name != CORRUPT]
    said = F.struct(
        *[F.col(f"`{name}`").cast("string").alias(name) for name in raw.columns if name != CORRUPT]
    )
    return raw.select(
        *fields,
        F.monotonically_increasing_id().alias("_mensagem"),
        F.lit(1).alias("_numero"),
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*fields))).alias("value"),
        F.when(F.col(CORRUPT).isNull(), said).alias("_texts"),
    )


def rejected(fields: Mapping[str, str], key: Sequence[str]) -> Column:
    """True for rows whose key is incomplete, or whose value did not parse.

    ``fields`` names the record's field of each silver column: text was sent, and
    the column is null. An empty JSON null is no text.
    """
    unkeyed = [F.col(f"`{name}`").isNull() for name in key]
    unread = [
        F.col(f"`{column}`").isNull() & F.col("_texts").getField(field).isNotNull()
        for column, field in fields.items()
    ]
    return reduce(lambda a, b: a | b, unkeyed + unread)


def production_rows(
    raw: DataFrame, also: Sequence[str] = (), state_codes: bool = False
) -> DataFrame:
    """``state_codes`` writes states as rain has them, for joins of the two."""
    state = F.col("unidade_federativa")
    return raw.select(
        iso_date(F.col("data")).alias("data"),
        (state_code(state) if state_codes else state).alias("estado"),
        "producao",
        *also,
    )


def production(messages: DataFrame) -> DataFrame:
    """Silver production from messages in ``value``."""
    return production_rows(records(messages, PRODUCTION_RECORD))


def station_rows(sampled: DataFrame) -> DataFrame:
    """Rows of the climate table from a grid sampled at the hubs."""
    return sampled.select(
        date_text(F.col("date")).alias("date"),
        "hub",
        "state",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("precip").alias("precipitation_mm"),
    )


def unreadable_json(raw: DataFrame) -> DataFrame:
    """Lines the JSON source could make nothing of, for quarantine."""
    fields = [F.col(f"`{name}`").isNull() for name in raw.columns if name != CORRUPT]
    nothing = reduce(lambda a, b: a & b, fields)
    return raw.filter(F.col(CORRUPT).isNotNull() & nothing).select(
        F.col(CORRUPT).alias("value")
    )


def unreadable_records(messages: DataFrame, record: T.StructType) -> DataFrame:
    """Texts of the messages that :func:`records` can make nothing of, for quarantine."""
    text = F.col("value").cast("string")
    return messages.select(text.alias("value")).filter(
        parse_records(F.col("value"), record).isNull()
    )
