"""Rows to JSON text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.schemas import PRICE_TIMESTAMP_FORMAT

_WRITE_OPTIONS = {
    "timestampFormat": PRICE_TIMESTAMP_FORMAT,
    "timestampNTZFormat": PRICE_TIMESTAMP_FORMAT,
    "ignoreNullFields": "false",
}


def record_json(*columns: str | Column) -> Column:
    """One JSON object per row; null fields stay in it."""
    return F.to_json(F.struct(*columns), _WRITE_OPTIONS)


def records_json(records: str | Column) -> Column:
    """One JSON array from an array of structs."""
    return F.to_json(records, _WRITE_OPTIONS)


def parse_records(text: str | Column, record: T.StructType) -> Column:
    """Array of records from JSON text.

    A bare object reads as one record, a field of the wrong type as null, and
    text that is no JSON as a null array.
    """
    return F.from_json(text, T.ArrayType(record))
