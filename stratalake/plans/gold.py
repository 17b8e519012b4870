"""Silver to gold.

``unique_on`` names the business key of the silver rows. Messages are replayed
and silver only appends, so a sum over silver would count a row once per replay;
with the key equal rows count once. Different rows of one key all count, unless
``newest_by`` names the column by which the last one replaces the others. ``scale`` is the number of decimal places of
the values, where they have a fixed one (see ``functions.numbers``).

Results are not sorted: a gold table is written, and sorted where it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import date_parts
from stratalake.operators.aggregates import keyed_mean, keyed_total
from stratalake.operators.quality import drop_replays

# --- fixed values: the sort order of each gold table -------------------------
MONTHLY_PRODUCTION_ORDER = ("ano", "mes", "estado")
DAILY_MEAN_RAIN_ORDER = ("data", "estado")
DAILY_MEAN_PRICE_ORDER = ("data",)
DAILY_TOTAL_RAIN_ORDER = ("ano", "mes", "dia", "estado")


def _once(
    silver: DataFrame, unique_on: Sequence[str] | None, newest_by: str | None
) -> DataFrame:
    return drop_replays(silver, unique_on, newest_by) if unique_on else silver


def _day(column: str) -> Column:
    return F.to_date(F.col(column))


def monthly_production(
    silver: DataFrame,
    unique_on: Sequence[str] | None = None,
    scale: int | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """``ano, mes, estado, producao_mensal_total``.

    Grouped on the month's first day, one key instead of two; the parts are
    taken from the few rows that remain.
    """
    month = F.trunc(_day("data"), "month")
    totals = keyed_total(
        _once(silver, unique_on, newest_by).withColumn("data", month),
        ["data", "estado"],
        "producao",
        "producao_mensal_total",
        scale,
    )
    year, month, _ = date_parts(F.col("data"))
    return totals.select(year, month, "estado", "producao_mensal_total")


def daily_mean_rain(
    silver: DataFrame,
    unique_on: Sequence[str] | None = None,
    scale: int | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """``data, estado, precipitacao_media_diaria``."""
    return keyed_mean(
        _once(silver, unique_on, newest_by),
        ["data", "estado"],
        "precipitacao_mm",
        "precipitacao_media_diaria",
        scale,
    )


def daily_mean_price(
    silver: DataFrame,
    unique_on: Sequence[str] | None = None,
    scale: int | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """``data, preco_medio_dolar``; the date is that of the session time zone."""
    dated = _once(silver, unique_on, newest_by).select(_day("timestamp").alias("data"), "preco")
    return keyed_mean(dated, ["data"], "preco", "preco_medio_dolar", scale)


def daily_total_rain(
    silver: DataFrame,
    unique_on: Sequence[str] | None = None,
    scale: int | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """``ano, mes, dia, estado, precipitacao_total_mm``."""
    totals = keyed_total(
        _once(silver, unique_on, newest_by).withColumn("data", _day("data")),
        ["data", "estado"],
        "precipitacao_mm",
        "precipitacao_total_mm",
        scale,
    )
    return totals.select(*date_parts(F.col("data")), "estado", "precipitacao_total_mm")


def price_rows(
    silver: DataFrame, unique_on: Sequence[str] | None = None, newest_by: str | None = None
) -> DataFrame:
    """``data, preco, ano, mes, dia``, one per silver row."""
    return _once(silver, unique_on, newest_by).select(
        F.col("timestamp").alias("data"), "preco", *date_parts(F.col("timestamp"))
    )
