"""Stored per-date figures of the rain and price relation, a row per date.

A figure row holds how many rows there are, how many have a value, their mean, and the
sum of squares about it (``linhas, n, media, m2``). Such rows are merged without the rows
they stand for, so cards and the trend line of any range of dates read a row per date (and
state), and a changed date replaces its own rows alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numbers import without_nan
from stratalake.operators.filters import in_dates, one_state
from stratalake.operators.joins import joined_means, joined_trend
from stratalake.plans.gold import daily_total_rain, price_rows

FIGURES = ("linhas", "n", "media", "m2")


def summarize(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Figures of ``value`` for each combination of ``by``."""
    v = without_nan(F.col(value))
    n = F.count(v)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("linhas"),
        n.alias("n"),
        F.avg(v).alias("media"),
        F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2"),
    )


def _merged(a: Column, b: Column) -> Column:
    """Figures of two sets of rows together."""
    n = a["n"] + b["n"]
    apart = F.coalesce(b["media"] - a["media"], F.lit(0.0))
    shift = F.coalesce(apart * F.try_divide(b["n"], n), F.lit(0.0))
    return F.struct(
        (a["linhas"] + b["linhas"]).alias("linhas"),
        n.alias("n"),
        F.when(a["n"] == 0, b["media"]).otherwise(a["media"] + shift).alias("media"),
        (a["m2"] + b["m2"] + F.coalesce(apart * shift * a["n"], F.lit(0.0))).alias("m2"),
    )


def merge_summaries(summaries: DataFrame, by: Sequence[str], over: Sequence[str]) -> DataFrame:
    """Figures for ``by`` from those for ``by`` and ``over``, merged in the order of ``over``.

    Made for the few rows of a date, such as its states, which meet in one task.
    """
    none = F.struct(
        F.lit(0).cast("long").alias("linhas"),
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("double").alias("media"),
        F.lit(0.0).alias("m2"),
    )
    own = F.array_sort(F.collect_list(F.struct(*over, *FIGURES)))
    return summaries.groupBy(*by).agg(F.aggregate(own, none, _merged).alias("_f")).select(
        *by, *[F.col("_f")[name].alias(name) for name in FIGURES]
    )


def rain_summaries(silver: DataFrame, **build: object) -> DataFrame:
    """``data, estado``, the figures of the day's total rain, and ``ano, mes``."""
    total = daily_total_rain(silver, **build)
    day = F.make_date("ano", "mes", "dia").alias("data")
    rows = total.select(day, "estado", "precipitacao_total_mm")
    return _with_month(summarize(rows, ["data", "estado"], "precipitacao_total_mm"))


def price_summaries(silver: DataFrame, **build: object) -> DataFrame:
    """``data``, the figures of the day's prices, and ``ano, mes``."""
    rows = price_rows(silver, **build).select(F.to_date("data").alias("data"), "preco")
    return _with_month(summarize(rows, ["data"], "preco"))


def _with_month(figures: DataFrame) -> DataFrame:
    """With the columns that a stored table is parted by: a row a day is too few rows for
    a folder a day."""
    return figures.withColumns({"ano": F.year("data"), "mes": F.month("data")})


@dataclass(frozen=True)
class RainPriceSummaries:
    """The cards and the trend line of :class:`stratalake.plans.serve.RainPriceRelation`
    from stored figures. Null dates relate to nothing."""

    rain: DataFrame
    price: DataFrame
    state: str | None = None
    first: dt.date | None = None
    last: dt.date | None = None

    def per_date(self) -> DataFrame:
        """One row per related date, as :func:`stratalake.operators.joins.date_summaries`."""

        def side(df: DataFrame, tag: str) -> DataFrame:
            # the year is a folder, so this part leaves files unopened
            if self.first is not None:
                df = df.filter(F.col("ano") >= self.first.year)
            if self.last is not None:
                df = df.filter(F.col("ano") <= self.last.year)
            kept = in_dates(df, "data", self.first, self.last).filter(F.col("data").isNotNull())
            if "estado" in df.columns:
                kept = merge_summaries(one_state(kept, self.state), ["data"], ["estado"])
            return kept.select(
                "data",
                F.col("linhas").cast("double").alias(f"{tag}_rows"),
                F.col("n").cast("double").alias(f"{tag}_n"),
                F.col("media").alias(f"{tag}_mean"),
                F.try_divide("m2", "n").alias(f"{tag}_var"),
            )

        return side(self.rain, "x").join(side(self.price, "y"), "data")

    def mean_cards(self, digits: int = 2) -> DataFrame:
        means = joined_means(self.per_date(), "precipitacao_media", "preco_medio")
        return means.select(*[F.round(name, digits).alias(name) for name in means.columns])

    def trend_line(self) -> DataFrame:
        return joined_trend(self.per_date())
