"""Gold to answers: the data behind each chart, card and filter list."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import day_of, month_start
from stratalake.operators.aggregates import bounds, distinct_sorted, keyed_total
from stratalake.operators.filters import ALL_STATES, in_dates, one_state, present
from stratalake.operators.joins import (
    date_summaries,
    join_on_date,
    joined_means,
    joined_trend,
)
from stratalake.operators.ordering import sort_rows


def production_series(
    gold: DataFrame, state: str | None = None, scale: int | None = None
) -> DataFrame:
    """``data, producao_mensal_total`` by month: one state, or all added up."""
    total = "producao_mensal_total"
    dated = one_state(gold, state).select(month_start().alias("data"), total)
    dated = present(dated, "data")
    if state is None or state == ALL_STATES:
        dated = keyed_total(dated, ["data"], total, total, scale)
    return dated.orderBy("data")


def production_states(gold: DataFrame) -> DataFrame:
    return distinct_sorted(gold, "estado")


def rain_and_price(mean_rain: DataFrame, mean_price: DataFrame) -> DataFrame:
    """Daily mean rain of each state beside the day's mean price."""
    return join_on_date(mean_rain, mean_price)


def rain_price_points(
    mean_rain: DataFrame, mean_price: DataFrame, state: str | None
) -> DataFrame:
    """Scatter points of one state."""
    return rain_and_price(one_state(mean_rain, state), mean_price).select(
        "precipitacao_media_diaria", "preco_medio_dolar"
    )


@dataclass(frozen=True)
class RainPriceRelation:
    """Daily total rain and single prices, related by date.

    A date may have several states and several prices; the relation pairs them
    all. ``state``, ``first`` and ``last`` are the viewer's filters. They are
    put on the two gold tables, before the join.
    """

    total_rain: DataFrame
    price_rows: DataFrame
    state: str | None = None
    first: dt.date | None = None
    last: dt.date | None = None

    def rain(self) -> DataFrame:
        """``data, estado, precipitacao_total_mm`` within the filters."""
        rain = one_state(self.total_rain, self.state)
        # the year is a stored column, so this part reaches the file scan
        if self.first is not None:
            rain = rain.filter(F.col("ano") >= self.first.year)
        if self.last is not None:
            rain = rain.filter(F.col("ano") <= self.last.year)
        dated = rain.select(day_of().alias("data"), "estado", "precipitacao_total_mm")
        return present(in_dates(dated, "data", self.first, self.last), "data")

    def prices(self) -> DataFrame:
        """``data, preco`` within the filters."""
        kept = in_dates(self.price_rows, "data", self.first, self.last)
        return present(kept.select(F.to_date("data").alias("data"), "preco"), "data")

    def rows(self) -> DataFrame:
        return join_on_date(self.rain(), self.prices())

    def rain_series(self) -> DataFrame:
        return sort_rows(
            self.rows().select("data", "estado", "precipitacao_total_mm"),
            ["data"],
            ties=["estado"],
        )

    def price_series(self) -> DataFrame:
        return sort_rows(self.rows().select("data", "preco"), ["data"], ties=["preco"])

    def _summaries(self) -> DataFrame:
        return date_summaries(
            self.rain(), "precipitacao_total_mm", self.prices(), "preco"
        )

    def mean_cards(self, digits: int = 2) -> DataFrame:
        """Mean rain and mean price over the related rows, rounded."""
        means = joined_means(self._summaries(), "precipitacao_media", "preco_medio")
        return means.select(
            *[F.round(name, digits).alias(name) for name in means.columns]
        )

    def trend_line(self) -> DataFrame:
        """Least-squares line of price on rain over the related rows."""
        return joined_trend(self._summaries())

    def states(self) -> DataFrame:
        """States that have a related row, in order."""
        days = self.prices().select("data").distinct()
        return distinct_sorted(self.rain().join(days, "data", "left_semi"), "estado")

    def date_range(self) -> DataFrame:
        """First and last related date."""
        days = self.rain().select("data").distinct()
        return bounds(days.join(self.prices().select("data").distinct(), "data"), "data")
