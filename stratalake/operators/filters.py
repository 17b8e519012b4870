"""Filters of the serving queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed value: the choice that means "no filter" --------------------------
ALL_STATES = "Todos"


def one_state(df: DataFrame, state: str | None, column: str = "estado") -> DataFrame:
    """Rows of one state; all rows for None or ``Todos``."""
    if state is None or state == ALL_STATES:
        return df
    return df.filter(F.col(column) == state)


def in_dates(
    df: DataFrame,
    column: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Rows from ``first`` to ``last``, both days whole; null dates go.

    The column is compared as it is stored, never cast, so the bounds reach the
    file scan: a timestamp is below the midnight after ``last``.
    """
    kind = df.schema[column].dataType
    on_days = isinstance(kind, T.DateType)
    cast_to = "date" if on_days else kind.simpleString()
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(first).cast(cast_to))
    if last is not None and on_days:
        df = df.filter(F.col(column) <= F.lit(last))
    elif last is not None:
        after = F.lit(last + dt.timedelta(days=1)).cast(cast_to)
        df = df.filter(F.col(column) < after)
    return df


def present(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


# Beyond this many intervals, the ones with the least gap between them become one.
MOST_INTERVALS = 64


def intervals(
    days: Iterable[dt.date], unit: str, most: int = MOST_INTERVALS
) -> list[tuple[dt.date, dt.date]]:
    """First day and the day after the last, of the days or months that ``days`` begin."""

    def after(day: dt.date) -> dt.date:
        if unit == "day":
            return day + dt.timedelta(days=1)
        return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)

    made: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if made and made[-1][1] >= day:
            made[-1] = (made[-1][0], after(day))
        else:
            made.append((day, after(day)))
    if len(made) > most:
        gaps = sorted(range(1, len(made)), key=lambda i: made[i][0] - made[i - 1][1])
        joined = set(gaps[: len(made) - most])
        wide: list[tuple[dt.date, dt.date]] = []
        for i, (first, end) in enumerate(made):
            if i in joined:
                wide[-1] = (wide[-1][0], end)
            else:
                wide.append((first, end))
        made = wide
    return made


def in_periods(df: DataFrame, column: str, periods: Iterable[dt.date | None], unit: str) -> DataFrame:
    """Rows whose date or timestamp is in one of some days or months, each named by its
    first day; None stands for rows without a date.

    Intervals of the stored column reach the scan, as partitions or as file statistics;
    the exact periods are then looked up in a set. A calendar bounds how many there are.
    """
    periods = list(periods)
    days = [day for day in periods if day is not None]
    at = F.col(column)
    wanted = F.lit(False)
    for first, end in intervals(days, unit):
        wanted = wanted | ((at >= F.lit(first)) & (at < F.lit(end)))
    if days:
        wanted = wanted & period_of(column, unit).isin(days)
    return df.filter(wanted | at.isNull() if None in periods else wanted)


def period_of(column: str, unit: str) -> Column:
    """The first day of a value's day or month."""
    day = F.to_date(column)
    return day if unit == "day" else F.trunc(day, "month")


def in_partitions(df: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the partitions named in ``touched``, a row each; null is one of them.

    Bounds of each column reach the scan, the rest is a semi-join without hints.
    """
    edges = touched.agg(
        *[F.min(c).alias(f"first_{i}") for i, c in enumerate(by)],
        *[F.max(c).alias(f"last_{i}") for i, c in enumerate(by)],
    ).first()
    for i, c in enumerate(by):
        if edges[f"first_{i}"] is None:
            df = df.filter(F.col(c).isNull())
        else:
            between = F.col(c).between(F.lit(edges[f"first_{i}"]), F.lit(edges[f"last_{i}"]))
            df = df.filter(between | F.col(c).isNull())
    rows, there = df.alias("rows"), touched.distinct().alias("there")
    equal = [F.col(f"rows.`{c}`").eqNullSafe(F.col(f"there.`{c}`")) for c in by]
    return rows.join(there, reduce(lambda a, b: a & b, equal), "left_semi")
