"""Aggregations. All of them combine within each task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numbers import fixed_mean, fixed_sum, without_nan


def keyed_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | None = None
) -> DataFrame:
    total = fixed_sum(without_nan(F.col(value)), scale)
    return df.groupBy(*keys).agg(total.alias(name))


def keyed_mean(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | None = None
) -> DataFrame:
    mean = fixed_mean(without_nan(F.col(value)), scale)
    return df.groupBy(*keys).agg(mean.alias(name))


def row_counts(df: DataFrame, keys: Sequence[str] = (), name: str = "linhas") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row with the least and greatest value, ``inicio`` and ``fim``."""
    return df.agg(F.min(column).alias("inicio"), F.max(column).alias("fim"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values in order."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` over the rows that have both."""
    a, b = without_nan(F.col(x)), without_nan(F.col(y))
    return df.agg(
        F.regr_slope(b, a).alias("inclinacao"),
        F.regr_intercept(b, a).alias("intercepto"),
        F.regr_r2(b, a).alias("r2"),
        F.regr_count(b, a).alias("pontos"),
    )
