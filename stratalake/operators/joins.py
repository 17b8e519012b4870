"""Joins on a date, and statistics of such a join taken without its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.numbers import without_nan
from stratalake.operators.sizing import settled


def join_on_date(left: DataFrame, right: DataFrame, on: str = "data") -> DataFrame:
    """Inner equi-join; null dates match nothing.

    No hint: the sides are gold tables or silver rows of unknown size. Adaptive
    execution broadcasts a side it has measured to be small and otherwise
    splits the partitions of a hot date.
    """
    return left.join(right, on, "inner")


def _per_date(df: DataFrame, value: str, on: str, tag: str) -> DataFrame:
    v = without_nan(F.col(value))
    return (
        df.filter(F.col(on).isNotNull())
        .groupBy(on)
        .agg(
            F.count(F.lit(1)).cast("double").alias(f"{tag}_rows"),
            F.count(v).cast("double").alias(f"{tag}_n"),
            F.avg(v).alias(f"{tag}_mean"),
            F.var_pop(v).alias(f"{tag}_var"),
        )
    )


def date_summaries(
    left: DataFrame, left_value: str, right: DataFrame, right_value: str, on: str = "data"
) -> DataFrame:
    """One row per date that both sides have: counts, means and variances.

    On one date the join pairs every left row with every right row. So all
    statistics of the joined rows follow from these per-date figures, and the
    pairs, n times m on a hot date, need never be formed.
    """
    return _per_date(left, left_value, on, "x").join(
        _per_date(right, right_value, on, "y"), on, "inner"
    )


def joined_means(summaries: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Means of both values over the joined rows."""

    def mean(tag: str, other: str) -> Column:
        weight = F.col(f"{tag}_n") * F.col(f"{other}_rows")
        return F.try_divide(F.sum(F.col(f"{tag}_mean") * weight), F.sum(weight))

    return summaries.agg(mean("x", "y").alias(left_name), mean("y", "x").alias(right_name))


def joined_trend(summaries: DataFrame) -> DataFrame:
    """Least-squares line of the right value on the left one over the joined rows.

    Squares are taken about the overall means, which keeps the digits that raw
    sums of squares would lose. That takes two passes; the summaries, a row per
    date, are settled first, so the tables beneath them are read once.
    """
    pairs = F.col("x_n") * F.col("y_n")
    used = settled(summaries.withColumn("w", pairs).filter(F.col("w") > 0))
    centre = used.agg(
        F.sum("w").alias("w"),
        F.try_divide(F.sum(F.col("x_mean") * F.col("w")), F.sum("w")).alias("cx"),
        F.try_divide(F.sum(F.col("y_mean") * F.col("w")), F.sum("w")).alias("cy"),
    )
    dx = F.col("x_mean") - centre.select("cx").scalar()
    dy = F.col("y_mean") - centre.select("cy").scalar()
    w = F.col("w")
    spread = used.agg(
        F.sum(w * (F.col("x_var") + dx * dx)).alias("sxx"),
        F.sum(w * (F.col("y_var") + dy * dy)).alias("syy"),
        F.sum(w * dx * dy).alias("sxy"),
        F.sum(w * F.col("x_mean")).alias("sx"),
        F.sum(w * F.col("y_mean")).alias("sy"),
        F.sum(w).alias("n"),
    )
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    flat = F.when((F.col("sxx") > 0) & (F.col("syy") == 0), F.lit(1.0))
    return spread.select(
        slope.alias("inclinacao"),
        F.try_divide(F.col("sy") - slope * F.col("sx"), F.col("n")).alias("intercepto"),
        F.coalesce(
            flat, F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy"))
        ).alias("r2"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("pontos"),
    )
