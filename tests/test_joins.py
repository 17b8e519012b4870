import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.operators.aggregates import bounds, distinct_sorted, row_counts, trend
from stratalake.operators.joins import date_summaries, join_on_date, joined_means, joined_trend

DAY = dt.date(2024, 1, 1)


def sample(spark, seed, rows, name, shift=0.0):
    """A third of the rows on one date; some values null or NaN, some dates null."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        day = DAY if i % 3 == 0 else DAY + dt.timedelta(days=rng.randrange(1, 30))
        value = rng.choice([None, float("nan")]) if rng.random() < 0.1 else shift + rng.random() * 10
        data.append((None if rng.random() < 0.02 else day, value))
    return spark.createDataFrame(data, f"data date, {name} double")


def test_null_dates_match_nothing(spark, rows):
    a = spark.createDataFrame([(DAY, 1), (None, 2)], "data date, x int")
    b = spark.createDataFrame([(DAY, 3), (None, 4)], "data date, y int")
    assert rows(join_on_date(a, b)) == [(DAY, 1, 3)]


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_summaries_give_the_statistics_of_the_joined_rows(spark, shift):
    x, y = sample(spark, 1, 300, "x", shift), sample(spark, 2, 200, "y", shift)
    pairs = join_on_date(x, y).toPandas()
    summaries = date_summaries(x, "x", y, "y")

    means = joined_means(summaries, "mx", "my").first()
    assert means.mx == pytest.approx(pairs.x.mean(), rel=1e-12)
    assert means.my == pytest.approx(pairs.y.mean(), rel=1e-12)

    both = pairs.dropna()
    line = joined_trend(summaries).first()
    slope, intercept = np.polyfit(both.x - shift, both.y, 1)
    assert line.pontos == len(both)
    assert line.inclinacao == pytest.approx(slope, rel=1e-6)
    assert line.intercepto == pytest.approx(intercept - slope * shift, rel=1e-6)
    assert line.r2 == pytest.approx(np.corrcoef(both.x, both.y)[0, 1] ** 2, rel=1e-5)


def test_summaries_agree_with_the_built_in_trend(spark):
    x, y = sample(spark, 3, 150, "x"), sample(spark, 4, 150, "y")
    plain = trend(join_on_date(x, y), "x", "y").first()
    line = joined_trend(date_summaries(x, "x", y, "y")).first()
    for name in ("inclinacao", "intercepto", "r2"):
        assert line[name] == pytest.approx(plain[name], rel=1e-9)
    assert line.pontos == plain.pontos


def test_statistics_without_common_dates(spark):
    x = spark.createDataFrame([(DAY, 1.0)], "data date, x double")
    y = spark.createDataFrame([(DAY + dt.timedelta(1), 1.0)], "data date, y double")
    summaries = date_summaries(x, "x", y, "y")
    assert tuple(joined_means(summaries, "a", "b").first()) == (None, None)
    assert tuple(joined_trend(summaries).first()) == (None, None, None, 0)


def test_trend_of_a_flat_line(spark):
    days = [DAY + dt.timedelta(i) for i in range(3)]
    x = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "data date, x double")
    y = spark.createDataFrame([(d, 5.0) for d in days], "data date, y double")
    line = joined_trend(date_summaries(x, "x", y, "y")).first()
    assert tuple(line) == (0.0, 5.0, 1.0, 3)


def test_summaries_do_not_pair_rows(spark):
    x, y = sample(spark, 5, 100, "x"), sample(spark, 6, 100, "y")
    summaries = date_summaries(x, "x", y, "y")
    plan = summaries._jdf.queryExecution().toString()
    assert plan.count("partial_count") >= 2
    for df in (summaries, joined_means(summaries, "a", "b"), joined_trend(summaries)):
        plan = df._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_trend_reads_its_tables_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def tick(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    x = sample(spark, 7, 90, "x").mapInArrow(tick, "data date, x double")
    y = sample(spark, 8, 60, "y").mapInArrow(tick, "data date, y double")
    assert joined_trend(date_summaries(x, "x", y, "y")).first().pontos > 0
    assert reads.value == 150


def test_bounds_distinct_counts(spark, rows):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (None, None), (2, "b")], "n int, s string")
    assert tuple(bounds(df, "n").first()) == (1, 3)
    assert [r.s for r in distinct_sorted(df, "s").collect()] == ["a", "b"]
    assert row_counts(df).first().linhas == 4
    assert rows(row_counts(df.filter(F.col("s").isNotNull()), ["s"])) == [("a", 1), ("b", 2)]


def test_row_join_splits_a_hot_date(spark):
    """Without a broadcast, adaptive execution cuts the hot date's partition up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        prices = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(DAY))
            .otherwise(F.date_add(F.lit(DAY), (F.col("id") % 900).cast("int")))
            .alias("data"),
            F.col("id").alias("preco"),
        )
        rain = spark.range(0, 900, 1, 4).select(
            F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("data"), F.col("id").alias("mm")
        )
        joined = join_on_date(rain, prices)
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
