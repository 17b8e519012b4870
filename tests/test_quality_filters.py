import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.operators.filters import in_dates, one_state, present
from stratalake.operators.ordering import first_rows, sort_rows
from stratalake.operators.quality import (
    append_absent,
    drop_incomplete,
    drop_replays,
    require_columns,
    require_rows,
    split_rejects,
)

D = dt.date


def test_guards(spark):
    df = spark.createDataFrame([], "data string, producao string")
    require_columns(df, ["data"])
    with pytest.raises(ValueError, match="unidade_federativa"):
        require_columns(df, ["data", "unidade_federativa"])
    with pytest.raises(ValueError, match="no rows"):
        require_rows(df)


def test_drop_incomplete_takes_nan_for_missing(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)], "k int, v double")
    assert rows(drop_incomplete(df, ["k", "v"])) == [(1, 1.0)]
    assert len(rows(drop_incomplete(df, ["k"]))) == 3


def test_drop_replays_of_equal_copies(spark, rows):
    base = [
        (D(2015, 1, 1), "BA", 1.0), (D(2015, 1, 1), "BA", 9.0), (D(2015, 1, 1), "MT", 2.0),
        (None, "MT", 3.0), (None, "MT", 4.0), (None, None, 5.0),
    ]
    df = spark.createDataFrame(base * 50, "data date, estado string, producao double").repartition(4)
    assert rows(drop_replays(df, ["data", "estado"])) == sorted(base, key=repr)


def test_drop_replays_newest_wins_and_keeps_columns(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0, 1, "x"), ("a", 9.0, 3, "y"), ("a", 5.0, 2, None), ("b", None, 1, "z")],
        "k string, v double, seq int, note string",
    )
    df = df.unionByName(df.filter("k = 'b'").selectExpr("cast(null as string) k", "v", "seq", "note"))
    df = df.unionByName(df.filter("k is null").withColumn("note", F.lit("other"))).unionByName(df)
    kept = drop_replays(df, ["k"], newest_by="seq")
    nameless = kept.filter("k is null")
    assert sorted(r.note for r in nameless.collect()) == ["other", "z"]
    kept = kept.filter("k is not null")
    assert kept.columns == df.columns
    assert rows(kept) == [("a", 9.0, 3, "y"), ("b", None, 1, "z")]


def test_drop_replays_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = drop_replays(df.repartition(4), ["k"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert before.index("HashAggregate(keys=[k") < before.index("Exchange RoundRobin")


def test_append_absent_keeps_the_key_unique(spark, rows):
    stored = spark.createDataFrame([("2015-01-01", "Sorriso", 1.0)], "date string, hub string, mm double")
    new = spark.createDataFrame(
        [("2015-01-01", "Sorriso", 9.0), ("2015-01-02", "Sorriso", 2.0), ("2015-01-02", "Sorriso", 2.0)],
        stored.schema,
    )
    assert rows(append_absent(new, stored, ["date", "hub"])) == [("2015-01-02", "Sorriso", 2.0)]


def test_split_rejects_parts_all_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, s string")
    good, bad = split_rejects(df, ["k", "s"])
    assert rows(good) == [(1, "a")]
    assert len(rows(bad)) == 2


def test_one_state(spark, rows):
    df = spark.createDataFrame([("BA",), ("MT",), (None,)], "estado string")
    assert rows(one_state(df, "BA")) == [("BA",)]
    assert len(rows(one_state(df, None))) == len(rows(one_state(df, "Todos"))) == 3


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_date_range_is_closed_and_drops_nulls(spark, kind):
    days = [None, "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-03 23:30:00", "2024-01-04 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "t string")
    df = df.select(F.col("t").try_cast(kind).alias("data"))
    kept = in_dates(df, "data", D(2024, 1, 2), D(2024, 1, 3))
    assert kept.count() == 2


def test_present(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert rows(present(df, "a", "b")) == [(3, 4)]


def test_sort_is_global_and_splits_copies(spark):
    hot = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k")
    )
    ordered = sort_rows(hot, ["k"], ascending=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ordered.filter("k = 7").select(F.spark_partition_id().alias("p")).distinct()
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [r.k for r in ordered.collect()]
    assert got == sorted(got, reverse=True)
    assert len(got) == 6000


def test_preview(spark):
    df = sort_rows(spark.range(100), ["id"], ascending=False)
    assert [r.id for r in first_rows(df).collect()] == [99, 98, 97, 96, 95]
