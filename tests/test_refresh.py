"""Gold of changed dates, and the filters that choose them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratalake import jobs
from stratalake.operators.filters import in_partitions, in_periods, intervals
from stratalake.plans import gold
from stratalake.plans.refresh import Periods, read_gold, refresh_gold

D = dt.date
DAILY = Periods("data", "day", ("data",))


def files(path):
    return {
        os.path.join(os.path.relpath(folder, path), name)
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def climate(spark, rows):
    return spark.createDataFrame(rows, "data date, cidade string, estado string, precipitacao_mm double")


def test_a_late_date_rewrites_its_partition_only(spark, tmp_path, rows):
    silver, out, cp = (str(tmp_path / n) for n in ("silver", "gold", "cp"))
    base = [(D(2024, 1, d), "A", s, float(d)) for d in range(1, 20) for s in ("BA", "MT")]
    base += [(None, "A", "BA", 3.0)]
    climate(spark, base).write.parquet(silver)
    columns = ["data", "estado", "precipitacao_media_diaria"]

    def run():
        return refresh_gold(spark, silver, out, cp, gold.daily_mean_rain, DAILY)

    assert run() == 20
    before = files(out)
    assert run() == 0 and files(out) == before
    climate(spark, [(D(2024, 1, 7), "B", "BA", 20.0)]).write.mode("append").parquet(silver)
    assert run() == 1
    changed = files(out) ^ before
    assert changed and all(name.startswith("data=2024-01-07/") for name in changed)
    whole = gold.daily_mean_rain(spark.read.parquet(silver))
    assert rows(read_gold(spark, out, columns)) == rows(whole.select(columns))
    climate(spark, [(None, "B", "BA", 5.0)]).write.mode("append").parquet(silver)
    assert run() == 1
    assert rows(read_gold(spark, out, columns)) == rows(gold.daily_mean_rain(spark.read.parquet(silver)).select(columns))


def test_a_run_that_failed_is_made_good(spark, tmp_path, rows):
    silver, out, cp = (str(tmp_path / n) for n in ("silver", "gold", "cp"))
    climate(spark, [(D(2024, 1, 1), "A", "BA", 1.0)]).write.parquet(silver)
    refresh_gold(spark, silver, out, cp, gold.daily_mean_rain, DAILY)
    climate(spark, [(D(2024, 1, 2), "A", "BA", 2.0)]).write.mode("append").parquet(silver)

    def broken(_):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        refresh_gold(spark, silver, out, cp, broken, DAILY)
    assert refresh_gold(spark, silver, out, cp, gold.daily_mean_rain, DAILY) == 1
    assert len(rows(spark.read.parquet(out))) == 2


def test_months_of_partitioned_silver(spark, tmp_path, rows):
    silver, out, cp = (str(tmp_path / n) for n in ("silver", "gold", "cp"))
    schema = "data date, estado string, producao double"
    first = [(D(2015, m, 1), "BA", float(m)) for m in (1, 2, 12)]
    spark.createDataFrame(first, schema).write.partitionBy("data").parquet(silver)
    monthly = Periods("data", "month", ("ano", "mes"))
    columns = ["ano", "mes", "estado", "producao_mensal_total"]
    assert refresh_gold(spark, silver, out, cp, gold.monthly_production, monthly) == 3
    before = files(out)
    late = [(D(2015, 12, 31), "BA", 8.0), (D(2016, 1, 1), "BA", 9.0)]
    spark.createDataFrame(late, schema).write.mode("append").partitionBy("data").parquet(silver)
    assert refresh_gold(spark, silver, out, cp, gold.monthly_production, monthly) == 2
    assert {n.rsplit("/", 1)[0] for n in files(out) ^ before} == {"ano=2015/mes=12", "ano=2016/mes=1"}
    assert read_gold(spark, out, columns).orderBy("ano", "mes").collect() == [
        (2015, 1, "BA", 1.0), (2015, 2, "BA", 2.0), (2015, 12, "BA", 20.0), (2016, 1, "BA", 9.0),
    ]


def test_changed_days_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    climate(spark, [(D(2024, 1, d), "A", "BA", 1.0) for d in range(1, 9)]).write.partitionBy("data").parquet(path)
    kept = in_periods(spark.read.parquet(path), "data", [D(2024, 1, 3), D(2024, 1, 4)], "day")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data" in plan or "PartitionFilters: [((data" in plan
    assert kept.count() == 2
    assert len(kept.inputFiles()) <= 8


def test_intervals_join_neighbours_and_stay_few():
    days = [D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1), D(2024, 3, 5)]
    assert intervals(days, "day") == [(D(2024, 2, 28), D(2024, 3, 2)), (D(2024, 3, 5), D(2024, 3, 6))]
    assert intervals([D(2023, 12, 1), D(2024, 1, 1)], "month") == [(D(2023, 12, 1), D(2024, 2, 1))]
    many = [D(2020, 1, 1) + dt.timedelta(days=3 * i + (100 if i > 5 else 0)) for i in range(10)]
    few = intervals(many, "day", most=2)
    assert len(few) == 2 and few[0][0] == many[0] and few[-1][1] == many[-1] + dt.timedelta(days=1)
    assert few[0][1] == many[5] + dt.timedelta(days=1)


def test_periods_between_wide_intervals_stay_out(spark, rows):
    df = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(days=i),) for i in range(400)], "data date")
    wanted = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(0, 400, 2)]
    assert in_periods(df, "data", wanted, "day").count() == 200
    stamped = df.select(F.col("data").cast("timestamp").alias("t"))
    assert in_periods(stamped, "t", wanted, "day").count() == 200
    assert in_periods(df, "data", [], "day").count() == 0


def test_partitions_are_met_with_their_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "a", 3), (2, None, 4)], "k int, s string, v int")
    touched = spark.createDataFrame([(1, "b"), (None, "a"), (1, "b")], "k int, s string")
    assert rows(in_partitions(df, touched, ["k", "s"])) == sorted([(1, "b", 2), (None, "a", 3)], key=repr)
    assert in_partitions(df, touched.limit(0), ["k", "s"]).count() == 0


def test_gold_command_refreshes(spark, tmp_path, rows):
    silver, out = tmp_path / "silver", tmp_path / "gold"
    price = "timestamp timestamp, preco double"
    spark.createDataFrame([(dt.datetime(2024, 1, d), float(d)) for d in (1, 2)], price).write.parquet(str(silver))

    def run():
        argv = ["gold", "daily-mean-price", "--silver", silver, "--gold", out, "--changes", tmp_path / "cp"]
        jobs.main([str(a) for a in argv], spark)

    run()
    before = files(str(out))
    spark.createDataFrame([(dt.datetime(2024, 1, 2), 4.0)], price).write.mode("append").parquet(str(silver))
    run()
    assert rows(spark.read.parquet(str(out)).select("data", "preco_medio_dolar")) == [
        (D(2024, 1, 1), 1.0), (D(2024, 1, 2), 3.0),
    ]
    assert all(name.startswith("data=2024-01-02/") for name in files(str(out)) ^ before)
