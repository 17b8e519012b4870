"""Compaction, published versions, bucketed tables, stored figures, keyed appends."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratalake.operators.joins import date_summaries, join_on_date
from stratalake.operators.quality import append_absent
from stratalake.plans import bronze, compaction, summaries
from stratalake.sinks.keyed import append_by_year, stored_near
from stratalake.sinks.tables import publish_version, write_bucketed
from stratalake.sources.streams import parquet_stream
from stratalake.streaming import run_to_end

D = dt.date


def land(spark, source, out, cp, first, count):
    rows = spark.range(first, first + count, 1, 6).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).cast("binary").alias("value"),
        F.col("id").alias("offset"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("dia"),
    )
    rows.write.mode("append").parquet(source)
    stream = parquet_stream(spark, source, rows.schema)
    run_to_end(bronze.landed(stream, F.col("dia")), out, cp, bronze.INGEST_PARTS, gather=False)
    return rows.schema


def test_compaction_keeps_rows_readers_and_streams(spark, tmp_path, rows, monkeypatch):
    source, out, cp, archive = (str(tmp_path / n) for n in ("in", "bronze", "cp", "archive"))
    land(spark, source, out, cp, 0, 300)
    silver = str(tmp_path / "silver")
    schema = spark.read.parquet(out).select("value", "offset").schema

    def follow():
        run_to_end(parquet_stream(spark, out, schema), silver, f"{silver}-cp")
        return sorted(r.offset for r in spark.read.parquet(silver).collect())

    assert follow() == list(range(300))
    before = rows(compaction.read_bronze(spark, out, archive))
    assert len(before) == 300

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # all is copied, and nothing recorded
        patch.setattr(compaction, "_marks", broken)
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact_days(spark, out, archive, D(2024, 1, 3))
    assert compaction.compacted_days(spark, archive) is None
    assert rows(compaction.read_bronze(spark, out, archive)) == before
    assert compaction.compact_days(spark, out, archive, D(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    found = compaction.compacted_days(spark, archive).orderBy("dia").collect()
    assert [(r.dia, r.linhas, r.novos) for r in found] == [("2024-01-01", 100, 1), ("2024-01-02", 100, 1)]
    assert all(r.arquivos > 1 and r.versao == 1 for r in found)
    both = compaction.read_bronze(spark, out, archive)
    assert rows(both) == before
    named = [f for f in both.select(F.input_file_name().alias("f")).distinct().collect()]
    assert sum("versao=1" in r.f for r in named) == 2
    assert compaction.compact_days(spark, out, archive, D(2024, 1, 3)) == []  # nothing new
    land(spark, source, out, cp, 300, 30)  # more rows of all three days
    assert follow() == list(range(330))
    assert len(rows(compaction.read_bronze(spark, out, archive))) == 330 - 20  # until the days are done again
    assert compaction.compact_days(spark, out, archive, D(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    again = compaction.read_bronze(spark, out, archive)
    assert sorted(r.offset for r in again.collect()) == list(range(330))


def test_large_days_get_several_files(spark, tmp_path):
    source, out, cp, archive = (str(tmp_path / n) for n in ("in", "bronze", "cp", "archive"))
    land(spark, source, out, cp, 0, 3000)
    compaction.compact_days(spark, out, archive, D(2024, 1, 2), target=8000)
    (day,) = compaction.compacted_days(spark, archive).collect()
    assert day.dia == "2024-01-01" and day.linhas == 1000 and 1 < day.novos < day.arquivos


def test_a_failed_version_leaves_the_former_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.range(5).withColumn("k", F.col("id") % 2)
    publish_version(first, "publicada", path, ["k"])
    before = rows(spark.table("publicada").select("id", "k"))
    half = spark.range(0, 1000, 1, 4).withColumn("k", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        publish_version(half, "publicada", path)
    assert rows(spark.table("publicada").select("id", "k")) == before
    kept = spark.table("publicada").filter("k = 1")
    assert "PartitionFilters: [isnotnull(k" in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(publish_version(spark.range(2), "publicada", path)) == [(0,), (1,)]
    assert len([n for n in os.listdir(path) if n.startswith("versao-")]) == 2  # the failed one is gone


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, rows):
    left = spark.range(400).select((F.col("id") % 50).alias("data"), F.col("id").alias("x"))
    right = spark.range(200).select((F.col("id") % 70).alias("data"), F.col("id").alias("y"))
    a = write_bucketed(left, "balde_a", "data", 4, str(tmp_path / "a"))
    b = write_bucketed(right, "balde_b", "data", 4, str(tmp_path / "b"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_on_date(a, b)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in join_on_date(left, right)._jdf.queryExecution().executedPlan().toString()
        assert rows(joined) == rows(join_on_date(left, right))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_figures_merge_to_those_of_all_rows(spark):
    values = [(D(2024, 1, 1 + i % 3), "ABCD"[i % 4], None if i % 7 == 0 else float("nan") if i % 11 == 0 else i * 1.5 + 1e6) for i in range(60)]
    values.append((D(2024, 1, 9), "A", None))
    df = spark.createDataFrame(values, "data date, estado string, v double")
    parts = summaries.summarize(df, ["data", "estado"], "v")
    merged = {r.data: r for r in summaries.merge_summaries(parts, ["data"], ["estado"]).collect()}
    for whole in summaries.summarize(df, ["data"], "v").collect():
        got = merged[whole.data]
        assert (got.linhas, got.n) == (whole.linhas, whole.n)
        assert got.media == pytest.approx(whole.media) and got.m2 == pytest.approx(whole.m2, rel=1e-6)


def test_figures_relate_like_the_rows(spark):
    rain = spark.createDataFrame(
        [(D(2024, 1, d), s, float(d * k)) for d in range(1, 8) for k, s in ((1, "BA"), (4, "MT"))],
        "data date, estado string, precipitacao_total_mm double",
    )
    price = spark.createDataFrame([(D(2024, 1, d), float(d + p)) for d in range(3, 12) for p in range(d)], "data date, preco double")
    stored = summaries.RainPriceSummaries(
        summaries._with_month(summaries.summarize(rain, ["data", "estado"], "precipitacao_total_mm")),
        summaries._with_month(summaries.summarize(price, ["data"], "preco")), None, D(2024, 1, 4), None,
    )
    later = "data >= '2024-01-04'"
    want = date_summaries(rain.filter(later), "precipitacao_total_mm", price.filter(later), "preco").orderBy("data").collect()
    got = stored.per_date().orderBy("data").collect()
    assert [r.data for r in got] == [r.data for r in want]
    for a, b in zip(got, want):
        assert a.asDict() == pytest.approx(b.asDict())


KEYED = "data date, hub string, mm double"


def test_different_rows_of_a_new_key_raise(spark, rows):
    stored = spark.createDataFrame([(D(2015, 1, 1), "A", 1.0)], KEYED)
    clash = spark.createDataFrame([(D(2015, 1, 2), "A", 1.0), (D(2015, 1, 2), "A", 2.0)], KEYED)
    with pytest.raises(Exception, match="different rows of the key 2015-01-02, A"):
        append_absent(clash, stored, ["data", "hub"]).collect()
    known = spark.createDataFrame([(D(2015, 1, 1), "A", 5.0), (D(2015, 1, 1), "A", 6.0)], KEYED)
    assert append_absent(known, stored, ["data", "hub"]).count() == 0


def test_null_keys_neither_merge_nor_repeat(spark, rows):
    stored = spark.createDataFrame([(None, "A", 1.0), (None, None, None), (D(2015, 1, 1), "A", 1.0)], KEYED)
    new = spark.createDataFrame(
        [(None, "A", 1.0), (None, "A", 2.0), (None, "A", 2.0), (None, "B", 1.0), (None, None, None), (D(2015, 1, 1), None, 3.0)],
        KEYED,
    )
    want = [(None, "A", 2.0), (None, "B", 1.0), (D(2015, 1, 1), None, 3.0)]
    assert rows(append_absent(new.union(new), stored, ["data", "hub"])) == sorted(want, key=repr)


def test_keyed_append_reads_its_years_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = [(D(y, m, 1), "A", float(y)) for y in range(2000, 2020) for m in (1, 7)] + [(None, "A", 1.0)]
    append_by_year(spark.createDataFrame(old, KEYED), path, ["data", "hub"], "data")
    new = spark.createDataFrame([(D(2005, 1, 1), "A", 9.0), (D(2005, 2, 1), "A", 3.0), (None, "A", 1.0), (None, "A", 2.0)], KEYED)
    near = stored_near(new, path, "data")
    plan = near._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "2005" in filters and near.count() == 2  # one date of the year, and the row without
    append_by_year(new, path, ["data", "hub"], "data")
    append_by_year(new, path, ["data", "hub"], "data")
    got = rows(spark.read.parquet(path).select("data", "hub", "mm"))
    assert got == sorted(old + [(D(2005, 2, 1), "A", 3.0), (None, "A", 2.0)], key=repr)
    with pytest.raises(ValueError, match="not in the key"):
        append_by_year(new, path, ["hub"], "data")
