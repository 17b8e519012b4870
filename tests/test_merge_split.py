"""Streams that merge corrections, and that split silver and rejects from one read."""

import os

import pytest
from pyspark.sql import functions as F

from stratalake.plans import silver
from stratalake.schemas import PRODUCTION_RECORD
from stratalake.sinks.files import read_batches, write_batch
from stratalake.sources.streams import parquet_stream, text_stream
from stratalake.streaming import into_batches, run_to_end, start_merge, start_split
from stratalake.streaming import merge, split

SCHEMA = "id long, dia int, preco double, ingest_ts int"


def send(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def merged(spark, source, out, cp):
    rows = parquet_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
    start_merge(rows, out, cp, ["id", "dia"], ["dia"], interval=None).awaitTermination()


def test_corrections_replace_and_replays_change_nothing(spark, tmp_path, rows):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    first = [(i, i % 5, float(i), 1) for i in range(50)] + [(None, 1, 7.0, 1), (1, None, 2.0, 1)]
    send(spark, source, first * 3)
    merged(spark, source, out, cp)
    assert rows(spark.read.parquet(out).select("id", "dia", "preco", "ingest_ts")) == sorted(first, key=repr)
    kept = {n for n in os.listdir(os.path.join(out, "dia=3"))}
    late = [(6, 1, 60.0, 2), (11, 1, 110.0, 3), (11, 1, 111.0, 2), (None, 1, 7.0, 2), (None, 1, 8.0, 2), (100, 9, 1.0, 2)]
    send(spark, source, late)
    merged(spark, source, out, cp)
    want = {(i, d): (p, s) for i, d, p, s in first if i is not None and d is not None}
    want |= {(6, 1): (60.0, 2), (11, 1): (110.0, 3), (100, 9): (1.0, 2)}
    got = [tuple(r) for r in spark.read.parquet(out).select("id", "dia", "preco", "ingest_ts").collect()]
    assert {(i, d): (p, s) for i, d, p, s in got if i is not None and d is not None} == want
    assert sorted(r[2] for r in got if r[0] is None) == [7.0, 8.0]  # equal copies are one
    assert len(got) == len(want) + 3
    assert {n for n in os.listdir(os.path.join(out, "dia=3"))} == kept  # no row of that day came
    merged(spark, source, out, cp)
    send(spark, source, first)  # a replay of all that has been corrected
    merged(spark, source, out, cp)
    again = [tuple(r) for r in spark.read.parquet(out).select("id", "dia", "preco", "ingest_ts").collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)
    assert [n for n in os.listdir(f"{cp}-staging") if n.startswith("lote=")] == ["lote=2"]


@pytest.mark.parametrize("halfway", [False, True])
def test_a_merge_that_failed_is_made_good(spark, tmp_path, rows, monkeypatch, halfway):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    send(spark, source, [(1, 1, 1.0, 1), (2, 1, 2.0, 1), (3, 2, 3.0, 1)])
    merged(spark, source, out, cp)
    send(spark, source, [(1, 1, 10.0, 2), (3, 2, 30.0, 2)])
    write = merge.overwrite_partitions

    def failing(df, path, by):
        if path == out:
            if halfway:  # one partition is gone, and no new one is there yet
                import shutil

                shutil.rmtree(os.path.join(out, "dia=1"))
            raise RuntimeError("lost")
        write(df, path, by)

    with monkeypatch.context() as patch:
        patch.setattr(merge, "overwrite_partitions", failing)
        with pytest.raises(Exception, match="lost"):
            merged(spark, source, out, cp)
    merged(spark, source, out, cp)
    assert rows(spark.read.parquet(out).select("id", "preco")) == [(1, 10.0), (2, 2.0), (3, 30.0)]


GOOD = '{"data":"2015-01-0%d","unidade_federativa":"Bahia","producao":%s}'


def lines():
    keyless = '{"data":"2015-13-01","unidade_federativa":"Bahia","producao":7.0}'
    nameless = '{"data":"2015-01-01","producao":7.0}'
    mixed = f'[{GOOD % (1, 1)},{GOOD % (2, chr(34) + "x" + chr(34))},{nameless},{GOOD % (3, 3)}]'
    return ["junk", "junk", mixed, GOOD % (4, 4), "[]", keyless]


def put(root, name, some):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w", encoding="utf-8") as file:
        file.write("\n".join(some))


def run_split(spark, tmp_path, take=None):
    out, bad, counts = (str(tmp_path / n) for n in ("out", "bad", "counts"))

    def check(batch):
        raw = silver.numbered_records(batch, PRODUCTION_RECORD)
        return silver.production_rows(raw, also=[split.MESSAGE, split.NUMBER, split.SENT, split.TEXTS])

    reason = split.rejection({"data": "data", "producao": "producao"}, ["data", "estado"])
    query = start_split(
        text_stream(spark, str(tmp_path / "in")), check, reason,
        take or into_batches(out, ["data"]), bad, str(tmp_path / "cp"), counts, None,
    )
    query.awaitTermination()
    return query


def test_one_read_feeds_silver_rejects_and_counts(spark, tmp_path, rows):
    put(str(tmp_path / "in"), "a.json", lines())
    query = run_split(spark, tmp_path)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [6]
    good = read_batches(spark, str(tmp_path / "out"))
    assert rows(good.select(F.dayofmonth("data").alias("d"), "producao")) == [(1, 1.0), (3, 3.0), (4, 4.0)]
    bad = read_batches(spark, str(tmp_path / "bad"))
    got = sorted((r.value, tuple(r.registros), tuple(r.motivos)) for r in bad.collect())
    assert [g[1:] for g in got if g[0] == "junk"] == [((1,), ("mensagem ilegível",))] * 2
    assert [g[1:] for g in got if g[0].startswith("[")] == [((2, 3), ("valor ilegível", "sem chave"))]
    assert len(got) == 4
    put(str(tmp_path / "in"), "b.json", lines()[3:4])
    run_split(spark, tmp_path)
    counts = spark.read.parquet(str(tmp_path / "counts")).orderBy("lote").collect()
    assert [c.asDict() for c in counts] == [
        {"entrada": 8, "prata": 3, "ilegiveis": 2, "sem_chave": 1, "valores": 2, "lote": 0},
        {"entrada": 1, "prata": 1, "ilegiveis": 0, "sem_chave": 0, "valores": 0, "lote": 1},
    ]


def test_a_failure_between_the_sinks_leaves_no_gap_and_no_repeat(spark, tmp_path, rows, monkeypatch):
    put(str(tmp_path / "in"), "a.json", lines())
    written = split.write_batch

    def failing(df, path, number, *more):
        if path.endswith("bad"):
            raise RuntimeError("lost")
        written(df, path, number, *more)

    with monkeypatch.context() as patch:
        patch.setattr(split, "write_batch", failing)
        with pytest.raises(Exception, match="lost"):
            run_split(spark, tmp_path)
    run_split(spark, tmp_path)
    run_split(spark, tmp_path)
    assert read_batches(spark, str(tmp_path / "out")).count() == 3
    assert read_batches(spark, str(tmp_path / "bad")).count() == 4
    assert spark.read.parquet(str(tmp_path / "counts")).select("entrada").collect()[0][0] == 8


def test_batches_refuse_a_table_of_a_streaming_sink(spark, tmp_path):
    put(str(tmp_path / "in"), "a.json", ["x"])
    out = str(tmp_path / "out")
    run_to_end(text_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "cp"))
    with pytest.raises(ValueError, match="streaming sink"):
        write_batch(spark.range(1), out, 0)
