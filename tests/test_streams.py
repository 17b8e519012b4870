import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from stratalake.plans import bronze, silver
from stratalake.schemas import CLIMATE_RECORD, PRICE_RECORD, PRODUCTION_RECORD
from stratalake.sinks.messages import send_in_order, write_lines
from stratalake.sources.streams import (
    json_stream,
    parquet_stream,
    replay_feed,
    text_stream,
)
from stratalake.streaming import drop_replays_stream, run_to_end, start_append

D = dt.date
CLIMATE = (
    '[{"date":"2024-01-01","hub":"Sorriso","state":"MT","latitude":-12.54,"longitude":-55.71,"precipitation_mm":1.5},'
    '{"date":"2024-01-01","hub":"Querencia","state":"MT","latitude":-12.6,"longitude":-52.21,"precipitation_mm":NaN}]'
)


def put(root, name, *lines):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(lines))


def dirs(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")


def test_climate_from_saver_folders(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    put(source, "2024/01/02/10-00-00-1.json", CLIMATE)
    put(source, "2024/01/02/10-02-00-2.json", "not json")
    put(source, "2024/01/03/10-02-00-3.json", '[{"date":"bad","hub":"X","state":"BA","precipitation_mm":2}]')
    raw = json_stream(spark, source, CLIMATE_RECORD)
    run_to_end(silver.climate(raw), out, cp)
    got = spark.read.parquet(out).filter(F.col("cidade").isNotNull()).orderBy("cidade").collect()
    assert [(r.data, r.cidade, r.estado) for r in got] == [
        (D(2024, 1, 1), "Querencia", "MT"),
        (D(2024, 1, 1), "Sorriso", "MT"),
        (None, "X", "BA"),
    ]
    assert math.isnan(got[0].precipitacao_mm) and got[1].precipitacao_mm == 1.5

    run_to_end(silver.unreadable_json(raw), str(tmp_path / "bad"), str(tmp_path / "cp-bad"))
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["not json"]


def test_json_source_and_from_json_agree(spark, tmp_path, rows):
    source, out, cp = dirs(tmp_path)
    put(source, "2024/01/02/a.json", CLIMATE)
    run_to_end(silver.climate(json_stream(spark, source, CLIMATE_RECORD)), out, cp)
    text = silver.records(text_stream(spark, source), CLIMATE_RECORD)
    run_to_end(silver.climate(text), out + "2", cp + "2")
    first, second = rows(spark.read.parquet(out)), rows(spark.read.parquet(out + "2"))
    assert repr(first) == repr(second) and len(first) == 2


def test_prices(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    body = '{"data":"%s","último":%s,"abertura":"1","vol.":"2","var%%":"0,1%%"}'
    put(
        source,
        "2024/01/02/a.json",
        body % ("2024-01-05 00:00:00", '"134,50"'),
        body % ("2024-01-06 00:00:00", "134.5"),
        body % ("2024-01-07 00:00:00", "NaN"),
        body % ("2024-01-08 00:00:00", '"1.234,50"'),
        body % ("2024-01-09 00:00:00", "null"),
        body % ("05/01/2024", '"1"'),
    )
    raw = json_stream(spark, source, PRICE_RECORD)
    run_to_end(silver.prices(raw, dated=True), out, cp, ["data"])
    got = spark.read.parquet(out).orderBy(F.col("timestamp").asc_nulls_last()).collect()
    assert [r.preco for r in got[:2]] == [134.5, 134.5]
    assert math.isnan(got[2].preco)
    assert [(r.timestamp, r.preco) for r in got[3:]] == [
        (dt.datetime(2024, 1, 8), None),
        (dt.datetime(2024, 1, 9), None),
        (None, 1.0),
    ]
    assert got[0].data == D(2024, 1, 5) and got[5].data is None


def production_lines():
    return [
        '[{"data":"2015-01-01 00:00:00","unidade_federativa":"Bahia","producao":1.5},'
        '{"data":"2015-01-01 00:00:00","unidade_federativa":"Piaui","produto":"Soja","producao":2.5}]',
        "[]",
        "junk",
        '{"data":"2015-02-01","unidade_federativa":"Bahia","producao":"x"}',
    ]


def test_production_stream_equals_batch(spark, tmp_path, rows):
    source, out, cp = dirs(tmp_path)
    put(source, "2024/01/02/a.json", *production_lines())
    run_to_end(silver.production(text_stream(spark, source)), out, cp, ["data"])
    columns = ["data", "estado", "producao"]
    streamed = rows(spark.read.parquet(out).select(columns))
    batch = silver.production(spark.read.option("recursiveFileLookup", True).text(source))
    assert streamed == rows(batch)
    assert streamed == sorted(
        [
            (D(2015, 1, 1), "Bahia", 1.5),
            (D(2015, 1, 1), "Piaui", 2.5),
            (D(2015, 2, 1), "Bahia", None),
        ],
        key=repr,
    )
    bad = silver.unreadable_records(
        spark.read.option("recursiveFileLookup", True).text(source), PRODUCTION_RECORD
    )
    assert rows(bad) == [("junk",)]


def test_restart_adds_only_what_is_new(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    put(source, "a.json", *production_lines())
    for expected in (3, 3):
        run_to_end(silver.production(text_stream(spark, source)), out, cp)
        assert spark.read.parquet(out).count() == expected
    put(source, "b.json", production_lines()[0])
    run_to_end(silver.production(text_stream(spark, source)), out, cp)
    assert spark.read.parquet(out).count() == 5


def test_gold_reader_ignores_files_the_sink_did_not_commit(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    put(source, "a.json", *production_lines())
    run_to_end(silver.production(text_stream(spark, source)), out, cp)
    stray = str(tmp_path / "stray")
    spark.read.parquet(out).write.parquet(stray)
    for name in os.listdir(stray):
        if name.endswith(".parquet"):
            with open(os.path.join(stray, name), "rb") as one, open(os.path.join(out, name), "wb") as two:
                two.write(one.read())
    assert spark.read.parquet(out).count() == 3


def test_replay_feed_takes_one_day_per_batch(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    days = [3, 1, 4, 2]
    sent = spark.createDataFrame(
        [(f"2024-01-0{d}", CLIMATE.replace("2024-01-01", f"2024-01-0{d}")) for d in days],
        "key string, value string",
    )
    seen = []

    def arrive(key):
        query = (
            replay_feed(spark, source, CLIMATE_RECORD)
            .writeStream.foreachBatch(
                lambda batch, n: seen.append((n, key, sorted({r.date for r in batch.collect()})))
            )
            .option("checkpointLocation", cp)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    assert send_in_order(sent, source, arrive) == [f"2024-01-0{d}" for d in sorted(days)]
    assert seen == [(d - 1, f"2024-01-0{d}", [f"2024-01-0{d}"]) for d in sorted(days)]


def test_replays_are_dropped_on_the_stream(spark, tmp_path, rows):
    source, out, cp = dirs(tmp_path)
    base = [
        (D(2015, m, 1) if m < 12 else None, s, float(m), None if m == 3 else "x")
        for m in range(1, 13) for s in ("BA", "MT", None)
    ]
    base += [(D(2015, 1, 1), "BA", 99.0, "x"), (None, "BA", 5.0, "y")]  # same keys, other values
    sent = spark.createDataFrame(base, "data date, estado string, producao double, nota string")
    for copies in (40, 1):
        again = sent
        for _ in range(copies - 1):
            again = again.union(sent)
        again.coalesce(2).write.mode("append").parquet(source)
        once = drop_replays_stream(parquet_stream(spark, source, sent.schema))
        run_to_end(once.drop("ingest_ts"), out, cp)
        assert rows(spark.read.parquet(out)) == sorted(base, key=repr)


def test_landing_shuffles_nothing(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    rows = spark.range(0, 4000, 1, 12).select(
        F.col("id").cast("string").cast("binary").alias("value"), F.col("id").alias("offset")
    )
    rows.write.parquet(source)
    stream = parquet_stream(spark, source, rows.schema)
    plans = {}
    for gather in (True, False):
        query = start_append(
            bronze.landed(stream), f"{out}-{gather}", f"{cp}-{gather}", bronze.INGEST_PARTS,
            interval=None, gather=gather,
        )
        query.awaitTermination()
        plans[gather] = query._jsq.explainInternal(False)
    assert "Exchange" in plans[True] and "Exchange" not in plans[False]
    assert spark.read.parquet(f"{out}-False").count() == 4000


def test_text_landing_refuses_what_a_line_cannot_hold(spark):
    payloads = [b"good", b"a\nb", b"a\rb", b"\xff", "último".encode(), None, b""]
    sent = spark.createDataFrame([(p and bytearray(p) if p != b"" else bytearray(),) for p in payloads], "value binary")
    kept = sorted(r.value for r in bronze.landed(sent, F.lit("2024-01-02").cast("date"), as_text=True).collect())
    assert kept == ["", "good", "último"]
    assert bronze.not_text(sent).count() == 4


def test_landing_keeps_payload_bytes(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    payloads = [b'[{"a":1}]\n \xff', b"", "último".encode()]
    sent = spark.createDataFrame(
        [(bytearray(p), "climate", 0, i, dt.datetime(2024, 1, 2, 3)) for i, p in enumerate(payloads)],
        "value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    sent.write.parquet(source)
    stream = parquet_stream(spark, source, sent.schema)
    run_to_end(bronze.landed(stream, F.col("timestamp")), out, cp, bronze.INGEST_PARTS)
    got = spark.read.parquet(out).orderBy("offset").collect()
    assert [bytes(r.value) for r in got] == payloads
    assert os.path.isdir(os.path.join(out, "ingest_year=2024", "ingest_month=01", "ingest_day=02"))


@pytest.mark.parametrize("as_text", [True, False])
def test_landed_messages_reach_silver(spark, tmp_path, rows, as_text):
    source, out, cp = dirs(tmp_path)
    sent = spark.createDataFrame([(bytearray(CLIMATE.encode()), 1)], "value binary, offset long")
    sent.write.parquet(source)
    stream = parquet_stream(spark, source, sent.schema)
    landed = bronze.landed(stream, as_text=as_text)
    run_to_end(landed, out, cp, bronze.INGEST_PARTS, "text" if as_text else "parquet")
    again = text_stream(spark, out) if as_text else parquet_stream(spark, out, sent.select("value").schema)
    target = str(tmp_path / "silver")
    run_to_end(silver.climate(silver.records(again, CLIMATE_RECORD)), target, cp + "2")
    got = spark.read.parquet(target)
    assert sorted(r.cidade for r in got.collect()) == ["Querencia", "Sorriso"]


def test_packed_days_stream_back(spark, tmp_path, rows):
    source, out, cp = dirs(tmp_path)
    table = spark.createDataFrame(
        [(f"2024-01-0{d}", h, "MT", 1.0, 2.0, d + 0.25) for d in range(1, 6) for h in ("A", "B")],
        CLIMATE_RECORD,
    )
    write_lines(bronze.climate_messages(table), source)
    run_to_end(silver.climate(json_stream(spark, source, CLIMATE_RECORD)), out, cp)
    assert rows(spark.read.parquet(out)) == rows(silver.climate(table))


def test_long_running_query_has_its_interval(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    put(source, "a.json", *production_lines())
    rows = silver.production(text_stream(spark, source))
    query = start_append(rows, out, cp, interval="1 second", name="producao")
    try:
        assert query.isActive and query.name == "producao"
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 3


def test_partitioned_sink_bounds_its_files(spark, tmp_path):
    source, out, cp = dirs(tmp_path)
    rows = spark.range(0, 4000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5).alias("k"), "id"
    )
    rows.write.parquet(source)
    query = start_append(
        parquet_stream(spark, source, rows.schema), out, cp, ["k"], interval=None, spread=2
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 4000
    for k in range(5):
        files = [n for n in os.listdir(os.path.join(out, f"k={k}")) if n.endswith(".parquet")]
        assert 1 <= len(files) <= 2


def test_states_as_codes(spark, rows):
    raw = spark.createDataFrame(
        [("2015-01-01", "Mato Grosso", None, 1.0)], PRODUCTION_RECORD
    )
    assert rows(silver.production_rows(raw, state_codes=True)) == [(D(2015, 1, 1), "MT", 1.0)]
