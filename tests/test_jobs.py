"""The commands, from files to answers."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from stratalake import jobs
from stratalake.sinks.files import read_batches

D = dt.date


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(lines))


@pytest.fixture
def run(spark):
    return lambda *argv: jobs.main([str(a) for a in argv], spark)


def test_production_from_csv_to_series(spark, tmp_path, run, rows):
    put(
        str(tmp_path / "p.csv"),
        "data,unidade_federativa,producao",
        "jan/15,Bahia,1.5",
        "jan/15,Piaui,2.5",
        "fev/15,Bahia,4",
        "bad,Bahia,9",
    )
    run("load-production", "--csv", tmp_path / "p.csv", "--table", "carga", "--path", tmp_path / "src")
    # the table is sent twice, as by an hourly replay
    for _ in range(2):
        run("publish", "production", "--source", "carga", "--target", tmp_path / "bronze")
    keyless = '{"data":"2015-13-01","unidade_federativa":"Bahia","produto":null,"producao":7.0}'
    number = '[ {"data":"2015-01-01","unidade_federativa":"Bahia","producao":"12,5"} ]'
    put(str(tmp_path / "bronze" / "2024" / "01" / "02" / "bad.json"), "junk", keyless, number)
    run(
        "silver", "production", "--bronze", tmp_path / "bronze", "--silver", tmp_path / "silver",
        "--checkpoint", tmp_path / "cp", "--quarantine", tmp_path / "bad", "--once",
    )
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 6
    bad = read_batches(spark, str(tmp_path / "bad"))
    assert rows(bad.select("value")) == sorted([("junk",), (keyless,), (number,)])
    assert {(r.value, tuple(r.registros), tuple(r.motivos)) for r in bad.collect()} == {
        ("junk", (1,), ("mensagem ilegível",)), (keyless, (1,), ("valor ilegível",)), (number, (1,), ("valor ilegível",)),
    }
    run("gold", "monthly-production", "--silver", tmp_path / "silver", "--gold", tmp_path / "gold")
    assert sorted(n for n in os.listdir(tmp_path / "gold") if "=" in n) == ["estado=Bahia", "estado=Piaui"]
    run("serve", "production-series", "--gold", tmp_path / "gold", "--to", tmp_path / "out")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(D(2015, 1, 1), 4.0), (D(2015, 2, 1), 4.0)]
    run("serve", "production-states", "--gold", tmp_path / "gold", "--to", tmp_path / "states", "--preview", 3)
    with pytest.raises(SystemExit):
        run("serve", "production-states", "--gold", tmp_path / "gold")


def test_stream_drops_replays(spark, tmp_path, run):
    line = '[{"data":"2015-01-01","unidade_federativa":"Bahia","producao":1}]'
    put(str(tmp_path / "bronze" / "a.json"), line, line)
    for name in ("b.json", "c.json"):
        run(
            "silver", "production", "--bronze", tmp_path / "bronze", "--silver", tmp_path / "silver",
            "--checkpoint", tmp_path / "cp", "--drop-replays-within", "2 hours", "--once",
        )
        assert spark.read.parquet(str(tmp_path / "silver")).count() == 1
        put(str(tmp_path / "bronze" / name), line)


def test_rain_and_prices_to_answers(spark, tmp_path, run, rows):
    day = '{"date":"2024-01-0%d","hub":"%s","state":"%s","precipitation_mm":%s}'
    put(
        str(tmp_path / "rain" / "2024" / "01" / "02" / "a.json"),
        "[" + ",".join([day % (1, "A", "MT", 1), day % (1, "B", "MT", 3), day % (2, "A", "MT", 6)]) + "]",
        "[" + day % (1, "C", "BA", 5) + "]",
    )
    put(
        str(tmp_path / "s.csv"),
        "Data,Último,Abertura,Máxima,Mínima,Vol.,Var%",
        '01/01/2024,"10,0",1,1,1,1,1',
        '02/01/2024,"20,0",1,1,1,1,1',
    )
    run("publish", "prices", "--source", tmp_path / "s.csv", "--target", tmp_path / "price", "--newest-first")
    for table, bronze in (("climate", "rain"), ("prices", "price")):
        run(
            "silver", table, "--bronze", tmp_path / bronze, "--silver", tmp_path / f"{table}-silver",
            "--checkpoint", tmp_path / f"{table}-cp", "--once",
        )
    for table, source in (
        ("daily-mean-rain", "climate"),
        ("daily-total-rain", "climate"),
        ("daily-mean-price", "prices"),
        ("price-rows", "prices"),
    ):
        run("gold", table, "--silver", tmp_path / f"{source}-silver", "--gold", tmp_path / table)

    out = tmp_path / "out"
    means = [tmp_path / "daily-mean-rain", tmp_path / "daily-mean-price"]
    run("serve", "points", "--gold", *means, "--state", "MT", "--to", out)
    assert rows(spark.read.parquet(str(out))) == [(2.0, 10.0), (6.0, 20.0)]

    both = [tmp_path / "daily-total-rain", tmp_path / "price-rows"]
    run("serve", "trend-line", "--gold", *both, "--state", "MT", "--to", out)
    line = spark.read.parquet(str(out)).first()
    assert (line.inclinacao, line.intercepto, line.pontos) == (5.0, -10.0, 2)
    run("serve", "mean-cards", "--gold", *both, "--first", "2024-01-01", "--last", "2024-01-01", "--to", out)
    assert rows(spark.read.parquet(str(out))) == [(4.5, 10.0)]
    for query in ("rain-series", "price-series", "states", "date-range"):
        run("serve", query, "--gold", *both, "--to", out)


def test_gold_keeps_both_prices_of_an_instant(spark, tmp_path, run, rows):
    price = [(dt.datetime(2024, 1, 1), 100.0, 1), (dt.datetime(2024, 1, 1), 200.0, 1)]
    schema = "timestamp timestamp, preco double, ordem int"
    silver = spark.createDataFrame(price * 2 + [(dt.datetime(2024, 1, 2), 5.0, 1)], schema)
    silver.write.parquet(str(tmp_path / "silver"))
    mean = tmp_path / "mean"
    run("gold", "daily-mean-price", "--silver", tmp_path / "silver", "--gold", mean)
    assert rows(spark.read.parquet(str(mean))) == [(D(2024, 1, 1), 150.0), (D(2024, 1, 2), 5.0)]
    later = spark.createDataFrame([(dt.datetime(2024, 1, 1), 400.0, 2)], schema)
    later.write.mode("append").parquet(str(tmp_path / "silver"))
    run(
        "gold", "daily-mean-price", "--silver", tmp_path / "silver", "--gold", mean,
        "--newest-by", "ordem",
    )
    assert rows(spark.read.parquet(str(mean)))[0] == (D(2024, 1, 1), 400.0)


def test_rain_is_loaded_under_its_key(spark, tmp_path, run, rows):
    def grid(rain):
        spark.createDataFrame(
            [(D(2015, 1, d), -12.5, -55.5, rain + d) for d in (1, 2)],
            "date date, latitude double, longitude double, precip double",
        ).write.mode("overwrite").parquet(str(tmp_path / "grid-2015"))

    template = str(tmp_path / "grid-{year}")
    grid(0.0)
    run("load-rain", "--grid", template, "--table-path", tmp_path / "t", "--first-load")
    stored = rows(spark.read.parquet(str(tmp_path / "t")))
    assert len(stored) == 20
    assert ("2015-01-01", "Sorriso", "MT", -12.54, -55.71, 1.0) in stored
    grid(100.0)
    run("load-rain", "--grid", template, "--table-path", tmp_path / "t")
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == stored
    run("publish", "climate", "--source", f"parquet.`{tmp_path}/t`", "--target", tmp_path / "msgs")
    assert spark.read.text(str(tmp_path / "msgs")).count() == 2


def test_replays_with_ingest_time_count_once(spark, tmp_path, run, rows):
    line = '[{"data":"2015-01-01","unidade_federativa":"Bahia","producao":10}]'
    put(str(tmp_path / "bronze" / "a.json"), line)
    for name in ("b.json", "c.json"):
        run(
            "silver", "production", "--bronze", tmp_path / "bronze", "--silver", tmp_path / "silver",
            "--checkpoint", tmp_path / "cp", "--keep-ingest", "--once",
        )
        put(str(tmp_path / "bronze" / name), line)
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert silver.count() == 2 and silver.select("ingest_ts").distinct().count() == 2
    run("gold", "monthly-production", "--silver", tmp_path / "silver", "--gold", tmp_path / "gold")
    assert rows(spark.read.parquet(str(tmp_path / "gold")).select("producao_mensal_total")) == [(10.0,)]


def test_json_source_reaches_silver_and_quarantine(spark, tmp_path, run, rows):
    day = '{"date":"2024-01-0%d","hub":"%s","state":"MT","precipitation_mm":%s}'
    put(str(tmp_path / "in" / "a.json"), "[" + day % (1, "A", "NaN") + "," + day % (1, "B", 2) + "]", "junk")
    put(str(tmp_path / "in" / "b.json"), '{"date":"2024-01-02","hub":null,"precipitation_mm":1}')
    argv = ["silver", "climate", "--json", "--bronze", tmp_path / "in", "--once"]
    run(*argv, "--silver", tmp_path / "plain", "--checkpoint", tmp_path / "cp0")
    assert spark.read.parquet(str(tmp_path / "plain")).filter("cidade is not null").count() == 2
    run(*argv, "--silver", tmp_path / "s", "--checkpoint", tmp_path / "cp", "--quarantine", tmp_path / "q")
    assert sorted(r.cidade for r in read_batches(spark, str(tmp_path / "s")).collect()) == ["A", "B"]
    bad = read_batches(spark, str(tmp_path / "q")).collect()
    assert sorted(r.motivos[0] for r in bad) == ["mensagem ilegível", "sem chave"]
    assert "junk" in [r.value for r in bad]
    counts = read_batches(spark, str(tmp_path / "q-contagem")).first().asDict()
    assert counts == {"entrada": 4, "prata": 2, "ilegiveis": 1, "sem_chave": 1, "valores": 0}


def test_merge_keeps_the_newest_row(spark, tmp_path, run, rows):
    line = '[{"data":"2015-0%d-01","unidade_federativa":"Bahia","producao":%s}]'
    put(str(tmp_path / "bronze" / "a.json"), line % (1, 1), line % (2, 2))
    for n, new in enumerate([line % (1, 9), line % (3, 3), line % (1, 9)]):
        for quarantine in ([], ["--quarantine", tmp_path / "bad"]):
            run(
                "silver", "production", "--bronze", tmp_path / "bronze", "--silver", tmp_path / f"s{len(quarantine)}",
                "--checkpoint", tmp_path / f"cp{len(quarantine)}", "--merge", "--once", *quarantine,
            )
        put(str(tmp_path / "bronze" / f"n{n}.json"), new)
    for name in ("s0", "s2"):
        got = spark.read.parquet(str(tmp_path / name)).select(F.month("data").alias("m"), "producao")
        assert rows(got) == [(1, 9.0), (2, 2.0), (3, 3.0)]


def test_hubs_without_a_row_are_told_and_years_kept_apart(spark, tmp_path, run, rows, capfd):
    def grid(rain):
        spark.createDataFrame(
            [(D(2015, 1, 1), -12.5, -55.5, rain), (D(2015, 1, 1), -17.5, -50.5, rain)],
            "date date, latitude double, longitude double, precip double",
        ).write.mode("overwrite").parquet(str(tmp_path / "grid-2015"))

    argv = ["load-rain", "--grid", str(tmp_path / "grid-{year}"), "--table-path", tmp_path / "t", "--by-year"]
    for rain in (1.0, 5.0):
        grid(rain)
        run(*argv)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(stored.select("precipitation_mm", "ano").distinct()) == [(1.0, 2015)]
    assert 0 < stored.count() < 10


def test_published_gold_and_summaries_serve(spark, tmp_path, run, rows):
    rain = [(D(2024, 1, d), "A", s, float(d * k)) for d in range(1, 6) for k, s in ((1, "BA"), (3, "MT"))]
    spark.createDataFrame(rain, "data date, cidade string, estado string, precipitacao_mm double").write.parquet(
        str(tmp_path / "rain")
    )
    price = [(dt.datetime(2024, 1, d, h), float(d * d + h)) for d in range(2, 7) for h in (0, 5)]
    spark.createDataFrame(price, "timestamp timestamp, preco double").write.parquet(str(tmp_path / "price"))
    for table, source in (("daily-total-rain", "rain"), ("price-rows", "price")):
        run("gold", table, "--silver", tmp_path / source, "--gold", tmp_path / table)
    for table, source in (("rain-summaries", "rain"), ("price-summaries", "price")):
        run("gold", table, "--silver", tmp_path / source, "--gold", tmp_path / table, "--changes", tmp_path / f"{table}-cp")
    both = ["--gold", tmp_path / "daily-total-rain", tmp_path / "price-rows"]
    stored = ["--gold", tmp_path / "rain-summaries", tmp_path / "price-summaries"]
    for full, short in (("mean-cards", "summary-cards"), ("trend-line", "summary-trend")):
        for choice in ([], ["--state", "MT"], ["--first", "2024-01-03", "--last", "2024-01-04"]):
            run("serve", full, *both, *choice, "--to", tmp_path / "a")
            run("serve", short, *stored, *choice, "--to", tmp_path / "b")
            a, b = (spark.read.parquet(str(tmp_path / n)).first().asDict() for n in "ab")
            assert a == pytest.approx(b)
    run("gold", "daily-total-rain", "--silver", tmp_path / "rain", "--gold", tmp_path / "pub", "--publish", "chuva")
    assert spark.table("chuva").count() == 10
    with pytest.raises(SystemExit):
        run("gold", "price-rows", "--silver", tmp_path / "price", "--gold", tmp_path / "x", "--changes", "cp", "--publish", "y")


def test_parts_are_planned_from_the_largest_date(spark):
    small = spark.range(10).select(F.lit("d").alias("date"), "id")
    assert jobs.planned_parts(small, "date") == 1 and jobs.planned_parts(small.limit(0), "date") == 1
    wide = spark.range(3000).select(F.lit("d").alias("date"), F.repeat(F.lit("x"), F.lit(1000)).alias("t"))
    assert jobs.planned_parts(wide, "date") >= 4
