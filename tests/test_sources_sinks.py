import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from stratalake import session
from stratalake.plans import bronze, silver
from stratalake.schemas import HUBS, STATES
from stratalake.sinks.files import append, overwrite
from stratalake.sinks.messages import write_lines
from stratalake.sinks.tables import replace_table
from stratalake.sources import dimensions, tables
from stratalake.sources.files import (
    read_csv_text,
    read_grid_years,
    read_parquet,
    read_price_csv,
    read_production_csv,
)

D = dt.date


def csv(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_production_csv_is_cleaned(spark, tmp_path, rows):
    path = csv(
        tmp_path,
        "data,unidade_federativa,producao\n"
        "jan/15,Bahia,1.5\nFEV/15,Bahia,2\nxyz/15,Bahia,3\njan15,Bahia,4\njan/15/1,Bahia,5\n"
        "jan/2015,Bahia,6\njan/15,,7\njan/15,Bahia,n/d\njan/15,Bahia,\n,Bahia,8\njan/15,NA,9\n",
    )
    clean = silver.clean_production_csv(read_production_csv(spark, path))
    assert clean.columns == ["data", "unidade_federativa", "producao"]
    assert rows(clean) == [(D(2015, 1, 1), "Bahia", 1.5), (D(2015, 2, 1), "Bahia", 2.0)]


def test_production_csv_guards(spark, tmp_path):
    with pytest.raises(ValueError, match="missing columns: producao"):
        read_production_csv(spark, csv(tmp_path, "data,unidade_federativa\njan/15,Bahia\n"))
    with pytest.raises(ValueError, match="no rows"):
        read_production_csv(spark, csv(tmp_path, "data,unidade_federativa,producao\n"))


def price_csv(tmp_path):
    return csv(
        tmp_path,
        ' Data ,Último,Abertura,Máxima,Mínima,Vol.,Var%\n'
        '06/01/2024,"135,50","1","1","1","2","0,1%"\n'
        '05.01.2024,"134,50","1","1","1",,"0,1%"\n',
    )


@pytest.mark.parametrize("ascending", [True, False])
def test_price_csv_to_ordered_messages(spark, tmp_path, ascending):
    read = read_price_csv(spark, price_csv(tmp_path))
    assert read.columns == ["data", "último", "abertura", "máxima", "mínima", "vol.", "var%"]
    sent = bronze.price_messages(bronze.price_table(read, ascending)).collect()
    keys = ["2024-01-05", "2024-01-06"]
    assert [m.key for m in sent] == (keys if ascending else keys[::-1])
    oldest = sent[0 if ascending else 1].value
    assert oldest == (
        '{"data":"2024-01-05 00:00:00","último":"134,50","abertura":"1","máxima":"1",'
        '"mínima":"1","vol.":null,"var%":"0,1%"}'
    )


def test_message_files_keep_the_order(spark, tmp_path):
    sent = bronze.price_messages(bronze.price_table(read_price_csv(spark, price_csv(tmp_path))))
    write_lines(sent, str(tmp_path / "lines"))
    seen = []
    for name in sorted(os.listdir(tmp_path / "lines")):
        if name.startswith("part-"):
            with open(tmp_path / "lines" / name, encoding="utf-8") as file:
                seen += [json.loads(line)["data"] for line in file]
    assert seen == ["2024-01-05 00:00:00", "2024-01-06 00:00:00"]


def test_csv_quotes_commas_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n"Ba ""x"", y",1\n"two\nlines",2\n')
    got = read_csv_text(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in got] == [('Ba "x", y', "1"), ("two\nlines", "2")]


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "1.csv").write_text("data,estado\n2024,BA\n")
    (tmp_path / "csv" / "2.csv").write_text("estado,data\nBA,2024\n")
    with pytest.raises(Exception, match="header"):
        read_csv_text(spark, str(tmp_path / "csv")).collect()


def test_only_a_missing_year_is_skipped(spark, tmp_path):
    (tmp_path / "grid-2016").mkdir()
    (tmp_path / "grid-2016" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        read_grid_years(spark, lambda y: str(tmp_path / f"grid-{y}"), range(2015, 2017)).collect()
    with pytest.raises(FileNotFoundError):
        read_grid_years(spark, lambda y: str(tmp_path / f"grid-{y}"), range(2020, 2022))


def test_days_are_sent_in_order_with_their_parts(spark, tmp_path):
    table = spark.createDataFrame(
        [(f"2024-01-{d:02d}", h, "MT", 0.0, 0.0, 1.0) for d in range(20, 0, -1) for h in "AB"],
        "date string, hub string, state string, latitude double, longitude double, precipitation_mm double",
    )
    sent = bronze.climate_messages(table, parts=2, ordered=True).collect()
    assert [(m.key, m.parte) for m in sent] == [(f"2024-01-{d:02d}", p) for d in range(1, 21) for p in (0, 1)]
    assert {m.partes for m in sent} == {2} and sum(m.linhas for m in sent) == 40


def test_production_messages_hold_a_month(spark):
    table = spark.createDataFrame(
        [("2015-01-01", "Bahia", 1.0), ("2015-01-01", "Piaui", 2.0), ("2015-02-01", "Bahia", 3.0)],
        "data string, unidade_federativa string, producao double",
    )
    sent = {m.key: m.value for m in bronze.production_messages(table).collect()}
    assert len(sent) == 2
    assert sent["2015-01-01 00:00:00"] == (
        '[{"data":"2015-01-01 00:00:00","unidade_federativa":"Bahia","producao":1.0},'
        '{"data":"2015-01-01 00:00:00","unidade_federativa":"Piaui","producao":2.0}]'
    )


def test_grid_years_skip_the_missing_one(spark, tmp_path):
    for year in (2015, 2017):
        spark.createDataFrame(
            [(D(year, 1, 1), 1.0, 2.0, 3.0)], "date date, latitude double, longitude double, precip double"
        ).write.parquet(str(tmp_path / f"grid-{year}"))
    grid = read_grid_years(spark, lambda y: str(tmp_path / f"grid-{y}"), range(2015, 2018))
    assert sorted(r.ano for r in grid.collect()) == [2015, 2017]
    plan = grid.filter(F.col("ano") == 2017)._jdf.queryExecution().optimizedPlan().toString()
    assert "grid-2015" not in plan
    with pytest.raises(FileNotFoundError):
        read_grid_years(spark, lambda y: str(tmp_path / "none"), [2015])


def test_dimensions(spark):
    assert dimensions.hubs(spark).count() == len(HUBS) == 10
    assert dimensions.states(spark).select("sigla").distinct().count() == len(STATES) == 27


def test_overwrite_replaces_and_reads_back(spark, tmp_path, rows):
    path = str(tmp_path / "gold")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "v int, estado string")
    overwrite(df.withColumn("estado", F.lit("old")), path, partition_by=["estado"])
    stored = overwrite(df, path, partition_by=["estado"])
    assert rows(stored) == rows(df)
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["estado=a", "estado=b"]


def test_overwrite_runs_the_plan_once(spark, tmp_path):
    count = spark.sparkContext.accumulator(0)

    def tick(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(tick, "id long")
    stored = overwrite(df, str(tmp_path / "once"))
    assert stored.count() == 100 and stored.agg(F.max("id")).first()[0] == 99
    assert count.value == 100


def test_partition_filter_prunes_directories(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, estado string")
    stored = overwrite(df, str(tmp_path / "p"), partition_by=["estado"])
    plan = stored.filter("estado = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(estado" in plan


def test_append_adds(spark, tmp_path):
    path = str(tmp_path / "a")
    for _ in range(2):
        append(spark.range(5), path)
    assert read_parquet(spark, path).count() == 10


def test_catalog_table_is_replaced(spark, tmp_path, rows):
    for value in (1, 2):
        df = spark.createDataFrame([(value, "x")], "v int, s string")
        stored = replace_table(df, "gold_teste", str(tmp_path / "t"))
        assert rows(stored) == [(value, "x")]
    assert rows(tables.read_table(spark, "gold_teste", ["v"])) == [(2, "x")]


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "t", "u", "p", "d", fetchsize="1000")
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p", "driver": "d", "fetchsize": "1000",
    }
    assert tables.split_options("data", "2015-01-01", "2026-01-01", 16)["numPartitions"] == "16"


def test_object_store_options():
    options = session.object_store_options("http://store", "key", "secret")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store"
    assert options["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_work_paths_are_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")  # the fixture sets it
    one, two = session.work_path(spark, "x"), session.work_path(spark, "x")
    assert one != two
    assert one.startswith(named.rstrip("/")) and two.startswith(named.rstrip("/"))
