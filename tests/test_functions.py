import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import functions as fn
from stratalake.schemas import PRODUCTION_RECORD


def evaluate(spark, values, expression, kind="string"):
    """The expression's value for each input, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_month_labels_of_the_whole_year(spark):
    labels = "jan fev mar abr mai jun jul ago set out nov dez".split()
    got = evaluate(spark, [f"{name}/15" for name in labels], fn.month_label_date)
    assert got == [dt.date(2015, month, 1) for month in range(1, 13)]


def test_month_label_case_and_bad_shapes(spark):
    values = ["JAN/15", "Fev/20", "xyz/15", "jan15", "jan/15/1", "jan/2015", "", None, "jan/1x", "jan/15\n"]
    got = evaluate(spark, values, fn.month_label_date)
    assert got == [dt.date(2015, 1, 1), dt.date(2020, 2, 1)] + [None] * 8


def test_month_label_round_trip(spark):
    days = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(0, 1200, 7)]
    got = evaluate(spark, days, lambda c: fn.month_label_date(fn.month_label(c)), "date")
    assert got == days


def test_day_first_dates(spark):
    values = ["05/01/2024", "05.01.2024", "5/1/2024", "05-01-2024", "2024-01-05", "31/02/2024", "x", None]
    got = evaluate(spark, values, fn.day_first_date)
    assert got == [dt.date(2024, 1, 5)] * 5 + [None] * 3


def test_price_timestamp_takes_only_its_format(spark):
    values = ["2024-01-05 00:00:00", "05/01/2024", "2024-13-05 00:00:00", None]
    got = evaluate(spark, values, fn.price_timestamp)
    assert got == [dt.datetime(2024, 1, 5), None, None, None]


def test_iso_date_reads_dates_and_timestamps(spark):
    values = ["2015-01-01", "2015-01-01 00:00:00", "bad", None]
    got = evaluate(spark, values, fn.iso_date)
    assert got == [dt.date(2015, 1, 1)] * 2 + [None] * 2


def test_decimal_comma(spark):
    values = ["134,50", "134.5", "1.234,50", "abc", None, "1.234.567,8"]
    assert evaluate(spark, values, fn.decimal_comma) == [134.5, 134.5, None, None, None, None]
    grouped = evaluate(spark, values, lambda c: fn.decimal_comma(c, grouped=True))
    assert grouped == [134.5, 134.5, 1234.5, None, None, 1234567.8]


def test_decimal_comma_reads_nan_tokens_as_nan(spark):
    assert math.isnan(evaluate(spark, ["NaN"], fn.decimal_comma)[0])


def test_numeric_coercion(spark):
    values = ["12", " 3.5 ", "1e3", "12d", "12f", "n/d", "", "NaN", None]
    assert evaluate(spark, values, fn.numeric) == [12.0, 3.5, 1000.0] + [None] * 6


def test_without_nan(spark):
    assert evaluate(spark, [1.0, float("nan"), None], fn.without_nan, "double") == [1.0, None, None]


def test_date_parts_and_back(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (None,)], "data date")
    parts = df.select("data", *fn.date_parts(F.col("data")))
    got = parts.select("*", fn.day_of().alias("d"), fn.month_start().alias("m")).collect()
    assert tuple(got[0]) == (dt.date(2024, 2, 29), 2024, 2, 29, dt.date(2024, 2, 29), dt.date(2024, 2, 1))
    assert tuple(got[1]) == (None,) * 6


def test_state_codes(spark):
    values = ["Mato Grosso", "MATO GROSSO", "MT", "Goiás", "Piaui", "Piauí", " Bahia ", "X", None]
    got = evaluate(spark, values, fn.state_code)
    assert got == ["MT", "MT", "MT", "GO", "PI", "PI", "BA", None, None]


def test_records_from_array_object_and_junk(spark):
    values = [
        '[{"data":"2015-01-01","unidade_federativa":"Bahia","producao":1.5}]',
        '{"data":"2015-01-01","unidade_federativa":"Bahia","producao":1.5}',
        "[]",
        "no json",
        '[{"data":"2015-01-01","producao":"many"}]',
    ]
    got = evaluate(spark, values, lambda c: fn.parse_records(c, PRODUCTION_RECORD))
    one = ("2015-01-01", "Bahia", None, 1.5)
    assert [tuple(r) for r in got[0]] == [one]
    assert [tuple(r) for r in got[1]] == [one]
    assert got[2] == []
    assert got[3] is None
    assert got[4][0].producao is None


def test_record_json_keeps_nulls_and_formats_timestamps(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5), None, 1.5)], "data timestamp, `vol.` string, `último` double"
    )
    text = df.select(fn.record_json("data", F.col("`vol.`"), "último").alias("v")).first().v
    assert text == '{"data":"2024-01-05 00:00:00","vol.":null,"último":1.5}'


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=60))
def test_fixed_sum_is_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double").repartition(3)
    row = df.agg(
        fn.fixed_sum(F.col("v"), 2).alias("s"), fn.fixed_mean(F.col("v"), 2).alias("m")
    ).first()
    assert row.s == sum(cents) / 100
    assert row.m == sum(cents) / 100 / len(cents)


def test_fixed_mean_of_nulls_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(fn.fixed_mean(F.col("v"), 2).alias("m")).first().m is None


def test_no_python_in_parsing_plans(spark):
    df = spark.createDataFrame([("jan/15", "1,5")], T.StructType().add("a", "string").add("b", "string"))
    plan = df.select(
        fn.month_label_date(F.col("a")), fn.decimal_comma(F.col("b")), fn.state_code(F.col("a"))
    )._jdf.queryExecution().toString()
    assert "Python" not in plan
