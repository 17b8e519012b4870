import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.plans import gold, serve

D, T = dt.date, dt.datetime
NAN = float("nan")


@pytest.fixture
def production(spark):
    return spark.createDataFrame(
        [
            (D(2015, 12, 1), "BA", 1.0),
            (D(2015, 12, 1), "MT", 2.0),
            (D(2016, 1, 1), "BA", 4.0),
            (D(2016, 1, 1), "MT", 8.0),
            (None, "MT", 16.0),
        ],
        "data date, estado string, producao double",
    )


@pytest.fixture
def climate(spark):
    return spark.createDataFrame(
        [
            (D(2024, 2, 29), "A", "MT", 1.0),
            (D(2024, 2, 29), "B", "MT", 4.0),
            (D(2024, 2, 29), "C", "BA", NAN),
            (D(2024, 2, 29), "D", "BA", 3.0),
            (D(2024, 3, 1), "A", "MT", None),
            (D(2024, 3, 1), "E", "BA", 5.0),
            (None, "A", "MT", 7.0),
        ],
        "data date, cidade string, estado string, precipitacao_mm double",
    )


@pytest.fixture
def prices(spark):
    return spark.createDataFrame(
        [
            (T(2024, 2, 29, 0, 0), 10.0),
            (T(2024, 2, 29, 23, 30), 20.0),
            (T(2024, 3, 2), 40.0),
            (None, 80.0),
        ],
        "timestamp timestamp, preco double",
    )


def test_monthly_production(production, rows):
    got = gold.monthly_production(production)
    assert got.columns == ["ano", "mes", "estado", "producao_mensal_total"]
    assert rows(got) == sorted(
        [(2015, 12, "BA", 1.0), (2015, 12, "MT", 2.0), (2016, 1, "BA", 4.0), (2016, 1, "MT", 8.0),
         (None, None, "MT", 16.0)],
        key=repr,
    )


def test_replays_count_once_with_the_key(production, rows):
    sent_thrice = production.union(production).union(production)
    once = gold.monthly_production(sent_thrice, unique_on=["data", "estado"])
    assert rows(once) == rows(gold.monthly_production(production))
    assert rows(gold.monthly_production(sent_thrice)) != rows(once)


def test_daily_mean_rain_skips_nan(climate, rows):
    assert rows(gold.daily_mean_rain(climate)) == sorted(
        [(D(2024, 2, 29), "MT", 2.5), (D(2024, 2, 29), "BA", 3.0), (D(2024, 3, 1), "MT", None),
         (D(2024, 3, 1), "BA", 5.0), (None, "MT", 7.0)],
        key=repr,
    )
    assert rows(gold.daily_mean_rain(climate, scale=1)) == rows(gold.daily_mean_rain(climate))


def test_daily_total_rain(climate, rows):
    got = gold.daily_total_rain(climate)
    assert got.columns == ["ano", "mes", "dia", "estado", "precipitacao_total_mm"]
    assert (2024, 2, 29, "MT", 5.0) in rows(got) and (2024, 3, 1, "MT", None) in rows(got)


def test_price_tables(prices, rows):
    assert rows(gold.daily_mean_price(prices)) == sorted(
        [(D(2024, 2, 29), 15.0), (D(2024, 3, 2), 40.0), (None, 80.0)], key=repr
    )
    got = gold.price_rows(prices)
    assert got.columns == ["data", "preco", "ano", "mes", "dia"]
    assert (T(2024, 2, 29, 23, 30), 20.0, 2024, 2, 29) in rows(got)
    assert got.count() == 4


def test_production_series(production):
    monthly = gold.monthly_production(production)
    whole = [tuple(r) for r in serve.production_series(monthly).collect()]
    assert whole == [(D(2015, 12, 1), 3.0), (D(2016, 1, 1), 12.0)]
    assert whole == [tuple(r) for r in serve.production_series(monthly, "Todos").collect()]
    one = [tuple(r) for r in serve.production_series(monthly, "BA").collect()]
    assert one == [(D(2015, 12, 1), 1.0), (D(2016, 1, 1), 4.0)]
    assert [r.estado for r in serve.production_states(monthly).collect()] == ["BA", "MT"]


def test_states_add_up_to_the_whole(production):
    monthly = gold.monthly_production(production)
    parts = {}
    for state in ("BA", "MT"):
        for r in serve.production_series(monthly, state).collect():
            parts[r.data] = parts.get(r.data, 0) + r.producao_mensal_total
    assert parts == {r.data: r.producao_mensal_total for r in serve.production_series(monthly).collect()}


def test_points(climate, prices, rows):
    rain, price = gold.daily_mean_rain(climate), gold.daily_mean_price(prices)
    assert rows(serve.rain_price_points(rain, price, "MT")) == [(2.5, 15.0)]
    assert serve.rain_and_price(rain, price).count() == 2


@pytest.fixture
def relation(climate, prices):
    def make(**filters):
        return serve.RainPriceRelation(
            gold.daily_total_rain(climate), gold.price_rows(prices), **filters
        )

    return make


def test_relation_pairs_every_price_of_the_day(relation, rows):
    day = D(2024, 2, 29)
    assert rows(relation().rows()) == [
        (day, "BA", 3.0, 10.0), (day, "BA", 3.0, 20.0), (day, "MT", 5.0, 10.0), (day, "MT", 5.0, 20.0),
    ]
    assert rows(relation(state="MT").price_series()) == [(day, 10.0), (day, 20.0)]
    assert rows(relation(state="MT").rain_series()) == [(day, "MT", 5.0)] * 2


def test_relation_filters(relation):
    assert relation(first=D(2024, 3, 1)).rows().count() == 0
    assert relation(first=D(2024, 2, 29), last=D(2024, 2, 29)).rows().count() == 4
    assert relation(last=D(2024, 2, 28)).rows().count() == 0


def test_cards_and_filter_choices(relation):
    assert tuple(relation().mean_cards().first()) == (4.0, 15.0)
    assert tuple(relation(state="BA").mean_cards().first()) == (3.0, 15.0)
    assert [r.estado for r in relation().states().collect()] == ["BA", "MT"]
    assert tuple(relation().date_range().first()) == (D(2024, 2, 29), D(2024, 2, 29))


def test_trend_line_matches_the_rows(relation):
    line = relation().trend_line().first()
    assert (line.inclinacao, line.intercepto, line.pontos) == (0.0, 15.0, 4)


def test_relation_filters_reach_the_scan(spark, tmp_path, climate, prices):
    gold.daily_total_rain(climate).write.parquet(str(tmp_path / "rain"))
    gold.price_rows(prices).write.parquet(str(tmp_path / "price"))
    stored = serve.RainPriceRelation(
        spark.read.parquet(str(tmp_path / "rain")),
        spark.read.parquet(str(tmp_path / "price")),
        "MT",
        D(2024, 1, 1),
        D(2024, 12, 31),
    )
    plan = stored.mean_cards()._jdf.queryExecution().executedPlan().toString()
    for pushed in ("EqualTo(estado,MT)", "GreaterThanOrEqual(ano,2024)", "GreaterThanOrEqual(data,2024-01-01"):
        assert pushed in plan, pushed
    assert "mes" in plan and "Cartesian" not in plan


def test_gold_plan_is_one_shuffle(spark, production):
    plan = gold.monthly_production(production)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan


def test_mean_price_groups_by_the_session_day(spark, prices):
    got = gold.daily_mean_price(prices.filter(F.col("preco") == 20.0)).first()
    assert got.data == D(2024, 2, 29)
