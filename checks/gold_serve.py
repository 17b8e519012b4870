"""Gold tables and serving queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    climate_silver,
    price_silver,
    production_silver,
    shipment_silver,
    table,
)
from stratalake.operators.aggregates import bounds, distinct_sorted, row_counts, trend
from stratalake.operators.filters import in_dates
from stratalake.operators.ordering import first_rows, sort_rows
from stratalake.plans import gold, serve

FIRST, LAST = dt.date(1996, 1, 1), dt.date(1998, 12, 31)

_MONTHLY = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
           l_returnflag AS estado, SUM(l_quantity) AS producao_mensal_total
    FROM lineitem GROUP BY ALL"""


@query(_MONTHLY + " ORDER BY ano, mes, estado")
def q_monthly_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = gold.monthly_production(production_silver(spark, sf_dir))
    return monthly.orderBy(*gold.MONTHLY_PRODUCTION_ORDER)


@query("""
    SELECT CAST(ts AS DATE) AS data, event_type AS estado,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)
               AS precipitacao_media_diaria
    FROM events GROUP BY ALL ORDER BY data, estado""")
def q_daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_mean_rain(climate_silver(spark, sf_dir), scale=2)
    return daily.orderBy(*gold.DAILY_MEAN_RAIN_ORDER)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS data,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice)
               AS preco_medio_dolar
    FROM orders GROUP BY ALL ORDER BY data""")
def q_daily_price_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_mean_price(price_silver(spark, sf_dir), scale=2)
    return daily.orderBy(*gold.DAILY_MEAN_PRICE_ORDER)


@query("""
    SELECT CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
           CAST(day(ts) AS INTEGER) AS dia, event_type AS estado,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS precipitacao_total_mm
    FROM events GROUP BY ALL ORDER BY ano, mes, dia, estado""")
def q_daily_sum_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_total_rain(climate_silver(spark, sf_dir), scale=2)
    return daily.orderBy(*gold.DAILY_TOTAL_RAIN_ORDER)


@query("""
    SELECT o_orderdate AS data, o_totalprice AS preco,
           CAST(year(o_orderdate) AS INTEGER) AS ano,
           CAST(month(o_orderdate) AS INTEGER) AS mes,
           CAST(day(o_orderdate) AS INTEGER) AS dia
    FROM orders""")
def q_price_rows_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.price_rows(price_silver(spark, sf_dir))


@query("""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS data,
           SUM(l_quantity) AS producao_mensal_total
    FROM lineitem GROUP BY ALL ORDER BY data""")
def q_national_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = gold.monthly_production(production_silver(spark, sf_dir))
    return serve.production_series(monthly, "Todos")


@query("""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS data,
           SUM(l_quantity) AS producao_mensal_total
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL ORDER BY data""")
def q_state_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = gold.monthly_production(production_silver(spark, sf_dir))
    return serve.production_series(monthly, "R")


@query("SELECT DISTINCT l_returnflag AS estado FROM lineitem ORDER BY estado")
def q_production_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = gold.monthly_production(production_silver(spark, sf_dir))
    return serve.production_states(monthly)


def _daily_means(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rain: all events by type. Price: the purchase events."""
    purchases = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    rain = gold.daily_mean_rain(climate_silver(spark, sf_dir), scale=2)
    price = gold.daily_mean_price(
        purchases.select(F.col("ts").alias("timestamp"), F.col("value").alias("preco")),
        scale=2,
    )
    return rain, price


_DAILY_JOIN = """
    WITH rain AS (
        SELECT CAST(ts AS DATE) AS data, event_type AS estado,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)
                   AS precipitacao_media_diaria
        FROM events GROUP BY ALL),
    price AS (
        SELECT CAST(ts AS DATE) AS data,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)
                   AS preco_medio_dolar
        FROM events WHERE event_type = 'purchase' GROUP BY ALL)"""


@query(_DAILY_JOIN + """
    SELECT data, estado, precipitacao_media_diaria, preco_medio_dolar
    FROM rain JOIN price USING (data)""")
def q_join_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.rain_and_price(*_daily_means(spark, sf_dir))


@query(_DAILY_JOIN + """
    SELECT precipitacao_media_diaria, preco_medio_dolar
    FROM rain JOIN price USING (data) WHERE estado = 'view'""")
def q_scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.rain_price_points(*_daily_means(spark, sf_dir), "view")


def _relation(
    spark: SparkSession,
    sf_dir: str,
    state: str | None = None,
    first: dt.date | None = FIRST,
    last: dt.date | None = LAST,
) -> serve.RainPriceRelation:
    """Daily shipped quantity per flag against the order rows.

    The gold tables are not stored here, so the dates are cut on silver too,
    where the bounds reach the scan.
    """
    shipped = in_dates(shipment_silver(spark, sf_dir), "data", first, last)
    return serve.RainPriceRelation(
        gold.daily_total_rain(shipped),
        gold.price_rows(price_silver(spark, sf_dir)),
        state,
        first,
        last,
    )


def _related(where: str) -> str:
    return f"""
    WITH rain AS (
        SELECT CAST(l_shipdate AS DATE) AS data, l_returnflag AS estado,
               SUM(l_quantity) AS precipitacao_total_mm
        FROM lineitem GROUP BY ALL),
    related AS (
        SELECT data, estado, precipitacao_total_mm, o_totalprice AS preco
        FROM rain JOIN orders ON data = CAST(o_orderdate AS DATE) WHERE {where})"""


_RANGE = "data BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"


@query(_related(_RANGE) + "SELECT * FROM related")
def q_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir).rows()


@query(_related(_RANGE + " AND estado = 'A'") + """
    SELECT data, estado, precipitacao_total_mm FROM related ORDER BY data""")
def q_rain_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir, "A").rain_series()


@query(_related(_RANGE + " AND estado = 'A'") + """
    SELECT data, preco FROM related ORDER BY data""")
def q_price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir, "A").price_series()


@query(_related(_RANGE) + """
    SELECT ROUND(AVG(precipitacao_total_mm), 2) AS precipitacao_media,
           ROUND(AVG(preco), 2) AS preco_medio
    FROM related""")
def q_means_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir).mean_cards()


@query(_related("estado = 'N'") + """
    SELECT ROUND(AVG(precipitacao_total_mm), 2) AS precipitacao_media,
           ROUND(AVG(preco), 2) AS preco_medio
    FROM related""")
def q_means_cards_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir, "N", None, None).mean_cards()


def _rounded(line: DataFrame) -> DataFrame:
    figures = ("inclinacao", "intercepto", "r2")
    return line.select(*[F.round(n, 6).alias(n) for n in figures], "pontos")


def _line(y: str, x: str) -> str:
    return f"""
    SELECT ROUND(regr_slope({y}, {x}), 6) AS inclinacao,
           ROUND(regr_intercept({y}, {x}), 6) AS intercepto,
           ROUND(regr_r2({y}, {x}), 6) AS r2,
           CAST(regr_count({y}, {x}) AS BIGINT) AS pontos"""


@query(_related(_RANGE) + _line("preco", "precipitacao_total_mm") + " FROM related")
def q_join_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_relation(spark, sf_dir).trend_line())


@query(_line("l_extendedprice", "l_quantity") + " FROM lineitem")
def q_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(trend(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"))


@query(_related("TRUE") + "SELECT DISTINCT estado FROM related ORDER BY estado")
def q_related_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir, None, None, None).states()


@query(_related("TRUE") + "SELECT MIN(data) AS inicio, MAX(data) AS fim FROM related")
def q_related_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relation(spark, sf_dir, None, None, None).date_range()


@query("""
    SELECT CAST(MIN(o_orderdate) AS DATE) AS inicio, CAST(MAX(o_orderdate) AS DATE) AS fim
    FROM orders""")
def q_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bounds(table(spark, sf_dir, "orders"), "o_orderdate")
    return found.select(*[F.to_date(name).alias(name) for name in found.columns])


@query("""
    SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL
    ORDER BY c_mktsegment""")
def q_distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sorted(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("SELECT COUNT(*) AS linhas FROM lineitem")
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(table(spark, sf_dir, "lineitem"))


@query("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def q_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return in_dates(orders, "o_orderdate", FIRST, LAST).select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate DESC, o_orderkey""")
def q_latest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return sort_rows(rows, ["o_orderdate"], ties=["o_orderkey"], ascending=False)


@query("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""")
def q_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(q_latest_first(spark, sf_dir))
