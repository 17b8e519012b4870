"""The driver's tables in the shape of the pipeline's silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The layout is known, so no job is spent on reading it from a file footer.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def production_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("data"),
        F.col("l_returnflag").alias("estado"),
        F.col("l_quantity").alias("producao"),
    )


def climate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("data"),
        F.col("user_id").cast("string").alias("cidade"),
        F.col("event_type").alias("estado"),
        F.col("value").alias("precipitacao_mm"),
    )


def price_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"), F.col("o_totalprice").alias("preco")
    )


def shipment_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem in the shape of rain, on the same dates as the orders."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("data"),
        F.col("l_returnflag").alias("estado"),
        F.col("l_quantity").alias("precipitacao_mm"),
    )
