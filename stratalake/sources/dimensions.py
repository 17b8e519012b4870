"""Literal dimension tables. Their size is fixed in the code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.schemas import HUB, HUBS, STATE, STATES


def hubs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HUBS, HUB)


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, STATE)
