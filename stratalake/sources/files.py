"""Batch file scans."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.quality import require_columns, require_rows
from stratalake.schemas import GRID, PRODUCTION_CSV_COLUMNS

log = logging.getLogger(__name__)

# --- fixed values: cell texts that count as missing in a CSV ------------------
MISSING_TEXTS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv_text(
    spark: SparkSession, path: str | list[str], sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column as text: no inference pass over the data.

    A quote within a quoted cell is doubled. A file whose header differs from the
    first one's raises when it is read. ``multi_line`` allows line breaks in
    quoted cells; a file is then one task, so it is off by default.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .csv(path)
    )
    cells = {
        name: F.when(~F.col(f"`{name}`").isin(MISSING_TEXTS), F.col(f"`{name}`"))
        for name in raw.columns
    }
    return raw.select(*[cell.alias(name) for name, cell in cells.items()])


def read_production_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Production CSV; raises where it has no rows or lacks a column."""
    df = read_csv_text(spark, path, multi_line=multi_line)
    require_columns(df, PRODUCTION_CSV_COLUMNS)
    require_rows(df)
    return df


def read_price_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Price CSV with its headers stripped and lower-cased."""
    df = read_csv_text(spark, path)
    return df.toDF(*[name.strip().lower() for name in df.columns])


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_grid_years(
    spark: SparkSession,
    path_of: Callable[[int], str],
    years: Iterable[int],
    schema: T.StructType = GRID,
) -> DataFrame:
    """Union of the yearly rainfall grids; a year without a path is logged and skipped.

    The year travels as a literal column ``ano``, so a filter on it drops whole
    branches of the union before any file is read.
    """
    union: DataFrame | None = None
    for year in years:
        try:
            grid = spark.read.schema(schema).parquet(path_of(year))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("grid of %s skipped: %s", year, error)
            continue
        grid = grid.withColumn("ano", F.lit(year))
        union = grid if union is None else union.unionByName(grid)
    if union is None:
        raise FileNotFoundError("none of the yearly grids can be read")
    return union
