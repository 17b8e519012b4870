"""Tables under a primary key, parted by year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.quality import append_absent
from stratalake.session import path_exists
from stratalake.sinks.files import append

YEAR = "ano"


def stored_near(new: DataFrame, path: str, date_col: str) -> DataFrame:
    """The stored rows that ``new`` can meet: its years' partitions, and in these the
    dates between its first and last one, by which files are skipped. Rows without a
    date are in a partition of their own. One pass over the dates of ``new``."""
    date = F.to_date(date_col)
    edges = new.agg(
        F.min(date_col).alias("first"), F.max(date_col).alias("last"),
        F.min(F.year(date)).alias("y0"), F.max(F.year(date)).alias("y1"),
    ).first()
    stored = new.sparkSession.read.parquet(path)
    unknown = F.col(YEAR).isNull()
    if edges["y0"] is None:
        return stored.filter(unknown)
    in_years = F.col(YEAR).between(edges["y0"], edges["y1"]) | unknown
    between = F.col(date_col).between(F.lit(edges["first"]), F.lit(edges["last"]))
    return stored.filter(in_years).filter(between | F.col(date_col).isNull() | unknown)


def append_by_year(new: DataFrame, path: str, keys: Sequence[str], date_col: str) -> None:
    """Append the rows whose key is not stored, to a table with a folder per year.

    ``date_col`` is one of ``keys``, a date or an ISO text. Of what is stored only the
    years of ``new`` are read, and of these only the key's columns for rows with a whole
    key. Keys, equal rows and nulls are as in
    :func:`stratalake.operators.quality.append_absent`.
    """
    if date_col not in keys:
        raise ValueError(f"{date_col} is not in the key, so a key may be in several years")
    dated = new.withColumn(YEAR, F.year(F.to_date(date_col)))
    if path_exists(new.sparkSession, path):
        stored = stored_near(new, path, date_col).select(*dated.columns)
    else:
        stored = dated.limit(0)
    append(append_absent(dated, stored, keys), path, partition_by=[YEAR])
