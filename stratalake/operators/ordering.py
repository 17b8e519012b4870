"""Global sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_rows(
    df: DataFrame, by: Sequence[str], ties: Sequence[str] = (), ascending: bool = True
) -> DataFrame:
    """Rows in the order of ``by``; equal ones in the order of ``ties``.

    The number of the source partition comes last. It says nothing about the
    order asked for, but lets the range shuffle split a value, or a set of
    copies, that holds a large share of the rows over many tasks.
    """
    keys = [F.col(name).asc() if ascending else F.col(name).desc() for name in by]
    return df.orderBy(*keys, *ties, F.spark_partition_id())


def first_rows(df: DataFrame, count: int = 5) -> DataFrame:
    """A preview; on sorted rows it takes the top without a full sort."""
    return df.limit(count)
