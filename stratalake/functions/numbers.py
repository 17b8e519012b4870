"""Number parsing and sums that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column, grouped: bool = False, to: str = "double") -> Column:
    """Number whose decimal mark may be a comma: ``134,50`` and ``134.5`` both read.

    ``grouped`` also takes ``1.234,50``: where a comma is present, the points
    are thousands marks and are dropped. Without it such text gives null.
    """
    plain = F.translate(text, ",", ".")
    if grouped:
        plain = F.when(F.contains(text, F.lit(",")), F.translate(text, ",.", ".")).otherwise(text)
    return plain.try_cast(to)


def numeric(text: Column) -> Column:
    """Number or null. The cast alone would read ``12d`` and ``12f`` as 12."""
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), without_nan(text.try_cast("double")))


def without_nan(value: Column) -> Column:
    """NaN as null, so that sums and means skip it."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def _units(value: Column, scale: int) -> Column:
    return F.rint(value * 10**scale).cast("bigint")


def fixed_sum(value: Column, scale: int | None = None) -> Column:
    """Sum as double. Give ``scale`` for data with that many decimal places.

    The sum then runs on whole units, so the result is exact and the same for
    any split of the rows, at the price of a plain long addition. Out-of-range
    values raise (ANSI) rather than wrap.
    """
    if scale is None:
        return F.sum(value)
    return F.sum(_units(value, scale)) / F.lit(10**scale)


def fixed_mean(value: Column, scale: int | None = None) -> Column:
    """Mean of the non-null values; ``scale`` as in :func:`fixed_sum`."""
    if scale is None:
        return F.avg(value)
    # try_divide: a group of nulls only has count 0 and gives null
    return F.try_divide(fixed_sum(value, scale), F.count(value))
