"""Input guards, null handling and replay de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.schemas import BOOKKEEPING


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the input has no rows")


def drop_incomplete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with a null or NaN in one of ``names`` go."""
    return df.na.drop(subset=list(names))


def _nameless(keys: Sequence[str]) -> Column:
    """True where a column of the key is null."""
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys], F.lit(False))


def drop_replays(
    df: DataFrame,
    keys: Sequence[str] = (),
    newest_by: str | None = None,
    ignore: Sequence[str] = BOOKKEEPING,
) -> DataFrame:
    """``df`` without the rows that a replay sent again.

    A replay sends equal rows, so only these go: two different rows of one key
    are both kept. Columns in ``ignore`` tell when a row came in, so rows that
    differ in them alone are equal, and the first is kept. Where a source corrects
    rows, name the ingest column in ``newest_by``, and of each key the last one sent
    stays. A null never matches another null there: rows with a null in the key go
    only as equal copies. All forms combine copies before the shuffle: a row that
    is a third of all leaves each task once.
    """
    when = [name for name in df.columns if name in ignore and name != newest_by]
    if newest_by is None:
        if not when:
            return df.dropDuplicates()
        said = [name for name in df.columns if name not in when]
        first = F.min(F.struct(*when)).alias("_first")
        return df.groupBy(*said).agg(first).select(*said, "_first.*").select(*df.columns)
    rest = [name for name in df.columns if name not in keys and name != newest_by]
    whole = F.when(_nameless(keys), F.struct(*[name for name in rest if name not in when]))
    newest = F.max(F.struct(newest_by, *rest)).alias("_newest")
    kept = df.groupBy(*keys, whole.alias("_whole")).agg(newest)
    return kept.select(*keys, "_newest.*").select(*df.columns)


def append_absent(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``stored`` lacks, one per key.

    Appending these keeps ``keys`` a primary key, so two different rows of a key that
    is not stored yet raise when the result is written; equal rows are one. A null
    in the key matches nothing: such a row is left out only where an equal row is
    stored, in all columns of ``new``, and different ones are all kept. Pass
    ``stored`` filtered to the part that ``new`` can touch (its year, say) so that
    only this is read.
    """
    keys, names = list(keys), new.columns
    rest = [F.col(f"`{name}`") for name in names if name not in keys]
    absent = new.filter(~_nameless(keys)).join(stored.select(*keys), keys, "left_anti")
    if rest:
        least, most = F.min(F.struct(*rest)), F.max(F.struct(*rest))
        named = F.concat_ws(", ", *[F.col(f"`{k}`").cast("string") for k in keys])
        clash = F.raise_error(F.concat(F.lit("different rows of the key "), named))
        one = absent.groupBy(*keys).agg(least.alias("_least"), most.alias("_most"))
        row = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_least")).otherwise(clash)
        absent = one.select(*keys, row.alias("_row")).select(*keys, "_row.*").select(*names)
    else:
        absent = absent.dropDuplicates()
    whole = new.filter(_nameless(keys)).dropDuplicates().alias("new")
    there = stored.filter(_nameless(keys)).select(*names).alias("there")
    equal = [F.col(f"new.`{n}`").eqNullSafe(F.col(f"there.`{n}`")) for n in names]
    unkeyed = whole.join(there, reduce(lambda a, b: a & b, equal), "left_anti")
    return absent.unionByName(unkeyed)


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all of ``required``, and the others for quarantine."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(f"`{name}`").isNotNull()
    return df.filter(complete), df.filter(~complete)
