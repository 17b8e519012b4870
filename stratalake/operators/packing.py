"""Many rows into few messages, one per key value, and back."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a message may measure: a Kafka producer's default bound is 1,048,576 bytes.
MESSAGE_BYTES = 1_000_000


def parts_for(most_rows: int, bytes_per_row: int, budget: int = MESSAGE_BYTES) -> int:
    """How many parts keep a message of the largest group within ``budget``.

    A hash does not deal evenly, so a part is planned for two thirds of it.
    """
    return max(1, math.ceil(most_rows * bytes_per_row * 1.5 / budget))


def pack(
    df: DataFrame,
    by: Sequence[str],
    record: Sequence[str] | None = None,
    unique_on: Sequence[str] | None = None,
    parts: int = 1,
) -> DataFrame:
    """Rows of the same ``by`` value as arrays of records, ``registros``.

    Every group makes ``parts`` messages, whatever its size, and each says which
    it is: ``parte`` (from 0) of ``partes``, with ``linhas`` records. A part may be
    empty. Rows are dealt to the parts by a hash of ``unique_on``, or in turn
    where no columns identify a row. The rows are shuffled once; for several parts
    the keys alone are read a second time, so that no part is missing.
    """
    record = list(record or df.columns)
    by = list(by)
    slot = F.xxhash64(*unique_on) if unique_on else F.monotonically_increasing_id()
    rows = df.select(
        *by,
        F.pmod(slot, F.lit(parts)).cast("int").alias("parte"),
        F.struct(*record).alias("_record"),
    )
    if parts > 1:
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("parte")
        empty = F.lit(None).cast(rows.schema["_record"].dataType).alias("_record")
        rows = rows.unionByName(df.select(*by).distinct().select(*by, every, empty))
    return rows.groupBy(*by, "parte").agg(
        F.lit(parts).cast("long").alias("partes"),
        F.count("_record").alias("linhas"),
        F.sort_array(F.collect_list("_record")).alias("registros"),
    )


def require_all_parts(df: DataFrame, by: Sequence[str]) -> None:
    """Raise where a part of a packed group is not there.

    Only the keys and numbers of the messages are read, not what is in them.
    """
    numbers = df.select(*by, "parte", "partes")
    broken = numbers.groupBy(*by).agg(
        F.count_distinct("parte").alias("n"), F.max("partes").alias("partes")
    )
    first = broken.filter("n <> partes").first()
    if first is not None:
        named = ", ".join(str(first[name]) for name in by)
        raise ValueError(f"{named}: {first['n']} of {first['partes']} parts are there and whole")


def require_whole_parts(df: DataFrame, by: Sequence[str], records: str = "registros") -> None:
    """Raise where a part has other than as many records as it says."""
    first = df.filter(F.size(records) != F.col("linhas")).select(*by, "parte").first()
    if first is not None:
        named = ", ".join(str(first[name]) for name in by)
        raise ValueError(f"{named}: part {first['parte']} is not whole")


def unpack(
    df: DataFrame,
    records: str = "registros",
    complete_by: Sequence[str] | None = None,
    checked: bool = True,
) -> DataFrame:
    """One row per record; null and empty arrays give none.

    With ``complete_by``, the columns the rows were packed by, a missing part or a cut
    one raises instead of leaving rows out. The messages are read for that once and
    again for the records. ``checked=False`` only counts the parts beforehand, from
    keys and numbers, and lets a cut part fail where its records are read.
    """
    if complete_by is not None:
        require_all_parts(df, complete_by)
        if checked:
            require_whole_parts(df, complete_by, records)
        else:
            cut = F.size(records) != F.col("linhas")
            said = F.concat_ws(" ", F.lit("part"), "parte", F.lit("is not whole"))
            df = df.withColumn(records, F.when(cut, F.raise_error(said)).otherwise(F.col(records)))
    return df.select(F.explode(records).alias("_record")).select("_record.*")
