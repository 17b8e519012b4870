"""Size checks that come before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import shared_folder

# What a broadcast side may measure, every copy of its rows counted.
BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows written as JSON, which names and digits make larger than
    they are in memory. One pass; each task sends one number."""
    size = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.sum(size)).first()[0] or 0


def broadcast_within(df: DataFrame, size: int, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it, else untouched.

    Untouched, the join shuffles both sides on the key and adaptive execution
    splits partitions that a hot key makes too large.
    """
    return F.broadcast(df) if size <= (BROADCAST_BYTES if limit is None else limit) else df


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so it is not run again."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
