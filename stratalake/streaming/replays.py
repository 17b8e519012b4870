"""Replay de-duplication on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.schemas import INGEST_TIME


def drop_replays_stream(
    df: DataFrame, within: str = "1 day", ingest_time: str = INGEST_TIME
) -> DataFrame:
    """The first of equal rows among those that came in ``within`` that time.

    Rows are equal if all columns but ``ingest_time`` are; two different rows of
    one key both pass. The watermark runs on ``ingest_time``, added as the batch's
    clock if absent: a replay repeats dates of years back, which an event-time
    watermark would take for late data. State holds the rows of the last
    ``within`` only; what is replayed later passes, and gold drops it.
    """
    if ingest_time not in df.columns:
        df = df.withColumn(ingest_time, F.current_timestamp())
    row = [name for name in df.columns if name != ingest_time]
    return df.withWatermark(ingest_time, within).dropDuplicatesWithinWatermark(row)
