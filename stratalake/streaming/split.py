"""Silver, rejects and their counts from one read of the source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.sinks.files import write_batch
from stratalake.streaming.queries import BATCH_INTERVAL

# What a checked row carries beside its silver columns.
MESSAGE, NUMBER, SENT, TEXTS = "_mensagem", "_numero", "value", "_texts"
REASON = "motivo"
UNREADABLE, NO_KEY, BAD_VALUE = "mensagem ilegível", "sem chave", "valor ilegível"


def rejection(fields: Mapping[str, str], key: Sequence[str]) -> Column:
    """Why a row is no silver row, null for a good one.

    ``fields`` names the record's field of each silver column: text was sent, and the
    column is null. A message that holds no record at all comes without texts.
    """

    def unread(column: str, field: str) -> Column:
        return F.col(f"`{column}`").isNull() & F.col(TEXTS).getField(field).isNotNull()

    bad = [unread(column, field) for column, field in fields.items()]
    unkeyed = [F.col(f"`{name}`").isNull() for name in key]
    either = reduce(lambda a, b: a | b, bad, F.lit(False))
    missing = reduce(lambda a, b: a | b, unkeyed, F.lit(False))
    return (
        F.when(F.col(TEXTS).isNull(), UNREADABLE).when(either, BAD_VALUE).when(missing, NO_KEY)
    )


def counts_of(reason: Column) -> dict[str, Column]:
    """Rows in, silver rows, and rejects by reason, as aggregates of one pass."""
    named = {"ilegiveis": UNREADABLE, "sem_chave": NO_KEY, "valores": BAD_VALUE}
    one = F.lit(1)
    return {
        "entrada": F.count(one),
        "prata": F.count(F.when(reason.isNull(), one)),
        **{name: F.count(F.when(reason == why, one)) for name, why in named.items()},
    }


def take_batch(
    checked: DataFrame,
    number: int,
    take_silver: Callable[[DataFrame, int], None],
    rejects: str,
    counts: str | None = None,
) -> None:
    """One batch of checked rows (with ``motivo``) to the three tables.

    The batch is read and parsed once and kept for its second write; a lost executor's
    share is read again. Each table takes it under the batch's number, so a batch that
    failed between them is complete and single when it has been tried again;
    ``take_silver`` has to see to that too, as a batch's folder or a merge does.

    Rejects have a row per message, not per record: the message as it was sent, the
    numbers (from 1) of its bad records and why they are, in the order of the numbers.
    """
    seen = Observation()
    kept = checked.observe(
        seen, *[count.alias(name) for name, count in counts_of(F.col(REASON)).items()]
    ).persist()
    helpers = [MESSAGE, NUMBER, SENT, TEXTS, REASON]
    take_silver(kept.filter(F.col(REASON).isNull()).drop(*helpers), number)
    numbered = F.array_sort(F.collect_list(F.struct(NUMBER, REASON)))
    bad = (
        kept.filter(F.col(REASON).isNotNull())
        .groupBy(MESSAGE).agg(F.first(SENT).alias("value"), numbered.alias("_bad"))
        .select(
            "value",
            F.transform("_bad", lambda r: r[NUMBER]).alias("registros"),
            F.transform("_bad", lambda r: r[REASON]).alias("motivos"),
        )
    )
    write_batch(bad, rejects, number)
    if counts:
        told = seen.get
        schema = T.StructType([T.StructField(name, T.LongType()) for name in told])
        row = checked.sparkSession.createDataFrame([tuple(told.values())], schema)
        write_batch(row, counts, number)
    kept.unpersist()


def start_split(
    arriving: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    reason: Column,
    take_silver: Callable[[DataFrame, int], None],
    rejects: str,
    checkpoint: str,
    counts: str | None = None,
    interval: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """A query that sends good rows to ``take_silver`` and the others to ``rejects``.

    ``check`` makes silver rows of a batch, beside the columns of
    :func:`stratalake.plans.silver.numbered_records`, and ``reason`` is null for the good
    ones. Every message, record and batch ends up in the tables once, however often a
    batch is tried. ``counts`` takes a row per batch: records in, silver rows, and
    rejects by reason.
    """

    def take(batch: DataFrame, number: int) -> None:
        checked = check(batch).withColumn(REASON, reason)
        take_batch(checked, number, take_silver, rejects, counts)

    writer = arriving.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def into_batches(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Silver as a folder per batch, for :func:`stratalake.sinks.files.read_batches`."""
    return lambda rows, number: write_batch(rows, path, number, partition_by)
