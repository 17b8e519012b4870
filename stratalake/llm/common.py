"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.sizing import settled

__all__ = ["held_out", "let", "list_texts", "map_texts", "read", "row_key", "settled"]

# Stands for a null id in keys; ids of this value and null ids sort alike, first.
NULL_ID = -(2**63)

FOLDS, HELD_OUT = 4, 2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column named inside a lambda may be inlined by the optimizer and then be
    computed for every element; a lambda's own variable is not.
    """
    return F.transform(F.array(value), use).getItem(0)


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Id (null as the least) and text hash. Equal rows have equal keys."""
    return (
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
    )


def held_out(id_col: str) -> Column:
    """The fold that labels are never learned from; a null id is in it."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def list_texts(column: pa.Array, least: int = 256) -> Iterator[tuple[int, list[str]]]:
    """Slices of a string column as Python strings (null as empty), with their start.

    Only one slice of a batch is held as Python objects at a time.
    """
    for start in range(0, len(column), least):
        yield start, [t or "" for t in column.slice(start, least).to_pylist()]


def map_texts(
    df: DataFrame,
    schema: str,
    work: Callable[[list[str]], dict[str, list | pa.Array]],
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """Run ``work`` on slices of texts; its columns stand beside those of ``keep``.

    ``schema`` names all columns in order, those of ``keep`` first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in list_texts(batch.column("_text")):
                made = work(texts)
                kept = [batch.column(name).slice(start, len(texts)) for name in keep]
                arrays = kept + [
                    v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v)
                    for v in made.values()
                ]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, *made])

    return df.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)
