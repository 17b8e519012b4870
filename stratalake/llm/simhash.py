"""SimHash fingerprints and their components (operator 1).

Fingerprints within the radius are found by covering masks: some table hides all
differing bits of such a pair, so both have one key there. Within a table's
bucket the members differ in hidden bits only. Two fingerprints of a bucket are
within two bits of each other exactly if both are within one bit of some third
value, so members meet at these values ("centres") instead of in pairs: a centre
has at most 65 different members, all of which are linked. No pairs of a bucket
are formed, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settled
from stratalake.llm.components import connected_components
from stratalake.llm.covering import covering_tables

BITS = 64
SEED = 42
RADIUS = 2


def shingle_hashes(text: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words, lower-cased in A-Z, joined by a space.

    bytes.lower() changes A-Z only and bytes.split() splits at ASCII white space
    only. Fewer words are one run; no words give no hash.
    """
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    whole = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[words - 1 :].tolist() if len(parts) >= words else [len(whole)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(whole[s:e], seed) for s, e in zip(starts, ends, strict=False)), np.uint64, len(ends)
    )


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes; none give zero. Signed."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        some = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp): one pass over whole texts, nothing is shuffled. Null is empty."""

    def run(batches):
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            made = np.fromiter(
                (fingerprint_of(shingle_hashes(t.as_py() or b"", words)) for t in texts),
                np.int64,
                len(texts),
            )
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(made)], [id_col, "fp"])

    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, fp long"
    return docs.select(id_col, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _signed(positions: list[int]) -> int:
    value = sum(1 << p for p in positions)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all of column fp within two bits of each other."""
    kept = covering_tables(BITS, RADIUS)
    hidden = [[p for p in range(BITS) if p not in table] for table in kept]
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(k))).alias("key"))
            for i, k in enumerate(kept)
        ]
    )
    entries = distinct.select("fp", F.explode(keys).alias("_k")).select("_k.t", "_k.key", "fp")
    shared = (
        entries.groupBy("t", "key")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .filter("low != high")
        .select("t", "key")
    )
    flips = F.array(*[F.array(F.lit(0), *[F.lit(_signed([p])) for p in h]) for h in hidden])
    centres = entries.join(shared, ["t", "key"]).select(
        "fp", F.explode(F.element_at(flips.cast("array<array<bigint>>"), F.col("t") + 1)).alias("_flip")
    )
    # at most 65 values of fp have a centre within one bit
    met = centres.groupBy(F.col("fp").bitwiseXOR(F.col("_flip")).alias("_centre")).agg(
        F.collect_set("fp").alias("_met")
    )
    return (
        met.filter(F.size("_met") > 1)
        .select(F.array_min("_met").alias("b"), F.explode("_met").alias("a"))
        .filter("a != b")
        .distinct()
    )


HOT = 1000


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint and component of every row.

    Returns the id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable over links of two or fewer differing bits. A null text
    is empty; all rows without words have fingerprint zero and are linked. Equal
    fingerprints are one node, so copies meet in an aggregate, not in pairs.
    Repeated rows come out as often as they went in. Null ids are kept and never
    name a component unless all of its ids are null; then it is null. Other
    columns are ignored; an empty table gives an empty result.
    """
    marked = settled(fingerprints(docs, words, id_col, text_col))
    nodes = settled(
        marked.groupBy("fp").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    )
    linked = connected_components(fingerprint_links(nodes.select("fp")))
    named = linked.join(nodes, linked["node"] == nodes["fp"]).select("fp", "component", "_first")
    least = named.groupBy("component").agg(F.min("_first").alias("_least"))
    of_linked = named.join(least, "component").select("fp", "_least")
    of_all = nodes.join(of_linked, "fp", "left").select(
        "fp", "_rows", F.coalesce("_least", "_first").alias("component_id")
    )
    # fingerprints of more than a HOT-th of the rows each: HOT of them at most, so they may
    # be broadcast, and none of the others makes a task large
    least_hot = (nodes.agg(F.sum("_rows")).first()[0] or 0) / HOT
    hot = of_all.filter(F.col("_rows") > least_hot).drop("_rows")
    rest = of_all.filter(F.col("_rows") <= least_hot).drop("_rows")
    cold = marked.join(F.broadcast(hot.select("fp")), "fp", "left_anti")
    met = marked.join(F.broadcast(hot), "fp").unionByName(cold.join(rest, "fp"))
    return met.select(id_col, hex16(F.col("fp")).alias("fingerprint"), "component_id")
