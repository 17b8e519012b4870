"""Divergence audit of sources (operator 11): cube partitioning over groups and terms.

Terms are counted per (language, source) group, combined in each task before they are
shuffled. The counts of a language form a table of groups by terms, which is cut into
blocks of groups and blocks of terms. A slice is one group's entries in one block of
terms. Slices are replicated to the cells (group block, group block, term block) that
compare them, a task owns a cell and adds up divergences over its terms alone, and the
partial sums are reduced along the term axis. What a cell holds is bounded by the two
block sizes, whatever a language, a source or a term weighs.

All arithmetic is on whole numbers: shares are parts of ``SHARE`` plus one, divided
exactly as decimals, and their squares stay within a long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import settled

SHARE = 1_000_000_000
LEAST_DOCS = 3
TOP_TERMS = 200
GROUP_BLOCK = 16
TERM_BLOCK = 4096

# What a task holds of counts before it sends them on.
_HELD_TERMS = 400_000

# A-Z to lower case; all else that is in no term becomes a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_COUNTS = "lang string, source string, term string, n long, d long"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), several rows a term at most.

    Each group also gives one row of the empty term, which no text holds.
    """
    names = ["lang", "source", "term", "n", "d"]
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in groups.items():
            n[b""] += 0
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    terms,
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([d[t] for t in n], pa.int64()),
                ],
                names,
            )

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        sources = batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for key, text in zip(zip(langs, sources), texts):
            own = Counter(text.as_py().translate(_FOLD).split())
            n, d = groups.setdefault(key, (Counter(), Counter()))
            held -= len(n)
            n.update(own)
            d.update(own.keys())
            held += len(n)
            if held > _HELD_TERMS:
                yield from flush()
                groups, held = {}, 0
    yield from flush()


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, d) with every group's empty term, partitioned by term."""
    read = docs.select(
        *(
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        )
    )
    return (
        read.mapInArrow(_count_terms, _COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SHARE * (count + 1) / (total + terms)), exactly."""
    part = F.lit(SHARE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    whole = (total + terms).cast("decimal(20,0)")
    return F.call_function("div", part, whole) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)² / q) of shares, which are up to SHARE + 1."""
    gap = p - q
    return gap * gap // q


def cell_sums(
    a: list[tuple[int, np.ndarray, np.ndarray]],
    b: list[tuple[int, np.ndarray, np.ndarray]],
    terms: int,
) -> np.ndarray:
    """Divergence of each group of ``a`` from each of ``b`` over one block of terms.

    A group is its share of a term it lacks, the numbers (from 0) of the terms it has
    and its shares of these. Terms that no group of the cell has differ by the same
    amount each and are counted, not visited.
    """
    met = np.unique(np.concatenate([g[1] for g in a + b])) if a or b else np.empty(0, np.int64)

    def filled(groups: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
        table = np.empty((len(groups), len(met)), np.int64)
        for row, (absent, numbers, shares) in zip(table, groups):
            row[:] = absent
            row[np.searchsorted(met, numbers)] = shares
        return table

    left, right = filled(a), filled(b)
    none_a = np.array([g[0] for g in a], np.int64)
    none_b = np.array([g[0] for g in b], np.int64)
    sums = np.empty((len(a), len(b)), np.int64)
    for i in range(len(a)):
        sums[i] = divergence(left[i], right).sum(axis=1)
        sums[i] += (terms - len(met)) * divergence(none_a[i], none_b)
    return sums


_PARTS = "lang string, source string, item string, value long"


def _solve_cell(key: tuple, table: pa.Table) -> pa.Table:
    """Both directions of every two groups of one cell."""
    low, high = key[1].as_py(), key[2].as_py()
    sides: dict[int, list] = {low: [], high: []}
    names: dict[int, list[str]] = {low: [], high: []}
    for at in range(table.num_rows):
        block = table["gb"][at].as_py()
        names[block].append(table["source"][at].as_py())
        sides[block].append(
            (
                table["absent"][at].as_py(),
                table["nos"][at].values.to_numpy().astype(np.int64),
                table["shares"][at].values.to_numpy(),
            )
        )
    terms = table["terms"][0].as_py()
    lang = key[0].as_py()
    source, item, value = [], [], []
    ways = {(low, high), (high, low)}
    for p, q in sorted(ways):
        sums = cell_sums(sides[p], sides[q], terms)
        for i, one in enumerate(names[p]):
            for j, other in enumerate(names[q]):
                if one != other:
                    source.append(one)
                    item.append(other)
                    value.append(int(sums[i, j]))
    return pa.table(
        {
            "lang": pa.array([lang] * len(source), pa.string()),
            "source": pa.array(source, pa.string()),
            "item": pa.array(item, pa.string()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _pairs(kept: DataFrame, groups: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """(lang, source, item, value) of every two groups of a language."""
    by_term = Window.partitionBy("lang", "tb").orderBy("term")
    # a block of terms holds about term_block of them; its terms are numbered from 0
    numbered = (
        kept.withColumn(
            "tb",
            F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / F.lit(term_block))).cast("int"),
        )
        .withColumn("no", F.dense_rank().over(by_term) - 1)
        .groupBy("lang", "tb", "source")
        .agg(
            F.collect_list(F.struct("no", "p")).alias("_own"),
            F.max("no").alias("_last"),
        )
    )
    numbered = settled(numbered)
    sizes = numbered.groupBy("lang", "tb").agg((F.max("_last") + 1).cast("long").alias("terms"))
    own = numbered.select(
        "lang", "tb", "source",
        F.transform("_own", lambda t: t["no"]).alias("nos"),
        F.transform("_own", lambda t: t["p"]).alias("shares"),
    )
    blocked = groups.select(
        "lang",
        "source",
        ((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / group_block)
        .cast("int").alias("gb"),
        F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v"))).otherwise(1)
        .alias("absent"),
    )
    most = blocked.groupBy("lang").agg(F.max("gb").alias("most"))
    # every group has a slice of every block of terms; a language without terms has one
    slices = (
        blocked.join(most, "lang")
        .join(sizes, "lang", "left")
        .select(
            "lang", "source", "gb", "absent", "most",
            F.coalesce("tb", F.lit(0)).alias("tb"), F.coalesce("terms", F.lit(0)).alias("terms"),
        )
        .join(own, ["lang", "tb", "source"], "left")
        .withColumn("nos", F.coalesce("nos", F.array().cast("array<int>")))
        .withColumn("shares", F.coalesce("shares", F.array().cast("array<bigint>")))
    )
    cells = slices.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("most")))).select(
        "lang",
        F.least("gb", "_with").alias("low"),
        F.greatest("gb", "_with").alias("high"),
        "tb", "source", "gb", "absent", "terms", "nos", "shares",
    )
    return (
        cells.groupBy("lang", "low", "high", "tb")
        .applyInArrow(_solve_cell, _PARTS)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def audit_sources(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """How far each source's use of terms is from other sources' and its language's.

    Rows (lang, source, part, item, value, rank). ``pair``: another source of the
    language, the sum over the language's kept terms of (p - q)² / q, each rounded
    down, p the source's share and q the other's. ``term``: a term the source uses
    more than its language, its own summand against the language's share; the first
    ``top_terms`` only. Ranks go down by value, ties up by the item's UTF-8.

    Terms are runs of letters A-Z and characters beyond ASCII, A-Z in lower case. A
    language keeps the terms in ``least_docs`` of its documents or more. Every row is
    a document, repeated rows too. Null language, source and text read as empty; a
    group without kept terms has pairs but no terms; other columns are ignored; an
    empty table gives an empty result. Sums must stay within a long.
    """
    counts = term_counts(docs, lang_col, source_col, text_col)
    by_term = Window.partitionBy("lang", "term")
    spread = settled(
        counts.select(
            "lang", "source", "term", "n",
            F.sum("d").over(by_term).alias("docs"),
            F.sum("n").over(by_term).alias("n_lang"),
            F.row_number().over(by_term.orderBy("source")).alias("_at"),
        )
        .filter((F.col("term") == "") | (F.col("docs") >= least_docs))
    )
    is_term = F.col("term") != ""
    langs = spread.groupBy("lang").agg(
        F.count(F.when(is_term & (F.col("_at") == 1), 1)).alias("v"),
        F.sum("n").alias("total_lang"),
    )
    groups = settled(
        spread.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    )
    kept = (
        spread.filter(is_term)
        .join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        kept.withColumn("q", _share(F.col("n_lang"), F.col("total_lang"), F.col("v")))
        .filter("n > 0 and p > q")
        .select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .filter(F.col("rank") <= top_terms)
    )
    pairs = _pairs(kept, groups, group_block, term_block).withColumn(
        "rank", F.row_number().over(by_value)
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )
