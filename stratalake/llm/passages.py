"""Passage dedup by winnowing over words (operator 5).

A document is the sequence of its words; a line break is white space like any
other. Within every span of ``guarantee`` words the place whose first two words
have the least hash is selected, and the ``noise`` words from there on are a
fingerprint. So a repeated span of ``guarantee`` words always holds a fingerprint
that its other copies have too, wherever it starts or ends in a line. The first
``noise`` words of a text are one as well, so texts that begin alike are found from
there on.

Each fingerprint is extended both ways against every earlier place that has it,
without pairs: places of equal neighbourhoods are a class, all but the first of a
class match in full, and the first is matched with other classes by a key per
number of words that agree. A task finds the first place of each key for some
fingerprints; those with very many classes have their keys dealt over all tasks. A deleted word always lies in a run of ``noise`` words
or more that an earlier place has, so one copy of everything stays.

Words, window minima and the hashes of runs of words are computed in numpy, over
all words of some texts at once; places meet in joins and aggregates. Each step's
rows are a table in the shared folder, and what a finished step shuffled goes.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import row_key
from stratalake.session import drop_path, work_path

NOISE_WORDS = 25
GUARANTEE_WORDS = 50

SLICE_BYTES = 1 << 21  # of texts taken at once; a longer text is taken whole
LONG_WORD = 256  # bytes; from there on a word is hashed by itself
NEAR = 4  # words beside a fingerprint that are compared first, in large groups
LOCAL = 4096  # neighbourhoods of a fingerprint that one task compares; more are dealt out

_WHITE = np.zeros(256, bool)
_WHITE[list(b" \t\n\x0b\f\r")] = True
_LOW = np.uint64((1 << 32) - 1)
_NONE = np.uint64((1 << 64) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_ODD = np.uint64(0xD6E8FEB86659FD93)

_PLACE = ("_d", "_t", "at")
_SIDE = 1 << 31  # a hit is at * _AT + (side + 1) * _SIDE + j
_AT = 4 * _SIDE


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the input counts."""
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h ^ (h >> np.uint64(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                made = np.full(size, base, np.uint64)
                made[0] = 1
                setattr(self, name, np.cumprod(made, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


class _Runs:
    """Hashes of runs of a sequence, in which place the run stands being of no account."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the values from ``a`` to before ``b``; the length counts."""
        raw = (self.sums[b] - self.sums[a]) * self.down[a]
        return _mix(raw ^ ((b - a).astype(np.uint64) * _ODD))


class Words:
    """The words of a column of texts: bytes, hashes, and each text's first and last."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        dark = ~_WHITE[self.data]
        cut = np.zeros(len(dark) + 1, bool)
        cut[self.offsets] = True
        begins, ends = dark & cut[:-1], dark & cut[1:]
        begins[1:] |= dark[1:] & ~dark[:-1]
        ends[:-1] |= dark[:-1] & ~dark[1:]
        self.begin, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        # words from first to before last are those of a text
        self.first = np.searchsorted(self.begin, self.offsets[:-1])
        self.last = np.searchsorted(self.begin, self.offsets[1:])
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.begin), np.uint64)
        i = 0
        while i < len(out):
            start = self.begin[i]
            j = max(i + 1, int(np.searchsorted(self.begin, start + SLICE_BYTES)))
            runs = _Runs(_BYTE[self.data[start : self.end[j - 1]]])
            out[i:j] = runs(self.begin[i:j] - start, self.end[i:j] - start)
            i = j
        for k in np.flatnonzero(self.end - self.begin >= LONG_WORD):
            out[k] = xxhash.xxh64_intdigest(self.data[self.begin[k] : self.end[k]].tobytes())
        return out

    def selected(self, noise: int, guarantee: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts and first words (both counted over all texts) of the fingerprints."""
        more, n = guarantee - noise, len(self.hashes)
        at = np.arange(n, dtype=np.uint64)
        text = np.repeat(np.arange(len(self.first)), self.last - self.first)
        fits = np.flatnonzero(np.arange(n) + noise <= self.last[text])
        if not len(fits):
            return fits, fits
        pair = _mix(self.hashes[fits] * _ODD + self.hashes[fits + 1])
        # room after each text, so that no window reaches into the next one
        low = np.full(n + len(self.first) * more, _NONE)
        spot = fits + text[fits] * more
        low[spot] = (pair & ~_LOW) | at[fits]
        width = 1
        while width < more + 1:  # minima of windows twice as wide
            step = min(width, more + 1 - width)
            np.minimum(low[:-step], low[step:].copy(), out=low[:-step])
            width += step
        least = (low[spot] & _LOW).astype(np.int64)
        begins = self.first[self.first + noise <= self.last]
        chosen = np.union1d(least, begins)
        return text[chosen], chosen


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts are of SLICE_BYTES or less, or a single row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + SLICE_BYTES, "right")))
        yield i, j
        i = j


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _fingerprints(texts: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """(_d, _t, g, at, l, r): hash, place (from 0) and hashes of the words around."""
    more = guarantee - noise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column("_x")):
                some = batch.slice(i, j - i)
                words = Words(some.column("_x"))
                text, at = words.selected(noise, guarantee)
                first, last = words.first[text], words.last[text]
                runs, row = _Runs(words.hashes), pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("_d").take(row), some.column("_t").take(row),
                        _signed(runs(at, at + noise)), pa.array((at - first).astype(np.int32)),
                        _signed(runs(np.maximum(first, at - more), at)),
                        _signed(runs(at + noise, np.minimum(last, at + noise + more))),
                    ],
                    ["_d", "_t", "g", "at", "l", "r"],
                )

    return texts.mapInArrow(run, "_d long, _t long, g long, at int, l long, r long")


def _ladders(texts: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """(g, _d, _t, at, side, keys): for the sides in ``_open``, a hash with the fingerprint
    of the nearest word, of the two nearest ones, and so on."""
    more = guarantee - noise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column("_x")):
                some = batch.slice(i, j - i)
                words = Words(some.column("_x"))
                lists = some.column("_open")
                text = np.repeat(np.arange(len(some)), np.asarray(pc.list_value_length(lists)))
                told = lists.flatten()
                g, at, side = (np.asarray(told.field(k)) for k in range(3))
                left, spot = (side < 0)[:, None], at + words.first[text]
                room = np.where(side < 0, at, words.last[text] - spot - noise)
                step = np.arange(1, more + 1)[None, :]
                there = step <= room[:, None]
                far = np.where(there, step, 0)
                a = np.where(left, spot[:, None] - far, spot[:, None] + noise)
                b = np.where(left, spot[:, None], spot[:, None] + noise + far)
                own = _mix(g.view(np.uint64) + side.astype(np.int64).view(np.uint64))
                keys = _mix(_Runs(words.hashes)(a, b) ^ own[:, None])
                ends = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        told.field(0), some.column("_d").take(row), some.column("_t").take(row),
                        told.field(1), told.field(2),
                        pa.ListArray.from_arrays(pa.array(ends), _signed(keys[there])),
                    ],
                    ["g", "_d", "_t", "at", "side", "keys"],
                )

    return texts.mapInArrow(run, "g long, _d long, _t long, at int, side int, keys array<long>")


def _agreed_by_group(ladders: DataFrame) -> DataFrame:
    """(place, side, j): on how many words an earlier place of the group agrees.

    The rows of a fingerprint's side meet in a task, which holds a batch and a group.
    """

    def told(rows: pa.Table) -> pa.RecordBatch:
        d, t, at, side = (np.asarray(rows.column(c)) for c in ("_d", "_t", "at", "side"))
        lists = rows.column("keys").combine_chunks()
        size, flat = np.asarray(pc.list_value_length(lists)), np.asarray(lists.flatten())
        start = np.cumsum(size) - size
        order = np.lexsort((side, at, t, d))
        # a document that is there several times is one place
        told_before = np.ones(len(d), bool)
        told_before[:1] = False
        for c in (d, t, at, side):
            told_before[1:] &= c[order[1:]] == c[order[:-1]]
        order = order[~told_before]
        agreed = np.zeros(len(d), np.int32)
        for j in range(size.max(initial=0)):
            there = order[size[order] > j]
            _, first, which = np.unique(flat[start[there] + j], return_index=True, return_inverse=True)
            agreed[there[first[which] != np.arange(len(there))]] = j + 1
        some = agreed > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c[some]) for c in (d, t, at, side, agreed)], ["_d", "_t", "at", "side", "j"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # of the group that may go on
        for batch in batches:
            if not len(batch):
                continue
            rest.append(batch)
            g, side = np.asarray(batch.column("g")), np.asarray(batch.column("side"))
            others = np.flatnonzero((g != g[-1]) | (side != side[-1]))
            head = rest[0]
            if len(others):
                end = int(others[-1]) + 1
                yield told(pa.Table.from_batches([*rest[:-1], batch.slice(0, end)]))
                rest = [batch.slice(end)]
            elif head.column("g")[0] != batch.column("g")[0] or head.column("side")[0] != batch.column("side")[0]:
                yield told(pa.Table.from_batches(rest[:-1]))
                rest = [batch]
        if rest:
            yield told(pa.Table.from_batches(rest))

    together = ladders.repartition("g", "side").sortWithinPartitions("g", "side")
    return together.mapInArrow(run, "_d long, _t long, at int, side int, j int")


class _Steps:
    """Tables of steps in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        path = work_path(self.spark, f"passages-{name}")
        rows.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads, and let go what was shuffled for them.

        Spark deletes the shuffle files of a plan once its driver has collected it.
        """
        for name in names:
            drop_path(self.spark, self.paths.pop(name))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def _place() -> Column:
    return F.struct(*_PLACE)


# An aggregate that stands in a join's own stage keeps adaptive execution from splitting
# a hot fingerprint there, so it is a table of its own first. Both sides of a join are
# shuffled at every size: a table that is just small enough to be broadcast would lie in
# each executor beside its Python workers.


def _repeated(keys: DataFrame) -> DataFrame:
    """(g, _least, sides): fingerprints that have several places.

    With their least id, and the sides on which not all their neighbourhoods are equal.
    Each is an aggregate of numbers, which Spark keeps in a hash table, unsorted.
    """
    sides = F.array_compact(
        F.array(
            F.when(F.col("_l0") != F.col("_l1"), -1), F.when(F.col("_r0") != F.col("_r1"), 1)
        )
    )
    return (
        keys.groupBy("g").agg(
            F.count("*").alias("_c"), F.min("_d").alias("_least"),
            F.min("l").alias("_l0"), F.max("l").alias("_l1"),
            F.min("r").alias("_r0"), F.max("r").alias("_r1"),
        )
        .filter("_c > 1").select("g", "_least", sides.alias("sides"))
    )


def _shared(keys: DataFrame, repeated: DataFrame) -> DataFrame:
    """Places whose fingerprint has several, and whether a lesser id is among these.

    ``sides`` as a number, which costs less than an array for each place: 1 for the left
    side, 2 for the right. The side of one row a fingerprint is hashed, so no place is sorted.
    """
    number = F.aggregate(
        "sides", F.lit(0), lambda n, side: n + F.when(side < 0, 1).otherwise(2)
    )
    few = repeated.select("g", "_least", number.alias("sides"))
    return keys.join(few.hint("shuffle_hash"), "g").select(
        "g", *_PLACE, "l", "r", "sides", (F.col("_d") > F.col("_least")).alias("later")
    )


def _firsts(shared: DataFrame) -> DataFrame:
    """(g, _f): the first place of each fingerprint."""
    return shared.filter("not later").groupBy("g").agg(F.min(_place()).alias("_f"))


def _again(shared: DataFrame, firsts: DataFrame) -> DataFrame:
    """Places that are not the first of their fingerprint."""
    least = shared.filter("not later").join(firsts.hint("shuffle_hash"), "g")
    return shared.filter("later").select(*_PLACE).unionByName(
        least.filter(F.col("_f") != _place()).select(*_PLACE)
    )


def _classes(shared: DataFrame) -> DataFrame:
    """(g, side, _f): the first place of each neighbourhood, on sides that have several."""
    left, right = F.lit(-1), F.lit(1)
    each = F.when(F.col("sides") == 1, F.array(left)).when(
        F.col("sides") == 2, F.array(right)
    ).otherwise(F.array(left, right))
    return (
        shared.filter("sides > 0").select("g", *_PLACE, "l", "r", F.explode_outer(each).alias("side"))
        .groupBy("g", "side", F.when(F.col("side") < 0, F.col("l")).otherwise(F.col("r")).alias("_ctx"))
        .agg(F.min(_place()).alias("_f"))
        .select("g", "side", "_f")
    )


def _mixed(classes: DataFrame) -> DataFrame:
    """(g, side, n): how many neighbourhoods a fingerprint has on a side."""
    return classes.groupBy("g", "side").agg(F.count("*").alias("n"))


def _agreeing(rows: DataFrame) -> DataFrame:
    """(place, side, j): where an earlier place has the same key of ``j`` words."""
    firsts = (
        rows.groupBy("key").agg(F.min(_place()).alias("_f"), F.count("*").alias("_c"))
        .filter("_c > 1").select("key", "_f")
    )
    met = rows.join(firsts, "key").filter(F.col("_f") != _place())
    return met.groupBy(*_PLACE, "side").agg(F.max("j").alias("j"))


def _levels(ladders: DataFrame, start: int, n: int) -> DataFrame:
    """A row for each key of the words from ``start`` (from 0) on."""
    return ladders.select(
        *_PLACE, "side", F.posexplode(F.slice("keys", start + 1, n)).alias("_j", "key")
    ).select(*_PLACE, "side", (F.col("_j") + start + 1).cast("int").alias("j"), "key")


def _agreed_by_keys(ladders: DataFrame, more: int) -> DataFrame:
    """As :func:`_agreed_by_group`, for groups of any size: keys are dealt over all tasks."""
    # most places differ within a few words; the others go on
    last = F.get("keys", F.lit(NEAR - 1))
    deep = ladders.groupBy(last.alias("_k")).count().filter("count > 1 and _k is not null")
    far = ladders.filter(F.size("keys") > NEAR).join(deep, last == F.col("_k"), "left_semi")
    return _agreeing(_levels(ladders, 0, NEAR)).unionByName(_agreeing(_levels(far, NEAR, more)))


def repeated_words(
    docs: DataFrame, noise: int, guarantee: int, id_col: str, text_col: str
) -> DataFrame:
    """(_d, _t, _hits): by document key, places (from 0) of repeated fingerprints.

    A hit is ``at``, ``side`` and ``j`` in one number: side 0 for a fingerprint to delete,
    else a side on which ``j`` words beside it go. A side that isn't named goes in full.
    """
    if not 2 <= noise <= guarantee:
        raise ValueError("noise must be 2 or more, and guarantee no less")
    more = guarantee - noise
    steps = _Steps(docs.sparkSession)
    d, t = row_key(id_col, text_col)
    texts = docs.select(
        d.alias("_d"), t.alias("_t"), F.coalesce(text_col, F.lit("")).alias("_x")
    )
    keys = steps.keep("keys", _fingerprints(texts, noise, guarantee))
    repeated = steps.keep("repeated", _repeated(keys))
    steps.drop()
    shared = steps.keep("shared", _shared(keys, repeated))
    del keys, repeated
    steps.drop("keys", "repeated")
    firsts = steps.keep("firsts", _firsts(shared))
    again = steps.keep("again", _again(shared, firsts))
    del firsts
    steps.drop("firsts")
    classes = steps.keep("classes", _classes(shared))
    mixed = steps.keep("mixed", _mixed(classes))
    both = classes.join(mixed.hint("merge"), ["g", "side"]).select("g", "side", "_f.*", "n")
    open_ = steps.keep("open", both)
    del classes, mixed, both, shared
    steps.drop("classes", "mixed", "shared")

    def ladders(some: DataFrame) -> DataFrame:
        asked = some.groupBy("_d", "_t").agg(
            F.collect_list(F.struct("g", "at", "side")).alias("_open")
        )
        return _ladders(texts.join(asked.hint("merge"), ["_d", "_t"]), noise, guarantee)

    agreed = steps.keep("agreed", _agreed_by_group(ladders(open_.filter(F.col("n") <= LOCAL))))
    steps.drop()
    many = open_.filter(F.col("n") > LOCAL)
    if not many.isEmpty():
        dealt = steps.keep("ladders", ladders(many))
        steps.drop()
        agreed = agreed.unionByName(steps.keep("dealt", _agreed_by_keys(dealt, more)))
        del dealt
        steps.drop("ladders")

    def hits(rows: DataFrame, side: Column, j: Column) -> DataFrame:
        # one number for each, in the order of at, side and j
        told = F.col("at").cast("long") * F.lit(_AT) + (side + 1) * F.lit(_SIDE) + j
        return rows.select("_d", "_t", told.alias("_h"))

    return (
        hits(again, F.lit(0), F.lit(0))
        .unionByName(hits(open_, F.col("side"), F.lit(0)))
        .unionByName(hits(agreed, F.col("side"), F.col("j")))
        .groupBy("_d", "_t").agg(F.collect_list("_h").alias("_hits"))
    )


def _spans(hits: np.ndarray, words: int, noise: int, more: int) -> np.ndarray:
    """First and last word of what goes, as rows in order; ``hits`` are at, side, j."""
    at = np.unique(hits[hits[:, 1] == 0, 0])
    if not len(at):
        return np.zeros((0, 2), np.int64)
    beside = {}
    for side in (-1, 1):
        beside[side] = np.full(len(at), more)
        some = hits[hits[:, 1] == side]
        some = some[np.lexsort((some[:, 2], some[:, 0]))]
        some = some[np.append(some[1:, 0] != some[:-1, 0], True)] if len(some) else some
        spot = np.minimum(np.searchsorted(at, some[:, 0]), len(at) - 1)
        same = at[spot] == some[:, 0]
        beside[side][spot[same]] = some[same, 2]
    a = np.maximum(at - beside[-1], 0)
    b = np.minimum(at + noise - 1 + beside[1], words - 1)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.append(True, a[1:] > b[:-1] + 1)
    return np.stack([a[new], b[np.append(new[1:], True)]], axis=1)


def _cut(words: Words, row: int, spans: np.ndarray) -> str:
    """The text without the words of ``spans`` and the white space after them."""
    low, high = words.offsets[row], words.offsets[row + 1]
    first, n = words.first[row], words.last[row] - words.first[row]
    kept, done = [], low
    for a, b in spans:
        kept.append(words.data[done : words.begin[first + a] if a else low].tobytes())
        done = words.begin[first + b + 1] if b + 1 < n else high
    kept.append(words.data[done:high].tobytes())
    return b"".join(kept).decode()


def _without(rows: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """``rows`` (_rest, _x, _hits) as (_rest, _x, _gone), with the texts cut."""
    more = guarantee - noise
    gone = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column("_x")):
                some = batch.slice(i, j - i)
                texts, lists = some.column("_x"), some.column("_hits")
                hit = np.flatnonzero(np.asarray(lists.is_valid()))
                words = Words(texts.take(pa.array(hit)))
                sizes = np.asarray(pc.list_value_length(lists.take(pa.array(hit))))
                told = np.asarray(lists.take(pa.array(hit)).flatten()).astype(np.int64)
                flat = np.stack([told // _AT, told % _AT // _SIDE - 1, told % _SIDE], axis=1)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
                cut, spans, changed = [], [None] * len(some), np.zeros(len(some), bool)
                for k, row in enumerate(hit):
                    n = int(words.last[k] - words.first[k])
                    found = _spans(flat[ends[k] : ends[k + 1]], n, noise, more)
                    if len(found):
                        changed[row] = True
                        cut.append(_cut(words, k, found))
                        spans[row] = [{"a": a + 1, "b": b + 1} for a, b in found.tolist()]
                if cut:
                    texts = pc.replace_with_mask(texts, pa.array(changed), pa.array(cut, texts.type))
                yield pa.RecordBatch.from_arrays(
                    [some.column("_rest"), texts, pa.array(spans, gone)], ["_rest", "_x", "_gone"]
                )

    rest = rows.schema["_rest"].dataType.simpleString()
    return rows.mapInArrow(run, f"_rest {rest}, _x string, _gone array<struct<a:int,b:int>>")


def dedup_passages(
    docs: DataFrame,
    noise: int = NOISE_WORDS,
    guarantee: int = GUARANTEE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    gone_col: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` with later copies of repeated passages deleted.

    Every word of a span of ``guarantee`` words that an earlier place has too goes,
    with the white space after it; a run of fewer than ``noise`` words never does.
    The corpus order is that of the id (null first), then of the text's hash, then
    of the word. All columns stay, whatever their names. ``gone_col`` adds the
    deleted spans as an array of first and last word (``a`` and ``b``, from 1), null
    if there are none.

    Null and empty texts stay as they are. Rows that repeat both id and text count
    as one document and get the same result. A text of any length is one task's work,
    as its words are looked at in order.
    """
    d, t = row_key(id_col, text_col)
    gone = repeated_words(docs.select(id_col, text_col), noise, guarantee, id_col, text_col)
    others = [c for c in docs.columns if c != text_col]
    # under names that cannot clash with each other
    rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    packed = docs.select(d.alias("_d"), t.alias("_t"), rest.alias("_rest"), F.col(text_col).alias("_x"))
    met = packed.join(gone.hint("merge"), ["_d", "_t"], "left").select("_rest", "_x", "_hits")
    made = _without(met, noise, guarantee)
    at = {c: F.col("_rest")[f"c{i}"].alias(c) for i, c in enumerate(others)}
    columns = [F.col("_x").alias(c) if c == text_col else at[c] for c in docs.columns]
    more = [] if gone_col is None else [F.col("_gone").alias(gone_col)]
    return made.select(*columns, *more)
