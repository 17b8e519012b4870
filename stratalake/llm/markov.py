"""Hidden Markov language model (operator 13): Baum-Welch counts and exact likelihoods.

Texts are cut into words and put into blocks of documents, each a list of numbers of
the block's own words. The corpus is read once. A block runs the forward and backward
recursions over its training documents under the starting model, and sends expected
counts of its words, a parcel per shard of the vocabulary. A shard adds up what all
blocks counted for its words and answers each block with the totals of just the words
that the block has. With these the block re-estimates its emissions and scores its
documents by the scaled forward recursion. So counts of every word of the corpus are
learned, while no task holds more than a block or a shard of them, and nothing that
grows with the corpus is broadcast or passes through the driver.

The starting model comes from the same documents: two passes before count the words and
then, for the most frequent ones, how often each follows each. Baum-Welch on that table,
whose size is fixed, begins with a seeded draw. It only says which state is which; the
counts that the model keeps are those of the round over all training documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import settled
from stratalake.session import drop_path, work_path

STATES = 4
START_WORDS = 510  # the starting model's words; others are one more, and so is the end
START_ROUNDS = 200  # on pairs of words, each a few products of small matrices
BLOCK_TOKENS = 2_000_000
SHARD_BYTES = 16 * 1024 * 1024  # of text for each shard of the vocabulary

END = "\n"  # no word holds white space
_BATCH_ROWS = 500
_COUNTED = 500_000
_SLICE_BYTES = 2 * 1024 * 1024


# --- words and blocks ---------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts (null: none) in order, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), np.diff(before[ends])


@dataclass
class Block:
    """Documents as numbers of the block's own words, an end after each."""

    words: pa.Array
    ids: np.ndarray
    lens: np.ndarray

    @classmethod
    def of(cls, flats: list[pa.Array], counts: np.ndarray) -> Block:
        coded = pa.concat_arrays(flats).dictionary_encode()
        flats.clear()  # the words are in the dictionary now
        words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.string())])
        ids = np.full(int(counts.sum()) + len(counts), len(words) - 1, np.int32)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(counts + 1) - 1] = False
        ids[inside] = coded.indices.to_numpy()
        return cls(words, ids, counts + 1)

    def only(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and lengths of some of the documents."""
        return self.ids[np.repeat(chosen, self.lens)], self.lens[chosen]


# --- recursions ---------------------------------------------------------------------


@dataclass
class Steps:
    """Tokens by step: the first of every document, longest first, then the second..."""

    tokens: np.ndarray
    widths: np.ndarray  # documents that have the step
    order: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, lens: np.ndarray) -> Steps:
        order = np.argsort(-lens, kind="stable")
        steps = int(lens.max(initial=0))
        widths = len(lens) - np.cumsum(np.bincount(lens, minlength=steps + 1))[:steps]
        first = np.concatenate([[0], np.cumsum(widths)])
        rank = np.empty(len(lens), np.int64)
        rank[order] = np.arange(len(lens))
        begin = np.cumsum(lens) - lens
        place = np.arange(len(ids))
        place -= np.repeat(begin, lens)
        np.take(first, place, out=place)
        place += np.repeat(rank, lens)
        tokens = np.empty(len(ids), ids.dtype)
        tokens[place] = ids
        return cls(tokens, widths, order)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # a row per word number


def forward(steps: Steps, model: Model, keep: np.ndarray | None = None) -> np.ndarray:
    """log10 of each document's likelihood; ``keep`` takes the scaled forward values."""
    logs = np.zeros(len(steps.order))
    at, now = 0, None
    for m in steps.widths:
        seen = model.emit[steps.tokens[at : at + m]]
        now = (model.start if now is None else now[:m] @ model.move) * seen
        scale = now.sum(axis=1)
        now /= scale[:, None]
        logs[:m] += np.log10(scale)
        if keep is not None:
            keep[at : at + m] = now
        at += m
    done = np.empty_like(logs)
    done[steps.order] = logs
    return done


@dataclass
class Counts:
    """Expected counts: first states, moves, and states of each word number."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def expected(steps: Steps, model: Model) -> tuple[Counts, float]:
    """Baum-Welch counts of some documents, and their log10 likelihood."""
    states = len(model.start)
    held = np.empty((len(steps.tokens), states), model.emit.dtype)
    total = float(forward(steps, model, held).sum())
    moves = np.zeros((states, states))
    after = np.ones((len(steps.order), states), model.emit.dtype)
    at = len(steps.tokens)
    for t in range(len(steps.widths) - 1, -1, -1):
        m = steps.widths[t]
        at -= m
        both = held[at : at + m] * after[:m]
        both /= both.sum(axis=1, keepdims=True)
        held[at : at + m] = both
        if t:
            left = at - steps.widths[t - 1]
            before = held[left : left + m]
            seen = model.emit[steps.tokens[at : at + m]] * after[:m]
            back = seen @ model.move.T
            norm = (before * back).sum(axis=1, keepdims=True)
            moves += (before / norm).T @ seen
            after[:m] = back / norm
    first = held[: steps.widths[0]].sum(axis=0) if len(steps.widths) else np.zeros(states)
    emit = np.zeros((states, len(model.emit)))
    for at in range(0, len(held), _COUNTED):  # a part at a time, which bincount copies
        tokens = steps.tokens[at : at + _COUNTED]
        for k in range(states):
            emit[k] += np.bincount(tokens, held[at : at + _COUNTED, k], len(model.emit))
    emit = np.ascontiguousarray(emit.T)
    return Counts(first.astype(float), moves * model.move, emit), total


def base_share(count: np.ndarray, tokens: int, vocabulary: int) -> np.ndarray:
    """Add-one share of a word; all unknown words together are one more."""
    return (count + 1.0) / (tokens + vocabulary + 1.0)


def estimate(counts: Counts, base: np.ndarray, weight: float, totals: np.ndarray) -> Model:
    """The model of some counts, its emissions drawn towards ``base`` by ``weight``.

    ``totals`` are the counts of the states over all words, which the rows of
    ``counts`` may be only some of.
    """
    start = (counts.start + 1) / (counts.start + 1).sum()
    move = (counts.move + 1) / (counts.move + 1).sum(axis=1, keepdims=True)
    emit = (counts.emit + weight * base[:, None]) / (totals + weight)
    return Model(start, move, emit)


@dataclass
class StartingModel:
    """A model over the most frequent words; other words tell nothing of the state."""

    words: pa.Array
    model: Model
    other: float

    def over(self, words: pa.Array) -> Model:
        found = pc.index_in(words, value_set=self.words)
        at = pc.fill_null(found, len(self.words)).to_numpy()
        rows = np.vstack([self.model.emit, np.full(len(self.model.start), self.other)])
        single = np.float32
        return Model(
            self.model.start.astype(single), self.model.move.astype(single), rows[at].astype(single)
        )


def expected_of_pairs(pairs: np.ndarray, first: np.ndarray, model: Model) -> tuple[Counts, np.ndarray]:
    """Baum-Welch counts of a table of pairs, and the states' shares among left words.

    ``pairs`` says how often a word number stands before another one in a document;
    its last row, the end's, says how often a document begins with a word.
    """
    inner, begins = pairs[:-1], pairs[-1]
    emit = model.emit
    left = emit[:-1] * first
    onward = left @ model.move
    ratio = inner / np.maximum(onward @ emit.T, np.finfo(float).tiny)
    moves = model.move * (left.T @ ratio @ emit)
    as_left = left * (ratio @ (emit @ model.move.T))
    as_right = emit * (ratio.T @ onward)
    start = emit * model.start
    start *= (begins / np.maximum(start.sum(axis=1), np.finfo(float).tiny))[:, None]
    # a word within a document is right in one pair and left in another, and is one word
    both = as_right + start
    both[:-1] = (both[:-1] + as_left) / 2
    left_states = as_left.sum(axis=0) + 1
    return Counts(start.sum(axis=0), moves, both), left_states / left_states.sum()


def starting_model(
    table: tuple[pa.Array, np.ndarray], states: int = STATES, rounds: int = START_ROUNDS, seed: int = 42
) -> StartingModel:
    """Baum-Welch on pairs of words, from emissions drawn at random around the word shares.

    ``table`` are some words and the pairs of :func:`expected_of_pairs`, whose numbers
    are those words, all others as one, and the end.
    """
    words, pairs = table
    n = pairs.sum(axis=0).astype(float)  # each word and each end is right in one pair
    size = len(n)
    base = base_share(n, int(n.sum()), size)
    rng = np.random.default_rng(seed)
    tilt = rng.gamma(4.0, 1.0, (size, states))
    emit = base[:, None] * tilt / tilt.mean()
    stay = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(stay, 0.95 if states > 1 else 1.0)
    model = Model(np.full(states, 1 / states), stay, emit / emit.sum(axis=0))
    first = model.start
    for _ in range(rounds):
        found, first = expected_of_pairs(pairs, first, model)
        model = estimate(found, base, float(size), found.emit.sum(axis=0))
    named = np.delete(model.emit, size - 2, axis=0)
    known = pa.concat_arrays([words, pa.array([END], pa.string())])
    return StartingModel(known, Model(model.start, model.move, named), 1.0 / (n.sum() + size))


# --- parcels ------------------------------------------------------------------------


def _sealed(columns: dict[str, np.ndarray | pa.Array]) -> bytes:
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(parcel: bytes) -> pa.Table:
    return pa.ipc.open_stream(parcel).read_all()


def _state_names(states: int) -> list[str]:
    """Columns of all states but the last, which has what is left of a word's count."""
    return [f"n{k}" for k in range(states - 1)]


def _all_states(count: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Counts of every state from those of all but the last."""
    last = np.maximum(count - some.sum(axis=1), 0)
    return np.concatenate([some, last[:, None]], axis=1)


def _planes(numbers: np.ndarray) -> dict[str, np.ndarray]:
    """Whole numbers byte by byte; where small ones are frequent, the high bytes are
    nearly all zero and pack away."""
    parts = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return {f"b{i}": np.ascontiguousarray(parts[:, i]) for i in range(4)}


def _from_planes(table: pa.Table) -> np.ndarray:
    parts = np.stack([table[f"b{i}"].to_numpy() for i in range(4)], axis=1)
    return np.ascontiguousarray(parts).view("<u4").ravel()


# --- Spark steps --------------------------------------------------------------------

_MADE = pa.schema(
    [
        ("block", pa.int64()), ("shard", pa.int32()), ("first", pa.int32()), ("parcel", pa.binary()),
        ("places", pa.binary()), ("learn", pa.list_(pa.bool_())), ("lens", pa.list_(pa.int64())),
        ("summed", pa.list_(pa.float64())),
    ]
)
_MADE_DDL = (
    "block bigint, shard int, first int, parcel binary, places binary, "
    "learn array<boolean>, lens array<bigint>, summed array<double>"
)


def _counted_block(
    block: Block, ids: pa.Array, learn: np.ndarray, number: int, begun: StartingModel, shards: int
) -> pa.RecordBatch:
    """A row per shard with its words' counts, and one (shard -1) with the documents.

    The documents' tokens are ranks of the block's words by frequency, and ``places``
    says where a rank's word stands among the words in the order of the shards.
    """
    model = begun.over(block.words)
    tokens, lens = block.only(learn)
    found, _ = expected(Steps.of(tokens, lens), model)
    size = len(block.words)
    count = np.bincount(tokens, minlength=size)
    some = found.emit[:, :-1].astype(np.float32)
    emit = _all_states(count, some)  # as the shards will know it
    marks = (zlib.crc32(word) for word in block.words.cast(pa.binary()).to_pylist())
    shard = np.fromiter(marks, np.int64, size) % shards
    by_shard = np.argsort(shard, kind="stable")
    place = np.empty(size, np.int64)
    place[by_shard] = np.arange(size)
    by_use = np.argsort(-np.bincount(block.ids, minlength=size), kind="stable")
    rank = np.empty(size, np.int64)
    rank[by_use] = np.arange(size)
    rows: dict[str, list] = {name: [] for name in _MADE.names}

    def add(shard_: int, first: int, parcel: bytes, *more: object) -> None:
        for name, value in zip(rows, (number, shard_, first, parcel, *(more or (None,) * 4))):
            rows[name].append(value)

    edges = np.searchsorted(shard[by_shard], np.arange(shards + 1))
    for s in range(shards):
        own = by_shard[edges[s] : edges[s + 1]]
        if len(own):
            shares = {n: some[own, k] for k, n in enumerate(_state_names(len(model.start)))}
            words = block.words.take(pa.array(own))
            add(s, int(edges[s]), _sealed({"word": words, "c": count[own], **shares}))
    summed = np.concatenate([[len(tokens)], found.start, found.move.ravel(), emit.sum(axis=0)])
    add(
        -1, 0, _sealed(_planes(rank[block.ids])), _sealed(_planes(place[by_use])),
        learn.tolist(), block.lens.tolist(), summed.tolist(),
    )
    batch = pa.RecordBatch.from_arrays(
        [pa.array(rows[f.name], f.type) for f in _MADE], schema=_MADE
    )
    own_ids = pa.array([None] * (batch.num_rows - 1) + [ids.to_pylist()], pa.list_(ids.type))
    return batch.append_column("ids", own_ids)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in parts whose texts are of some _SLICE_BYTES; a longer text is whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
        cuts = np.searchsorted(sizes, np.arange(0, sizes[-1] + _SLICE_BYTES, _SLICE_BYTES))
        cuts = np.unique(np.concatenate([[0], cuts, [batch.num_rows]])).clip(max=batch.num_rows)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def frequent_words(texts: DataFrame, many: int, block_tokens: int) -> pa.Array:
    """The ``many`` words that column text has most often; of ties the least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flats: list[pa.Array] = []
        held = 0

        def counted() -> pa.RecordBatch:
            found = pa.chunked_array(flats, pa.string()).value_counts()
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

        for part in _slices(batches):
            flats.append(words_of(part.column("text"))[0])
            held += len(flats[-1])
            if held >= block_tokens:
                yield counted()
                flats, held = [], 0
        if held:
            yield counted()

    found = (
        texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(many).collect()
    )
    return pa.array([r["word"] for r in found], pa.string())


def word_pairs(texts: DataFrame, words: pa.Array) -> np.ndarray:
    """How often each of ``words``, another word or the end stands before each of these.

    Over all of column text. The end stands before the first word of every text.
    """
    size = len(words) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for part in _slices(batches):
            flat, counts = words_of(part.column("text"))
            ids = np.full(len(flat) + len(counts) + 1, size - 1, np.int64)
            inside = np.ones(len(ids), bool)
            inside[np.concatenate([[0], np.cumsum(counts + 1)])] = False
            ids[inside] = pc.fill_null(pc.index_in(flat, value_set=words), size - 2).to_numpy()
            total += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        table = total.reshape(size, size)
        some = np.flatnonzero(table.any(axis=1))
        parcels = [_sealed({"n": table[a]}) for a in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(parcels, pa.binary())], ["a", "parcel"]
        )

    def add(rows: pa.Table) -> pa.Table:
        total = sum(_opened(p.as_py())["n"].to_numpy() for p in rows["parcel"])
        return pa.table({"a": rows["a"][:1], "parcel": pa.array([_sealed({"n": total})], pa.binary())})

    summed = texts.mapInArrow(run, "a int, parcel binary").groupBy("a").applyInArrow(
        add, "a int, parcel binary"
    )
    pairs = np.zeros((size, size))
    for r in summed.collect():
        pairs[r["a"]] = _opened(bytes(r["parcel"]))["n"].to_numpy()
    return pairs


def _to_blocks(begun: StartingModel, shards: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        flats: list[pa.Array] = []
        counts: list[np.ndarray] = []
        ids: list[pa.Array] = []
        learn: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            return _counted_block(
                Block.of(flats, np.concatenate(counts).astype(np.int64)),
                pa.concat_arrays(ids), np.concatenate(learn), number, begun, shards,
            )

        for part in _slices(batches):
            flat, n = words_of(part.column("text"))
            flats.append(flat)
            counts.append(n)
            ids.append(part.column("id"))
            learn.append(part.column("learn").to_numpy(zero_copy_only=False))
            held += len(flat)
            if held >= block_tokens:
                yield block()
                flats, counts, ids, learn, held = [], [], [], [], 0
                number += 1
        if ids:
            yield block()

    return run


_ANSWER = "block bigint, first int, parcel binary, words bigint"


def _answers(table: pa.Table) -> pa.Table:
    """What all blocks counted for the words of a shard, to each block for its own words."""
    parcels = [_opened(p.as_py()) for p in table["parcel"]]
    coded = pa.concat_tables([p.select(["word"]) for p in parcels])["word"]
    at = coded.combine_chunks().dictionary_encode().indices.to_numpy()
    totals = {
        name: np.bincount(at, np.concatenate([p[name].to_numpy() for p in parcels]))
        for name in parcels[0].column_names[1:]
    }
    known = int((totals["c"] > 0).sum())
    answers, done = [], 0
    for parcel in parcels:
        own = at[done : done + parcel.num_rows]
        done += parcel.num_rows
        columns = {n: t[own].astype(np.float32) for n, t in totals.items() if n != "c"}
        answers.append(_sealed({"c": totals["c"][own].astype(np.int64), **columns}))
    return pa.table(
        {
            "block": table["block"],
            "first": table["first"],
            "parcel": pa.array(answers, pa.binary()),
            "words": pa.array([known] + [0] * (len(answers) - 1), pa.int64()),
        }
    )


@dataclass
class Totals:
    """What the whole training corpus adds up to."""

    tokens: int
    vocabulary: int
    start: np.ndarray
    move: np.ndarray
    states: np.ndarray


def _scored(totals: Totals):
    def run(key: tuple, documents: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["first"].to_numpy())
        parcels = [_opened(answers["parcel"][int(i)].as_py()) for i in order]
        table = pa.concat_tables(parcels)
        count = table["c"].to_numpy()
        base = base_share(count, totals.tokens, totals.vocabulary)
        some = np.empty((len(count), len(totals.start) - 1))
        for k, name in enumerate(_state_names(len(totals.start))):
            some[:, k] = table[name].to_numpy()
        model = estimate(
            Counts(totals.start, totals.move, _all_states(count, some)), base,
            totals.vocabulary + 1.0, totals.states,
        )
        places = _from_planes(_opened(documents["places"][0].as_py()))
        ids = places.astype(np.int32)[_from_planes(_opened(documents["parcel"][0].as_py()))]
        lens = documents["lens"][0].values.to_numpy()
        begin = np.cumsum(lens) - lens
        return pa.table(
            {
                "id": documents["ids"][0].values,
                "held_out": pc.invert(documents["learn"][0].values),
                "n_tokens": pa.array(lens),
                "n_known": pa.array(np.add.reduceat((count > 0)[ids], begin, dtype=np.int64)),
                "train_tokens": pa.array(np.full(len(lens), totals.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(np.log10(base)[ids], begin)),
                "score": pa.array(forward(Steps.of(ids, lens), model)),
            }
        )

    return run


@contextmanager
def _rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows in a batch than the session has, while an action runs: whole texts
    are large rows, and a block gathers them anyway."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def score_documents(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    start_docs: int | None = None,
    start_chars: int | None = None,
    start_rounds: int = START_ROUNDS,
    block_tokens: int = BLOCK_TOKENS,
    shard_bytes: int = SHARD_BYTES,
    start_words: int = START_WORDS,
) -> DataFrame:
    """log10 likelihood of every text under a model of the texts where ``learn`` holds.

    Columns: the id, held_out (not learned from), n_tokens, n_known (tokens that a
    training text has), train_tokens, base_score (add-one shares of single words) and
    score (the hidden Markov model). Words are runs of anything but ASCII white space
    with A-Z in lower case, and each text ends in an end token. The emissions of a
    state are its expected counts plus V + 1 times the add-one shares, V being the
    words known, so an unknown word has a share in every state.

    A null text reads as empty, which is one end token. A null ``learn`` is false.
    Every row is scored, repeated rows each, and rows of null id too; other columns
    are left out. Without training texts all shares are equal. An empty table gives
    an empty result. A document is never cut, so the longest one is the least that a
    task holds. The result is kept in the shared folder.

    The starting model is of all training texts too: of the pairs that their
    ``start_words`` most frequent words form, the others as one. It says where the
    recursions begin, and no more. ``start_docs`` and ``start_chars`` once bounded a
    sample for it; they are still taken, and nothing depends on them.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    taught = rows.filter("learn").select("text")
    with _rows_at_once(spark, _BATCH_ROWS):
        words = frequent_words(taught, start_words, block_tokens)
        pairs = word_pairs(taught, words)
    begun = starting_model((words, pairs), states, start_rounds)
    shards = max(8, -(-size // shard_bytes))
    id_type = rows.schema["id"].dataType.simpleString()
    path = work_path(spark, "markov")
    blocks = rows.mapInArrow(
        _to_blocks(begun, shards, block_tokens), f"{_MADE_DDL}, ids array<{id_type}>"
    )
    with _rows_at_once(spark, _BATCH_ROWS):
        blocks.write.parquet(path)
    made = spark.read.parquet(path)
    documents = made.filter("shard = -1")
    answers = settled(
        made.filter("shard >= 0").select("block", "shard", "first", "parcel")
        .groupBy("shard").applyInArrow(_answers, _ANSWER)
    )
    vocabulary = answers.agg(F.sum("words")).first()[0] or 0
    summed = (
        documents.select(F.posexplode("summed").alias("at", "x"))
        .groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()
    )
    numbers = np.array([r["x"] for r in summed] or [0.0] * (1 + 2 * states + states * states))
    start, move, by_state = np.split(numbers[1:], [states, states + states * states])
    totals = Totals(
        int(numbers[0]), int(vocabulary), start, move.reshape(states, states), by_state
    )
    scored = (
        documents.select("block", "parcel", "places", "learn", "lens", "ids").groupBy("block")
        .cogroup(answers.select("block", "first", "parcel").groupBy("block"))
        .applyInArrow(
            _scored(totals),
            f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        )
        .withColumnRenamed("id", id_col)
    )
    scored = settled(scored)
    drop_path(spark, path)
    return scored
