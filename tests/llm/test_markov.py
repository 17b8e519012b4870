"""Hidden Markov model: recursions against all paths, the Spark job against plain loops."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import markov

SCHEMA = "doc_id long, text string, id long, learn boolean, block long, shard int, lens int"
CLASH = (5, False, 6, 7, 8)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [markov.END]


def some_model(states, size, seed=1):
    rng = np.random.default_rng(seed)
    return markov.Model(
        rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states),
        rng.dirichlet(np.ones(size), states).T.copy(),
    )


def paths(model, ids):
    """Every path of states with its probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(ids)):
        p = model.start[path[0]] * model.emit[ids[0], path[0]]
        for a, b, w in zip(path, path[1:], ids[1:]):
            p *= model.move[a, b] * model.emit[w, b]
        yield path, p


def test_words_are_those_of_the_pattern():
    texts = ["  A b\tÉc\x0b\x0cD ", "", None, "x y z\r\n", "\x1ca\x85b c d", "ÀB😀 ß"]
    flat, counts = markov.words_of(pa.array(texts).slice(0))
    assert flat.to_pylist() == [w for t in texts for w in words(t)[:-1]]
    assert counts.tolist() == [len(words(t)) - 1 for t in texts]
    flat, counts = markov.words_of(pa.array(texts).slice(2, 3))
    assert flat.to_pylist() == [w for t in texts[2:5] for w in words(t)[:-1]]
    assert counts.tolist() == [len(words(t)) - 1 for t in texts[2:5]]


@pytest.mark.parametrize("states", [1, 2, 3])
def test_recursions_equal_all_paths(states):
    docs = [[0, 1, 2, 1, 0], [3], [2, 2, 2], [4, 0, 1, 3], [1]]
    model = some_model(states, 5)
    ids = np.array([w for d in docs for w in d], np.int32)
    lens = np.array([len(d) for d in docs])
    steps = markov.Steps.of(ids, lens)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((5, states))
    logs = []
    for doc in docs:
        whole = sum(p for _, p in paths(model, doc))
        logs.append(math.log10(whole))
        for path, p in paths(model, doc):
            p /= whole
            start[path[0]] += p
            for a, b in zip(path, path[1:]):
                move[a, b] += p
            for s, w in zip(path, doc):
                emit[w, s] += p
    assert np.allclose(markov.forward(steps, model), logs)
    found, total = markov.expected(steps, model)
    assert math.isclose(total, sum(logs))
    assert np.allclose(found.start, start)
    assert np.allclose(found.move, move)
    assert np.allclose(found.emit, emit)


def test_rounds_raise_the_likelihood_and_long_texts_do_not_vanish():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 6, 30_000).astype(np.int32)
    ids[10_000:] = rng.integers(4, 9, 20_000)
    steps = markov.Steps.of(ids, np.array([29_000, 1, 999]))
    model, last = some_model(2, 9), -math.inf
    for _ in range(5):
        found, total = markov.expected(steps, model)
        assert total >= last - 1e-6
        last = total
        model = markov.estimate(found, np.full(9, 1 / 9), 0.0, found.emit.sum(axis=0))
    assert math.isfinite(last)


def test_shares_of_a_state_add_up_to_one():
    counts = np.array([5.0, 1, 0, 3])
    base = markov.base_share(counts, 9, 3)
    emit = np.array([[4.0, 1], [0.5, 0.5], [0, 0], [1, 2]])
    model = markov.estimate(markov.Counts(np.zeros(2), np.zeros((2, 2)), emit), base, 4.0, emit.sum(axis=0))
    # the third word, unknown, stands for all unknown words together
    assert np.allclose(model.emit.sum(axis=0), 1)
    assert np.allclose(model.move.sum(axis=1), 1) and math.isclose(model.start.sum(), 1)


def plain(rows, begun, states):
    """The job in loops over documents, words and states."""
    tokens = [words(t) for _, t, _ in rows]
    train = [w for w, (_, _, learn) in zip(tokens, rows) if learn]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)
    known = {w: i for i, w in enumerate(begun.words.to_pylist())}
    start, move = np.zeros(states), np.zeros((states, states))
    emit = {w: np.zeros(states) for ws in tokens for w in ws}

    def row(w):
        return begun.model.emit[known[w]] if w in known else np.full(states, begun.other)

    for ws in train:
        a = [begun.model.start * row(ws[0])]
        for w in ws[1:]:
            a[-1] = a[-1] / a[-1].sum()
            a.append((a[-1] @ begun.model.move) * row(w))
        b = [np.ones(states)]
        for w in reversed(ws[1:]):
            b.append(begun.model.move @ (row(w) * b[-1]))
            b[-1] = b[-1] / b[-1].sum()
        b.reverse()
        for t, w in enumerate(ws):
            g = a[t] * b[t] / (a[t] @ b[t])
            emit[w] = emit[w] + g
            if t == 0:
                start += g
            else:
                x = begun.model.move * np.outer(a[t - 1], row(w) * b[t])
                move += x / x.sum()
    totals = sum(emit.values()) if emit else np.zeros(states)
    start, move = (start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True)
    out = []
    for (i, _, learn), ws in zip(rows, tokens):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        score, now = 0.0, None
        for w in ws:
            e = (emit[w] + (c[w] + 1) / (n + v + 1) * (v + 1)) / (totals + v + 1)
            now = (start if now is None else now @ move) * e
            score += math.log10(now.sum())
            now = now / now.sum()
        out.append((i, not learn, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return out


def _rows():
    rng = np.random.default_rng(2)
    left, right = [f"le{i}" for i in range(40)], [f"RI{i}ß" for i in range(40)]
    rows = [
        (i, " ".join(rng.choice(left if i % 2 else right, rng.integers(1, 60))), i % 7 != 2) for i in range(90)
    ]
    rows += [(200, None, True), (201, "", False), (202, " \n", True), (203, "never seen words", False)]
    rows += [rows[0], rows[0], (None, "le1 le2", False), (None, None, False)]
    rows += [(300, " ".join(rng.choice(left, 20_000)), True), (301, "x" * 100_000, False)]
    return rows


@pytest.mark.parametrize("block", [200, 4_000_000])
def test_job_equals_plain_loops(spark, block):
    rows = _rows()
    df = spark.createDataFrame([(i, t, *CLASH) for i, t, _ in rows], SCHEMA).repartition(3)
    learn = (F.col("doc_id") % 7 != 2) & ~F.col("doc_id").isin(201, 203, 301)
    rows = [(i, t, i is not None and i % 7 != 2 and i not in (201, 203, 301)) for i, t, _ in rows]
    seen = {}
    kept = markov.starting_model

    def starting(texts, *more):
        seen["begun"] = kept(texts, *more)
        return seen["begun"]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(markov, "starting_model", starting)
        got = markov.score_documents(
            df, learn, states=3, start_docs=40, start_rounds=3, block_tokens=block, shard_bytes=50_000
        )
    assert got.columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    want = sorted(plain(rows, seen["begun"], 3), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-12)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-5)
    held = [r for r in got if r[1] and r[0] is not None and r[0] < 90]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # states tell the two kinds apart


def test_nothing_to_learn_from_or_to_score(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert markov.score_documents(empty, F.lit(True)).count() == 0
    df = spark.createDataFrame([(1, "a b", *CLASH), (2, None, *CLASH)], SCHEMA)
    got = {r["doc_id"]: r for r in markov.score_documents(df, F.lit(None).cast("boolean")).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["n_tokens"] == 3
    assert got[1]["base_score"] == 0.0 and abs(got[1]["score"]) < 1e-9 and got[2]["n_tokens"] == 1


def test_starting_model_is_of_all_training_texts(spark):
    rows = [(i, t, learn) for i, t, learn in _rows() if i is None or i < 300]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    taught = [words(t) for _, t, learn in rows if learn]
    counts = Counter(w for ws in taught for w in ws[:-1])
    most = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:50]
    found = markov.frequent_words(df.filter("learn").select("text"), 50, 300)
    assert found.to_pylist() == most
    want = np.zeros((52, 52))
    at = {w: i for i, w in enumerate(most)} | {markov.END: 51}
    for ws in taught:
        for a, b in zip([markov.END, *ws], ws):
            want[at.get(a, 50), at.get(b, 50)] += 1
    assert (markov.word_pairs(df.filter("learn").select("text"), found) == want).all()

    def scores(**more):
        got = markov.score_documents(df, F.col("learn"), states=2, **more).collect()
        return sorted(r["score"] for r in got)

    assert np.allclose(scores(start_docs=1, start_chars=40), scores(), rtol=1e-6)
