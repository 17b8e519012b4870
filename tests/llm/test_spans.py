"""The line stage and operator 5 without Python on the executors."""

import numpy as np
import pytest
from brute_passages import corpus_order, repeated

import corpus_pipeline
from stratalake.llm import queries, spans


def _rows():
    rng = np.random.default_rng(5)
    pool = [[f"v{x}" for x in rng.integers(0, 40, rng.integers(3, 30))] for _ in range(20)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.integers(0, 7)):
            words += [f"u{x}" for x in rng.integers(0, 500, rng.integers(0, 15))]
            one = pool[rng.integers(0, len(pool))]
            words += one[rng.integers(0, 4) :][: rng.integers(2, 30)]
        gaps = rng.choice([" ", "\n", "  ", "\r\n", "\t"], len(words))
        rows.append((i // 2, "".join(w + g for w, g in zip(words, gaps))))
    odd = [(None, "\t" + " ".join(pool[3] * 2)), (81, None), (82, ""), (83, " \n "), rows[7]]
    return rows + [(80, "again " * 70)] + odd


@pytest.mark.parametrize("local", [spans.LOCAL, 3])
def test_spans_match_their_definition(spark, monkeypatch, local):
    monkeypatch.setattr(spans, "LOCAL", local)  # larger groups go the other way
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans.dedup_passages(df, 5, 12, gone_col="gone").collect()
    docs = corpus_order(rows)
    assert len(got) == len(rows)
    for (doc_id, text), least, most in zip(docs, repeated(docs, 12), repeated(docs, 5)):
        words, fits = (text or "").split(), 0
        for r in got:
            gone = {w - 1 for s in r["gone"] or [] for w in range(s["a"], s["b"] + 1)}
            left = [w for i, w in enumerate(words) if i not in gone]
            same = r["doc_id"] == doc_id and (r["text"] or "").split() == left
            fits += same and least <= gone <= most
        assert fits, (doc_id, sorted(least))
    kept = {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (81, 82, 83)}
    assert kept == {81: None, 82: "", 83: " \n "}


def test_window_minima_match_a_plain_version(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30, n)) for n in (4, 5, 6, 12, 13, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "_d long, _x string").selectExpr("_d", "0L as _t", "_x")
    found = {}
    for r in spans.fingerprints(df, 5, 12).collect():
        found.setdefault(r["_d"], []).append(r["at"])
    for r in df.select("_d", spans.word_hashes(df["_x"]).alias("h")).collect():
        places = max(0, len(r["h"]) - 4)
        want = {0} if places else set()
        for i in range(places):
            want.add(min(range(i, min(i + 8, places)), key=lambda k: (r["h"][k], k)))
        assert sorted(found.get(r["_d"], [])) == sorted(want)


@pytest.mark.parametrize("stage", ["op5_line_dedup", "line dedup"])
def test_no_python_on_the_executors(spark, tmp_path, stage, monkeypatch):
    docs = spark.createDataFrame(_rows()[:20], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plans, keep = [], spans._Steps.keep

    def told(self, name, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return keep(self, name, rows)

    monkeypatch.setattr(spans._Steps, "keep", told)
    if stage == "line dedup":
        made = corpus_pipeline.dedup_lines(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "")
    else:
        made = queries.op5_line_dedup(spark, str(tmp_path))
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5
    assert not [p for p in plans if "Arrow" in p or "Python" in p or "Pandas" in p]


def test_keys_of_near_words_take_no_lambda(spark):
    texts = spark.createDataFrame([(1, 1, "a b c d e f g")], "_d long, _t long, _x string")
    asked = spark.createDataFrame(
        [(1, 1, 5, 2, 1), (1, 1, 5, 2, -1)], "_d long, _t long, g long, at int, side int"
    )
    made = spans.ladders(texts, asked, 2, 6)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 1  # that of the words' hashes
    assert {r["side"]: len(r["keys"]) for r in made.collect()} == {-1: 2, 1: 3}


def test_places_are_not_sorted_to_meet_repeated_fingerprints(spark):
    keys = spark.createDataFrame(
        [(7, 2, 0, 0, 1, 5), (7, 1, 0, 3, 1, 6), (8, 1, 0, 4, 2, 2)],
        "g long, _d long, _t long, at int, l long, r long",
    )
    shared = spans._shared(keys, spans._repeated(keys))
    assert "SortMergeJoin" not in shared._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["_d"], r["later"]) for r in shared.collect()) == [(1, False), (2, True)]
