"""The corpus pipeline, stage by stage, against plain versions of the stages."""

import hashlib

import numpy as np
import pytest
from brute_passages import corpus_order, repeated

import corpus_pipeline
from stratalake.llm import mixing, passages, pieces, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
RUDE = ["grobian", "frechdachs", "miesling"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(900)]

    def line(n):
        return " ".join(rng.choice(words, n))

    passage = "\n".join(line(20) for _ in range(3))
    rows, marks = [], []
    for i in range(400):
        text = "\n".join(line(int(rng.integers(8, 30))) for _ in range(int(rng.integers(1, 6))))
        if i % 9 == 0:
            some = text.split(" ")
            some[len(some) // 2 : len(some) // 2] = RUDE
            text = " ".join(some)
        if i % 11 == 0:
            text += "\n" + passage
        rows.append([i, text, "en" if i % 3 else "de", f"s{i % 4}", len(text), "x"])
        if i % 2 == 0 or i % 9 == 0:
            marks.append((i, 1, int(i % 9 == 0)))
    for k in range(40):  # near copies with one word in about a hundred changed
        some = rows[200 + k][1].replace("\n", " ").split(" ")
        some[0] = "changed"
        rows.append([1000 + k, " ".join(some), "en", "s1", 5, "y"])
    rows += [[2000, None, None, None, None, None], [2001, "", "en", "s1", 0, "z"], list(rows[5])]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
        str(path / "labels.parquet")
    )
    return str(path)


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def _near_groups(rows, least):
    """Least ids of the groups that pairs of ``least`` similarity connect."""

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= least * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best.setdefault(root(i), []).append(doc_id)
    return sorted(min(ids) for ids in best.values())


def _raked(rows, rounds):
    cells = {}
    for cell, tokens in rows:
        cells[cell] = cells.get(cell, 0) + tokens
    weight = {c: float(t) for c, t in cells.items()}
    total = sum(cells.values())
    goals = []
    for at, power in enumerate(mixing.POWERS.values()):
        sums = {}
        for c, t in cells.items():
            sums[c[at]] = sums.get(c[at], 0) + t
        powered = {v: s**power for v, s in sums.items()}
        goals.append({v: p / sum(powered.values()) * total for v, p in powered.items()})
    for _ in range(rounds):
        for at, goal in enumerate(goals):
            sums = {}
            for c, w in weight.items():
                sums[c[at]] = sums.get(c[at], 0) + w
            weight = {c: w * goal[c[at]] / sums[c[at]] if sums[c[at]] else 0.0 for c, w in weight.items()}
    factor = {c: weight[c] / cells[c] for c in cells if cells[c]}
    return {c: factor.get(c, max(factor.values())) / max(factor.values()) for c in cells}


def test_stages_match_their_plain_versions(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "mixing sources to target weights",
        "SentencePiece encoding and decoding",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns

    kept = stages["toxicity"](spark, docs, sf_dir).cache()
    rude = [bool(set(RUDE) & set((t or "").replace("\n", " ").split(" "))) for _, t in _rows(docs)]
    assert kept.columns == columns and kept.count() == len(rude) - sum(rude)
    assert not any(set(RUDE) & set((t or "").split()) for _, t in _rows(kept))
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain = [r for r in _rows(docs) if model.scores([r[1] or ""])[0] < toxicity.CUT]
    assert sorted(plain, key=repr) == sorted(_rows(kept), key=repr)

    slim = stages["line dedup"](spark, kept, sf_dir).cache()
    told = passages.dedup_passages(kept, gone_col="gone").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in told), key=repr) == sorted(_rows(slim), key=repr)
    docs_in_order = corpus_order(_rows(kept))
    sure, most = repeated(docs_in_order, 50), repeated(docs_in_order, 25)
    bounds = {d: (s, m) for (d, _), s, m in zip(docs_in_order, sure, most)}
    before = dict(_rows(kept))
    for r in told:  # every word of a repeated span of 50, none outside repeated spans of 25
        gone = {w - 1 for span in r["gone"] or [] for w in range(span["a"], span["b"] + 1)}
        assert bounds[r["doc_id"]][0] <= gone <= bounds[r["doc_id"]][1]
        left = [w for i, w in enumerate((before[r["doc_id"]] or "").split()) if i not in gone]
        assert left == (r["text"] or "").split()
    assert sum(len(s) for s in sure) > 1000 and slim.columns == columns
    assert all(r["n_chars"] == len(r["text"]) for r in slim.collect() if r["n_chars"] is not None and r["text"])

    single = stages["SimHash near-dedup"](spark, slim, sf_dir).cache()
    assert single.columns == columns
    stayed = sorted(r[0] for r in _rows(single))
    assert stayed == _near_groups(_rows(slim), 0.8)
    assert len(stayed) == len(set(stayed))
    assert single.count() < slim.count()

    mixed = stages["mixing sources to target weights"](spark, single, sf_dir).cache()
    assert mixed.columns == columns
    told = single.select(
        "doc_id", "source", "lang", mixing.topic_of(single["text"]).alias("topic"),
        mixing.token_count(single["text"]).alias("tokens"),
    ).collect()
    chance = _raked([((r[1], r[2], r[3]), r[4]) for r in told], mixing.ROUNDS)
    drawn = []
    for r in told:
        u = int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:8], 16) / 2**32
        if u < chance[r[1], r[2], r[3]]:
            drawn.append(r[0])
    assert sorted(r[0] for r in _rows(mixed)) == sorted(drawn)

    last = stages["SentencePiece encoding and decoding"](spark, mixed, sf_dir).collect()
    codec = pieces.Codec(pieces.load_vocabulary())
    texts = dict(_rows(mixed))
    assert len(last) == len(texts)
    for r in last:
        assert r["ids"] == list(codec.encode(texts[r["doc_id"]] or ""))
        assert codec.decode(r["ids"]) == (texts[r["doc_id"]] or "") and r["round_trip"]

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in whole) == sorted((r["doc_id"], r["ids"]) for r in last)


def test_stages_of_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0, name
