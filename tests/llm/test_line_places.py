"""Line dedup against all earlier places of a repeat, not the first alone."""

import brute_lines
import numpy as np
import pytest

import corpus_pipeline
from stratalake.llm import lines


def _line(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_run_shared_with_a_later_place_goes(spark):
    """A has L1, X; B and C share L1, L2: 54 words, of which A has the first 30."""
    one, two, other = _line("l", 30), _line("m", 24), _line("x", 24)
    rows = [(1, f"{one}\n{other}"), (2, f"{one}\n{two}"), (3, f"{one}\n{two}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 2: two, 3: ""}


def _everywhere(rows, noise, guarantee):
    """{id: line numbers} by comparing each selected gram with all earlier places."""
    docs = sorted(set(rows), key=lambda r: r[0])
    tables = [brute_lines.line_table(t) for _, t in docs]
    places = [
        (g, k, at, n)
        for k, table in enumerate(tables)
        for g, at, n in sorted(brute_lines.selected(table, noise, guarantee), key=lambda x: x[1])
    ]
    gone = {}
    for i, (g, k, at, n) in enumerate(places):
        for h, fk, fat, fn in places[:i]:
            if h != g:
                continue
            own, other = tables[k], tables[fk]
            left = brute_lines.matching(own[:at][::-1], other[:fat][::-1], guarantee)
            right = brute_lines.matching(own[at + n :], other[fat + fn :], guarantee)
            gone.setdefault(docs[k][0], set()).update(
                own[j][0] for j in range(at - left, at + n + right)
            )
    return {k: sorted(v) for k, v in gone.items()}


@pytest.mark.parametrize("seed", [3])
def test_all_places_match_the_plain_version(spark, seed):
    rng = np.random.default_rng(seed)
    pool = [_line(f"v{j}_", int(rng.integers(1, 12))) for j in range(14)] + [""]
    rows = []
    for i in range(70):
        picked = [pool[j] for j in rng.integers(0, len(pool), rng.integers(0, 12))]
        rows.append((i, "\n".join(picked)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(docs, 8, 20, gone_col="gone", all_places=True).collect()
    want = _everywhere(rows, 8, 20)
    assert {r["doc_id"]: r["gone"] for r in got if r["gone"]} == want
    first_only = {i: v for (i, _), v in brute_lines.deleted(rows, 8, 20).items()}
    assert want != first_only and len(got) == len(rows)
