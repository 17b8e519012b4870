"""Quality and toxicity classifiers against plain loops over rows."""

import math
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import quality, toxicity

SCHEMA = "doc_id long, text string, host string, path string, evidence double, n long, k long, bins string"
CLASH = (0.1, 5, 6, "b")


def traits(text):
    words = [w for w in re.split(r"[\x09-\x0D\x20]+", text) if w]
    if not words:
        return None
    kinds = [unicodedata.category(c) for c in text]
    letters = sum(k[0] == "L" for k in kinds)
    marks = sum(not (k[0] in "LN") and c not in " \t\n\x0b\f\r" for k, c in zip(kinds, text))
    n = len(words)
    return {
        "upper": kinds.count("Lu") / max(letters, 1),
        "marks": marks / len(text),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / n,
        "distinct": len(set(words)) / n,
        "length": (len(text) - n + 1) / n,
    }


def strength(groups):
    """Pseudo-counts from (n, k, expected) by the moments of the beta-binomial."""
    if len(groups) < 2:
        return 100.0
    s = sum((k - n * e) ** 2 / n / (e * (1 - e)) for n, k, e in groups)
    total, squares, g = sum(n for n, _, _ in groups), sum(n * n for n, _, _ in groups), len(groups)
    room = total - squares / total - (g - 1)
    between = (s - (g - 1)) / room if room > 0 else 0.0
    return 1 / min(max(between, 1e-4), 0.5) - 1


def plain_quality(rows, labels):
    bins = {}
    for i, (_, text, _, _) in enumerate(rows):
        told = traits(text or "")
        bins[i] = {n: -1 if told is None else sum(told[n] >= c for c in cuts) for n, cuts in quality.CUTS.items()}
    held = {d: d is None or zlib.crc32(str(d).encode()) % 4 == 2 for d, *_ in rows}
    known = {}
    for d, q in labels:
        if d is not None and q is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            known[d] = max(known.get(d, 0), int(q > 0))
    learned = [i for i, r in enumerate(rows) if r[0] in known]
    ratios = {}
    for name, cuts in quality.CUTS.items():
        of = {1: {}, 0: {}}
        for i in learned:
            good = known[rows[i][0]]
            of[good][bins[i][name]] = of[good].get(bins[i][name], 0) + 1
        size = len(cuts) + 2
        for b in {*of[0], *of[1]}:
            share = [(of[g].get(b, 0) + 0.5) / (sum(of[g].values()) + 0.5 * size) for g in (1, 0)]
            ratios[name, b] = 0.5 * math.log(share[0] / share[1])
    paths, hosts = {}, {}
    for i in learned:
        good = known[rows[i][0]]
        for table, key in ((paths, rows[i][2:4]), (hosts, rows[i][2])):
            n, k = table.get(key, (0, 0))
            table[key] = (n + 1, k + good)
    rate = (sum(k for _, k in hosts.values()) + 0.5) / (sum(n for n, _ in hosts.values()) + 1)
    m = strength([(n, k, rate) for n, k in hosts.values()])
    host_rate = {h: (k + m * rate) / (n + m) for h, (n, k) in hosts.items()}
    m = strength([(n, k, host_rate[p[0]]) for p, (n, k) in paths.items()])
    path_rate = {p: (k + m * host_rate[p[0]]) / (n + m) for p, (n, k) in paths.items()}
    out = []
    for i, (d, _, host, path) in enumerate(rows):
        evidence = sum(ratios.get((n, b), 0.0) for n, b in bins[i].items())
        prior = path_rate.get((host, path), host_rate.get(host, rate))
        score = 1 / (1 + math.exp(-(evidence + math.log(prior / (1 - prior)))))
        out.append((d, held[d], evidence, prior, score))
    return out


def test_quality_equals_plain_loops(spark):
    rng = np.random.default_rng(6)
    words = "der Hund LÄUFT, schnell! x 12 e-mail ÀB (so) und und the cat; sat... on It's".split()
    rows = []
    for i in range(150):
        some = " ".join(rng.choice(words[: 4 + i % 15], rng.integers(0, 40)))
        rows.append((i, some if i % 9 else some.upper() + "!!!", f"h{i % 4}" if i % 11 else None, f"p{i % 3}"))
    rows += [(200, None, "h9", "p"), (201, " \t\n", "h0", "p9"), (None, "a b", "h1", "p1"), rows[3], rows[3]]
    labels = [(i, int(i % 4 > 1 or i % 9 == 0)) for i in range(0, 150, 1 + 0)] + [(3, 0), (4, None), (None, 1), (999, 1)]
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)
    got = quality.classify_quality(
        df, spark.createDataFrame(labels, "doc_id long, quality int"), F.col("host"), F.col("path")
    )
    got = sorted(((r["doc_id"], r["held_out"], r["evidence"], r["site_prior"], r["score"]) for r in got.collect()), key=repr)
    want = sorted(plain_quality(rows, labels), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:], abs=1e-9)


def risk(pos, unl, prior, w, b):
    """The two parts of the risk, with the log loss of each row."""

    def loss(row, sign):
        return math.log1p(math.exp(-sign * (sum(x * y for x, y in zip(row, w)) + b)))

    as_clean = sum(loss(r, -1) for r in unl) / len(unl) - prior * sum(loss(r, -1) for r in pos) / len(pos)
    return prior * sum(loss(r, 1) for r in pos) / len(pos), as_clean


def plain_fit(pos, unl, prior, steps, rate, decay):
    """Adam on numeric slopes of the risk, turned round where the clean part is below zero."""
    point = [0.0] * len(pos[0]) + [math.log(prior / (1 - prior))]
    first, second = [0.0] * len(point), [0.0] * len(point)
    turned = 0
    for step in range(1, steps + 1):
        below = risk(pos, unl, prior, point[:-1], point[-1])[1] < 0
        turned += below

        def value(at):
            on_pos, clean = risk(pos, unl, prior, at[:-1], at[-1])
            return -clean if below else on_pos + clean

        slope = []
        for j in range(len(point)):
            up, down = list(point), list(point)
            up[j] += 1e-5
            down[j] -= 1e-5
            s = (value(up) - value(down)) / 2e-5
            slope.append(s + (decay * point[j] if j < len(point) - 1 else 0))
        for j, s in enumerate(slope):
            first[j] = 0.9 * first[j] + 0.1 * s
            second[j] = 0.999 * second[j] + 0.001 * s * s
            point[j] -= rate * (first[j] / (1 - 0.9**step)) / (math.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return point, turned


def test_risk_is_followed_as_defined():
    rng = np.random.default_rng(9)
    pos = (rng.random((12, 3)) < [0.9, 0.5, 0.1]).astype(float)
    unl = (rng.random((40, 3)) < [0.1, 0.5, 0.3]).astype(float)
    unl[0], pos[0] = 0, 1
    turns = 0
    for prior in (0.05, 0.45):
        w, b = toxicity.nnpu_fit(pos, unl, prior, steps=40, rate=0.1, decay=1e-3)
        want, turned = plain_fit(pos.tolist(), unl.tolist(), prior, 40, 0.1, 1e-3)
        turns += turned
        assert [*w, b] == pytest.approx(want, rel=1e-3, abs=1e-3)
    assert turns  # the estimate of the clean part went below zero, and was held back
