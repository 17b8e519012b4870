"""Divergence audit: a plain version over odd input, and blocks of any size."""

import re
from collections import Counter

import pytest

from stratalake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p long, gb int, value string"
CLASH = ("x", 5, 6, 7, "y")


def plain(rows, least, top):
    docs = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")))
        for text, lang, source in rows
    ]
    out = []
    for lang in {d[0] for d in docs}:
        df, by, all_ = Counter(), {}, Counter()
        for d in docs:
            if d[0] == lang:
                df.update(set(d[2]))
        kept = {t for t, c in df.items() if c >= least}
        for d in docs:
            if d[0] == lang:
                by.setdefault(d[1], Counter()).update(t for t in d[2] if t in kept)
                all_.update(t for t in d[2] if t in kept)

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(p, q):
            return (p - q) ** 2 // q

        for s, c in by.items():
            pairs = [(o, sum(f(share(c, t), share(oc, t)) for t in kept)) for o, oc in by.items() if o != s]
            terms = [(t, f(share(c, t), share(all_, t))) for t in kept if c[t] and share(c, t) > share(all_, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                items = items if part == "pair" else items[:top]
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1)]
    return sorted(out)


def _rows():
    words = "Aa bb aA Cc-dd éÉ ff7gg hh 😀x ÀB zz".split()
    rows = []
    for i in range(60):
        text = " ".join(words[(i * j + j * j) % len(words)] * (1 + i % 2) for j in range(1, 4 + i % 9))
        rows.append((text, ["en", "de", None][i % 3], f"s{i % 7}" if i % 11 else None))
    rows += [rows[0]] * 4 + [(None, "en", "s1"), ("", "fr", "only"), (None, None, None), ("1 2 3", "xx", "a"), ("", "xx", "b")]
    rows.append((" ".join(f"long{'abcdefghij'[i % 10]}" for i in range(30000)), "en", "s2"))
    return rows


@pytest.mark.parametrize("blocks", [(16, 4096), (2, 3), (1, 1)])
def test_audit_equals_plain_version(spark, blocks):
    rows = _rows()
    df = spark.createDataFrame(
        [(i, t, lang, s, *CLASH) for i, (t, lang, s) in enumerate(rows)], SCHEMA
    ).repartition(5)
    got = divergence.audit_sources(df, 3, 4, group_block=blocks[0], term_block=blocks[1])
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 3, 4)


def test_audit_flushes_counts_and_takes_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_HELD_TERMS", 5)
    batch = spark.createDataFrame([("a b c d e f a", "l", "s")] * 3, "text string, lang string, source string")
    import pyarrow as pa

    rows = [
        pa.RecordBatch.from_pylist([{"lang": r["lang"], "source": r["source"], "text": r["text"]}])
        for r in batch.collect()
    ]
    total = Counter()
    for part in divergence._count_terms(iter(rows)):
        for row in part.to_pylist():
            total[row["term"]] += row["n"]
    assert total == Counter({"a": 6, "b": 3, "c": 3, "d": 3, "e": 3, "f": 3, "": 0}) and len(total) == 7
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.audit_sources(empty).count() == 0


def test_shares_beyond_a_long_are_exact(spark):
    df = spark.createDataFrame([(10**12, 7 * 10**12, 10**9)], "n long, total long, v long")
    got = df.select(divergence._share(df.n, df.total, df.v)).first()[0]
    assert got == 1 + 10**9 * (10**12 + 1) // (7 * 10**12 + 10**9)
