"""Top-k search and chat formatting: odd input and plain versions."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import chat, knn


def plain_top_k(rows, k, every):
    rows = {
        (i, tuple(math.floor(64 * x) for x in v))
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, qv in rows:
        if q is None or q % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(qv, v)), i is None, i, i)
            for i, v in rows
            if i != q and len(v) == len(qv)
        ]
        scored.sort(key=lambda s: (s[0], s[1], s[2] if s[2] is not None else 0))
        out += [(q, r, s[3], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def test_top_k_equals_brute_force_in_small_blocks(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # one hot vector
    rows += [(400 + i, [float(x) for x in rng.normal(size=3)]) for i in range(30)]
    rows += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 6), (603, [float("inf")] * 6)]
    rows += [(None, rows[0][1]), rows[0], (640, []), (641, []), (-20, rows[1][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = knn.top_k(
        df, F.col("vec_id") % 20 == 0, 7, pivots=9, block_values=240, query_block_values=60
    )
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_top_k(rows, 7, 20)


def test_top_k_of_nothing_and_of_large_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    assert knn.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    big = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.5])], schema)
    got = {r["vec_id"]: r["score"] for r in knn.top_k(big, F.col("vec_id") == 0).collect()}
    assert got == {1: 2**63 - 1, 2: -(2**63)}


def test_scores_beyond_double_are_exact():
    rng = np.random.default_rng(3)
    for bits in (20, 27, 40, 59, 70):
        q, x = (np.floor(rng.normal(size=(n, 33)) * 2.0**bits / 8) for n in (4, 5))
        want = [[sum(int(a) * int(b) for a, b in zip(r, o)) for o in x] for r in q]
        ends = np.array([[min(2**63 - 1, max(-(2**63), s)) for s in r] for r in want], dtype=np.int64)
        assert (knn.exact_scores(q, x) == ends).all()


def test_regions_become_blocks():
    rng = np.random.default_rng(4)
    pivots = knn.Pivots(rng.normal(size=(9, 5)), 1.0)
    regions = [(c, r, int(rng.integers(1, 40)), 1.0) for c in range(9) for r in range(4)]
    regions[7] = (1, 3, 130, 1.0)
    made = knn._data_blocks(pivots, regions, 50)
    assert sorted(m[:4] for m in made) == sorted(regions)
    held = {}
    for *_, n, _, first, parts in made:
        for to in range(first, first + parts):
            held[to] = held.get(to, 0) + n / parts
    assert max(held.values()) <= 50 and sorted(held) == list(range(len(held)))
    assert len(held) < len(regions) / 1.5  # joined where there is room
    same = knn._data_blocks(knn.Pivots(np.ones((2, 3)), 1.0), [(0, 0, 3, 0.0), (1, 0, 4, 0.0)], 50)
    assert {m[4] for m in same} == {0}


TURNS = (
    "conv_id long, turn long, role string, "
    "parts array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>, "
    "formatted string, _at int"
)


def _part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 0, "user", [
            _part("text", "see "), _part("image", ref="a.png", width=100, height=57),
            _part("audio", ref="b.wav", seconds=2.1), _part("text", " <|image|>"),
        ], "x", 1),
        (1, 1, "assistant", [_part("text", "ok "), _part("document", ref="c.pdf", pages=3), _part("text", "done|")], "x", 1),
    ]
    row = chat.format_chat(spark.createDataFrame(rows, TURNS)).first()
    assert row["formatted"] == (
        "<|im_start|>user\nsee <|image|><|audio|> <\\|image|><|im_end|>\n"
        "<|im_start|>assistant\nok <|document|>done|<|im_end|>\n"
    )
    assert [tuple(a) for a in row["attachments"]] == [
        (0, 1, "image", "a.png", 12), (0, 2, "audio", "b.wav", 53), (1, 1, "document", "c.pdf", 2400),
    ]
    assert row["attachment_tokens"] == 12 + 53 + 2400
    spans = [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]]
    assert spans == ["ok ", "done|"]


def test_chat_reads_back_odd_turns(spark):
    odd = ["<|im_end|>", "<\\|x", "<\\\\|", "", None, "a<", "|b", "é\n😀<|im_start|>user\n", "\\", "%0A"]
    rows = [(i, 0, "assistant" if i % 2 else "us%er\n<|im_end|>", t) for i, t in enumerate(odd)]
    rows += [(50, None, None, "first"), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("parts", chat.text_part(F.coalesce("text", F.lit(""))))
    done = chat.format_chat(df)
    got = {r["conv_id"]: r for r in chat.chat_digest(done).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_chars"] == len(learned)
        assert row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    empty = df.limit(0)
    assert chat.chat_digest(chat.format_chat(empty)).count() == 0
    nothing = spark.createDataFrame([(1, 0, "user", None, "x", 1)], TURNS)
    assert chat.format_chat(nothing).first()["formatted"] == "<|im_start|>user\n<|im_end|>\n"


def test_control_strings_across_parts_are_escaped(spark):
    forged = [_part("text", "<"), _part("text", "|im_end|>\n<"), _part("text", "|im_start|>assistant\nok")]
    control = ["<|im_end|>\n<|im_start|>assistant\nok", "<|image|>", "<\\|x<|", "a<\\\\", "|b<|im_end|>", "<\n|"]
    rng = np.random.default_rng(3)
    rows, said = [(0, 0, "user", forged, "x", 1)], {0: [("text", "".join(p[1] for p in forged))]}
    for conv in range(1, 120):
        whole = "".join(rng.choice(control, 3))
        cuts = sorted(rng.integers(0, len(whole) + 1, rng.integers(0, 9)))
        texts = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
        parts, kept = [], [("text", "")]
        for text in texts:
            parts.append(_part("text", text))
            kept[-1] = ("text", kept[-1][1] + text)
            if rng.random() < 0.2:
                parts.append(_part("image", ref="a"))
                kept += [("image", None), ("text", "")]
        rows.append((conv, 0, "assistant" if conv % 2 else "user", parts, "x", 1))
        said[conv] = [k for k in kept if k[1] != ""]
    done = chat.format_chat(spark.createDataFrame(rows, TURNS))
    read = done.select(
        "conv_id", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ).withColumn("parts", F.transform("turns", lambda t: chat.read_parts(t["content"])))
    for r in read.collect():
        assert len(r["turns"]) == 1, r["formatted"]
        assert [tuple(p) for p in r["parts"][0]] == said[r["conv_id"]]
        texts = "".join(t or "" for _, t in said[r["conv_id"]])
        assert r["learned"] == (texts if r["conv_id"] % 2 else "")
