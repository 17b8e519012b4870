"""Passage dedup by winnowing over words (operator 5), DataFrame functions only.

What is selected, extended and deleted is as in :mod:`stratalake.llm.passages`, whose
joins are used here: every word of a span of ``guarantee`` words that an earlier place
has too goes, and no run of fewer than ``noise`` words. The order of places is that
of the hash of their first word, so of the runs between these lengths others may go.

A row per word, which no step writes, looks at the hashes of the words around it: it
goes on only if the least of its window differs from that of the window before.
Places that agree on a fingerprint and the
next word are compared as arrays, each with those before it; if they are many, by a row for
each key. Spans are merged by document before the texts meet them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import let, row_key
from stratalake.llm.passages import (
    GUARANTEE_WORDS, NOISE_WORDS, _again, _agreed_by_keys, _classes, _firsts, _PLACE, _repeated,
    _shared, _Steps,
)

LOCAL = 4096  # places of a fingerprint and its next word that are compared as arrays
PROBES = 8  # places of a window that are looked at before all of it

# Arrays are exploded as outer ones, none being empty: the filter on empty ones that goes
# with the others is moved below what makes the array, which is then made three times.

_WHITE = " \t\n\x0b\f\r"
_IN = r"[ \t\n\x0B\f\r]"
_OUT = r"[^ \t\n\x0B\f\r]"


def word_hashes(text: Column) -> Column:
    """A hash of 63 bits for each word."""
    words = F.split(F.btrim(text, F.lit(_WHITE)), f"{_IN}+")
    return F.transform(words, lambda w: F.shiftright(F.xxhash64(w), 1))


def fingerprints(texts: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """(_d, _t, g, at, l, r): hash, place (from 0) and hashes of the words around."""
    more = guarantee - noise
    h, i, at = F.col("h"), F.col("i"), F.col("at")
    places = F.size(h) - (noise - 1)
    # the window that starts at i, against the one before: its least place is another if
    # the place that left it, or the one that came, is less than all they share
    left = F.get(h, i - 1)
    came = F.when(i + more < places, F.get(h, i + more))
    common = F.array_min(F.slice(h, i + 1, F.least(F.lit(more), places - i)))
    edge = F.least(left - 1, came)
    # a few places rule most windows out
    probes = [
        F.when(i + j < places, F.get(h, i + j)) for j in range(0, more, max(1, more // PROBES))
    ]
    some = [F.coalesce(F.least(*probes) > edge, F.lit(True))] if len(probes) > 1 else []
    other = (i == 0) | reduce(Column.__and__, [*some, F.coalesce(common > edge, F.lit(True))])
    window = F.slice(h, i + 1, F.least(F.lit(more + 1), places - i))
    least = (i + F.array_position(window, F.array_min(window)) - 1).cast("int")
    begin = F.lit(0)
    chosen = F.when((i == 0) & (least != 0), F.array(begin, least)).otherwise(F.array(least))
    return (
        texts.select("_d", "_t", word_hashes(F.col("_x")).alias("h"))
        .select("_d", "_t", "h", F.posexplode_outer("h").alias("i", "_w"))
        .filter((i < places) & other)
        .select("_d", "_t", "h", F.explode_outer(chosen).alias("at"))
        .select(
            "_d", "_t", F.xxhash64(F.slice(h, at + 1, noise)).alias("g"), "at",
            F.xxhash64(F.slice(h, F.greatest(at - more, begin) + 1, F.least(at, F.lit(more)))).alias("l"),
            F.xxhash64(F.slice(h, at + noise + 1, more)).alias("r"),
        )
    )


def ladders(texts: DataFrame, asked: DataFrame, noise: int, guarantee: int) -> DataFrame:
    """(_d, _t, at, side, keys): for the places and sides ``asked``, a hash with the
    fingerprint of the nearest word, of the two nearest ones, and so on."""
    more = guarantee - noise
    per_doc = asked.groupBy("_d", "_t").agg(
        F.collect_list(F.struct("g", "at", "side")).alias("_open")
    )
    # a document that is there several times is one place
    met = texts.join(per_doc.hint("merge"), ["_d", "_t"]).dropDuplicates(["_d", "_t"])
    h, at = F.col("h"), F.col("at")
    before = F.slice(h, F.greatest(at - more, F.lit(0)) + 1, F.least(at, F.lit(more)))
    near = F.when(F.col("side") < 0, F.reverse(before)).otherwise(
        F.slice(h, at + noise + 1, more)
    )
    beside = F.when(F.col("side") < 0, at > 0).otherwise(at + noise < F.size(h))
    rows = (
        met.select("_d", "_t", word_hashes(F.col("_x")).alias("h"), "_open")
        .select("_d", "_t", "h", F.inline("_open")).filter(beside)
        .select(*_PLACE, "side", near.alias("_near"), F.xxhash64("g", "side").alias("_k0"))
    )
    # a column for each number of words, made from the one before in compiled code
    for j in range(more):
        rows = rows.withColumn(f"_k{j + 1}", F.xxhash64(f"_k{j}", F.get("_near", F.lit(j))))
    keys = F.array(*[f"_k{j + 1}" for j in range(more)])
    return rows.select(*_PLACE, "side", F.slice(keys, 1, F.size("_near")).alias("keys"))


def agreed_by_group(rows: DataFrame, groups: DataFrame, more: int) -> DataFrame:
    """(place, side, j): on how many words an earlier place agrees, by the first key.

    Whoever agrees on some words agrees on fewer, so their number is found by halving.
    """
    some = rows.withColumn("key", F.get("keys", F.lit(0))).join(groups.hint("shuffle_hash"), "key")
    met = some.groupBy("key", "side").agg(F.collect_list(F.struct(*_PLACE, "keys")).alias("_all"))
    halves = [1 << k for k in reversed(range(more.bit_length()))]

    def told(all_: Column, levels: Column) -> Column:
        def one(place: Column, i: Column) -> Column:
            def step(j: Column, half: Column) -> Column:
                # its own key is there, at i + 1 or before; null if it has no such key
                first = F.array_position(F.get(levels, j + half - 1), F.get(place["keys"], j + half - 1))
                return F.when(first <= i, j + half).otherwise(j)

            j = F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step)
            return F.struct(*[place[c].alias(c) for c in _PLACE], j.alias("j"))

        return F.transform(all_, one)

    def by_level(all_: Column) -> Column:
        made = F.transform(
            F.sequence(F.lit(0), F.lit(more - 1)),
            lambda j: F.transform(all_, lambda p: F.get(p["keys"], j)),
        )
        return let(made, lambda levels: told(all_, levels))

    return met.select("side", F.inline_outer(let(F.sort_array("_all"), by_level))).filter(
        "j > 0"
    ).select(*_PLACE, "side", "j")


def merged_spans(again: DataFrame, open_: DataFrame, agreed: DataFrame, noise: int, more: int) -> DataFrame:
    """(_d, _t, _spans): by document key, first and last word (from 0) of what goes.

    A side of a repeat that is not open goes in full; the last word may lie beyond the text.
    """
    none = F.lit(None).cast("int")
    rows = (
        again.select(*_PLACE, F.lit(0).alias("side"), none.alias("j"))
        .unionByName(open_.select(*_PLACE, "side", F.lit(0).alias("j")))
        .unionByName(agreed.select(*_PLACE, "side", "j"))
    )

    def beside(side: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col("j"))), F.lit(more))

    first = F.greatest(F.col("at") - F.col("_l"), F.lit(0)).cast("long")
    last = F.col("at") + (noise - 1) + F.col("_r")
    per_doc = (
        rows.repartition("_d", "_t").groupBy(*_PLACE)
        .agg(F.max(F.col("side") == 0).alias("_gone"), beside(-1).alias("_l"), beside(1).alias("_r"))
        .filter("_gone").select("_d", "_t", (F.shiftleft(first, 32) + last).alias("_s"))
        .groupBy("_d", "_t").agg(F.collect_list("_s").alias("_s"))
    )

    def span(a: Column, b: Column) -> Column:
        return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))

    def state(a: Column, b: Column, done: Column) -> Column:
        return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), done.alias("done"))

    def step(acc: Column, x: Column) -> Column:
        a, b = F.shiftright(x, 32), x.bitwiseAND(F.lit((1 << 32) - 1))
        apart = state(a, b, F.array_append(acc["done"], span(acc["a"], acc["b"])))
        return F.when(a > acc["b"] + 1, apart).when(
            b > acc["b"], state(acc["a"], b, acc["done"])
        ).otherwise(acc)

    def merge(all_: Column) -> Column:
        first = all_[0]
        start = state(
            F.shiftright(first, 32), first.bitwiseAND(F.lit((1 << 32) - 1)),
            F.array().cast("array<struct<a:int,b:int>>"),
        )
        return F.aggregate(
            all_, start, step, lambda acc: F.array_append(acc["done"], span(acc["a"], acc["b"]))
        )

    return per_doc.select("_d", "_t", let(F.sort_array("_s"), merge).alias("_spans"))


def repeated_spans(
    docs: DataFrame, noise: int, guarantee: int, id_col: str, text_col: str
) -> DataFrame:
    """(_d, _t, _spans): as :func:`merged_spans`, kept as a table."""
    if not 2 <= noise <= guarantee:
        raise ValueError("noise must be 2 or more, and guarantee no less")
    more = guarantee - noise
    steps = _Steps(docs.sparkSession)
    d, t = row_key(id_col, text_col)
    texts = docs.select(
        d.alias("_d"), t.alias("_t"), F.coalesce(text_col, F.lit("")).alias("_x")
    )
    keys = steps.keep("keys", fingerprints(texts, noise, guarantee))
    repeated = steps.keep("repeated", _repeated(keys))
    steps.drop()
    shared = steps.keep("shared", _shared(keys, repeated))
    del keys, repeated
    steps.drop("keys", "repeated")
    firsts = steps.keep("firsts", _firsts(shared))
    again = steps.keep("again", _again(shared, firsts))
    del firsts
    steps.drop("firsts")
    open_ = steps.keep("open", _classes(shared).select("g", "side", "_f.*"))
    del shared
    steps.drop("shared")

    rows = steps.keep("ladders", ladders(texts, open_, noise, guarantee))
    steps.drop()
    # most places differ in the first word beside the fingerprint
    first = F.get("keys", F.lit(0))
    groups = steps.keep("groups", rows.groupBy(first.alias("key")).count().filter("count > 1"))
    agreed = steps.keep("agreed", agreed_by_group(rows, groups.filter(F.col("count") <= LOCAL), more))
    large = groups.filter(F.col("count") > LOCAL)
    if not large.isEmpty():
        # there is one for LOCAL places at most, so they are few on any table
        hot = rows.join(F.broadcast(large), first == F.col("key"), "left_semi")
        many = steps.keep("many", hot)
        agreed = agreed.unionByName(steps.keep("dealt", _agreed_by_keys(many, more)))
        del hot, many
        steps.drop("many")
    del rows, groups, large
    steps.drop("groups", "ladders")
    spans = steps.keep("spans", merged_spans(again, open_, agreed, noise, more))
    del again, open_, agreed
    steps.drop(*[name for name in steps.paths if name != "spans"])
    return spans


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans`` and the white space after them, and these as
    ``gone``, first and last word from 1; null without spans."""
    # each word with the white space after it, and the first also with that before it
    word = f"{_IN}*+{_OUT}++{_IN}*+"
    pieces = F.regexp_extract_all(text, F.lit(word), F.lit(0))

    def cut(all_: Column) -> Column:
        n = F.size(all_)

        def between(k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(spans, k - 1)["b"] + 1)
            end = F.coalesce(F.get(spans, k)["a"], n)
            return F.slice(all_, start + 1, F.greatest(end - start, F.lit(0)))

        kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), between))
        told = F.transform(
            spans,
            lambda s: F.struct((s["a"] + 1).alias("a"), F.least(s["b"] + 1, n).cast("int").alias("b")),
        )
        return F.struct(F.array_join(kept, "").alias("text"), told.alias("gone"))

    return F.when(spans.isNotNull(), let(pieces, cut))


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
    as one document and get the same result. A text of any length is one task's work.
    """
    d, t = row_key(id_col, text_col)
    spans = repeated_spans(docs.select(id_col, text_col), noise, guarantee, id_col, text_col)
    others = [c for c in docs.columns if c != text_col]
    # under names that cannot clash with each other
    rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    packed = docs.select(d.alias("_d"), t.alias("_t"), rest.alias("_rest"), F.col(text_col).alias("_x"))
    met = packed.join(spans.hint("merge"), ["_d", "_t"], "left")
    made = met.select("_rest", "_x", without_spans(F.col("_x"), F.col("_spans")).alias("_made"))
    text = F.coalesce(F.col("_made.text"), F.col("_x"))
    at = {c: F.col("_rest")[f"c{i}"].alias(c) for i, c in enumerate(others)}
    columns = [text.alias(c) if c == text_col else at[c] for c in docs.columns]
    more = [] if gone_col is None else [F.col("_made.gone").alias(gone_col)]
    return made.select(*columns, *more)
