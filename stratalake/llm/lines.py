"""Line dedup by winnowing over line hashes (operator 5), DataFrame functions only.

A document is the sequence of its non-blank lines. From each line on, the fewest
lines that hold at least ``noise`` words are a gram. Within every span of
``guarantee`` words the gram of least hash is selected as a fingerprint. So a
repeated run of ``guarantee`` words always holds a fingerprint that its other
copies have too, and nothing below ``noise`` words is ever matched.

Fingerprints are joined with their first place in the corpus. Each later one is
extended both ways while its lines equal those around the first place, for up to
``guarantee`` words; a longer match holds a further fingerprint that goes on from
there. The lines of the extended run are deleted. A deleted line always equals an
earlier line, so one copy of every line stays.

With ``all_places`` a fingerprint is extended against every earlier place that has
it, not the first alone: each number of lines that agree makes a key with the hash
of those lines, and a key that an earlier place has deletes them. Without it, a
line that repeats only beside a fingerprint's second place or a later one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import let, row_key, settled

NOISE_WORDS = 25
GUARANTEE_WORDS = 50

_LINE = "array<struct<no:int,h:bigint,w:int>>"


def line_table(text: Column) -> Column:
    """Number (from 1), hash and word count of each line that is not blank."""
    lines = F.split(text, "\n")
    told = F.transform(
        lines,
        lambda line, i: F.struct(
            (i + 1).cast("int").alias("no"),
            F.xxhash64(F.trim(line)).alias("h"),
            F.regexp_count(line, F.lit(r"\S+")).cast("int").alias("w"),
        ),
    )
    return F.filter(told, lambda t: t["w"] > 0)


def _taken(lines: Column, words: int) -> Column:
    """The leading lines that it takes to reach ``words`` words: count, words, hash."""
    start = F.struct(
        F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(42).cast("long").alias("h")
    )
    return F.aggregate(
        lines,
        start,
        lambda a, t: F.when(a["w"] >= words, a).otherwise(
            F.struct(
                (a["n"] + 1).alias("n"), (a["w"] + t["w"]).alias("w"),
                F.xxhash64(a["h"], t["h"]).alias("h"),
            )
        ),
    )


def selected_grams(lines: Column, noise: int, guarantee: int) -> Column:
    """Fingerprints of a line table: hash, first line's index (from 1), lines.

    Every line has a word at least, so a gram has ``noise`` lines at most and a
    span is looked at for a bounded number of lines.
    """
    reach = guarantee - noise + 1  # a gram that starts within it ends in the span

    def gram(t: Column, i: Column) -> Column:
        key = let(
            _taken(F.slice(lines, i + 1, noise), noise),
            lambda some: F.when(
                some["w"] >= noise,
                F.struct(
                    some["h"].alias("g"), (i + 1).cast("int").alias("at"), some["n"].alias("n")
                ),
            ),
        )
        return F.struct(t["w"].alias("w"), key.alias("key"))

    def least(grams: Column, i: Column) -> Column:
        none = F.struct(
            F.lit(0).alias("w"), F.lit(None).cast("struct<g:bigint,at:int,n:int>").alias("key")
        )
        return F.aggregate(
            F.slice(grams, i + 1, reach),
            none,
            lambda a, x: F.when(a["w"] >= reach, a).otherwise(
                F.struct(
                    (a["w"] + x["w"]).alias("w"), F.least(a["key"], x["key"]).alias("key")
                )
            ),
            lambda a: a["key"],
        )

    chosen = let(
        F.transform(lines, gram), lambda grams: F.transform(grams, lambda _, i: least(grams, i))
    )
    return F.array_distinct(F.filter(chosen, lambda key: key.isNotNull()))


def _lines_for(lines: Column, words: int) -> Column:
    """Hashes of the leading lines that reach ``words`` words."""
    return F.transform(F.slice(lines, 1, _taken(lines, words)["n"]), lambda t: t["h"])


def _before(lines: Column, at: Column, most: int) -> Column:
    """The lines before ``at``, nearest first."""
    first = F.greatest(F.lit(1), at - most)
    return F.reverse(F.slice(lines, first, at - first))


def _matching(own: Column, other: Column, words: int) -> Column:
    """How many leading lines of ``own`` equal the hashes ``other``, up to ``words`` words."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(True).alias("on"))
    return F.aggregate(
        own,
        state,
        lambda a, t: F.when(
            a["on"] & (a["w"] < words) & (t["h"] == F.get(other, a["n"])),
            F.struct(
                (a["n"] + 1).alias("n"), (a["w"] + t["w"]).alias("w"), F.lit(True).alias("on")
            ),
        ).otherwise(F.struct(a["n"].alias("n"), a["w"].alias("w"), F.lit(False).alias("on"))),
        lambda a: a["n"],
    )


def _as_gone(per_doc: DataFrame, own: DataFrame, gone: Column) -> DataFrame:
    """Indexes of lines as their numbers in the text, a row per document key."""
    return per_doc.join(own, ["_d", "_t"]).select(
        "_d",
        "_t",
        F.transform(F.array_sort(gone), lambda i: F.col("_lines")[i - 1]["no"]).alias("_gone"),
    ).dropDuplicates(["_d", "_t"])


def _repeats_anywhere(keys: DataFrame, own: DataFrame, guarantee: int) -> DataFrame:
    """(_d, _t, _gone) of fingerprints extended against all earlier places."""
    several = keys.groupBy("g").agg(F.count("*").alias("c")).filter("c > 1").select("g")
    per_doc = (
        keys.join(several, "g", "left_semi")
        .groupBy("_d", "_t")
        .agg(F.collect_set(F.struct("g", "at", "n")).alias("_hits"))
    )

    def steps(hit: Column) -> Column:
        def side(sign: int, lines: Column) -> Column:
            return let(
                _lines_for(lines, guarantee),
                lambda some: F.transform(
                    some,
                    lambda _, j: F.struct(
                        F.xxhash64(hit["g"], F.lit(sign), j, F.slice(some, 1, j + 1)).alias("key"),
                        hit["at"].alias("at"),
                        (hit["at"] - (j + 1) if sign < 0 else hit["at"] + hit["n"] + j)
                        .cast("int").alias("line"),
                    ),
                ),
            )

        gram = F.transform(
            F.sequence(F.lit(0), hit["n"] - 1),
            lambda j: F.struct(
                F.xxhash64(hit["g"], F.lit(0), j).alias("key"), hit["at"].alias("at"),
                (hit["at"] + j).cast("int").alias("line"),
            ),
        )
        return F.concat(
            gram,
            side(-1, _before(F.col("_lines"), hit["at"], guarantee)),
            side(1, F.slice("_lines", hit["at"] + hit["n"], guarantee)),
        )

    met = per_doc.join(own, ["_d", "_t"]).dropDuplicates(["_d", "_t"])
    rows = met.select("_d", "_t", F.explode(F.flatten(F.transform("_hits", steps))).alias("_s"))
    rows = settled(rows.select("_d", "_t", "_s.*"))
    place = F.struct("_d", "_t", "at")
    first = (
        rows.groupBy("key").agg(F.min(place).alias("_f"), F.count("*").alias("c"))
        .filter("c > 1").select("key", "_f")
    )
    marked = (
        rows.join(first, "key").filter(F.col("_f") != place)
        .groupBy("_d", "_t").agg(F.collect_set("line").alias("_at"))
    )
    return _as_gone(marked, own, F.col("_at"))


def repeated_lines(
    docs: DataFrame,
    noise: int,
    guarantee: int,
    id_col: str,
    text_col: str,
    all_places: bool = False,
) -> DataFrame:
    """(_d, _t, _gone): by document key, the numbers of the lines to delete."""
    d, t = row_key(id_col, text_col)
    lines = docs.select(
        d.alias("_d"), t.alias("_t"), line_table(F.coalesce(text_col, F.lit(""))).alias("_lines")
    )
    profile = settled(
        lines.withColumn("_keys", selected_grams(F.col("_lines"), noise, guarantee))
    )
    keys = profile.select("_d", "_t", F.explode("_keys").alias("_k")).select(
        "_d", "_t", "_k.g", "_k.at", "_k.n"
    )
    if all_places:
        return _repeats_anywhere(keys, profile.select("_d", "_t", "_lines"), guarantee)
    # the first place of each fingerprint that has several, a row per fingerprint
    first = (
        keys.groupBy("g")
        .agg(F.min(F.struct("_d", "_t", "at", "n")).alias("f"), F.count("*").alias("c"))
        .filter("c > 1")
        .select("g", "f.*")
    )
    own = profile.select("_d", "_t", "_lines")
    around = (
        first.groupBy("_d", "_t")
        .agg(F.collect_list(F.struct("g", "at", "n")).alias("_firsts"))
        .join(own, ["_d", "_t"])
        .select(
            "_d",
            "_t",
            F.explode(
                F.transform(
                    "_firsts",
                    lambda k: F.struct(
                        k["g"].alias("g"),
                        k["at"].alias("f_at"),
                        _lines_for(
                            _before(F.col("_lines"), k["at"], guarantee), guarantee
                        ).alias("before"),
                        _lines_for(
                            F.slice("_lines", k["at"] + k["n"], guarantee), guarantee
                        ).alias("after"),
                    ),
                )
            ).alias("_a"),
        )
        .select(F.col("_d").alias("f_d"), F.col("_t").alias("f_t"), "_a.*")
        .dropDuplicates(["g"])
    )
    later = keys.join(around, "g").filter("not (_d = f_d and _t = f_t and at = f_at)")
    per_doc = later.groupBy("_d", "_t").agg(
        F.collect_list(F.struct("at", "n", "before", "after")).alias("_hits")
    )

    def run(hit: Column) -> Column:
        left = _matching(_before(F.col("_lines"), hit["at"], guarantee), hit["before"], guarantee)
        right = _matching(
            F.slice("_lines", hit["at"] + hit["n"], guarantee), hit["after"], guarantee
        )
        return F.sequence(hit["at"] - left, hit["at"] + hit["n"] - 1 + right)

    gone = F.array_distinct(F.flatten(F.transform("_hits", run)))
    return _as_gone(per_doc, own, gone)


def dedup_lines(
    docs: DataFrame,
    noise: int = NOISE_WORDS,
    guarantee: int = GUARANTEE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    gone_col: str | None = None,
    all_places: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with later copies of repeated runs of lines deleted.

    The corpus order is that of the id (null first), then of the text's hash, then
    of the line. All columns stay; only the text changes, and only where lines go:
    it is the kept lines joined by line breaks, empty if none is left. ``gone_col``
    adds the numbers (from 1) of the deleted lines, null if there are none.
    ``all_places`` compares each repeat with every earlier place of its fingerprint.

    Null and empty texts stay as they are. Rows that repeat both id and text count
    as one document and get the same result. Blank lines are no part of a run and
    are kept. Texts are shuffled once, to meet their deletions.
    """
    d, t = row_key(id_col, text_col)
    gone = repeated_lines(docs, noise, guarantee, id_col, text_col, all_places)
    packed = docs.select(d.alias("_d"), t.alias("_t"), F.struct("*").alias("_row"))
    met = packed.join(gone, ["_d", "_t"], "left")
    old = F.col("_row")[text_col]
    lines = F.split(old, "\n")
    kept = F.array_join(
        let(
            lines,
            lambda all_: F.transform(
                F.array_except(F.sequence(F.lit(1), F.size(all_)), F.col("_gone")),
                lambda i: all_[i - 1],
            ),
        ),
        "\n",
    )
    text = F.when(F.col("_gone").isNull(), old).otherwise(kept)
    columns = [text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    more = [] if gone_col is None else [F.col("_gone").alias(gone_col)]
    return met.select(*columns, *more)
