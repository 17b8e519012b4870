"""Document fingerprints: threshold-scaled sketches (operator 2), DataFrame functions only.

A sketch holds every shingle hash below a fixed fraction of the hash range, so its
size follows the document and sketches of very unequal documents compare: the
union of two sketches is the sketch of both texts, and the share of one sketch
found in another estimates containment. A document too short for any hash below
the threshold is anchored by its least hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import NULL_ID, let

SHINGLE_WORDS = 5
FRACTION = 1 / 4
HASH_BITS = 60

# --- fixed values: letters lowered before words are taken ------------------------
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# ----------------------------------------------------------------------------------


def word_hashes(text: Column) -> Column:
    """Hash of each word, A-Z lower-cased; words end at ASCII white space."""
    words = F.split(F.translate(text, UPPER, UPPER.lower()), "[\\x20\\x09-\\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hash of every run of ``words`` words; fewer words are one run, none give none."""
    mask = F.lit((1 << HASH_BITS) - 1)

    def runs(w: Column) -> Column:
        whole = F.aggregate(w, F.lit(42).cast("long"), lambda h, x: F.xxhash64(h, x))
        many = F.transform(
            F.sequence(F.lit(0), F.size(w) - words),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]).bitwiseAND(mask),
        )
        return (
            F.when(F.size(w) >= words, many)
            .when(F.size(w) > 0, F.array(whole.bitwiseAND(mask)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(word_hashes(text), runs)


def sketch(text: Column, words: int = SHINGLE_WORDS, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the threshold, or the least one if none is."""
    threshold = F.lit(int(fraction * (1 << HASH_BITS)))

    def kept(h: Column) -> Column:
        return let(
            F.array_min(h), lambda least: F.filter(h, lambda x: (x < threshold) | (x == least))
        )

    return F.array_sort(F.array_distinct(let(shingle_hashes(text, words), kept)))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts taken together, from their sketches."""
    threshold = F.lit(int(fraction * (1 << HASH_BITS)))
    return let(
        F.array_union(a, b),
        lambda u: F.array_sort(
            F.filter(u, lambda x: (x < threshold) | (x == F.array_min(u)))
        ),
    )


def resemblance(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes; two empty sketches are alike."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def containment(a: Column, b: Column) -> Column:
    """Share of sketch ``a`` found in ``b``; an empty sketch is in every other."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(a)
    )


def as_text(hashes: Column) -> Column:
    """A sketch as a string: 15 hex digits a hash, in order."""
    return F.array_join(
        F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), HASH_BITS // 4, "0"))), ""
    )


def _id_bounds(docs: DataFrame, key: Column, buckets: int) -> list[int]:
    """Least ids of about ``buckets`` ranges with like numbers of rows; bounded."""
    shares = [i / buckets for i in range(1, buckets)]
    row = docs.agg(
        F.min(key).alias("low"),
        F.percentile_approx(key, F.array(*map(F.lit, shares)), 20 * buckets).alias("cuts"),
    ).first()
    return sorted({row["low"], *(row["cuts"] or [])} - {None})


def with_next(
    docs: DataFrame, carry: dict[str, Column], next_of: dict[str, str],
    id_col: str = "doc_id", buckets: int | None = None,
) -> DataFrame:
    """``carry`` columns of each row beside some of those of the next row by id.

    ``next_of`` names the new columns and the carried ones they are taken from.
    Rows are ordered by id (null first), then by the text hash ``_hash`` that
    ``carry`` must hold; after the last comes the first. Ids are cut into ranges
    of like size, one shuffle brings a range together, and a window looks ahead
    in it. The first rows of a range are also sent to the range before it, so no
    window spans the table.
    """
    buckets = buckets or max(
        2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    bounds = _id_bounds(docs, key, buckets)
    if not bounds:
        bounds = [NULL_ID]
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    # the last cut that is not above the key, by halving
    bucket = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda p, s: F.when((p + s <= len(bounds)) & (F.get(cuts, p + s - 1) <= F.col("_key")), p + s)
        .otherwise(p),
    ) - 1
    carried = [c.alias(n) for n, c in carry.items()]
    rows = docs.withColumn("_key", key).select("_key", *carried).withColumn("_bucket", bucket)
    firsts = {
        r["_bucket"]: r["_first"]
        for r in docs.select(key.alias("_key"))
        .withColumn("_bucket", bucket)
        .groupBy("_bucket")
        .agg(F.min("_key").alias("_first"))
        .collect()  # a row per range
    }
    used = sorted(firsts)
    spark = docs.sparkSession
    guests_of = [
        (firsts[b], used[i - 1], int(i == 0)) for i, b in enumerate(used)
    ] or [(NULL_ID, 0, 1)]
    before = spark.createDataFrame(guests_of, "_key long, _to int, _lap int")
    # joined before anything is computed, so only guests are computed again
    guests = (
        docs.withColumn("_key", key)
        .join(F.broadcast(before), "_key")
        .select("_key", *carried, F.col("_to").alias("_bucket"), (F.col("_lap") + 1).alias("_lap"))
    )
    both = rows.withColumn("_lap", F.lit(0)).unionByName(guests)
    ahead = Window.partitionBy("_bucket").orderBy("_lap", "_key", "_hash")
    seen = both.select("*", *[F.lead(c).over(ahead).alias(n) for n, c in next_of.items()])
    return seen.filter("_lap = 0").drop("_lap", "_bucket", "_key")


def fingerprint_documents(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    fraction: float = FRACTION,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's start.

    In the edited text the last half (rounded down) of the code points is replaced
    by as many, or all, from the start of the next document by id; after the last
    comes the first. Returns the id, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, and the likeness of the fingerprint to
    the edited text's (``near_edited``) and the next document's (``near_next``):
    shared hashes over all hashes. ``contained_edited`` and ``contained_next`` are
    the shares of the fingerprint found there.

    A null text is empty; an empty text has an empty fingerprint, and two of these
    are alike. Repeated rows follow one another. A single row is its own next.
    Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    carry = {
        "_id": F.col(id_col),
        "_text": text,
        "_hash": F.xxhash64(text),
        "_sketch": sketch(text, words, fraction),
    }
    rows = with_next(
        docs.select(id_col, text_col), carry, {"_next_text": "_text", "_next_sketch": "_sketch"}, id_col
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("_text").cast("long"))
    rows = rows.withColumn(
        "_edited",
        F.concat(
            F.substring("_text", F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring("_next_text", F.lit(1), half),
        ),
    )
    rows = rows.withColumn("_edited_sketch", sketch(F.col("_edited"), words, fraction))
    own = F.col("_sketch")
    return rows.select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(own, F.col("_edited_sketch")).alias("near_edited"),
        resemblance(own, F.col("_next_sketch")).alias("near_next"),
        containment(own, F.col("_edited_sketch")).alias("contained_edited"),
        containment(own, F.col("_next_sketch")).alias("contained_next"),
    )
