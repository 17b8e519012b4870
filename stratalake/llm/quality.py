"""Quality by hierarchical empirical Bayes (operator 7).

The document's own evidence is a naive Bayes log likelihood ratio over how its
whole text is built. Where it comes from gives the prior: labels of a path shrink
towards its host's rate, those of a host towards the global rate, and how hard
they shrink is estimated from how much the rates of hosts and paths vary. A site
with few labels thus gets the prior of the level above. All of it is learned by
grouped aggregates over all labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, let, settled

# Traits of a text and where their values are cut into bins.
CUTS: dict[str, tuple[float, ...]] = {
    "upper": (0.004, 0.01, 0.02, 0.035, 0.06, 0.12, 0.3, 0.5),
    "marks": (0.008, 0.015, 0.022, 0.03, 0.045, 0.07, 0.12, 0.2),
    "repeats": (0.01, 0.03, 0.06, 0.12, 0.3, 0.6),
    "distinct": (0.03, 0.08, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65),
    "length": (3.5, 4.2, 4.6, 5.0, 5.4, 5.8, 6.5, 7.5, 9.0, 12.0),
}
KEEP = 0.5


def traits(text: Column) -> Column:
    """Shares of capitals, marks, repeated and distinct words, mean word length.

    A text without words has null traits, which are a bin of their own.
    """

    def told(words: Column) -> Column:
        n = F.size(words)
        chars = F.length(text)
        letters = F.regexp_count(text, F.lit(r"\p{L}"))
        return F.when(
            n > 0,
            F.struct(
                (F.regexp_count(text, F.lit(r"\p{Lu}")) / F.greatest(letters, F.lit(1))).alias("upper"),
                (F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")) / chars).alias("marks"),
                (
                    F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))) / n
                ).alias("repeats"),
                (F.size(F.array_distinct(words)) / n).alias("distinct"),
                ((chars - n + 1) / n).alias("length"),
            ),
        )

    words = F.filter(F.split(text, r"[\x09-\x0D\x20]+"), lambda w: w != "")
    return let(words, told)


def bin_of(value: Column, cuts: tuple[float, ...]) -> Column:
    """How many cuts the value reaches; -1 for null."""
    reached = sum(((value >= c).cast("int") for c in cuts[1:]), (value >= cuts[0]).cast("int"))
    return F.coalesce(reached, F.lit(-1))


@dataclass(frozen=True)
class Evidence:
    """Log likelihood ratio of every bin; bounded by CUTS."""

    ratios: dict[tuple[str, int], float]

    def of(self, bins: Column) -> Column:
        total = F.lit(0.0)
        for name, cuts in CUTS.items():
            table = [self.ratios.get((name, b), 0.0) for b in range(-1, len(cuts) + 1)]
            total = total + F.get(F.array(*map(F.lit, table)), bins[name] + 1)
        return total


def learn_evidence(labelled: DataFrame) -> Evidence:
    """From (bins, good): smoothed shares of each bin among good and bad rows.

    The traits overlap, so the sum of their ratios is taken at half weight.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col("bins")[n].alias("bin")) for n in CUTS])
    counts = (
        labelled.select(F.explode(pairs).alias("p"), "good")
        .groupBy("p.name", "p.bin")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
        .collect()  # a row per bin
    )
    good, bad = {}, {}
    for r in counts:
        good[r["name"]] = good.get(r["name"], 0) + r["good"]
        bad[r["name"]] = bad.get(r["name"], 0) + r["bad"]
    ratios = {}
    for r in counts:
        bins = len(CUTS[r["name"]]) + 2
        in_good = (r["good"] + 0.5) / (good[r["name"]] + 0.5 * bins)
        in_bad = (r["bad"] + 0.5) / (bad[r["name"]] + 0.5 * bins)
        ratios[r["name"], r["bin"]] = 0.5 * math.log(in_good / in_bad)
    return Evidence(ratios)


def prior_strength(groups: DataFrame) -> float:
    """Pseudo-counts of the prior, from (n, k, expected) of each group.

    Moments of the beta-binomial: the weighted spread of the groups' rates around
    the expected ones, less what chance alone gives, is the share of variance
    between groups, and the strength is its inverse odds.
    """
    spread = F.sum(
        F.pow(F.col("k") - F.col("n") * F.col("expected"), 2)
        / F.col("n")
        / (F.col("expected") * (1 - F.col("expected")))
    )
    r = groups.filter("n > 0").agg(
        spread.alias("s"), F.count("*").alias("g"), F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    if not r["g"] or r["g"] < 2:
        return 100.0
    room = r["n"] - r["nn"] / r["n"] - (r["g"] - 1)
    between = (r["s"] - (r["g"] - 1)) / room if room > 0 else 0.0
    between = min(max(between, 1e-4), 0.5)
    return 1 / between - 1


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, float]:
    """(_host, _path, prior) of every path with labels, and the global rate.

    Rates are counted per path and host by aggregates; a host with most labels is
    one row per task before the shuffle.
    """
    paths = settled(
        labelled.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("good").alias("k"))
    )
    n, k = paths.agg(F.sum("n"), F.sum("k")).first()
    rate = ((k or 0) + 0.5) / ((n or 0) + 1)
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    strength = prior_strength(hosts.withColumn("expected", F.lit(rate)))
    of_host = hosts.select(
        F.col("_host").alias("_of"),
        ((F.col("k") + strength * rate) / (F.col("n") + strength)).alias("host_rate"),
    )
    both = settled(paths.join(of_host, F.col("_host").eqNullSafe(F.col("_of"))).drop("_of"))
    own = prior_strength(both.withColumn("expected", F.col("host_rate")))
    prior = (F.col("k") + own * F.col("host_rate")) / (F.col("n") + own)
    return both.select("_host", "_path", "host_rate", prior.alias("path_rate")), rate


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """Probability of good quality for every row.

    Returns the id, ``held_out``, ``evidence`` (log likelihood ratio of the text),
    ``site_prior`` (rate of its path after shrinking), ``score`` and ``keep`` (1 if
    the score is at least 0.5). Labels of the held-out fold are never learned from.

    A null text is empty. Null hosts and paths are values like others; a path
    without labels has its host's rate, a host without labels the global one. An
    id with several labels takes the highest; null labels and ids are passed over.
    Without labels the score is 0.5 for all. Repeated rows come out as they went in.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        host.alias("_host"),
        path.alias("_path"),
        held_out(id_col).alias("held_out"),
        traits(F.coalesce(text_col, F.lit(""))).alias("_traits"),
    )
    bins = F.struct(*[bin_of(F.col("_traits")[n], c).alias(n) for n, c in CUTS.items()])
    # a row per document without its text
    rows = settled(rows.select("_id", "_host", "_path", "held_out", bins.alias("bins")))
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(~held_out(id_col))
        .groupBy(F.col(id_col).alias("_of"))
        .agg((F.max(label_col) > 0).cast("long").alias("good"))
    )
    labelled = settled(
        rows.join(known, F.col("_id") == F.col("_of")).select("_host", "_path", "bins", "good")
    )
    evidence = learn_evidence(labelled)
    sites, rate = site_posteriors(labelled)
    hosts = sites.groupBy(F.col("_host").alias("_h")).agg(F.first("host_rate").alias("_host_rate"))
    paths = sites.select(
        F.col("_host").alias("_ph"), F.col("_path").alias("_pp"), F.col("path_rate")
    )
    placed = rows.join(hosts, F.col("_host").eqNullSafe(F.col("_h")), "left").join(
        paths,
        F.col("_host").eqNullSafe(F.col("_ph")) & F.col("_path").eqNullSafe(F.col("_pp")),
        "left",
    )
    prior = F.coalesce("path_rate", "_host_rate", F.lit(rate))
    told = placed.select(
        F.col("_id").alias(id_col),
        "held_out",
        evidence.of(F.col("bins")).alias("evidence"),
        prior.alias("site_prior"),
    )
    odds = F.col("evidence") + F.log(F.col("site_prior") / (1 - F.col("site_prior")))
    score = 1 / (1 + F.exp(-odds))
    return told.withColumn("score", score).withColumn(
        "keep", (F.col("score") >= KEEP).cast("int")
    )
