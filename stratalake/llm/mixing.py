"""Mixing sources to target weights by raking (operator 3), DataFrame functions only.

Token weights are raked to target shares of several columns at once: iterative
proportional fitting scales the cells of the contingency table to each column's
targets in turn until all hold. The factor of a cell over the largest factor is
the probability with which a document of the cell is sampled, so the sample has
the target shares in expectation and no document counts more than once. A wished
sample size scales the factors instead, up to a probability of one.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import settled
from stratalake.operators.sizing import broadcast_within, measured_bytes

# How far the shares of each column are evened out: 1 keeps them, 0 makes them equal.
POWERS = {"source": 0.85, "lang": 0.9, "topic": 0.95}
ROUNDS = 12
ROUNDS_A_JOB = 4
# Targets that the cells cannot meet together leave a distance above this.
TOLERANCE = 1e-3
POINTS = 32  # scales tried at once for a wished sample size
SALT = "mix"

# What a text is made of, by the share of some characters; a stand-in where no
# topic column is given.
DIGITS = "0123456789"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def token_count(text: Column) -> Column:
    """Runs of characters that are not ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x09-\x0D\x20]+")).cast("long")


def topic_of(text: Column) -> Column:
    """``figures``, ``marked``, ``lines``, ``brief`` or ``prose``, from the whole text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)

    def share(some: str) -> Column:
        return (chars - F.length(F.translate(text, some, ""))) * 100

    return (
        F.when(chars < 200, "brief")
        .when(share(DIGITS) >= chars * 2, "figures")
        .when(share(MARKS) >= chars * 8, "marked")
        .when(share("\n") * 2 >= chars, "lines")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, name: str, power: float) -> DataFrame:
    """Targets (value, target): each value's share of tokens to ``power``."""
    return cells.groupBy(F.col(name).alias("value")).agg(
        F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("target")
    )


def _goals(cells: DataFrame, name: str, target: DataFrame, total: int) -> DataFrame:
    """(_value, _goal): tokens that each value is to have; they sum to the total.

    A value without a target keeps its tokens, the others share the rest.
    """
    sums = cells.groupBy(F.col(name).alias("_value")).agg(F.sum("tokens").alias("_sum"))
    told = sums.join(target, F.col("_value").eqNullSafe(F.col("value")), "left").select(
        "_value", "_sum", F.when(F.col("target") >= 0, F.col("target")).alias("_target")
    )
    given, kept = told.agg(
        F.sum("_target"), F.sum(F.when(F.col("_target").isNull(), F.col("_sum")))
    ).first()
    if not given:
        return told.select("_value", F.col("_sum").cast("double").alias("_goal"))
    rest = float(total - (kept or 0))
    goal = F.coalesce(F.col("_target") / float(given) * rest, F.col("_sum").cast("double"))
    return settled(told.select("_value", goal.alias("_goal")))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with column ``weight``: tokens raked to the targets' shares.

    ``cells`` has a row per combination of the columns that ``targets`` names, and
    ``tokens``. A target table has ``value`` and ``target`` (any scale, one row a
    value); a value without one keeps the tokens it has, a target of zero empties
    it. Nulls are a value like others. A step is a window over the cells of a value;
    cells are counts of documents, so that is far less than the value's documents.
    Some rounds make one job, which ends in a checkpoint. Targets that are not met
    to ``TOLERANCE`` in the end are told by a warning.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    if not total:
        return now
    for name, target in targets.items():
        goal = _goals(cells, name, target, total).withColumnRenamed("_goal", f"_goal_{name}")
        now = now.join(goal, F.col(name).eqNullSafe(F.col("_value"))).drop("_value")
    for i in range(rounds):
        for name in targets:
            there = F.sum("weight").over(Window.partitionBy(name))
            scaled = F.col("weight") * F.col(f"_goal_{name}") / there
            now = now.withColumn("weight", F.when(there > 0, scaled).otherwise(0.0))
        if i % ROUNDS_A_JOB == ROUNDS_A_JOB - 1:
            now = settled(now)
    off = farthest(now, list(targets))
    if off > TOLERANCE:
        warnings.warn(f"shares are up to {off:.2g} of a target away from it", stacklevel=2)
    return now.select(*cells.columns, "weight")


def farthest(raked: DataFrame, names: Sequence[str]) -> float:
    """The largest distance of a value's tokens from its goal, as a share of the goal."""
    most = 0.0
    for name in names:
        sums = raked.groupBy(name).agg(
            F.sum("weight").alias("_sum"), F.first(f"_goal_{name}").alias("_goal")
        )
        away = F.max(F.abs(F.col("_sum") - F.col("_goal")) / F.col("_goal"))
        most = max(most, sums.filter("_goal > 0").agg(away).first()[0] or 0.0)
    return most


def scale_for(raked: DataFrame, share: float) -> float:
    """What to multiply the factors by to keep ``share`` of all tokens in expectation.

    Probabilities end at one, so a cell that gets there stays below its target and
    the others make up for it. Each pass over the cells tries some scales at once.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and no more than 1")
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    total, least = raked.agg(F.sum("tokens"), F.min(F.when(F.col("weight") > 0, factor))).first()
    if not total or not least:
        return 1.0
    low, high = 0.0, 1.0 / least
    for _ in range(8):
        tried = [low + (high - low) * i / POINTS for i in range(1, POINTS + 1)]
        kept = raked.agg(
            *[F.sum(F.col("tokens") * F.least(F.lit(1.0), factor * s)) for s in tried]
        ).first()
        enough = next((i for i, k in enumerate(kept) if (k or 0) >= share * total), POINTS - 1)
        low, high = tried[enough] - (high - low) / POINTS, tried[enough]
    return high


def uniform(id_col: str, salt: str = SALT) -> Column:
    """A number in [0, 1) that depends on the id alone, so a rerun draws the same."""
    text = F.concat_ws(":", F.lit(salt), F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 2**32


def mix(
    docs: DataFrame,
    powers: Mapping[str, float],
    targets: Mapping[str, DataFrame] | None = None,
    topic: Column | None = None,
    tokens: Column | None = None,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float | None = None,
) -> DataFrame:
    """Sampling probability of every document, under raked shares.

    ``powers`` names the columns to rake (``topic`` stands for ``topic``, by default
    :func:`topic_of`) and tempers each one's present shares; a table in ``targets``
    takes the place of a power. ``tokens`` is the token count, by default that of the
    text; where both are given, the text isn't needed. Returns all columns of ``docs`` in struct ``_row``,
    ``_cell`` (the raked columns), ``tokens``, ``weight`` (a document's tokens after
    raking), ``probability`` and ``selected``. Without ``share`` the probabilities are
    relative to the largest factor, which a cell of a few documents may set; with it
    that share of all tokens is kept in expectation (:func:`scale_for`).

    The table of cells is gathered by aggregates; it is broadcast if measured to be
    small, else joined by shuffle, where skewed cells are split. A null text has no
    tokens. A null in a raked column is a value like others. Documents in a cell
    without tokens are selected. Rows that repeat an id share its draw.
    """
    topic = topic_of(F.col(text_col)) if topic is None else topic
    dims = list(powers)
    # under names of their own, so no column of the input can clash
    of = {d: topic if d == "topic" else F.col(d) for d in dims}
    told = docs.select(
        F.struct("*").alias("_row"),
        F.struct(*[of[d].alias(d) for d in dims]).alias("_cell"),
        (token_count(F.col(text_col)) if tokens is None else tokens).alias("tokens"),
        uniform(id_col).alias("_draw"),
    )
    cells = settled(
        told.groupBy(*[F.col("_cell")[d].alias(d) for d in dims]).agg(
            F.sum("tokens").alias("tokens")
        )
    )
    goals = {
        d: (targets or {}).get(d) or tempered(cells, d, power) for d, power in powers.items()
    }
    raked = rake(cells, goals, rounds)
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    if share is None:
        most = raked.agg(F.max(factor)).first()[0] or 1.0
    else:
        most = 1.0 / scale_for(raked, share)
    table = raked.select(*[F.col(d).alias(f"_{d}") for d in dims], factor.alias("_factor"))
    table = broadcast_within(table, measured_bytes(table))
    same = reduce(
        Column.__and__, [F.col("_cell")[d].eqNullSafe(F.col(f"_{d}")) for d in dims]
    )
    chance = F.least(F.lit(1.0), F.coalesce(F.col("_factor") / float(most), F.lit(1.0)))
    return told.join(table, same).select(
        "_row",
        "_cell",
        "tokens",
        (F.col("tokens") * F.coalesce("_factor", F.lit(0.0))).alias("weight"),
        chance.alias("probability"),
        (F.col("_draw") < chance).alias("selected"),
    )


def sample_mix(docs: DataFrame, powers: Mapping[str, float], **more) -> DataFrame:
    """The selected rows of ``docs``, with its columns."""
    return mix(docs, powers, **more).filter("selected").select("_row.*")


def sample_columns(mixed: DataFrame, dims: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """The figures of :func:`mix` without the documents."""
    return mixed.select(
        F.col("_row")[id_col].alias(id_col),
        *[F.col("_cell")[d].alias(d) for d in dims],
        "tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 9).alias("probability"),
        "selected",
    )
