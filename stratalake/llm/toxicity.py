"""Toxicity by non-negative positive-unlabelled learning (operator 9).

Classifiers learn from confirmed toxic texts and from texts of unknown class.
With class prior p, loss l and decision f, the risk of a classifier is
    p E_pos[l(f, +1)] + max(0, E_unl[l(f, -1)] - p E_pos[l(f, -1)]).
The second term estimates the risk on clean texts; where it falls below zero the
model has begun to memorise positives, and the step goes the other way.

Spark draws the training sample, spreads it over a few groups and trains a numpy
classifier in each; only their word weights come back. Scoring is one pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, list_texts, settled

WORDS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)
MOST_WORDS = 3  # of one beginning, told apart
CUT = 0.3

# Bounds of the training sample: rows in expectation, over the whole table alike.
MOST_POSITIVE = 4000
MOST_UNLABELLED = 16000
MODELS = 2
FEATURES = 1024
LEAST_DOCUMENTS = 3
PURITY = 0.35
CHANCE = float(np.log(1e6))


def features(text: str) -> set[str]:
    """The words of a text in lower case, and the beginnings of its words.

    ``begi-2`` says that at least two different words begin so.
    """
    words = set(WORDS.findall(text.lower()))
    found = set(words)
    for n in STEMS:
        times = Counter([w[:n] for w in words if len(w) > n])
        for k in range(1, MOST_WORDS + 1):
            found.update([f"{stem}-{k}" for stem, c in times.items() if c >= k])
    return found


def nnpu_fit(
    pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05,
    decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model under the non-negative risk (Adam)."""
    w = np.zeros(pos.shape[1])
    b = float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        on_pos = 1 / (1 + np.exp(-(pos @ w + b)))
        on_unl = 1 / (1 + np.exp(-(unl @ w + b)))
        # log loss: l(f,+1) = -log s, l(f,-1) = -log(1 - s), with gradients s - 1 and s
        clean = -np.log1p(-np.minimum(on_unl, 1 - 1e-12)).mean() + prior * np.log1p(
            -np.minimum(on_pos, 1 - 1e-12)
        ).mean()
        g_unl, g_pos = on_unl / len(unl), -prior * on_pos / len(pos)
        if clean < 0:
            slope = [-(unl.T @ g_unl + pos.T @ g_pos), -(g_unl.sum() + g_pos.sum())]
        else:
            g_pos = g_pos + prior * (on_pos - 1) / len(pos)
            slope = [unl.T @ g_unl + pos.T @ g_pos, g_unl.sum() + g_pos.sum()]
        slope = np.append(slope[0] + decay * w, slope[1])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def choose_features(
    in_pos: np.ndarray, in_unl: np.ndarray, n_pos: int, n_unl: int, prior: float, most: int
) -> np.ndarray:
    """Features that mark positive texts: telling, and not so by chance.

    From the number of texts of either kind with each feature. By Bayes' rule
    ``prior * share in positives / share in all`` estimates how many texts with the
    feature are positive. Chance is bounded by the Chernoff bound on the number of
    positives with it, against the number of features looked at.
    """
    rate = np.minimum((in_unl + 0.5) / (n_unl + 1), 0.999)
    share = in_pos / n_pos
    told = (in_pos >= LEAST_DOCUMENTS) & (prior * share >= PURITY * rate)
    some = np.flatnonzero(told)
    share, rate = share[some], rate[some]
    rest = np.where(share < 1, (1 - share) * np.log(np.maximum(1 - share, 1e-12) / (1 - rate)), 0)
    bound = share * np.log(share / rate) + rest
    sure = n_pos * bound >= CHANCE
    some, bound = some[sure], bound[sure]
    return some[np.lexsort((some, -bound))][:most]


def fit_group(table: pa.Table, prior: float, most: int = FEATURES) -> dict:
    """One classifier from rows (_order, positive, features).

    Features are coded as numbers at once; no row's words become Python objects.
    """
    table = table.sort_by("_order")
    positive = np.asarray(table["positive"].to_numpy(zero_copy_only=False), bool)
    lists = table["features"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    coded = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    code = coded.indices.to_numpy()
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    nothing = {"names": [], "weights": [], "bias": float(np.log(prior / (1 - prior)))}
    if not n_pos or not n_unl or not len(code):
        return nothing
    of_pos = positive[owner]
    words = len(coded.dictionary)
    chosen = choose_features(
        np.bincount(code[of_pos], minlength=words),
        np.bincount(code[~of_pos], minlength=words),
        n_pos, n_unl, prior, most,
    )
    if not len(chosen):
        return nothing
    place = np.full(words, -1)
    place[chosen] = np.arange(len(chosen))
    used = place[code] >= 0
    x = np.zeros((len(lists), len(chosen)), np.float32)
    x[owner[used], place[code[used]]] = 1
    # labels may be drawn with a preference for toxic texts; how much more often
    # positives than all texts bear a chosen feature bounds the prior as well
    marked = x.any(axis=1)
    seen = (marked[~positive].sum() + 0.5) / (n_unl + 1) / max(marked[positive].mean(), 1e-9)
    prior = float(np.clip(min(prior, seen), 1e-4, 0.5))
    w, b = nnpu_fit(x[positive], x[~positive], prior)
    names = coded.dictionary.take(pa.array(chosen)).to_pylist()
    return {"names": names, "weights": w.tolist(), "bias": b}


@dataclass
class ToxicityModel:
    """Mean of the classifiers' decisions as one table of feature weights."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scores(self, texts: list[str]) -> np.ndarray:
        known = self.weights
        words = {k for k in known if "-" not in k}
        stems = {n: {k[:n] for k in known if "-" in k and k.index("-") == n} for n in STEMS}
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found = set(WORDS.findall(text.lower()))
            hits = list(found & words)
            for n, some in stems.items():
                times = Counter([w[:n] for w in found if w[:n] in some and len(w) > n])
                hits += [f"{stem}-{k}" for stem, c in times.items() for k in range(1, min(c, MOST_WORDS) + 1)]
            out[i] = self.bias + sum(known.get(h, 0.0) for h in sorted(hits))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _share(mark: str, most: int, there: int) -> Column:
    """True for about ``most`` of ``there`` texts, by a hash of their mark."""
    part = min(1.0, most / max(there, 1))
    return F.pmod(F.xxhash64(mark, F.lit("sample")), F.lit(1 << 30)) < int(part * (1 << 30))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    models: int = MODELS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Train on labelled rows outside the held-out fold.

    The sample has about ``most_positive`` toxic and ``most_unlabelled`` other
    texts in expectation; every model takes all of the former and a share of the
    latter, whose labels it doesn't see. The class prior is the share of toxic
    texts among all labelled ones, or if that is less, what the unlabelled texts
    show of the features that mark positives. An id with several labels is toxic if one of
    them is; null labels and ids are passed over. Without toxic rows the model
    scores every text alike.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(~held_out(id_col))
        .groupBy(id_col)
        .agg(F.max(label_col).alias("_toxic"))
    )
    texts = docs.filter(~held_out(id_col)).select(
        F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")
    ).withColumn("_order", F.xxhash64("_text"))
    # copies of a text count once, in the prior as in the sample
    told = settled(
        texts.select("_id", "_order")
        .join(known, F.col("_id") == F.col(id_col))
        .groupBy("_order")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    n_all, n_toxic = told.agg(F.count("*"), F.sum((F.col("_toxic") > 0).cast("long"))).first()
    prior = float(np.clip(((n_toxic or 0) + 0.5) / (n_all + 1), 1e-4, 0.5))
    if not n_toxic:
        return ToxicityModel(float(np.log(prior / (1 - prior))))
    # bounded: about most_positive rows
    chosen = F.broadcast(
        told.filter("_toxic > 0").filter(_share("_order", most_positive, n_toxic))
        .select("_order", F.lit(True).alias("_chosen"))
    )
    there = texts.agg(F.approx_count_distinct("_order")).first()[0]
    sample = (
        texts.join(chosen, "_order", "left")
        .withColumn("_unl", _share("_order", most_unlabelled, there))
        .filter("_chosen or _unl")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in list_texts(batch.column("_text")):
                kept = [batch.column(n).slice(start, len(some)) for n in ("_order", "_chosen", "_unl")]
                found = pa.array([sorted(features(t)) for t in some], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*kept, found], ["_order", "_chosen", "_unl", "features"]
                )

    found = sample.select(
        "_order", F.coalesce("_chosen", F.lit(False)).alias("_chosen"), "_unl", "_text"
    ).mapInArrow(extract, "_order long, _chosen boolean, _unl boolean, features array<string>")
    found = found.groupBy("_order").agg(
        F.max("_chosen").alias("_chosen"),
        F.max("_unl").alias("_unl"),
        F.first("features").alias("features"),
    )
    # a positive text goes to every model; an unlabelled one, whatever its class, to one
    uses = F.concat(
        F.when(
            F.col("_chosen"),
            F.transform(
                F.sequence(F.lit(0), F.lit(models - 1)),
                lambda m: F.struct(m.alias("model"), F.lit(True).alias("positive")),
            ),
        ).otherwise(F.array().cast("array<struct<model:int,positive:boolean>>")),
        F.when(
            F.col("_unl"),
            F.array(
                F.struct(
                    F.pmod("_order", F.lit(models)).cast("int").alias("model"),
                    F.lit(False).alias("positive"),
                )
            ),
        ).otherwise(F.array().cast("array<struct<model:int,positive:boolean>>")),
    )
    rows = found.select("_order", "features", F.explode(uses).alias("_use")).select(
        "_order", "features", "_use.model", "_use.positive"
    )

    made_of = pa.schema(
        [("names", pa.list_(pa.string())), ("weights", pa.list_(pa.float64())), ("bias", pa.float64())]
    )

    def train(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([fit_group(table, prior)], made_of)

    fitted = rows.groupBy("model").applyInArrow(
        train, "names array<string>, weights array<double>, bias double"
    )
    made = sorted(fitted.collect(), key=lambda r: r["bias"])  # one row per model
    if not made:
        return ToxicityModel(float(np.log(prior / (1 - prior))))
    total: dict[str, float] = {}
    for row in made:
        for name, weight in zip(row["names"], row["weights"], strict=True):
            total[name] = total.get(name, 0.0) + weight / len(made)
    return ToxicityModel(float(np.mean([r["bias"] for r in made])), total)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score of every row: the id, ``held_out``, ``score`` (0 to 1), ``predicted``.

    One pass over whole texts. A null text is empty and gets the score of a text
    without known words. Repeated rows and null ids come out as they went in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in list_texts(batch.column("_text")):
                kept = [batch.column(n).slice(start, len(texts)) for n in (id_col, "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(model.scores(texts))], [id_col, "held_out", "score"]
                )

    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, held_out boolean, score double"
    scored = docs.select(
        id_col, held_out(id_col).alias("held_out"), F.col(text_col).alias("_text")
    ).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            keep = [model.scores(some) < CUT for _, some in list_texts(texts)]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
