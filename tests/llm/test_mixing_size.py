"""Mixing to a wished sample size, and targets that cannot all be met."""

import warnings

import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing

SCHEMA = "doc_id long, source string, lang string, n long, text string"
POWERS = {"source": 0.5, "lang": 0.9}


def _docs(spark):
    rows = [(i, f"s{min(i % 7, 3)}", "en" if i % 5 else "de", 5 + i % 11, "") for i in range(400)]
    rows += [(500, "tiny", "de", 1, ""), (501, "tiny", None, 0, None), (None, None, "en", 9, "")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("share", [0.05, 0.5, 0.9, 1.0])
def test_a_share_of_the_tokens_is_kept(spark, share):
    got = mixing.mix(_docs(spark), POWERS, tokens=F.col("n"), share=share).collect()
    total = sum(r["tokens"] for r in got)
    assert sum(r["tokens"] * r["probability"] for r in got) == pytest.approx(share * total, rel=1e-6)
    assert all(0 < r["probability"] <= 1 for r in got)
    # below one, the probabilities of cells are as their factors
    some = {r["weight"] / r["tokens"] / r["probability"] for r in got if r["tokens"] and r["probability"] < 1}
    assert not some or max(some) == pytest.approx(min(some))


def test_a_tiny_cell_sets_the_size_only_without_a_share(spark):
    kept = {
        share: sum(
            r["tokens"] * r["probability"]
            for r in mixing.mix(_docs(spark), POWERS, tokens=F.col("n"), share=share).collect()
        )
        for share in (None, 0.6)
    }
    assert kept[None] < kept[0.6] / 2
    with pytest.raises(ValueError):
        mixing.mix(_docs(spark), POWERS, tokens=F.col("n"), share=0.0)
    assert mixing.mix(_docs(spark).limit(0), POWERS, share=0.5).count() == 0


def test_targets_that_contradict_are_told(spark):
    cells = spark.createDataFrame(
        [("a", "x", 10), ("b", "y", 10)], "source string, lang string, tokens long"
    )

    def targets(y):
        return {
            "source": spark.createDataFrame([("a", 1.0), ("b", 1.0)], "value string, target double"),
            "lang": spark.createDataFrame([("x", 1.0), ("y", y)], "value string, target double"),
        }

    with pytest.warns(UserWarning, match="away"):
        mixing.rake(cells, targets(3.0))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert mixing.rake(cells, targets(1.0)).count() == 2
