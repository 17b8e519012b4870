"""The toxicity sample is as large as it was before memory was short."""

from stratalake.llm import toxicity


def test_bounds_of_the_sample():
    assert (toxicity.MOST_POSITIVE, toxicity.MOST_UNLABELLED) == (4000, 16000)
