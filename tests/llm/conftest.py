"""Tables with everything that may go wrong."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, node bigint, `key` string, `row` int, `value` string, spans int, kept string, n_tokens string"
LONG = "alpha beta gamma delta. " * 3000


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, and extra columns with names of all kinds."""
    texts = [(1, "one two three four five six seven."), (2, "one two three four five six seven."), (2, "one two three four five six seven."), (3, None), (4, ""), (None, "lost id"), (None, None), (5, LONG), (6, LONG), (7, "\n\t  "), (8, "naïve façade — 日本語 ✓ \u0000 x"), (9, "AKIA" + "Z" * 16 + " password = hunter2hunter2")]
    rows = [(i, t, None if k % 3 else "en", None, None if k % 2 else k, None, k, None, k, "v", None, "x", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
