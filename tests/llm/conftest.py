import random

import pytest

SCHEMA = "doc_id long, text string, lang string, n_words string, kept string, bands int"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns whose names operators use, too."""

    def make(pairs, parts=3):
        rows = [(i, t, "en", "x", "y", 1) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)

    return make


@pytest.fixture
def odd_texts():
    """Nulls, empty and blank texts, one long word, odd spaces, a very long text."""
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdeé日", k=r.randint(1, 9))) for _ in range(3000)]
    long = " ".join(r.choices(vocabulary, k=20_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "x" * 5000), (5, "one"),
        (6, "a b \x1f c\x00d"), (7, long), (None, "null id text"), (None, None),
        (8, "tail \U0001f600 end"), (9, "one"), (9, "one"), (9, "another text of nine"),
    ]
