import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, crc string, start string, size string"


def make_documents(spark, rows):
    """Documents from (doc_id, text[, source]), with columns whose names the operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture
def documents(spark):
    return lambda rows: make_documents(spark, rows)


@pytest.fixture
def prose():
    """A function that makes texts of so many words from a small vocabulary."""

    def make(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))

    return make
