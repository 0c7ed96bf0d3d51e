"""Fixtures of the training-data tests (no conftest: the name would hide the parent one)."""

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples."""
    def docs(rows, extra=None):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        return df.withColumns(extra) if extra else df
    return docs


@pytest.fixture(scope="session")
def words():
    """A deterministic stream of invented words: words(n, seed) -> list."""
    import random

    def take(n, seed, vocabulary=400):
        r = random.Random(seed)
        return [f"w{r.randrange(vocabulary)}x" for _ in range(n)]
    return take
