import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """Rows of texts (or whole rows) as a documents table."""

    def make(rows, extra=""):
        full = [r if isinstance(r, tuple) else (i, r, "en", "s", 0) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, DOCS + extra)

    return make


@pytest.fixture
def sentence():
    """Invented words, the same for the same seed."""

    def make(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(n))

    return make
