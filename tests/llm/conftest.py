import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """``prose(n, seed)``: n invented words."""
    parts = ["an", "ter", "lo", "mi", "sha", "ru", "kel", "o", "pa", "zin", "du", "ve"]

    def make(n, seed=0):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def docs(spark):
    """``docs(rows)``: a documents table with clashing and extra columns; rows are (doc_id, text) or (doc_id, text, lang)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, 7, "x", 1) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, row long, digest string, size int")

    return make
