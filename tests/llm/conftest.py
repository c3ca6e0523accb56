import os
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, f1 string, row int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) or (doc_id, text, source) rows as a documents table, with columns whose
    names operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1)
                for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random prose over a small vocabulary, with its own generator."""

    def write(seed, words, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))

    return write


@pytest.fixture(scope="session")
def sf_dir():
    """The smallest driver tables."""
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path
