import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n long, group string, __id string, size long, words string"


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, with columns that clash with inner names."""

    def make(rows):
        full = []
        for r in rows:
            r = tuple(r) + (None,) * (4 - len(r))
            full.append((*r[:4], None if r[1] is None else len(r[1]), 7, "g", "x", 1, "w"))
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


@pytest.fixture()
def prose():
    """Seeded word salad."""

    def make(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return make



@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
