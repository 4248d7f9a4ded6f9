import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture
def table(spark):
    """Documents from ``(doc_id, text)`` pairs, with extra columns whose names clash with results."""

    def make(*rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, score string, uid string, n_lines string"
        return spark.createDataFrame([(i, x, "en", "s0", len(x or ""), 7, "own", "own", "own") for i, x in rows], schema)

    return make


@pytest.fixture
def prose():
    def make(seed, n):
        rng = random.Random(seed)
        return [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]

    return make


@pytest.fixture
def by_id():
    """Rows of a DataFrame as dicts, by ``doc_id``."""
    return lambda df: {r["doc_id"]: r.asDict() for r in df.collect()}
