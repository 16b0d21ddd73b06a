import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture
def prose():
    rng = random.Random(5)
    return lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture
def docs(spark):
    """Documents with columns of clashing names besides their own."""

    def make(rows):
        full = [(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string")

    return make
