import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron", "pi", "rho", "sigma", "tau", "upsilon"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.4) for _ in range(n))


def corpus():
    """Exact and near copies, repeated rows, null, empty, blank and long texts, ties in every column."""
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([3, 8, 40, 90, 200])) for _ in range(60)]
    for k in range(12):  # near copies of a common text
        w = texts[5 + k % 3].split() + prose(random.Random(k % 3), 60).split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [texts[0], texts[0].upper(), texts[1], None, "", " \t\n ", "one", "one", "ONE", "a b c d", "ñandú ÑANDÚ é 中文 ▁ x", "x" * 3000, prose(rng, 20_000)]
    rows = [(k, t, ["en", "fr", None][k % 3], f"src{k % 4}", len(t) if t else None) for k, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, "text without an id", None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
