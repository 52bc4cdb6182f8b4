import numpy as np
import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def docs(spark):
    """Small documents with nulls, empty and long texts, repeated rows, odd characters, and columns whose names clash with the operators' own."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, rng.integers(1, 60))) for _ in range(60)]
    texts += [None, "", "   ", "\n\n", "a", "it's we'll I'VE 12 34.5 !? été 中文 \U0001f600 ͸", texts[0], texts[0], texts[1] + " x", "mail a.b@c.de or 1.2.3.4 or 4111 1111 1111 1111 or +49 30 1234567", " ".join(rng.choice(WORDS, 30_000)), "q" * 5000]
    rows = [(i, t, "en" if i % 2 else None, i, "block") for i, t in enumerate(texts)] + [(5, texts[5], "en", 1, "x"), (None, "no id here", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, fp string")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
