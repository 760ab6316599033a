from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, **extra):
    """Documents 0, 1, ... with the given texts; lang, source and n_chars have nulls."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 1 else f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


EDGE_TEXTS = [None, "", " \n\t ", "one", "one two", "One  TWO", "a b c", "x" * 5000, "é ü ñ é ü ñ", "same words here now", "same words here now", "\n\n", "a b c"]


def near_copies(seed=7, groups=12, words=60):
    """Texts in groups of near copies with one to many word changes, and some exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, words))]
        for k in range(rng.randint(1, 7)):
            text = list(base)
            for _ in range(k):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(" ".join(text))
        out.append(" ".join(base))
    return out


@pytest.fixture()
def docs_of(spark):
    return lambda texts: make_docs(spark, texts)


@pytest.fixture()
def clashing():
    """Adds columns whose names the operators use for themselves."""
    from pyspark.sql import functions as F

    names = "n h1 h2 u v rep weight family block kind component_id key text_sha256 line lines score words pos start hash".split()
    return lambda df: df.withColumns({n: F.lit("clash") for n in names})
