import random

import pytest

#: Columns whose names the operators use inside; all inputs carry them.
CLASHING = ("kept", "component_id", "key", "bucket", "mark", "entry", "text_sha256", "node", "part", "score", "x")


@pytest.fixture(scope="session")
def documents(spark):
    """``make(rows)``: a documents table from (doc_id, text) or (doc_id, text, lang), with clashing columns."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 7, *["z"] * len(CLASHING)) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"{c} string" for c in CLASHING)
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """``make(seed, n)``: n words, a few frequent and many rare ones."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else
                        "".join(rng.choice(["er", "in", "th", "on", "ea", "st"]) for _ in range(rng.randrange(2, 5)))
                        for _ in range(n))

    return make


#: Texts that are awkward for every operator.
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "a null id"), (4, "a null id"), (5, "repeated row"), (5, "repeated row"),
       (6, "é́ 日本 😀 ▁ \x00 x" * 3), (7, "12 34 .. !!"), (8, "word " * 30_000), (9, "w" * 50_000)]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
