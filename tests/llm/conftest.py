import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, t string, id string, h int, spans string, row string"


@pytest.fixture
def documents(spark):
    """Frames like the documents table, with extra columns whose names the operators use themselves."""

    def make(rows):
        rows = [(i, t, l, "s", None if t is None else len(t), "x", "y", 1, "z", "r") for i, t, l in rows]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def words():
    """Invented prose: ``words(n, seed)``."""
    import random

    def make(n, seed=0):
        pick = random.Random(seed)
        return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 8))) for _ in range(n))

    return make
