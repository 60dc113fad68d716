import random

import pytest

# Columns whose names operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class string, n_words long, size int, _id long, kept boolean"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))


BASE = words(1, 120)
NEAR = BASE + " " + words(2, 6)
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "one two"), (None, None), (4, "short"), (5, "short"), (5, "short"),
    (6, BASE), (7, BASE), (8, NEAR), (9, words(3, 200)), (10, words(4, 30_000)), (11, "é" * 500 + " \U0001f600 x"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated ids and rows, copies and near copies, and clashing columns."""
    rows = [(i, t, None, "src0", len(t or ""), "c", 7, 3, 1, None) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
