import random
from collections import defaultdict

import numpy as np

from millrace.llm import jaccard
from millrace.llm.components import components
from tests.llm.conftest import words


def brute(rows):
    sets = [frozenset(jaccard.shingles(t).tolist()) for _, t in rows]
    kinds = [s for s in dict.fromkeys(sets) if s]
    parent = {s: s for s in kinds}

    def top(s):
        while parent[s] != s:
            s = parent[s]
        return s

    links = defaultdict(int)
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if len(a & b) >= 0.8 * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[top(s)] = min(least.get(top(s), i), i)
    return sorted(
        (str(i), str(least.get(top(s)) if s else i), links[s], sets.count(s) if s else 1) for (i, _), s in zip(rows, sets, strict=True)
    )


def result(df):
    return sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"], r["n_copies"]) for r in jaccard.jaccard_classes(df).collect())


def test_odd(odd, none):
    from tests.llm.conftest import ODD

    assert result(odd) == brute(ODD)
    assert jaccard.jaccard_classes(none).count() == 0


def test_blocks_and_chains(spark, monkeypatch):
    """A large group of near copies over several blocks, and a chain whose ends are not alike."""
    rng = random.Random(5)
    base = words(50, 150).split()
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = words(rng.randrange(10**6), 1)
        rows.append((i, " ".join(own)))
    chain = words(51, 200).split()
    rows += [(1000 + k, " ".join(chain[12 * k :] + words(60 + k, 12 * k).split())) for k in range(6)]
    rows += [(2000 + k, words(100 + k, 80)) for k in range(30)]
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_one_of_each(odd, none, documents):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "None", "None", "4", "6", "9", "10", "11"])
    assert jaccard.one_of_each(none).count() == 0
    classes = {r["class_id"] for r in jaccard.jaccard_classes(documents).collect()}
    assert {r["doc_id"] for r in jaccard.one_of_each(documents).collect()} == classes


def test_least_matches():
    """The bound holds: below it, similarities of the threshold are as improbable as the tolerance says."""
    least = jaccard.least_matches(216)
    assert list(least) == list(range(24, 217, 24))
    grid = np.linspace(0, 1, 20_001)
    for n, m in least.items():
        for k, below in ((m, False), (m - 1, True)):
            weight = grid**k * (1 - grid) ** (n - k)
            assert (weight[grid >= 0.8].sum() / weight.sum() < jaccard.TOLERANCE) == below


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 200)]
    random.Random(1).shuffle(edges)
    got = {r["a"]: r["place"] for r in components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 200: 200}
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0
