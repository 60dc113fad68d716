import math

import numpy as np
import pytest

from millrace.llm import neighbours
from millrace.llm.queries import op13_near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, digest string, class long, n int"


def brute(rows, threshold=0.93):
    """(id, links, component) of each row, by all pairs."""

    def fit(v):
        return v is not None and len(v) and None not in v and all(map(math.isfinite, v)) and any(v)

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if fit(v) else None for _, v, _ in rows]
    links = [set() for _ in rows]
    for a, (_, _, x) in enumerate(rows):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and x is not None and x == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a, row in enumerate(rows):
        reached, todo = {a}, [a]
        while todo:
            more = links[todo.pop()] - reached
            reached |= more
            todo.extend(more)
        ids = [rows[k][0] for k in reached if rows[k][0] is not None]
        out.append((row[0], len(links[a]), min(ids, default=None)))
    return sorted(out, key=str)


def near(rng, x, cosine):
    z = rng.normal(size=len(x))
    z -= z @ x / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def planted(size=64, groups=60, seed=1):
    """Groups around a centre with cosines from below to above the threshold, chains, copies and scaled copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        x = rng.normal(size=size)
        rows.append(x)
        for cosine in rng.choice([0.7, 0.9, 0.925, 0.931, 0.94, 0.97, 0.999], 4):
            x = near(rng, x, cosine)
            rows.append(x * rng.uniform(0.1, 10))
        rows += [rows[-1]] * (g % 3)
        rows.append(rows[-1] * 2)
    return [(7 * k % 10_007, [float(c) for c in x], int(rng.integers(0, 2))) for k, x in enumerate(rows)]


def result(spark, rows):
    df = spark.createDataFrame([(*r, "d", 1, 2) for r in rows], SCHEMA)
    got = neighbours.near_vectors(df).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)


@pytest.mark.parametrize("size", [64, 24])
def test_equals_brute_force(spark, size):
    rows = planted(size)
    assert result(spark, rows) == brute(rows)


def test_large_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(3)
    x = rng.normal(size=64)
    rows = [(k, [float(c) for c in near(rng, x, 0.98)], 1) for k in range(200)] + planted(groups=10)
    assert result(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    x, y = [1.0] * 8, [1.0] * 7 + [0.9]
    rows = [
        (1, x, 1), (2, y, 1), (3, y, 2), (4, x, None), (5, y, None), (6, None, 1), (7, [], 1), (8, [0.0] * 8, 1), (9, [None, *x[1:]], 1),
        (10, [math.nan, *x[1:]], 1), (11, [math.inf, *x[1:]], 1), (12, x + x, 1), (13, [1e-30] * 8, 1), (14, [1e30] * 8, 1), (15, [-1.0] * 8, 1),
        (None, x, 3), (None, y, 3), (16, x, 4), (16, x, 4), (16, y, 4), (17, [3.0], 1), (18, [2.0], 1), (None, [0.0], 1), (None, None, None),
    ]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert neighbours.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = op13_near_vectors(spark, small).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == brute(rows)


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(neighbours.hadamard(neighbours.hadamard(x)), x)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 64))
    y = np.stack([near(rng, v, 0.93) for v in x])
    axes = neighbours.axes_for(100_000, 64)
    tables = neighbours.tables_for(axes, 64, 0.93)
    a, b = (neighbours.buckets(neighbours._unit(v), axes, tables) for v in (x, y))
    assert neighbours.meeting(a, b).any(1).mean() >= 0.999
