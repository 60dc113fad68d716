import random
from collections import defaultdict

import numpy as np

from millrace import sizing
from millrace.llm import suffixes
from tests.llm.conftest import ODD, words


def brute(rows):
    w = [suffixes.WORD.findall((t or "").lower()) for _, t in rows]
    where = defaultdict(set)
    for n, x in enumerate(w):
        for k in range(len(x) - 49):
            where[tuple(x[k : k + 50])].add(n)
    out = []
    for n, x in enumerate(w):
        hit = set()
        for k in range(len(x) - 49):
            if len(where[tuple(x[k : k + 50])]) > 1:
                hit |= set(range(k + 1, k + 51))
        spans = []
        for p in sorted(hit):
            if spans and spans[-1][1] == p - 1:
                spans[-1][1] = p
            else:
                spans.append([p, p])
        out.append((str(rows[n][0]), len(x), len(hit), spans))
    return sorted(out)


def result(df):
    got = suffixes.repeated_passages(df).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_repeated"], [[s["start"], s["last"]] for s in r["spans"]]) for r in got)


def test_odd(odd, none):
    rows = [(i, t) for i, t in ODD]
    assert result(odd) == brute(rows)
    assert suffixes.repeated_passages(none).count() == 0


def test_planted(spark, documents):
    passage, other = words(70, 50), words(71, 140)
    rows = [(1, passage), (2, words(72, 30) + " " + passage + " " + words(73, 20)), (3, other + " " + passage), (4, other)]
    rows += [(5, words(74, 10) + " " + " ".join(other.split()[:49])), (6, " ".join((other + " " + words(75, 5) + " " + passage).split()[20:]))]
    rows += [(100 + k, passage + " " + words(200 + k, k)) for k in range(40)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert result(documents) == brute(rows)


def shared_tails(seed):
    """Per group two texts with a passage and many that share only its tail, sometimes with repeats inside a text."""
    rng, rows = random.Random(seed), []
    for group in range(16):
        n = rng.choice([50, 55, 60, 80])
        passage = words(seed * 1000 + group, n).split()
        tail = passage[-rng.choice([16, 34, 45, 49]) :]
        seeds = iter(range(seed * 100_000 + group * 1000, 10**9))

        def around(middle, seeds=seeds):
            return " ".join([*words(next(seeds), 40).split(), *middle, *words(next(seeds), rng.randint(0, 60)).split()])

        some = [around(passage), around(passage)] + [around(tail) for _ in range(30)]
        if group % 4 == 0:
            some += [around(passage + ["x"] + passage), around(tail + ["y"] + tail + ["z"] + passage)]
        rows += some
    return [(n, text) for n, text in enumerate(rows)]


def test_shared_tails(spark):
    rows = shared_tails(1)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_many_sorted_parts(spark, monkeypatch):
    rows = shared_tails(2)
    common = words(900, 70)
    rows += [(10_000 + k, words(5000 + k, 3) + " " + common + " " + words(6000 + k % 3, 60)) for k in range(60)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(sizing, "is_small", lambda *a: False)
    try:
        assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_window_hashes_are_those_of_the_words():
    text = np.random.default_rng(5).integers(0, 3, 200).astype(">u4")
    seen = {}
    for p in range(60, 140):
        row = suffixes.window_hashes([text[p - 34 : p][::-1].tobytes()], [text[p : p + 50].tobytes()])[0]
        assert len(row) == 35
        for k, h in enumerate(row.tolist()):
            assert seen.setdefault(text[p - 34 + k :][:50].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
