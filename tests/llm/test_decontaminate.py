import re

from pyspark.sql import functions as F

from millrace.llm import decontaminate as dec

WORD = re.compile(dec.WORD)


def split(text):
    return WORD.findall((text or "").translate(str.maketrans(dec.UPPER, dec.LOWER)))


def brute(texts, items):
    out = []
    for i, t in texts:
        w, hit, names = split(t), set(), set()
        for name, item in items:
            x = split(item)
            n = min(10, len(x))
            grams = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    names.add(str(name))
        out.append((str(i), len(w), len(hit), sorted(names)))
    return sorted(out)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then some"), (2, "Tiny item"), (3, None), (4, "--"), (10, "tiny ITEM")]


def cases():
    long = "pad " * 20_000 + ITEMS[0][1] + " end" * 20
    return [
        (1, ITEMS[0][1].upper()), (2, "a tiny item, tiny item"), (3, None), (4, ""), (5, "quick brown fox"), (6, long), (6, long),
        (None, "so: the quick brown fox jumps over the lazy dog and then, some... more"), (7, "é tiny\nitem é"),
    ]


def test_against_brute_force(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in cases()], "doc_id long, text string, size int, hash string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for small in (True, False):
        monkeypatch.setattr(dec, "is_small", lambda df, small=small: small)
        got = dec.contamination(docs, items).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["item_ids"])) for r in got) == brute(cases(), ITEMS)


def test_cut(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in cases()], "doc_id long, text string, size int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dec.without_hits(docs, dec.contamination(docs, items)).collect()
    got = {r["doc_id"]: r["text"] for r in kept}
    assert 1 not in got
    assert len(kept) == len(cases()) - 1
    assert got[2] == "a " and got[3] is None and got[5] == "quick brown fox" and got[7] == "é  é"
    assert got[None] == "so: ... more"
    assert split(got[6]) == ["pad"] * 20_000 + ["end"] * 20


def test_empty(spark, none, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.contamination(none, items).count() == 0
    clean = dec.contamination(documents, items.limit(0))
    assert clean.filter("n_hit > 0").count() == 0 and clean.count() == documents.count()


def test_plan(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = dec.contamination(documents, items)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [hash" in plan and "Python" not in plan and "Cartesian" not in plan


def test_ranges(spark):
    kind = "array<struct<start:int,last:int>>"
    row = spark.createDataFrame([([(5, 9), (1, 3), (4, 4), (8, 12), (20, 21)],), ([],)], f"r {kind}")
    got = [[tuple(x) for x in r["m"]] for r in row.select(dec.merge_ranges(F.col("r")).alias("m")).collect()]
    assert got == [[(1, 12), (20, 21)], []]
