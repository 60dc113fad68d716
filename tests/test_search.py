import math
from collections import Counter

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import sizing
from millrace.functions import scoring
from millrace.operators import evaluate, postings, search
from millrace.operators.postings import KeywordIndex
from millrace.session import new_path

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "the", "the", "the"]


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, int(rng.integers(3, 30)))) for _ in range(300)]
    # A third of all chunks are copies of one text, so that many scores are equal.
    return [(f"c{n:04d}", f"d{n // 3}", "alpha the beta beta" if n % 3 == 0 else text) for n, text in enumerate(texts)]


@pytest.fixture(scope="module")
def chunks(spark, corpus):
    return spark.createDataFrame(corpus, "chunk_id string, path string, chunk_to_embed string").repartition(5)


@pytest.fixture(scope="module")
def questions(spark):
    asked = [(1, "alpha beta"), (2, "the theta"), (3, "kappa iota iota"), (4, "unknown words only")]
    return search.question_terms(spark.createDataFrame(asked, "q long, t string"), "q", "t")


@pytest.fixture(scope="module")
def index(chunks):
    return search.build_index(chunks)


def best(scores, k):
    """The k best of {id: score}, by score and then id."""
    kept = [(-round(s, 6), i) for i, s in scores.items() if round(s, 6) > 0]
    return [(i, -s) for s, i in sorted(kept)[:k]]


def answers(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r[1], r.score))
    return out


def bm25_model(corpus, asked, k):
    docs = {i: Counter(t.split()) for i, _, t in corpus}
    size = {i: sum(c.values()) for i, c in docs.items()}
    mean = sum(size.values()) / len(size)
    df = Counter(w for c in docs.values() for w in c)
    scores = {}
    for i, counts in docs.items():
        for w in set(asked.split()):
            if w in counts:
                weight = math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
                part = counts[w] * 2.2 / (counts[w] + 1.2 * (0.25 + 0.75 * size[i] / mean))
                scores[i] = scores.get(i, 0) + weight * part
    return best(scores, k)


@pytest.mark.parametrize("k", [1, 7, 120, 1000])
def test_bm25_follows_the_model(corpus, index, questions, k):
    got = answers(search.bm25_top_k(index.terms, questions, k))
    assert set(got) == {1, 2, 3}
    for q, text in {1: "alpha beta", 2: "the theta", 3: "kappa iota iota"}.items():
        want = bm25_model(corpus, text, k)
        assert [i for i, _ in got[q]] == [i for i, _ in want]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=2e-6)


def test_blocks_and_sparse_sums_give_the_same_answers(index, questions, monkeypatch):
    want = answers(search.bm25_top_k(index.terms, questions, 20))
    monkeypatch.setattr(search, "BLOCK_ENTRIES", 2)
    monkeypatch.setattr(search, "BLOCK_CELLS", 2)
    assert answers(search.bm25_top_k(index.terms, questions, 20)) == want


@pytest.mark.parametrize("dense_keys, cells", [(0, 4_000_000), (0, 8), (8192, 8)])
def test_scorer_paths_agree(dense_keys, cells, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    rows_ = [[{"key": int(k), "weight": float(rng.normal())} for k in rng.choice(50, 6, replace=False)] for _ in range(200)]
    rows_[7] = []
    keys = pa.array(range(0, 40), pa.int32())
    weights = rng.normal(size=(40, 5))
    kind = pa.list_(pa.struct([("key", pa.int32()), ("weight", pa.float64())]))
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(a, a + 50)), pa.array(rows_[a : a + 50], kind)], names=["id", "e"])
        for a in range(0, 200, 50)
    ]
    monkeypatch.setattr(scoring, "DENSE_KEYS", dense_keys)
    monkeypatch.setattr(scoring, "CELLS", cells)
    out = list(scoring.sparse_scorer(keys, weights, pa.array(range(5)), 9, schema)(iter(batches)))[0].to_pylist()
    for q in range(5):
        full = {i: sum(e["weight"] * weights[e["key"], q] for e in r if e["key"] < 40) for i, r in enumerate(rows_)}
        got = sorted(((o["id"], o["score"]) for o in out if o["query_id"] == q), key=lambda p: (-p[1], p[0]))
        assert [i for i, _ in got] == [i for i, _ in best(full, 9)]


def test_vectors_have_unit_length_and_rank_copies_by_id(index, questions):
    lengths = index.vectors.select(F.expr("aggregate(vector, 0D, (s, e) -> s + e.value * e.value)").alias("n"))
    assert lengths.filter("abs(n - 1) > 1e-9").count() == 0
    hits = answers(search.vector_top_k(index.vectors, search.question_vectors(questions, index.weights), 100))
    assert [i for i, _ in hits[1]][:3] == ["c0000", "c0003", "c0006"]
    assert hits[1][0][1] == hits[1][99][1]


def test_vectors_follow_the_model(spark, corpus, chunks, index, monkeypatch):
    """Exact frequencies by term, whether terms are sent to the rows or joined."""
    from hashlib import md5

    docs = {i: Counter(t.split()) for i, _, t in corpus}
    df = Counter(w for c in docs.values() for w in c)
    want = {}
    for i, counts in docs.items():
        sums = Counter()
        for w, n in counts.items():
            a, b = (int(md5(w.encode()).hexdigest()[k : k + 8], 16) for k in (0, 8))
            sums[a % 1024] += (1 if (b >> 28) % 2 == 0 else -1) * n * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
        norm = math.sqrt(sum(v * v for v in sums.values()))
        want[i] = {d: v / norm for d, v in sums.items()}
    for frequent in (65_536, 3, 0):
        monkeypatch.setattr(search, "FREQUENT", frequent)
        weights = index.weights
        assert (len(weights.frequent) == len(df)) if frequent > 100 else (len(weights.frequent) <= frequent)
        got = search.add_vectors(index.terms.select("chunk_id", "terms"), weights)
        assert got.columns == ["chunk_id", "vector"]
        for r in got.collect():
            assert {e["dim"]: e["value"] for e in r["vector"]} == pytest.approx(want[r["chunk_id"]], abs=1e-12)


def test_fusion_and_rerank(index, questions):
    found = search.search_all(index, questions, 5, pool=20)
    assert set(found) == {"KEYWORD", "ANN", "HYBRID"}
    votes = {}
    for method in ("KEYWORD", "ANN"):
        hits = search.bm25_top_k(index.terms, questions, 20) if method == "KEYWORD" else search.vector_top_k(
            index.vectors, search.question_vectors(questions, index.weights), 20
        )
        for r in hits.collect():
            votes.setdefault(r.query_id, {}).setdefault(r.chunk_id, []).append(1 / (60 + r.rank))
    got = answers(found["HYBRID"])
    for q, by_id in votes.items():
        want = sorted((-round(sum(v), 8), i) for i, v in by_id.items())[:5]
        assert [i for i, _ in got[q]] == [i for _, i in want]
    asked = search.question_vectors(questions, index.weights)
    again = search.rerank(found["KEYWORD"], index.vectors, asked, 3)
    assert again.filter("rank <= 3").count() == 9
    exact = answers(search.vector_top_k(index.vectors, asked, 300))
    for q, hits in answers(again).items():
        scores = dict(exact[q])
        assert all(s == pytest.approx(scores.get(i, s), abs=2e-6) for i, s in hits)


def test_nothing_of_the_size_rows_times_questions_is_shuffled(index, questions):
    text = plan(search.bm25_top_k(index.terms, questions, 5))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.fixture(scope="module")
def larger(spark):
    """Rare and frequent words over many small blocks."""
    rng = np.random.default_rng(5)
    words = [f"w{n}" for n in range(400)]
    weights = 1 / np.arange(1, 401)
    texts = [" ".join(rng.choice(words, int(rng.integers(5, 60)), p=weights / weights.sum())) for _ in range(1500)]
    rows_ = [(f"c{n:05d}", f"d{n // 5}", t if n % 7 else texts[0]) for n, t in enumerate(texts)] + [("empty", "d", ""), ("null", "d", None)]
    return spark.createDataFrame(rows_, "chunk_id string, path string, chunk_to_embed string").repartition(4)


def _asked(spark, n=60):
    rng = np.random.default_rng(6)
    asked = [(q, " ".join(f"w{int(i)}" for i in rng.integers(0, 420, int(rng.integers(1, 12))))) for q in range(n)]
    return search.question_terms(spark.createDataFrame(asked, "q long, t string"), "q", "t")


def _kept(spark, chunks):
    index = KeywordIndex(spark, new_path(spark, "keyword"))
    index.sync(chunks)
    return index


@pytest.mark.parametrize("k, block, pushed, small", [(1, 256, 10_000, True), (5, 8, 10_000, True), (5, 4, 3, False), (40, 16, 10_000, True)])
def test_kept_index_answers_like_a_scan(spark, larger, monkeypatch, k, block, pushed, small):
    monkeypatch.setattr(postings, "BLOCK", block)
    monkeypatch.setattr(postings, "PUSHED", pushed)
    if not small:
        monkeypatch.setattr(postings, "is_small", lambda df: False)
    index = _kept(spark, larger)
    whole = search.index_terms(larger.fillna("", "chunk_to_embed"))  # nulls count as empty
    want = answers(search.bm25_top_k(whole, _asked(spark), k))
    got = answers(index.top_k(_asked(spark), k))
    assert {q: [i for i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in want.items()}
    assert all(s == pytest.approx(t, abs=2e-6) for q in want for (_, s), (_, t) in zip(got[q], want[q]))


def test_many_questions_are_answered_by_one_scan(spark, larger, monkeypatch):
    index = _kept(spark, larger.filter("chunk_id <> 'c00003'"))
    index.sync(larger.filter("chunk_id <> 'c00004'"))
    want = answers(index.top_k(_asked(spark, 60), 5))
    asked = _asked(spark, 200)
    seen, keep = [], postings.written
    monkeypatch.setattr(postings, "written", lambda df, label: (seen.append(label), keep(df, label))[1])
    got = answers(index.top_k(asked, 5))
    assert "parts" not in seen and {q: got[q] for q in want} == want
    seen.clear()
    monkeypatch.setattr(postings, "MOST_SCANS", 0)
    by_postings = answers(index.top_k(asked, 5))
    assert "parts" in seen and {q: [i for i, _ in h] for q, h in by_postings.items()} == {q: [i for i, _ in h] for q, h in got.items()}
    # Ids that are not unique are left to the postings.
    monkeypatch.setattr(postings, "MOST_SCANS", 16)
    seen.clear()
    _kept(spark, larger.union(larger)).top_k(asked, 5)
    assert "parts" in seen


def test_postings_are_brought_together_before_the_shuffle(spark, larger):
    rows_ = search.index_terms(larger).filter("n_terms > 0").withColumn("no", F.monotonically_increasing_id())
    schema = KeywordIndex(spark, "unused")._schema("blocks")
    for most in (50, 1_000_000):
        blocks = rows_.coalesce(1).select("no", F.col("n_terms").cast("int"), "terms").mapInArrow(scoring.inverter(16, most), schema)
        got = blocks.select("term", F.size("postings").alias("n"), "chunks", "max_tf", "min_terms", F.inline("postings"))
        want = rows_.select(F.explode("terms").alias("t"), "no", "n_terms").select("t.term", "no", "t.tf", F.col("n_terms").cast("int"))
        assert rows(got.select("term", "no", "tf", "n_terms")) == rows(want)
        assert got.filter("n > 16 or n <> chunks or tf > max_tf or n_terms < min_terms").count() == 0
    assert blocks.count() < want.count() / 8


def test_kept_index_skips_blocks_and_pushes_terms(spark, larger, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 8)
    index = _kept(spark, larger)
    seen = []
    keep = postings.written
    monkeypatch.setattr(postings, "written", lambda df, label: (seen.append((label, plan(df))), keep(df, label))[1])
    hits = index.top_k(_asked(spark, 5), 3)
    assert all("PushedFilters: [In(term" in text for label, text in seen if label in ("bars", "parts"))
    opened = [t for label, t in seen if label == "parts"][0]
    assert "max_tf" in opened and "NestedLoop" not in opened and "Cartesian" not in opened
    assert "PushedFilters: [In(no" in plan(hits)
    blocks = index._read("blocks")
    assert blocks.agg(F.max(F.size("postings"))).first()[0] <= 8
    assert blocks.agg(F.sum(F.size("postings"))).first()[0] == index.live().agg(F.sum(F.size("terms"))).first()[0]


def test_synced_index_equals_a_new_one(spark, larger, tmp_path):
    index = KeywordIndex(spark, str(tmp_path / "index"))
    index.sync(larger)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    n = F.substring("chunk_id", 2, 5).try_cast("int")
    second = larger.filter("chunk_id <> 'null'").filter(n.isNull() | (n % 10 != 0)).withColumn(
        "chunk_to_embed", F.when(n % 10 == 1, F.concat("chunk_to_embed", F.lit(" w399 brandnew"))).otherwise(F.col("chunk_to_embed"))
    )
    added = spark.createDataFrame([("n1", "dn", "w1 w2 brandnew"), ("n2", "dn", "w399")], "chunk_id string, path string, chunk_to_embed string")
    second = second.unionByName(added)
    assert index.sync(second) and not index.sync(second)
    new = _kept(spark, second)
    asked, want = _asked(spark, 30), answers(new.top_k(_asked(spark, 30), 5))
    assert index.totals() == pytest.approx(new.totals())
    assert rows(index.frequencies()) == rows(new.frequencies())
    assert rows(index.live().select("chunk_id", "digest", "n_terms")) == rows(new.live().select("chunk_id", "digest", "n_terms"))
    assert answers(index.top_k(asked, 5)) == want
    assert index.sync(larger)
    # Files of earlier syncs are as they were, and a segment that was not finished does not count.
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    last = index.segments()[-1]
    (tmp_path / "index" / "totals" / f"segment={last}" / "_SUCCESS").unlink()
    assert answers(index.top_k(asked, 5)) == want
    index.sync(larger)
    index.remove(spark.createDataFrame([("d0",), ("d7",)], "p string"))
    rest = larger.filter("path not in ('d0', 'd7')")
    assert answers(index.top_k(asked, 5)) == answers(_kept(spark, rest).top_k(asked, 5))


@pytest.mark.parametrize("small", [True, False])
def test_rows_by_a_bit_for_each_number(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(sizing, "is_small", lambda *_: False)
    far = 3 << postings.PLACE_BITS
    known = [0, 1, 7, 8, 9, 32_767, 32_768, 32_769, 65_536, 65_537, far, far + (1 << 33), far + (1 << 33) + 250]
    wanted = [1, 8, 8, 32_768, 65_537, 70_000, far, far + (1 << 33) + 250]
    rows_ = spark.createDataFrame([(n, str(n)) for n in [*known, 8]], "no long, t string")
    numbers = spark.createDataFrame([(n,) for n in wanted], "n long")
    both = [(n, str(n)) for n in sorted([*known, 8])]
    assert sorted(map(tuple, postings.with_bit(rows_, F.col("no"), numbers).collect())) == [r for r in both if r[0] in wanted]
    assert sorted(map(tuple, postings.with_bit(rows_, F.col("no"), numbers, there=False).collect())) == [r for r in both if r[0] not in wanted]
    assert postings.with_bit(rows_, F.col("no"), numbers.limit(0)).count() == 0
    assert postings.with_bit(rows_, F.col("no"), numbers.limit(0), there=False).count() == len(both)


def test_what_a_sync_broadcasts_does_not_grow_with_the_changes(spark, monkeypatch):
    sent, keep = [], sizing.is_small

    def small(df, *limits):
        found = keep(df, *limits)
        sent.extend([df.count()] * found)
        return found

    first = spark.range(30_000).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"), F.lit("d").alias("path"), F.concat(F.lit("w"), F.col("id") % 9).alias("chunk_to_embed")
    )
    second = first.filter("chunk_id <> 'c7'").withColumn(
        "chunk_to_embed", F.when(F.col("chunk_id") < "c3", F.concat("chunk_to_embed", F.lit(" new"))).otherwise(F.col("chunk_to_embed"))
    )
    index = _kept(spark, first)
    monkeypatch.setattr(sizing, "is_small", small)
    assert index.sync(second) and not index.sync(second)
    assert index.live().count() == 29_999 and max(sent) < 500
    new = _kept(spark, second)
    assert rows(index.frequencies()) == rows(new.frequencies()) and index.totals() == new.totals()
    assert first.filter("chunk_id < 'c3'").count() > sizing.LOOKUP_ROWS


def test_kept_vectors_follow_a_sync(spark, chunks, questions, tmp_path):
    index = search.Index(spark, str(tmp_path))
    index.sync(chunks)
    fewer = chunks.filter("path > 'd3'")
    assert index.sync(fewer) and not index.sync(fewer)
    asked = lambda i: answers(search.vector_top_k(i.vectors, search.question_vectors(questions, i.weights), 9))
    assert asked(index) == asked(search.build_index(fewer))


def test_many_questions_at_once(spark, larger):
    index = _kept(spark, larger)
    many = _asked(spark, 5000)
    assert index.top_k(many, 3).select("query_id").distinct().count() > 4900


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(400, 16)).astype("float32")
    # Nearly a third of the vectors share one bucket in every table.
    vectors[:130] = vectors[0] + rng.normal(size=(130, 16)).astype("float32") * 0.01
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
    )
    data = [(n, [float(x) for x in v], n % 4) for n, v in enumerate(vectors)]
    return vectors.astype(float), spark.createDataFrame(data, schema).repartition(6)


def test_dense_search_and_centroids(dense, monkeypatch):
    vectors, df = dense
    queries = search.centroids(df, "label")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = answers(search.dense_top_k(df, "vec_id", queries, 6))
    for label in range(4):
        mean = vectors[np.arange(400) % 4 == label].mean(axis=0)
        scores = np.round(unit @ (mean / np.linalg.norm(mean)), 6)
        assert [i for i, _ in got[label]] == sorted(range(400), key=lambda n: (-scores[n], n))[:6]
    monkeypatch.setattr(search, "BLOCK_QUERIES", 1)
    assert answers(search.dense_top_k(df, "vec_id", queries, 6)) == got


def test_lsh_scores_exactly_within_buckets(spark, dense):
    vectors, df = dense
    setting = {"tables": 5, "bits": 4, "dims": 16}
    path = new_path(spark, "buckets")
    search.write_buckets(df, "vec_id", path, **setting)
    buckets = spark.read.parquet(path)
    assert buckets.count() == 400 * 5
    queries = df.filter("vec_id in (3, 200, 399)").select(F.col("vec_id").alias("query_id"), "embedding")
    got = answers(search.lsh_top_k(buckets, "vec_id", queries, 10, **setting))
    exact = answers(search.dense_top_k(df, "vec_id", queries, 400))
    sides = np.einsum("nd,tbd->ntb", vectors, search.planes(**setting)) >= 0
    for q, hits in got.items():
        near = {n for n in range(400) if (sides[n] == sides[q]).all(axis=1).any()}
        assert hits == [(i, s) for i, s in exact[q] if i in near][:10]
        assert hits[0][0] == q or hits[0][1] == 1.0
    assert "PushedFilters: [In(bucket" in plan(search.lsh_top_k(buckets, "vec_id", queries, 3, **setting))


def test_sketch_search(spark, dense, monkeypatch):
    vectors, df = dense
    queries = df.filter("vec_id in (3, 200, 399)").select(F.col("vec_id").alias("query_id"), "embedding")
    index = search.SketchIndex(spark, new_path(spark, "sketches"), "vec_id", 16).write(df)
    exact = search.dense_top_k(df, "vec_id", queries, 8)
    sides = vectors @ search.sketch_planes(128, 16).T >= 0
    chosen = answers(index.candidates(queries, 30).withColumn("score", F.lit(0.0)).withColumn("rank", F.lit(1)))
    for q, hits in chosen.items():
        near = sorted(range(400), key=lambda n: (int((sides[n] != sides[q]).sum()), n))[:30]
        assert sorted(i for i, _ in hits) == sorted(near)
    got = index.top_k(queries, 8)
    assert search.recall(got, exact, "vec_id").first()["recall"] >= 0.9
    want = answers(got)
    monkeypatch.setattr(search, "PUSHED", 2)
    assert answers(index.top_k(queries, 8)) == want
    assert index.top_k(queries.limit(0), 8).count() == 0


def test_recall_of_the_registered_search(spark, small):
    from millrace.plans.registry import QUERIES

    assert QUERIES["ann_recall"](spark, f"{small}/../sf0.1").first()["recall"] >= 0.9


def test_citations(spark, index, questions):
    chunks = index.terms.select("chunk_id", F.lit("text").alias("chunk_content"), "path", F.lit("u").alias("source_uri"), F.lit(0).alias("chunk_position"))
    out = search.with_citations(search.bm25_top_k(index.terms, questions, 2), chunks)
    assert out.columns == ["query_id", "rank", "score", "chunk_id", "chunk_content", "source_uri", "chunk_position"]
    assert out.count() == 6


def test_ground_truth_needs_no_cross_join(spark):
    documents = spark.createDataFrame(
        [("a", "xxone two three four\nfive sixyy"), ("b", "one two three"), ("c", "two three four five and one two\nthree fours")],
        "path string, text string",
    )
    passages = [(1, "one two three four\nfive six"), (2, "two three four"), (3, "absent word here")]
    asked = spark.createDataFrame(passages, "q long, t string")
    truth = evaluate.passage_sources(asked, documents, "q", "t")
    data = {r.path: r.text for r in documents.collect()}
    assert rows(truth) == sorted((q, p) for q, t in passages for p, text in data.items() if t in text)
    text = plan(truth)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_ground_truth_of_short_passages(spark, monkeypatch):
    documents = spark.createDataFrame([("a", "one two three"), ("b", "twofold three"), ("c", None)], "path string, text string")
    passages = [(1, "two"), (2, "e t"), (3, "one two three"), (4, "none"), (5, ""), (6, None), (7, "two three")]
    asked = spark.createDataFrame(passages, "q long, t string")
    want = [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (7, "a")]
    assert rows(evaluate.passage_sources(asked, documents, "q", "t")) == want
    monkeypatch.setattr(evaluate, "ANCHORS_IN_ROW", 2)
    assert rows(evaluate.passage_sources(asked, documents, "q", "t")) == want


def test_hit_rates_and_gate(spark):
    paths = spark.createDataFrame([("c1", "a"), ("c2", "b"), ("c3", "c")], "chunk_id string, path string")
    truth = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "c")], "query_id long, path string")
    hits = spark.createDataFrame([(1, "c1"), (2, "c1"), (3, "c3"), (9, "c1")], "query_id long, chunk_id string")
    none = hits.limit(0)
    rates = evaluate.hit_rates({"HYBRID": hits, "ANN": none}, truth, paths)
    assert rows(rates) == [("ANN", 0, 3, 0.0), ("HYBRID", 2, 3, pytest.approx(2 / 3))]
    measured = rates.select(F.col("method").alias("metric"), F.col("hit_rate").alias("value"))
    gate = evaluate.gate(measured, {"HYBRID": 0.6, "ANN": 0.5, "groundedness": 0.8})
    assert {r.metric: r.passed for r in gate.collect()} == {"HYBRID": True, "ANN": False, "groundedness": False}
    with pytest.raises(ValueError):
        evaluate.gate(measured, {"HYBRID": 1.5})


def test_blocks_are_packed_for_the_shuffle(spark, larger):
    rows_ = search.index_terms(larger).filter("n_terms > 0").withColumn("no", F.monotonically_increasing_id() * 1_000_003)
    given = rows_.select("no", F.col("n_terms").cast("int"), "terms").coalesce(1)
    schema = KeywordIndex(spark, "unused")._schema("blocks")
    packed = "term string, max_tf int, min_terms int, chunks int, first long, packed binary"
    for most in (50, 1_000_000):
        short = given.mapInArrow(scoring.inverter(16, most, packed=True), packed)
        whole = short.coalesce(1).sortWithinPartitions("term").mapInArrow(scoring.block_merger(16), schema)
        want = given.mapInArrow(scoring.inverter(16), schema)
        names = ["term", F.inline("postings")]
        assert rows(whole.select(*names)) == rows(want.select(*names))
        assert rows(whole.select("term", "max_tf", "min_terms", "chunks")) == rows(want.select("term", "max_tf", "min_terms", "chunks"))
    assert short.agg(F.sum(F.length("packed"))).first()[0] < 8 * given.agg(F.sum(F.size("terms"))).first()[0]


@pytest.mark.parametrize("value", [0, 1, 127, 128, 16_383, 16_384, 1 << 33, (1 << 63) - 1])
def test_numbers_of_any_size_are_packed(value):
    values = np.array([5, value, 300, value])
    assert scoring._from_varints(scoring._varints(values)[0]).tolist() == values.tolist()
    assert len(scoring._from_varints(scoring._varints(values[:0])[0])) == 0


def test_kept_vectors_are_short_and_read_back(spark, chunks, tmp_path, monkeypatch):
    """Neither the vectors' own values nor working files stay; what is read is the same from any object."""
    monkeypatch.setattr(search, "FREQUENT", 4)
    working = tmp_path / "working"
    monkeypatch.setattr(search, "new_path", lambda _, label: str(working / label))
    index = search.Index(spark, str(tmp_path / "index"))
    index.sync(chunks)
    frequencies = {r.term: r.frequency for r in index.keyword.frequencies().collect()}
    best_terms = sorted(frequencies, key=lambda w: -frequencies[w])[:4]
    assert set(index.weights.frequent) <= set(best_terms) and index.weights.frequent
    assert list(working.iterdir()) == []
    kept = spark.read.parquet(str(tmp_path / "index" / "coded"))
    assert "vector" not in kept.columns and kept.agg(F.sum(F.size("_codes"))).first()[0] > 0 < kept.agg(F.sum(F.size("_rest"))).first()[0]
    monkeypatch.setattr(search, "FREQUENT", 65_536)
    exact = search.add_vectors(index.terms.select("chunk_id", "terms"), index.weights)
    value = ["chunk_id", F.inline("vector")]
    rounded = lambda df: rows(df.select(*value).select("chunk_id", "dim", F.round("value", 9)))
    assert rounded(search.Index(spark, str(tmp_path / "index")).vectors) == rounded(exact)


def test_frequencies_are_not_broadcast_by_a_guess(spark, index, monkeypatch):
    seen, keep = [], search.written_to
    monkeypatch.setattr(search, "written_to", lambda path, df, codec=None: (seen.append(plan(df)), keep(path, df, codec))[1])
    monkeypatch.setattr(search, "FREQUENT", 3)
    vectors_ = search.add_vectors(index.terms.select("chunk_id", "terms"), index.weights)
    assert "SortMergeJoin" in seen[1] and "Broadcast" not in seen[1] and "Broadcast" not in plan(vectors_)
