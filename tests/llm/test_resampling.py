import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import resampling
from millrace.llm.queries import op12_importance_resampling
from tests.llm.conftest import ODD

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, target, longest=1, buckets=10_000, least=20, percent=10):
    def features(text):
        ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        runs = [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]
        return len(ws), [zlib.crc32(r.encode()) % buckets for r in runs]

    def noise(i):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for r in own for b in r[2]), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    out = [(i, n, len(f), w := sum(gain[b] for b in f), w + noise(i)) for i, n, f in own]
    apt = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = Counter()
    for k, r in enumerate(apt[: percent * len(apt) // 100]):
        ranks[r, k + 1] += 1
    for r in out:
        if r[1] < least:
            ranks[r, None] += 1
    for r in apt[percent * len(apt) // 100 :]:
        ranks[r, None] += 1
    return ranks


def result(df):
    return Counter(((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]), r["rank"]) for r in df.collect())


def targets(spark, folder):
    return [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


def test_whole_table(spark, small, texts):
    want = brute(texts.items(), targets(spark, small))
    got = op12_importance_resampling(spark, small).collect()
    assert Counter(((r["doc_id"], r["n_features"], r["weight"], r["score"]), r["rank"]) for r in got) == Counter(
        ((k[0][0], k[0][2], k[0][3], k[0][4]), k[1]) for k in want.elements()
    )
    assert sum(r["rank"] is not None for r in got) > 5


@pytest.mark.parametrize("longest", [2, 3])
def test_runs_of_words(spark, small, documents, texts, longest):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    got = resampling.resample(documents, target, longest=longest, buckets=997, percent=50, least_words=5)
    assert result(got) == brute(texts.items(), targets(spark, small), longest, 997, 5, 50)


def test_odd_rows(spark, small, odd, none):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    got = resampling.resample(odd, target, percent=60)
    assert result(got) == brute(ODD, targets(spark, small), percent=60)
    assert resampling.resample(none, target).collect() == []
    empty = target.limit(0)
    assert result(resampling.resample(odd, empty, percent=60)) == brute(ODD, [], percent=60)


def test_head_does_not_change_buckets():
    ws = resampling.words(b"The cat, the hat; THE cat \xc3\x89t\xc3\xa9")
    plain = resampling.Head({}, {})
    head = resampling.Head({b"the": zlib.crc32(b"the")}, {b"the cat": zlib.crc32(b"the cat") % 10_000})
    for longest in (1, 2, 3):
        assert list(resampling.feature_buckets(ws, plain, longest)) == list(resampling.feature_buckets(ws, head, longest))


def test_head_holds_what_is_frequent(spark, monkeypatch):
    # 20,000 rare words, and one that is every tenth.
    rows = [(" ".join(f"w{i * 200 + k} often" if k % 10 == 0 else f"w{i * 200 + k}" for k in range(200)),) for i in range(100)]
    monkeypatch.setattr(resampling, "HEAD", 100)
    head = resampling.learn_head(spark.createDataFrame(rows, "text string").repartition(3), longest=2)
    assert dict(head.states) == {b"often": zlib.crc32(b"often")}
    assert len(head.pairs) <= 100


def test_ranks_over_many_ranges(spark):
    rows = [(k, k % 50, 30, 30, 0, k % 7) for k in range(1000)]
    scored = spark.createDataFrame(rows, "row long, doc_id long, n_words long, n_features long, weight long, score long")
    got = {r["row"]: r["rank"] for r in resampling.drawn(scored.repartition(5), percent=37).collect()}
    order = sorted(rows, key=lambda r: (-r[5], r[1], r[0]))
    assert got == {r[0]: k + 1 if k < 370 else None for k, r in enumerate(order)}
