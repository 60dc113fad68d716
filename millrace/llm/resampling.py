"""Importance resampling towards a target distribution, over hashed word features.

A text's features are its runs of one to ``longest`` words, each in the bucket of its CRC. How much likelier a bucket is in the
target than in the source gives its gain, and documents are drawn by the sum of their gains plus noise from their id.

The vocabulary is split into head and tail. Words that hold a fixed share of all words are few, whatever the size of the corpus: their
exact CRC states are broadcast, and so are the buckets of pairs with such a share. Any other feature takes its CRC directly. Both
ways give the same bucket, so the split changes only the time, and totals are exact.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# A word or pair of the head holds at least one of so many occurrences, so there are at most so many. Longer ones stay in the tail.
HEAD = 65_536
HEAD_BYTES = 64
# Occurrences that are counted together in a task.
CHUNK = 1_000_000

# Letters and digits stay, A-Z in lower case; bytes of other characters stay; the rest parts words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8; a null text has none."""
    return text.translate(FOLD).split() if text else []


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").cast("binary").alias("text"))


class Head:
    """Frequent words with their CRC states, and frequent pairs, as ``word word``, with their buckets."""

    def __init__(self, states: dict[bytes, int], pairs: dict[bytes, int]):
        self.states, self.pairs = _States(states), pairs


class _States(dict):
    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)

    def __reduce__(self):
        return _States, (dict(self),)


def learn_head(*corpora: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> Head:
    """The head of the words, and with ``longest`` above 1 of the pairs, of the texts in all ``corpora``.

    Each task counts some occurrences at a time and passes on what holds the share there; what still holds it over all is the
    head. A sum of such counts is at most the true count, so the bound holds. Nulls and empty texts add nothing, and a long
    text is cut into several counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bool, Counter] = {False: Counter(), True: Counter()}
        seen = {False: 0, True: 0}

        def flushed(pair: bool) -> pa.RecordBatch:
            often = [(f, n) for f, n in known[pair].items() if n * HEAD >= seen[pair] and len(f) <= HEAD_BYTES]
            often.append((None, seen[pair]))
            known[pair], seen[pair] = Counter(), 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f for f, _ in often], pa.binary()),
                    pa.array([pair] * len(often), pa.bool_()),
                    pa.array([n for _, n in often], pa.int64()),
                ],
                names=["feature", "pair", "n"],
            )

        for batch in batches:
            for value in batch.column(0):
                ws = words(value.as_py())
                for at in range(0, len(ws), CHUNK):
                    part = ws[at : at + CHUNK + 1]
                    runs = [(False, part[:CHUNK])]
                    if longest > 1:
                        runs.append((True, [a + b" " + b for a, b in zip(part, part[1:])]))  # noqa: B905
                    for pair, features in runs:
                        known[pair].update(features)
                        seen[pair] += len(features)
                        if seen[pair] >= CHUNK:
                            yield flushed(pair)
        yield flushed(False)
        yield flushed(True)

    given = _texts(corpora[0], text)
    for more in corpora[1:]:
        given = given.unionByName(_texts(more, text))
    counts = given.mapInArrow(count, "feature binary, pair boolean, n long").groupBy("pair", "feature").agg(F.sum("n").alias("n"))
    counts = written(counts, "head")
    totals = counts.filter("feature is null").select("pair", F.col("n").alias("total"))
    often = counts.filter("feature is not null").join(F.broadcast(totals), "pair").filter(F.col("n") * HEAD >= F.col("total"))
    # At most HEAD words and HEAD pairs of HEAD_BYTES.
    found = [(r["pair"], bytes(r["feature"])) for r in often.select("pair", "feature").collect()]
    return Head(
        {f: zlib.crc32(f) for pair, f in found if not pair}, {f: zlib.crc32(f) % buckets for pair, f in found if pair}
    )


def feature_buckets(ws: list[bytes], head: Head, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each feature, runs of one word first, then of two, and so on."""
    states = list(map(head.states.__getitem__, ws))
    out = [np.array(states, np.int64) % buckets]
    for size in range(2, longest + 1):
        if len(ws) < size:
            break
        ends = [b" " + w for w in ws[size - 1 :]]
        if size == 2:
            named = [head.pairs.get(a + b) for a, b in zip(ws, ends)]  # noqa: B905
            row = [zlib.crc32(b, s) % buckets if k is None else k for k, b, s in zip(named, ends, states)]  # noqa: B905
            out.append(np.array(row, np.int64))
            if longest == 2:
                break
        states = [zlib.crc32(b, s) for b, s in zip(ends, states)]  # noqa: B905
        if size > 2:
            out.append(np.array(states, np.int64) % buckets)
    return np.concatenate(out)


FEATURES = "row long, doc_id long, n_words long, n_features long, buckets binary"


def hashed_features(
    docs: DataFrame, head: Head, doc_id: str | None = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS
) -> DataFrame:
    """``row, doc_id, n_words, n_features, buckets``, a row per row of ``docs``; ``buckets`` are little-endian unsigned 32-bit numbers.

    ``row`` is a number that no other row has, once the result is written. A null or empty text, or one without words, has no
    features. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("row", "doc_id", "n_words", "n_features", "buckets")}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ws = words(value.as_py())
                found = feature_buckets(ws, shared.value, longest, buckets)
                for column, v in zip(out.values(), (row, name, len(ws), len(found), found.astype("<u4").tobytes()), strict=True):
                    column.append(v)
                row += 1
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    ids = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    return docs.select(ids.alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(encode, FEATURES)


def bucket_totals(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of a table of ``hashed_features`` are in each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer() or b"", "<u4"), minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket from both tables' totals: a thousand times the log of how much likelier the target has it, rounded down.

    Every bucket counts one more than was seen. The totals are at most ``buckets`` rows each.
    """
    s, t = ({r["bucket"]: r["n"] for r in totals.collect()} for totals in (source, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t.get(b, 0) + 1.0) * all_s / ((s.get(b, 0) + 1.0) * all_t)))
            for b in range(buckets)
        ],
        np.int64,
    )


def weighed(features: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight, score``: the sum of a document's gains, and that plus noise from its id.

    Without features the weight is 0. A null id takes the noise of an empty name.
    """
    shared = features.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(shared.value[np.frombuffer(v.as_buffer() or b"", "<u4")].sum()) for v in batch.column("buckets")]
            rest = batch.select(["row", "doc_id", "n_words", "n_features"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(weights, pa.int64())], names=[*rest.schema.names, "weight"])

    out = features.mapInArrow(weigh, "row long, doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))


def _noise(doc_id: Column, seed: int) -> Column:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: of documents with ``least_words`` words the ``percent`` of highest scores, from 1; null for all others.

    The share is rounded down; ties go to the smaller id, null last, and rows of equal id and score are ranked in any order. Rows are dealt into
    ranges of score and id, counted per range and numbered inside each, so no task holds all of them. ``scored`` must be a written
    table. An empty table stays empty.
    """
    apt = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    ranged = scored.filter(apt).repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # One row per range: as many as there are partitions.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.floor(F.sum("n").over(whole) * percent / 100).alias("share"),
    )
    number = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("start")
    numbered = ranged.join(F.broadcast(starts), "range").withColumn("rank", number.cast("long"))
    numbered = numbered.withColumn("rank", F.when(F.col("rank") <= F.col("share"), F.col("rank")))
    others = scored.filter(~apt).withColumn("rank", F.lit(None).cast("long"))
    return numbered.select(*scored.columns, "rank").unionByName(others)


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``; see ``weighed`` and ``drawn``.

    Repeated rows are documents of their own, and equal ones have equal scores. An empty target gives every bucket the gain of
    a bucket that the target doesn't have. A very long text is one row of four bytes per feature between the steps.
    """
    head = learn_head(docs.select(F.col(text).alias("text")), target.select(F.col(target_text).alias("text")), longest=longest, buckets=buckets)
    source = written(hashed_features(docs, head, doc_id, text, longest, buckets), "features")
    wanted = hashed_features(target, head, None, target_text, longest, buckets)
    gains = bucket_gains(bucket_totals(source, buckets), bucket_totals(wanted, buckets), buckets)
    scored = written(weighed(source, gains, seed), "scored")
    return drawn(scored, percent, least_words).drop("row")
