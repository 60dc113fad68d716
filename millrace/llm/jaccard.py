"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Documents of equal shingle sets form one class, and only classes are compared. Bands of MinHash values put classes that may
be similar into one neighbourhood. Each neighbourhood is dealt into blocks of bounded size, and every pair of blocks is one
unit of work: MinHash values are compared some at a time, a pair whose posterior probability of reaching the threshold
falls below the tolerance is dropped, and the rest are compared by their whole shingle sets. A unit gives a count of
links per class and a spanning set of links, never all pairs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.session import written

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 6, 36
STEP = 24
TOLERANCE = 1e-6
BLOCK = 256
WORD = re.compile(r"\w+")

SIGNED = "doc_id long, text_key string, class string, n_shingles int, bands array<long>, signature binary"
CACHED_WORDS = 300_000


class _WordHashes(dict):
    """Hash by word. Words that come back are hashed once as long as the table is not full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _WordHashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted, distinct 64-bit hashes of a text's word shingles; one of all its words when it has fewer."""
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of each of the hash functions over a set, as 32 bits. Long sets are taken in pieces of bounded size."""
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 512):
        best = np.minimum(best, (values[at : at + 512, None] * a + b).min(0))
    return (best >> np.uint64(32)).astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _permutations(ROWS * BANDS)
    for batch in batches:
        rows = {"doc_id": batch.column(0), "text_key": batch.column(2), "class": [], "n_shingles": [], "bands": [], "signature": []}
        for text in batch.column(1):
            own = shingles(text.as_py())
            rows["n_shingles"].append(len(own))
            if not len(own):
                for name in ("class", "bands", "signature"):
                    rows[name].append(None)
                continue
            rows["class"].append(xxhash.xxh128_hexdigest(own.tobytes()))
            sig = signature(own, a, b)
            parts = sig.reshape(BANDS, ROWS).tobytes()
            width = 4 * ROWS
            rows["bands"].append(
                [_signed(xxhash.xxh64_intdigest(parts[k : k + width], seed=k)) for k in range(0, len(parts), width)]
            )
            rows["signature"].append(sig.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                rows["doc_id"],
                rows["text_key"],
                pa.array(rows["class"], pa.string()),
                pa.array(rows["n_shingles"], pa.int32()),
                pa.array(rows["bands"], pa.list_(pa.int64())),
                pa.array(rows["signature"], pa.binary()),
            ],
            names=["doc_id", "text_key", "class", "n_shingles", "bands", "signature"],
        )


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def least_matches(total: int, threshold: float = THRESHOLD, step: int = STEP, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values the fewest matches with which a pair goes on.

    The prior of a similarity is flat. With ``m`` matches of ``n`` the posterior is Beta(m + 1, n - m + 1), whose probability
    of at least ``threshold`` is that of at most ``m`` successes in ``n + 1`` trials at ``threshold``.
    """
    out = {}
    for n in range(step, total + 1, step):
        tail, m = 0.0, -1
        while m < n:
            term = math.comb(n + 1, m + 1) * threshold ** (m + 1) * (1 - threshold) ** (n - m)
            if tail + term >= tolerance:
                break
            tail, m = tail + term, m + 1
        out[n] = m + 1
    return out


def _links(left: list[dict], right: list[dict], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (numbers in ``left`` and ``right``) of a Jaccard similarity of ``THRESHOLD`` or more."""
    x = np.stack([np.frombuffer(r["signature"], np.uint32) for r in left])
    y = x if same else np.stack([np.frombuffer(r["signature"], np.uint32) for r in right])
    sizes = np.array([r["n_shingles"] for r in left], np.float64), np.array([r["n_shingles"] for r in right], np.float64)
    # Sets whose sizes are too far apart can't be similar enough.
    i, j = np.nonzero(np.minimum.outer(*sizes) >= THRESHOLD * np.maximum.outer(*sizes))
    if same:
        i, j = i[i < j], j[i < j]
    matches = np.zeros(len(i), np.int32)
    for n, least in least_matches(x.shape[1]).items():
        if not len(i):
            break
        for c in range(n - STEP, n):
            matches += x[i, c] == y[j, c]
        on = matches >= least
        i, j, matches = i[on], j[on], matches[on]
    if not len(i):
        return i, j
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in left], [np.frombuffer(r["shingles"], np.uint64) for r in right]
    if len(i) < 64:
        shared = np.array([len(np.intersect1d(sets[0][a], sets[1][b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    else:
        shared = _shared(*sets)[i, j]
    on = shared >= THRESHOLD * (sizes[0][i] + sizes[1][j] - shared) - 1e-9
    return i[on], j[on]


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two blocks, by products of bounded slices of their incidence matrices."""
    known = np.unique(np.concatenate(left + right))
    out = np.zeros((len(left), len(right)), np.float32)
    at = [np.searchsorted(known, s) for s in left], [np.searchsorted(known, s) for s in right]
    for low in range(0, len(known), 4096):
        parts = []
        for places in at:
            m = np.zeros((len(places), min(4096, len(known) - low)), np.float32)
            for row, p in enumerate(places):
                a, b = np.searchsorted(p, (low, low + 4096))
                m[row, p[a:b] - low] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out.round().astype(np.int64)


LINKED = "class string, links long, other string"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit, so that each unit is in memory alone."""

    def result(unit: list[dict]) -> dict[str, list]:
        low, high = unit[0]["low"], unit[0]["high"]
        left = [r for r in unit if r["block"] == low]
        right = left if low == high else [r for r in unit if r["block"] == high]
        out = {"class": [], "links": [], "other": []}
        if not left or not right:
            return out
        i, j = _links(left, right, low == high)
        rows = [r["class"] for r in left], [r["class"] for r in right]
        for own, mine in ((rows[0], i), (rows[1], j)):
            for k, n in zip(*np.unique(mine, return_counts=True), strict=True):
                out["class"].append(own[k])
                out["links"].append(int(n))
                out["other"].append(None)
        # A forest holds together what the unit's links connect.
        parent: dict[str, str] = {}

        def top(v: str) -> str:
            while parent.setdefault(v, v) != v:
                parent[v] = v = parent[parent[v]]
            return v

        for a, b in zip(i, j, strict=True):
            p, q = top(rows[0][a]), top(rows[1][b])
            if p != q:
                parent[max(p, q)] = min(p, q)
                out["class"].append(rows[0][a])
                out["links"].append(0)
                out["other"].append(rows[1][b])
        return out

    def table(out: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out["class"], pa.string()), pa.array(out["links"], pa.int64()), pa.array(out["other"], pa.string())],
            names=["class", "links", "other"],
        )

    unit: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if unit and (row["place"], row["low"], row["high"]) != (unit[0]["place"], unit[0]["low"], unit[0]["high"]):
                yield table(result(unit))
                unit = []
            unit.append(row)
    if unit:
        yield table(result(unit))


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, text) to (class, shingles), without texts that only share their id with a text of the class."""
    for batch in batches:
        kept = {"class": [], "shingles": []}
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = shingles(text.as_py()).tobytes()
            if xxhash.xxh128_hexdigest(own) == name:
                kept["class"].append(name)
                kept["shingles"].append(own)
        yield pa.RecordBatch.from_pydict(kept, schema=pa.schema([("class", pa.string()), ("shingles", pa.binary())]))


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, n_copies, class, text_key, place``.

    ``class_id`` is the least document id of all that are connected by links or equal shingle sets, ``n_links`` the number of
    other shingle sets linked to the document's own, ``n_copies`` the number of documents with its own set, ``class``
    a digest of that set, ``text_key`` one of the text, and ``place`` names what ``class_id`` does when ids are null. A link is a Jaccard similarity of ``THRESHOLD`` or more between sets of ``SHINGLE`` words.

    Words are runs of letters, digits and underscores in lower case. A text of fewer words has one shingle of all of them. A
    text without words, or null, has no set: it is like nothing, and its ``class_id`` is its own id. Every row comes back,
    repeated ids included. A class whose ids are all null has a null ``class_id``. An empty table gives no rows. Other columns are ignored.

    Two sets of the threshold's similarity share a band with a probability of 1 - (1 - 0.8^6)^36, all but 2 in 100,000,
    and a pair at the threshold is dropped by the tolerance in fewer cases still. A set is told by 64-bit hashes of its
    shingles.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _text_key(text).alias("text_key"))
    signed = written(given.mapInArrow(_sign, SIGNED), "signed")
    members = signed.filter("class is not null")
    # Copies are counted before anything else happens to them, by partial sums.
    classes = members.groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"))
    classes = written(classes, "classes")

    bands = members.select("class", F.explode("bands").alias("band")).distinct()
    shared = bands.groupBy("band").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = bands.join(shared, "band").filter(F.col("class") != F.col("first")).select("class", F.col("first").alias("other"))
    near = written(components(edges.distinct(), "class", "other"), "near")  # class -> place, only those with a neighbour

    # Payloads are fetched once for each class that has a neighbour.
    sets = _payload(given, signed, near)
    sizes = near.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    blocks = near.join(sizes, "place").select(
        "class", "place", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks")
    )
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("class"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    units = blocks.select("class", "place", "block", other.alias("o"))
    units = units.select(
        "class", "place", "block", F.least("block", "o").alias("low"), F.greatest("block", "o").alias("high")
    )
    dealt = units.join(sets, "class").repartition("place", "low", "high").sortWithinPartitions("place", "low", "high")
    linked = written(
        dealt.select("class", "place", "block", "low", "high", "n_shingles", "signature", "shingles").mapInArrow(_compare, LINKED),
        "linked",
    )
    counts = linked.groupBy("class").agg(F.sum("links").alias("n_links"))
    joined = components(linked.filter("other is not null").select("class", "other").distinct(), "class", "other")
    known = classes.join(joined, "class", "left").withColumn("place", F.coalesce("place", "class"))
    least = known.groupBy("place").agg(F.min("least").alias("class_id"))
    result = written(
        known.join(least, "place").join(counts, "class", "left")
        .select("class", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", "place"),
        "joined",
    )
    # A class may hold a third of all documents: the documents stay where they are if the classes are few, and are
    # split by adaptive execution otherwise.
    return signed.select("doc_id", "text_key", "class").join(result, "class", "left").select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        "class",
        "text_key",
        "place",
    )


def _text_key(text: str) -> F.Column:
    return F.coalesce(F.md5(F.col(text)), F.lit(""))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of ``jaccard_classes``: that of the least id, then the least digest of its text.

    A null id comes last. Of rows with equal id and text one stays. Documents without words are in no group and all stay.
    All columns of ``docs`` come back. Groups are reduced by partial minima, and the documents are joined with the winners by id
    and digest, a row of numbers each.
    """
    found = written(jaccard_classes(docs, doc_id, text), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    grouped = found.filter("class is not null").groupBy("place")
    best = grouped.agg(F.min(order).alias("w")).select("w.doc_id", "w.text_key")
    wordless = found.filter("class is null").select("doc_id", "text_key").distinct()
    stay = best.unionByName(wordless)
    stay = written(stay, "winners")
    # The rows are wrapped, so that no column of theirs is taken for one of these.
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), _text_key(text).alias("text_key")
    )
    twice = found.filter("class is not null").groupBy("doc_id", "text_key").count().filter("count > 1").drop("count")

    def joined(ids: DataFrame, how: str) -> DataFrame:
        return rows.join(ids, rows["doc_id"].eqNullSafe(ids["doc_id"]) & (rows["text_key"] == ids["text_key"]), how)

    if not twice.head(1):
        return joined(stay, "left_semi").select("row.*")
    twins = F.col("stay.doc_id").eqNullSafe(F.col("twice.doc_id")) & (F.col("stay.text_key") == F.col("twice.text_key"))
    alone, several = (written(stay.alias("stay").join(twice.alias("twice"), twins, how), "winners") for how in ("left_anti", "left_semi"))
    first = joined(several, "left_semi").dropDuplicates(["doc_id", "text_key"])
    return joined(alone, "left_semi").select("row.*").unionByName(first.select("row.*"))


def _payload(given: DataFrame, signed: DataFrame, near: DataFrame) -> DataFrame:
    """``class, n_shingles, signature, shingles`` of the classes in ``near``, each from its first document.

    The texts read are those of one document per class: that of the least id. Documents that share it are told apart by class.
    """
    first = signed.join(near, "class", "left_semi").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    first = written(first, "firsts")
    texts = given.withColumnRenamed("doc_id", "_id").join(first.select("class", "doc_id"), F.col("_id").eqNullSafe(F.col("doc_id")))
    sets = texts.select("class", "text").mapInArrow(_with_shingles, "class string, shingles binary")
    return first.drop("doc_id").join(sets.dropDuplicates(["class"]), "class")
