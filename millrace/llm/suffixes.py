"""Passages that repeat across documents, found with sparse suffix arrays.

Only suffixes at minimiser positions are kept: the least hash in each window of word grams, so that equal passages keep equal
positions. They are sorted all together, and each is compared with its neighbours in other documents, to the right and to
the left. Passages whose partner may lie beyond the neighbours are compared by hash. What matches is put together, and passages that are long
enough are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.jaccard import WORD, _hashes, _signed
from millrace.session import written
from millrace.sizing import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join

PASSAGE = 50  # words that a reported passage has at least
GRAM = 16
WINDOW = PASSAGE - GRAM + 1  # grams of which one is kept: any passage long enough has a whole window


def _words(text: str | None) -> np.ndarray:
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes that are kept of a text; none of a text shorter than a passage."""
    if len(words) < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(words) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams = (grams ^ words[k : k + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(1) + np.arange(len(grams) - WINDOW + 1)
    positions = np.unique(least)
    return positions, grams[positions]


def _short(words: np.ndarray) -> np.ndarray:
    """Word hashes as they are compared: 32 bits, in the byte order in which they sort."""
    return (words >> np.uint64(32)).astype(">u4")


def _key(words: np.ndarray) -> int | None:
    """A number for the word sequence; texts without words have none."""
    return _signed(xxhash.xxh64_intdigest(words.tobytes())) if len(words) else None


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"key": [], "n_words": [], "grams": []}
        for text in batch.column(1):
            words = _words(text.as_py())
            out["key"].append(_key(words))
            out["n_words"].append(len(words))
            out["grams"].append(minimisers(words)[1].astype(np.int64, casting="unsafe").tolist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(out["key"], pa.int64()), pa.array(out["n_words"], pa.int64()),
                pa.array(out["grams"], pa.list_(pa.int64())),
            ],
            names=["doc_id", "key", "n_words", "grams"],
        )


SUFFIX = "gram long, right binary, left binary, key long, pos int"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, wanted grams, text) to the suffixes at these grams, each with the words around it.

    A passage that is long enough has a position that all its texts keep within ``WINDOW`` words of its beginning, of its end less a gram,
    and of each other. So that many words to the left, and a gram more to the right, hold together what matches.
    """
    for batch in batches:
        out: dict[str, list] = {"gram": [], "right": [], "left": [], "key": [], "pos": []}
        for key, wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = _words(text.as_py())
            if _key(words) != key:
                continue
            positions, grams = minimisers(words)
            short, known = _short(words), set(wanted)
            for p, g in zip(positions.tolist(), grams.astype(np.int64, casting="unsafe").tolist(), strict=True):
                if g in known:
                    out["gram"].append(g)
                    out["right"].append(short[p : p + WINDOW + GRAM].tobytes())
                    out["left"].append(short[max(0, p - WINDOW) : p][::-1].tobytes())
                    out["key"].append(key)
                    out["pos"].append(p)
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _common(a: bytes, b: bytes) -> int:
    """How many words two runs have in common from their beginning."""
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, np.uint32, n), np.frombuffer(b, np.uint32, n)
    differ = np.nonzero(x != y)[0]
    return int(differ[0]) if len(differ) else n


MATCHED = "key long, start int, until int, hash long, known boolean"


def window_hashes(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Hashes of the passages around suffixes: a row per suffix, and a column per number of words, ``WINDOW - 1`` to 0, to the left of it.

    What lies beyond a text counts as zeros; such columns mean nothing.
    """
    n, before = len(left), WINDOW - 1
    words = np.empty((n, before + PASSAGE), np.uint64)
    # The words to the left come nearest first.
    words[:, :before] = np.frombuffer(b"".join(x[: 4 * before].ljust(4 * before, b"\0") for x in left), ">u4").reshape(n, before)[:, ::-1]
    words[:, before:] = np.frombuffer(b"".join(x[: 4 * PASSAGE].ljust(4 * PASSAGE, b"\0") for x in right), ">u4").reshape(n, PASSAGE)

    def both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0x2545F4914F6CDD1D))
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return z ^ (z >> np.uint64(29))

    # Runs of 1, 2, 4, ... words, and of these the ones that make up a passage.
    whole, size, runs = None, 0, words
    for bit in range(PASSAGE.bit_length()):
        if bit:
            half = 1 << (bit - 1)
            runs = both(runs[:, :-half], runs[:, half:])
        if PASSAGE >> bit & 1:
            part = runs[:, size : size + WINDOW]
            whole, size = part if whole is None else both(whole, part), size + (1 << bit)
    return whole


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes to the range of words that each shares with its neighbours of other texts, and to the hashes of open passages.

    A stretch of suffixes of one text lies between two of other texts, and each of it is compared with both. Suffixes that have a passage
    in common have the right part of it in common, so they lie in one run in which all have that right part, maybe with others between them
    whose left part differs. Where a neighbour has the right part of a passage but not its left part, or is in another sorted part,
    the passage's hash is given out, and whether the other neighbour is already known to have it. If the stretch is longer,
    it is given out for all right parts in common with a neighbour. So of any two texts with a passage, each either has a neighbour with it, or
    its hash meets one of another text, or a known one.
    """
    found: list[tuple] = []
    open_: list[tuple] = []
    before: tuple | None = None  # the last suffix of the text before the stretch
    stretch: list[tuple] = []

    def close(after: tuple | None) -> None:
        for x in stretch:
            top, known = -PASSAGE, []
            for other in (before, after):
                if other is None:
                    top = 0
                elif x[0] == other[0]:
                    right, left = _common(x[1], other[1]), _common(x[2], other[2])
                    if right >= GRAM and left + right >= PASSAGE:
                        found.append((x[3], x[4] - left, x[4] + right))
                        known.append((-left, right - PASSAGE))
                    top = max(top, right - PASSAGE if len(stretch) > 1 else min(right - PASSAGE, -left - 1))
            first = -min(WINDOW - 1, len(x[2]) // 4)
            last = min(top, 0, len(x[1]) // 4 - PASSAGE)
            if first <= last:
                open_.append((x, first, last, known))

    def table() -> pa.RecordBatch:
        key, start, until = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
        hashes, sure = [None] * len(key), [None] * len(key)
        if open_:
            passages = window_hashes([o[0][2] for o in open_], [o[0][1] for o in open_]).astype(np.int64, casting="unsafe")
            for (x, first, last, known), row in zip(open_, passages.tolist(), strict=True):
                for at in range(first, last + 1):
                    key.append(x[3])
                    start.append(x[4] + at)
                    until.append(x[4] + at + PASSAGE)
                    hashes.append(row[WINDOW - 1 + at])
                    sure.append(any(a <= at <= b for a, b in known))
        found.clear()
        open_.clear()
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_())
        columns = (key, start, until, hashes, sure)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "start", "until", "hash", "known"]
        )

    for batch in batches:
        for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if stretch and x[3] != stretch[-1][3]:
                close(x)
                before, stretch = stretch[-1], []
            stretch.append(x)
        yield table()
    close(None)
    yield table()


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_repeated, spans``.

    ``spans`` are sorted, disjoint ranges (``start`` and ``last``, word numbers from 1) of ``PASSAGE`` words or more that also occur in
    another document, and ``n_repeated`` is how many words lie in them. Words are runs of letters, digits and underscores in
    lower case. A text of fewer words, and a null one, has no spans. Documents of equal words repeat each other whole. Repeated rows
    count as documents of their own. Repeats inside one document are not reported. Every row comes back; an empty table gives no rows; other columns are ignored.

    Documents of equal words are one text here, so copies add no suffixes. Suffixes whose gram occurs in one text only are left
    out before contexts are fetched. Sorting is by ranges of gram, context and text, so a gram that a third of all texts share
    is split over many parts. Passages that neighbours leave open, at the edges of parts too, are looked up by hash among each other.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = written(given.mapInArrow(_keyed, "doc_id long, key long, n_words long, grams array<long>"), "keyed")
    texts = keyed.filter(f"n_words >= {PASSAGE}").groupBy("key").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    texts = written(texts, "texts")
    grams = keyed.filter(f"n_words >= {PASSAGE}").select("key", F.explode("grams").alias("gram")).distinct()
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    wanted = grams.join(shared, "gram").groupBy("key").agg(F.collect_list("gram").alias("wanted"))
    wanted = written(wanted.join(texts, "key").select("key", "first", "wanted"), "wanted")

    sources = given.join(wanted.withColumnRenamed("first", "_first"), F.col("doc_id").eqNullSafe(F.col("_first")))
    suffixes = sources.select("key", "wanted", "text").mapInArrow(_suffixes, SUFFIX)
    # Rows of equal id may give the same text twice.
    ordered = suffixes.repartitionByRange("gram", "right", "left", "key", "pos").sortWithinPartitions(
        "gram", "right", "left", "key", "pos"
    )
    matched = written(ordered.mapInArrow(_neighbours, MATCHED), "matched")
    passages = matched.filter("hash is not null")
    several = passages.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.max("known").alias("known"))
    several = written(several.filter("known or least < most").select("hash"), "several")
    met = lookup_join(passages.filter("not known"), several, ["hash"], "left_semi", max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES)
    ranges = matched.filter("hash is null").union(met.select(matched.columns)).select(
        "key", F.struct((F.col("start") + 1).alias("start"), F.col("until").alias("last")).alias("r")
    )
    spans = ranges.groupBy("key").agg(F.collect_set("r").alias("ranges")).mapInArrow(_join_ranges, JOINED)
    found = texts.join(spans, "key", "left").select("key", "n", "spans")
    both = keyed.select("doc_id", "key", "n_words").join(found, "key", "left")
    whole = F.array(F.struct(F.lit(1).alias("start"), F.col("n_words").cast("int").alias("last")))
    none = F.array().cast("array<struct<start:int,last:int>>")
    return both.select(
        "doc_id", "n_words", F.when(F.col("n") > 1, whole).otherwise(F.coalesce("spans", none)).alias("spans")
    ).select(
        "doc_id", "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["start"] + 1).alias("n_repeated"),
        "spans",
    )


JOINED = "key long, spans array<struct<start:int,last:int>>"


def _join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of a text, put together where they meet. Each is a passage by itself."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("last", pa.int32())]))
    for batch in batches:
        out = []
        for ranges in batch.column(1).to_pylist():
            runs: list[dict[str, int]] = []
            for start, last in sorted((r["start"], r["last"]) for r in ranges):
                if runs and start <= runs[-1]["last"] + 1:
                    runs[-1]["last"] = max(runs[-1]["last"], last)
                else:
                    runs.append({"start": start, "last": last})
            out.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["key", "spans"])
