"""Scores of one Arrow batch against a bounded set of queries, with a running top list per query.

Spark splits and schedules the rows; each task keeps at most ``k`` hits per query and hands on only those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROUND = 6
CELLS = 4_000_000
DENSE_KEYS = 8192
# A matrix counts as full when one of so many cells is.
FILLED = 20


class TopLists:
    """The best ``k`` (score, id) per query seen so far; equal scores are ordered by id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.ids = [np.empty(0, dtype=object) for _ in range(queries)]
        self.scores = [np.empty(0) for _ in range(queries)]
        self.floor = np.zeros(queries)

    def offer(self, ids: pa.Array, at: np.ndarray, scores: np.ndarray, positive: bool) -> None:
        """``scores`` has a row for each place in ``at`` and a column per query; ``positive`` keeps scores above zero.

        Only the ids of rows that enter a list are taken out of the batch.
        """
        scores = np.round(scores, ROUND)
        good = scores >= self.floor if positive else np.ones_like(scores, dtype=bool)
        if positive:
            good &= scores > 0
        else:
            full = np.array([len(s) == self.k for s in self.scores])
            good[:, full] = scores[:, full] >= self.floor[full]
        entering = np.flatnonzero(good.any(axis=1))
        good, scores = good[entering], scores[entering]
        names = np.array(ids.take(pa.array(at[entering])).to_pylist(), dtype=object)
        for q in np.flatnonzero(good.any(axis=0)):
            rows = np.flatnonzero(good[:, q])
            all_ids = np.concatenate([self.ids[q], names[rows]])
            all_scores = np.concatenate([self.scores[q], scores[rows, q]])
            if len(all_ids) > self.k:
                # Everything above the k-th score stays; ids decide only among those that share it.
                bar = np.partition(all_scores, len(all_scores) - self.k)[len(all_scores) - self.k]
                sure = np.flatnonzero(all_scores > bar)
                tied = np.flatnonzero(all_scores == bar)
                tied = tied[np.argsort(all_ids[tied], kind="stable")][: self.k - len(sure)]
                keep = np.concatenate([sure, tied])
                all_ids, all_scores = all_ids[keep], all_scores[keep]
            self.ids[q], self.scores[q] = all_ids, all_scores
            if len(all_scores) == self.k:
                self.floor[q] = all_scores.min()

    def batch(self, query_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        counts = [len(s) for s in self.scores]
        which = np.repeat(np.arange(len(counts)), counts)
        ids = np.concatenate(self.ids) if counts else np.empty(0, dtype=object)
        columns = [
            query_ids.take(pa.array(which, pa.int64())),
            pa.array(list(ids), schema.field(1).type),
            pa.array(np.concatenate(self.scores) if counts else np.empty(0), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _row_blocks(lengths: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Cut rows into blocks of about ``CELLS / width`` entries, never less than a row."""
    limit = max(1, CELLS // max(1, width))
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield first, last
        first = last


def sparse_scorer(
    keys: pa.Array, weights: np.ndarray, query_ids: pa.Array, k: int, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score rows of ``id, array<struct<key, weight>>``. ``weights`` has a row per key and a column per query."""
    queries = weights.shape[1]
    which, asking = np.nonzero(weights)
    # With few keys that many queries share, a product of full matrices is faster than adding up the entries one by one.
    dense = len(keys) <= DENSE_KEYS and len(which) * FILLED >= weights.size
    # Else only what is not zero travels with the tasks: the queries of each key lie one after the other.
    given = weights[which, asking]
    shares = np.bincount(which, minlength=len(keys))
    begins = np.cumsum(shares) - shares
    full = weights if dense else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TopLists(queries, k)
        for batch in batches:
            entries = batch.column(1)
            flat = entries.flatten()
            place = pc.fill_null(pc.index_in(flat.field(0), value_set=keys), -1).to_numpy(zero_copy_only=False)
            value = flat.field(1).to_numpy(zero_copy_only=False)
            owner = np.repeat(
                np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(entries), 0).to_numpy(zero_copy_only=False)
            )
            known = place >= 0
            place, value, owner = place[known], value[known], owner[known]
            rows, starts, lengths = np.unique(owner, return_index=True, return_counts=True)
            if dense:
                blocks = _row_blocks(np.ones_like(lengths), len(keys))
            else:
                blocks = _row_blocks(np.add.reduceat(shares[place], starts) + queries if len(rows) else lengths, 1)
            for first, last in blocks:
                begin = starts[first]
                end = starts[last] if last < len(starts) else len(place)
                at = np.repeat(np.arange(last - first), lengths[first:last])
                if dense:
                    block = np.zeros((last - first, len(keys)))
                    np.add.at(block, (at, place[begin:end]), value[begin:end])
                    scores = block @ full
                else:
                    times = shares[place[begin:end]]
                    entry = np.repeat(begins[place[begin:end]] - np.cumsum(times) + times, times) + np.arange(times.sum())
                    cell = np.repeat(at, times) * queries + asking[entry]
                    part = np.repeat(value[begin:end], times) * given[entry]
                    scores = np.bincount(cell, weights=part, minlength=(last - first) * queries).reshape(-1, queries)
                best.offer(batch.column(0), rows[first:last], scores, True)
        yield best.batch(query_ids, schema)

    return run


def dense_scorer(
    queries: np.ndarray, query_ids: pa.Array, k: int, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score rows of ``id, array<float>`` by cosine. ``queries`` holds one unit vector per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TopLists(len(queries), k)
        for batch in batches:
            vectors = unit_rows(matrix(batch.column(1)))
            step = max(1, CELLS // max(1, len(queries)))
            for first in range(0, len(vectors), step):
                scores = vectors[first : first + step] @ queries.T
                best.offer(batch.column(0), np.arange(first, first + len(scores)), scores, False)
        yield best.batch(query_ids, schema)

    return run


def matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow list column as rows of a matrix; all vectors must have one length."""
    lengths = pc.list_value_length(vectors)
    if len(vectors) and (lengths.null_count or pc.min_max(lengths)["min"] != pc.min_max(lengths)["max"]):
        raise ValueError("vectors must all have the same length and none may be NULL")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def bucket_codes(planes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add to each row the bucket number of its vector (last column) in every table.

    ``planes`` has the shape tables x bits x dimensions; the sides of its planes on which a vector lies are the bits.
    """
    powers = 1 << np.arange(planes.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(batch.num_columns - 1))
            if not len(vectors):
                continue
            sides = np.einsum("nd,tbd->ntb", vectors, planes) >= 0
            codes = (sides * powers).sum(axis=2).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel(), pa.int32()), codes.shape[1])
            names = [*batch.schema.names, "codes"]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists.cast(pa.list_(pa.int32()))], names=names)

    return run


def _cut_blocks(coded: pa.DictionaryArray, no: np.ndarray, tf: np.ndarray, length: np.ndarray, size: int) -> pa.RecordBatch:
    """Postings to rows of up to ``size`` of one term, those that count most first, terms in order of appearance."""
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Very large counts share a place in the order, which scores don't depend on.
    place = code << 32 | (0xFFFF - np.minimum(tf, 0xFFFF)).astype(np.int64) << 16 | np.minimum(length, 0xFFFF)
    order = np.lexsort((no, place))
    code, no, tf, length = code[order], no[order], tf[order], length[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    inside = np.arange(len(code)) - np.repeat(starts, np.diff(np.r_[starts, len(code)]))
    first = np.flatnonzero(inside % size == 0)
    entries = pa.StructArray.from_arrays([pa.array(no, pa.int64()), pa.array(tf, pa.int32()), pa.array(length, pa.int32())], names=["no", "tf", "n_terms"])
    ends = np.r_[first, len(code)]
    return pa.RecordBatch.from_arrays(
        [
            coded.dictionary.take(pa.array(code[first])),
            pa.array(np.maximum.reduceat(tf, first), pa.int32()),
            pa.array(np.minimum.reduceat(length, first), pa.int32()),
            pa.array(np.diff(ends), pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries),
        ],
        names=["term", "max_tf", "min_terms", "chunks", "postings"],
    )


def _per_entry(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0 on in bytes of seven bits each, the last byte of each below 128, and how many bytes each has."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        sizes += values >> bits > 0
    begins = np.cumsum(sizes) - sizes
    out = np.empty(sizes.sum(), np.uint8)
    for n in range(sizes.max(initial=0)):
        long = np.flatnonzero(sizes > n)
        out[begins[long] + n] = (values[long] >> 7 * n & 127) | np.where(sizes[long] > n + 1, 128, 0)
    return out, sizes


def _from_varints(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    begins = np.r_[0, ends[:-1] + 1][: len(ends)]
    bits = 7 * (np.arange(len(data)) - np.repeat(begins, ends - begins + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << bits, begins) if len(ends) else np.empty(0, np.int64)


def _planes(chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each posting of packed blocks the place of its step, and how much later its count is, and its length after that."""
    starts, many = np.cumsum(chunks) - chunks, np.repeat(chunks, chunks).astype(np.int64)
    return np.arange(len(many)) + 2 * np.repeat(starts, chunks), many


def _packed(blocks: pa.RecordBatch) -> pa.RecordBatch:
    """Blocks with the least number of their postings as ``first``, and in ``packed`` the postings in order of number: each one's step from
    the one before, then all counts, then all lengths. A list of structs would take several times the bytes in a shuffle."""
    flat, block = blocks.column(4).flatten(), _per_entry(blocks.column(4))
    no, tf, length = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in range(3))
    order = np.lexsort((no, block))
    no, tf, length = no[order], tf[order], length[order]
    chunks = blocks.column(3).to_numpy(zero_copy_only=False)
    starts = np.cumsum(chunks) - chunks
    first = no[starts]
    step = np.diff(no, prepend=0)
    step[starts] = 0
    place, many = _planes(chunks)
    values = np.empty(3 * len(no), np.int64)
    values[place], values[place + many], values[place + 2 * many] = step, tf, length
    data, sizes = _varints(values)
    ends = np.r_[0, np.cumsum(sizes)[3 * np.cumsum(chunks) - 1]].astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(chunks), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([*blocks.columns[:4], pa.array(first, pa.int64()), packed], names=[*blocks.schema.names[:4], "first", "packed"])


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each posting of packed blocks its block, number, count and length."""
    chunks = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
    data = batch.column(5).combine_chunks() if isinstance(batch.column(5), pa.ChunkedArray) else batch.column(5)
    ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    values = _from_varints(np.frombuffer(data.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    place, many = _planes(chunks)
    step, tf, length = (values[place + n * many] for n in range(3))
    block = np.repeat(np.arange(len(chunks)), chunks)
    starts = np.cumsum(chunks) - chunks
    total = np.cumsum(step)
    no = batch.column(4).to_numpy(zero_copy_only=False)[block] + total - total[starts][block]
    return block, no, tf, length


def inverter(size: int, most: int = 1_000_000, packed: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``no, n_terms, terms`` to blocks of postings by term, ``packed`` for a shuffle.

    Rows are taken together until they have about ``most`` postings, so what is handed on has far fewer rows than there are postings.
    """

    def inverted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        numbers, lengths, terms = (pa.concat_arrays([b.column(n) for b in held]) for n in range(3))
        flat, owner = terms.flatten(), _per_entry(terms)
        no, length = (values.to_numpy(zero_copy_only=False)[owner] for values in (numbers, lengths))
        blocks = _cut_blocks(flat.field(0).dictionary_encode(), no, flat.field(1).to_numpy(zero_copy_only=False), length, size)
        return _packed(blocks) if packed else blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            held.append(batch)
            waiting += len(batch.column(2).flatten())
            if waiting >= most:
                yield inverted(held)
                held, waiting = [], 0
        if waiting:
            yield inverted(held)

    return run


def block_merger(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed blocks in order of term to plain ones, with the blocks of a term joined and cut anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                block, no, tf, length = _unpacked(batch)
                yield _cut_blocks(batch.column(0).take(pa.array(block)).dictionary_encode(), no, tf.astype(np.int32), length.astype(np.int32), size)

    return run


def sketcher(planes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``id, array<float>`` to the id and the sides of the planes on which the vector lies, a bit each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = matrix(batch.column(1)) @ planes.T >= 0 if batch.num_rows else np.zeros((0, len(planes)), bool)
            bits = np.packbits(sides, axis=1, bitorder="little")
            sketches = pa.array([row.tobytes() for row in bits], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sketches], names=[batch.schema.names[0], "sketch"])

    return run


def sketch_matrix(sketches: pa.Array) -> np.ndarray:
    values = sketches.to_pylist()
    return np.frombuffer(b"".join(values), "<u8").reshape(len(values), -1)


def sketch_scorer(
    asked: np.ndarray, query_ids: pa.Array, k: int, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score rows of ``id, sketch`` by the number of signs that differ, with a minus. ``asked`` has a sketch per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TopLists(len(asked), k)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = sketch_matrix(batch.column(1))
            step = max(1, CELLS // asked.size)
            for first in range(0, len(codes), step):
                part = codes[first : first + step]
                differ = np.zeros((len(part), len(asked)))
                for word in range(asked.shape[1]):
                    differ += np.bitwise_count(part[:, word, None] ^ asked[None, :, word])
                best.offer(batch.column(0), np.arange(first, first + len(part)), -differ, False)
        yield best.batch(query_ids, schema)

    return run
