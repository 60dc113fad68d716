"""Sparse text vectors by signed feature hashing, one Arrow batch at a time.

A term is hashed once per batch and not once per occurrence, which is why this is not a built-in expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DIMENSIONS = 1024
# Values that cancel out leave no more than this.
NOTHING = 1e-12
CODE_ZERO = 1 << 15

Batches = Iterator[pa.RecordBatch]
VECTOR = pa.list_(pa.struct([("dim", pa.int32()), ("value", pa.float64())]))
COUNTS = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int32())]))


def _owners(lists: pa.Array) -> np.ndarray:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths)


def _lists(owner: np.ndarray, rows: int, values: list[pa.Array], kind: pa.ListType) -> pa.ListArray:
    """Entries of rows in order as one list per row."""
    ends = np.cumsum(np.bincount(owner, minlength=rows))
    entries = pa.StructArray.from_arrays(values, names=[f.name for f in kind.value_type])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), entries).cast(kind)


def _summed(owner: np.ndarray, dim: np.ndarray, value: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row times ``dims`` plus dimension) in order, and the sum at each."""
    places, which = np.unique(owner * dims + dim, return_inverse=True)
    return places, np.bincount(which, weights=value, minlength=len(places))


def places(names: list[str], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimension and the sign of each term."""
    digests = b"".join(md5(term.encode()).digest() for term in names)
    words = np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)
    return words[:, 0] % dims, np.where((words[:, 1] >> 28) % 2 == 0, 1.0, -1.0)


def coder(known) -> Callable[[Batches], Batches]:
    """The last column, a list of (term, tf), as the codes of its known terms in order and their counts (two plain lists, which are short in files
    and in a shuffle), and the list of the others.

    ``known`` is a broadcast of the codes by term. Codes are kept as ``CODE_ZERO`` less, in 16 bits.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            terms = batch.column(batch.num_columns - 1)
            flat, owner = terms.flatten(), _owners(terms)
            coded = flat.field(0).dictionary_encode()
            code = np.array([known.value.get(term, -1) for term in coded.dictionary.to_pylist()], np.int64)
            code = code[coded.indices.to_numpy(zero_copy_only=False)]
            near, far = np.flatnonzero(code >= 0), np.flatnonzero(code < 0)
            near = near[np.lexsort((code[near], owner[near]))]
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(owner[near], minlength=batch.num_rows))].astype(np.int32))
            codes = pa.array(code[near] - CODE_ZERO).cast(pa.int16())
            lists = [pa.ListArray.from_arrays(ends, values) for values in (codes, flat.field(1).take(pa.array(near)))]
            others = _lists(owner[far], batch.num_rows, [flat.field(0).take(pa.array(far)), flat.field(1).take(pa.array(far))], COUNTS)
            columns = [*batch.columns[:-1], *lists, others]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_codes", "_counts", "_far"])

    return run


def finisher(known, dims: int) -> Callable[[Batches], Batches]:
    """The last three columns, lists of codes, of their counts and of more (dim, value), as the unit vector of all sums in order of dimension.

    ``known`` is a broadcast of two arrays by code: the dimension, and the weight with the sign.
    """

    def run(batches: Batches) -> Batches:
        dim_of, weight_of = known.value
        for batch in batches:
            codes, counts, rest = batch.columns[-3:]
            flat = rest.flatten()
            code = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + CODE_ZERO
            dim = np.concatenate([dim_of[code], flat.field(0).to_numpy(zero_copy_only=False)])
            value = np.concatenate([weight_of[code] * counts.flatten().to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)])
            owner = np.concatenate([_owners(codes), _owners(rest)])
            places, total = _summed(owner, dim.astype(np.int64), value, dims)
            places, total = places[np.abs(total) > NOTHING], total[np.abs(total) > NOTHING]
            rows = places // dims
            length = np.sqrt(np.bincount(rows, weights=total * total, minlength=batch.num_rows))
            unit = _lists(rows, batch.num_rows, [pa.array((places % dims).astype(np.int32)), pa.array(total / length[rows])], VECTOR)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], unit], names=[*batch.schema.names[:-3], "vector"])

    return run
