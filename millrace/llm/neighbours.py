"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, probed buckets, verified pairs.

Each table turns a vector by sign flips and Hadamard transforms and takes the nearest axis of the cross-polytope, several times over; these
axes together name the vector's home bucket. The next nearest combinations name buckets that it visits. Two vectors meet in a
table if one is at home or on a visit where the other is at home, and pairs that meet are compared exactly.

Equal vectors form one class before anything is compared. A bucket is dealt into blocks of bounded size, and pairs of blocks
are the units of work. A unit gives counts of links per class and a spanning set of links, never its pairs. A pair that meets in
several places is counted in the first of them only.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.session import written

THRESHOLD = 0.93
VISITS = 2
# The probability with which a pair exactly at the threshold may meet nowhere.
MISS = 1e-4
BLOCK = 512
ROUNDS = 3
NEAREST = 3
SEED = 20240229


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    n, half = x.shape[-1], 1
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return x / math.sqrt(n)


def _width(size: int) -> int:
    return max(2, 1 << (size - 1).bit_length())


def buckets(vectors: np.ndarray, axes: int, tables: int, visits: int = VISITS, seed: int = SEED) -> np.ndarray:
    """Codes of unit vectors, (row, table, place): first the home, then the ``visits`` next nearest combinations of ``axes`` axes.

    The nearest axis after the best is the one whose coordinate falls short by least; a combination costs the sum of squares.
    """
    size = _width(vectors.shape[1])
    padded = np.zeros((len(vectors), size))
    padded[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, axes, ROUNDS, size))
    near = min(NEAREST, size)
    ways = np.array(list(itertools.product(range(near), repeat=axes)))
    out = np.zeros((len(vectors), tables, min(visits + 1, len(ways))), np.int64)
    for table in range(tables):
        cost = np.zeros((len(vectors), len(ways)))
        code = np.zeros((len(vectors), len(ways)), np.int64)
        for axis in range(axes):
            turned = padded
            for flips in signs[table, axis]:
                turned = hadamard(turned * flips)
            best = np.argsort(-np.abs(turned), 1, kind="stable")[:, :near]
            value = np.take_along_axis(turned, best, 1)
            cost += ((np.abs(value[:, :1]) - np.abs(value)) ** 2)[:, ways[:, axis]]
            code = code * (2 * size) + (2 * best + (value < 0))[:, ways[:, axis]]
        order = np.argsort(cost, 1, kind="stable")[:, : out.shape[2]]
        out[:, table] = np.take_along_axis(code, order, 1)
    return out


def meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of codes (pair, table, place) the tables in which they meet, (pair, table)."""
    return (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)


def axes_for(rows: int, size: int) -> int:
    """So many axes that there are as many buckets as rows, and at most what a code holds."""
    sides = 2 * _width(size)
    return min(max(1, math.ceil(math.log(max(rows, 2)) / math.log(sides))), int(62 / math.log2(sides)), 6)


def tables_for(axes: int, size: int, threshold: float, visits: int = VISITS, miss: float = MISS) -> int:
    """So many tables that random pairs exactly at the threshold meet nowhere with a probability of at most ``miss``."""
    rng = np.random.default_rng(SEED)
    x, z = rng.normal(size=(2, 2000, max(size, 2)))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z
    met = meeting(buckets(x, axes, 1, visits), buckets(y, axes, 1, visits)).mean()
    return 1 if met >= 1 - miss else math.ceil(math.log(miss) / math.log1p(-max(met, 0.01)))


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles with a digest of label, size and value; neither for those that can't be compared."""
    for batch in batches:
        digests, values = [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            value = None
            if label is not None and vector.is_valid and len(vector) and not vector.values.null_count:
                found = np.asarray(vector.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
                # The largest component is taken out first, so that squares neither overflow nor vanish.
                top = np.abs(found).max()
                if np.isfinite(top) and top > 0:
                    value = found
            digests.append(None if value is None else xxhash.xxh128_digest(f"{len(label)}:{label}:{len(value)}:".encode() + value.tobytes()))
            values.append(None if value is None else value.astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
            names=["vec_id", "label", "digest", "vector"],
        )


def _unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(1)[:, None]
    return values / np.linalg.norm(values, axis=1)[:, None]


def _stacked(vectors: list[bytes]) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1))


LINKED = "class long, links long, other long"


def _links(
    homes: list[dict], others: list[dict], same: bool, at_home: bool, threshold: float, shape: tuple[int, int], at: int
) -> tuple[np.ndarray, ...]:
    """Pairs of ``homes`` and ``others``, which are at home too or visitors, at or above the threshold that meet in table ``at`` first."""
    x = _stacked([r["vector"] for r in homes])
    y = x if same else _stacked([r["vector"] for r in others])
    i, j = np.nonzero(x @ y.T >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    alike = np.array([homes[p]["label"] == others[q]["label"] for p, q in zip(i, j, strict=True)], bool)
    i, j = i[alike], j[alike]
    if not len(i):
        return i, j
    a = np.frombuffer(b"".join(r["codes"] for r in homes), "<i8").reshape(len(homes), *shape)
    b = a if same else np.frombuffer(b"".join(r["codes"] for r in others), "<i8").reshape(len(others), *shape)
    first = np.ones(len(i), bool)
    for low in range(0, len(i), 65_536):
        part = slice(low, low + 65_536)
        x, y = a[i[part]], b[j[part]]
        first[part] = ~meeting(x[:, :at], y[:, :at]).any(1)
        # Names of buckets are hashes, so the codes decide.
        if at_home:
            first[part] &= x[:, at, 0] == y[:, at, 0]
        else:
            # Two that visit each other's home are counted in the home of the lesser code.
            mutual = (x[:, at] == y[:, at, :1]).any(1) & (y[:, at, 0] < x[:, at, 0])
            first[part] &= (y[:, at, 1:] == x[:, at, :1]).any(1) & ~mutual
    return i[first], j[first]


def _forest(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    parent: dict[int, int] = {}

    def top(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    for a, b in pairs:
        p, q = top(a), top(b)
        if p != q:
            parent[max(p, q)] = min(p, q)
            yield a, b


def _compare(threshold: float, shape: tuple[int, int]):
    def linked(unit: list[dict]) -> Iterator[tuple[int, int, int | None]]:
        first = unit[0]
        low, high, homes = first["low"], first["high"], first["home_blocks"]
        # Blocks of homes come first, then those of visitors; the first of these is compared together with the homes alone.
        left = [r for r in unit if r["block"] == low]
        groups = [(left, True)] if low == high else []
        second = homes if low == high else high
        groups.append(([r for r in unit if r["block"] == second], second < homes))
        for right, at_home in groups:
            if not left or not right:
                continue
            i, j = _links(left, right, right is left, at_home, threshold, shape, first["at"])
            if not len(i):
                continue
            copies = [np.array([r["n"] for r in rows], np.int64) for rows in (left, right)]
            for rows, mine, theirs in ((left, i, copies[1][j]), (right, j, copies[0][i])):
                sums = np.zeros(len(rows), np.int64)
                np.add.at(sums, mine, theirs)
                for k in np.nonzero(sums)[0]:
                    yield rows[k]["class"], int(sums[k]), None
            for a, b in _forest((left[a]["class"], right[b]["class"]) for a, b in zip(i, j, strict=True)):
                yield a, 0, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit, so that each unit is in memory alone."""
        unit: list[dict] = []
        found: list[tuple[int, int, int | None]] = []

        def table() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["class", "links", "other"])

        for batch in batches:
            for row in batch.to_pylist():
                if unit and any(row[k] != unit[0][k] for k in ("bucket", "at", "low", "high")):
                    found.extend(linked(unit))
                    unit = []
                    if len(found) >= 10_000:
                        yield table()
                        found.clear()
                unit.append(row)
        if unit:
            found.extend(linked(unit))
        yield table()

    return run


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD,
    visits: int = VISITS, miss: float = MISS,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept, n_copies``.

    Vectors of equal labels and sizes link if their cosine, in doubles, is ``threshold`` or more. ``n_links`` is the number of other
    vectors linked directly, ``component_id`` the least id that links reach, ``kept`` whether that is the vector's own, ``n_copies`` the number of rows
    of its own label and value. ``threshold`` is above 0.

    A vector that is null, empty, zero, or holds nulls or non-finite components, and one without label, links with nothing: its component is its own id.
    Every row comes back; of repeated ids each row counts as a vector. A component whose ids are all null has a null id, and its rows count as kept, as do single rows
    without id. An empty table gives no rows. Other columns are ignored.

    The number of axes follows from the size of the largest label, and the number of tables from how often random pairs exactly
    at the threshold meet, so that all but ``miss`` of such pairs are found, and more of those above it.
    """
    given = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    prepared = written(given.mapInArrow(_prepared, "vec_id long, label string, digest binary, vector binary"), "vectors")
    grouped = prepared.filter("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("vector").alias("vector"), F.min("label").alias("label")
    )
    classes = written(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")
    size = F.expr("length(vector) div 8").alias("size")
    largest = classes.groupBy("label", size).agg(F.count(F.lit(1)).alias("rows")).groupBy("size").agg(F.max("rows").alias("rows"))
    parts = []
    # Labels may be many, sizes are those of the models that made the vectors.
    for found in largest.collect():
        own = classes.filter(F.expr("length(vector) div 8") == found["size"])
        axes = axes_for(found["rows"], found["size"])
        tables = tables_for(axes, found["size"], threshold, visits, miss)
        parts.append(_linked(own, found["size"], axes, tables, threshold, visits))
    linked = parts[0] if parts else vectors.sparkSession.createDataFrame([], LINKED)
    for more in parts[1:]:
        linked = linked.unionByName(more)
    linked = written(linked, "linked")
    counts = linked.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(linked.filter("other is not null").select("class", "other").distinct(), "class", "other")
    known = classes.select("class", "digest", "least", "n").join(joined, "class", "left").withColumn("place", F.coalesce("place", "class"))
    least = known.groupBy("place").agg(F.min("least").alias("component_id"))
    known = written(known.join(least, "place").join(counts, "class", "left").drop("place", "class", "least"), "joined")
    return prepared.select("vec_id", "digest").join(known, "digest", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("digest").isNull(), True).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        F.coalesce("n", F.lit(1)).cast("long").alias("n_copies"),
    )


def _linked(classes: DataFrame, size: int, axes: int, tables: int, threshold: float, visits: int) -> DataFrame:
    """``class, links, other`` of classes whose vectors have ``size`` components: counts of links, and a forest that joins what they join."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = buckets(_stacked(batch.column("vector").to_pylist()), axes, tables, visits)
            names = [
                [
                    # A bucket's name holds its label and table.
                    xxhash.xxh64_intdigest(f"{table}:{label}".encode(), seed=int(code)) - 2**63
                    for table, places in enumerate(row)
                    for code in places
                ]
                for label, row in zip(batch.column("label").to_pylist(), codes, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class"), batch.column("n"), batch.column("label"), batch.column("vector"),
                    pa.array([c.astype("<i8").tobytes() for c in codes], pa.binary()), pa.array(names, pa.list_(pa.int64())),
                ],
                names=["class", "n", "label", "vector", "codes", "names"],
            )

    coded = classes.select("class", "n", "vector", "label").mapInArrow(
        encode, "class long, n long, label string, vector binary, codes binary, names array<long>"
    )
    coded = written(coded, "codes")
    places = buckets(np.ones((1, size)), axes, 1, visits).shape[2]
    spots = coded.select("class", F.posexplode("names").alias("spot", "bucket")).select(
        "class", "bucket", F.expr(f"spot div {places}").cast("int").alias("at"), (F.col("spot") % places == 0).alias("home")
    )
    met = spots.groupBy("bucket", "at").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("members"))
    met = met.filter("homes > 0 and members > 1").select(
        "bucket",
        "at",
        F.ceil(F.col("homes") / BLOCK).cast("int").alias("home_blocks"),
        F.greatest(F.ceil((F.col("members") - F.col("homes")) / BLOCK), F.lit(1)).cast("int").alias("visit_blocks"),
    )
    # Homes have the blocks from 0 on, visitors those after them. A block of homes meets every other one and every block of visitors;
    # the first block of visitors comes along when homes are compared among themselves.
    own = F.when(F.col("home"), F.pmod(F.xxhash64("class"), F.col("home_blocks"))).otherwise(
        F.col("home_blocks") + F.pmod(F.xxhash64("class"), F.col("visit_blocks"))
    )
    first, last = F.lit(0), F.col("home_blocks") - 1
    others = F.when(
        F.col("home"),
        F.concat(F.sequence(first, last), F.slice(F.sequence(F.col("home_blocks"), last + F.col("visit_blocks")), F.lit(2), F.col("visit_blocks"))),
    ).otherwise(F.sequence(first, last))
    dealt = spots.join(met, ["bucket", "at"]).withColumn("block", own.cast("int")).withColumn("other", F.explode(others))
    early = ~F.col("home") & (F.col("block") == F.col("home_blocks"))
    dealt = dealt.select(
        "class", "bucket", "at", "block", "home_blocks",
        F.when(early, F.col("other")).otherwise(F.least("block", "other")).alias("low"),
        F.when(early, F.col("other")).otherwise(F.greatest("block", "other")).alias("high"),
    )
    units = dealt.join(coded.drop("names"), "class").repartition("bucket", "at", "low", "high")
    units = units.sortWithinPartitions("bucket", "at", "low", "high")
    columns = ["class", "bucket", "at", "block", "home_blocks", "low", "high", "n", "label", "vector", "codes"]
    return units.select(*columns).mapInArrow(_compare(threshold, (tables, places)), LINKED)
