"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of documents are dealt into shards of bounded size. Several islands evolve packings of one shard, each a row of a table: a
crossover injects whole well-filled bins of one packing into another, takes out the bins that hold the same pieces,
and best-fits the pieces that lost their place. Between epochs each island's best packing moves to the next island of its shard,
as a join. Bins that stay badly filled are dissolved, and their pieces of all shards are packed together in a next round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

CAPACITY = 4096
END_ID = 1
SHARD = 4096
ISLANDS, EPOCHS, POPULATION, CHILDREN = 3, 2, 5, 6
WELL_FILLED = 0.98
PROGRESS = 0.25
CACHED_CHUNKS = 600_000

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


# A run that is one word of these letters and perhaps marks after it. The tokenizer parts it into just these two.
SIMPLE = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,!?;:]*)")


def _byte_signs() -> list[str]:
    """The character by which the tokenizer writes each byte: printable ones as themselves, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class _Ids(dict):
    """Ids, as little-endian unsigned 32-bit numbers, by a run of text without blanks.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its runs one after the other. A simple run
    goes to the tokenizer's model as a lower-case word and marks; any other run takes the whole way.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.words: dict[str, bytes] = {}
        self.signs = _byte_signs()

    def __missing__(self, run: str) -> bytes:
        simple = SIMPLE.fullmatch(run)
        if simple:
            ids = self._part(simple[1].lower())
            if simple[2]:
                ids += self._part(simple[2])
        else:
            ids = np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes() if run else b""
        return _remember(self, run, ids)

    def _part(self, part: str) -> bytes:
        ids = self.words.get(part)
        if ids is None:
            signs = part if part.isascii() else "".join(self.signs[b] for b in part.encode())
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(signs)], "<u4").tobytes()
            _remember(self.words, part, ids)
        return ids


def _remember(known: dict[str, bytes], name: str, ids: bytes) -> bytes:
    if len(name) <= 64:
        if len(known) >= CACHED_CHUNKS:
            known.clear()
        known[name] = ids
    return ids


_known: dict[str, _Ids] = {}


def token_ids(text: str | None, file: str) -> bytes:
    """The ids of a text and the end id, as bytes; a null text counts as empty."""
    if file not in _known:
        _known[file] = _Ids(file)
    runs = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    return b"".join(map(_known[file].__getitem__, runs)) + np.array([END_ID], "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``row, doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``: documents as token ids, cut at ``CAPACITY``.

    ``row`` is a number that no other piece of the table has. A null or empty text is one piece of the end id alone.
    Repeated rows are documents of their own. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(value.as_py(), tokenizer)
                for number, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    part = ids[at : at + 4 * CAPACITY]
                    values = (row, name, number, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, v in zip(names, values):  # noqa: B905
                        out[column].append(v)
                    row += 1
            yield pa.RecordBatch.from_pydict(out, schema=kinds)

    kinds = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64())]
        + [("length", pa.int64()), ("ids_crc32", pa.int64())]
        + ([("ids", pa.binary())] if with_ids else [])
    )
    names = kinds.names
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(encode, PIECES + (", ids binary" if with_ids else ""))


class Bins:
    """Bins being filled. The free spaces are bits of one number, so the tightest bin that is wide enough is one shift away."""

    def __init__(self, fills: list[int]):
        self.fills, self.open, self.mask = list(fills), {}, 0
        for number, fill in enumerate(self.fills):
            self._offer(number, CAPACITY - fill)

    def _offer(self, number: int, space: int) -> None:
        if space > 0:
            self.open.setdefault(space, []).append(number)
            self.mask |= 1 << space

    def best_fit(self, length: int) -> int:
        wide = self.mask >> length
        if not wide:
            self.fills.append(length)
            self._offer(len(self.fills) - 1, CAPACITY - length)
            return len(self.fills) - 1
        space = length + (wide & -wide).bit_length() - 1
        number = self.open[space].pop()
        if not self.open[space]:
            self.mask ^= 1 << space
        self.fills[number] += length
        self._offer(number, space - length)
        return number


def packed(lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The bin of every piece when they are best-fitted in this order."""
    bins, out = Bins([]), np.zeros(len(lengths), np.int32)
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        out[i] = bins.best_fit(length)
    return out


def crossover(lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``mother`` with some of the best-filled bins of ``father`` put in whole."""
    fills = np.bincount(father, lengths)
    ranked = np.argsort(-fills + rng.random(len(fills)))[: max(1, len(fills) // 2)]
    chosen = np.zeros(len(fills), bool)
    chosen[rng.choice(ranked, max(1, len(ranked) // 4), replace=False)] = True
    injected = chosen[father]
    broken = np.zeros(mother.max() + 1, bool)
    broken[mother[injected]] = True
    return _refill(lengths, mother, broken, injected, father)


def mutation(lengths: np.ndarray, packing: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``packing`` with its worst-filled bins, and a few others, emptied and their pieces best-fitted anew."""
    fills = np.bincount(packing, lengths)
    broken = fills <= np.partition(fills, min(2, len(fills) - 1))[min(2, len(fills) - 1)]
    broken[rng.integers(0, len(fills), max(1, len(fills) // 50))] = True
    none = np.zeros(len(lengths), bool)
    return _refill(lengths, packing, broken, none, packing)


def _refill(lengths: np.ndarray, packing: np.ndarray, broken: np.ndarray, injected: np.ndarray, father: np.ndarray) -> np.ndarray:
    out = np.full(len(lengths), -1, np.int64)
    kept = ~broken[packing]
    n = 0
    for where, source in ((kept, packing), (injected, father)):
        if where.any():
            values, numbers = np.unique(source[where], return_inverse=True)
            out[where] = numbers + n
            n += len(values)
    placed = out >= 0
    bins = Bins(np.bincount(out[placed], lengths[placed], minlength=n).astype(int).tolist() if n else [])
    lost = np.nonzero(~placed)[0]
    lost = lost[np.argsort(-lengths[lost], kind="stable")]
    for i, length in zip(lost.tolist(), lengths[lost].tolist(), strict=True):
        out[i] = bins.best_fit(length)
    return out.astype(np.int32)


def worth(lengths: np.ndarray, packing: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then bins filled as unevenly as can be, which leaves room that can be used."""
    fills = np.bincount(packing, lengths)
    return -len(fills), float(np.mean((fills / CAPACITY) ** 2))


def evolved(lengths: np.ndarray, population: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """The population after one epoch, best first. It ends early at a packing that no other can beat."""
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // CAPACITY)
    if not population:
        # One packing in decreasing order, the others in orders that are disturbed the more the later they come.
        for k in range(POPULATION):
            population.append(packed(lengths, np.argsort(-lengths + rng.normal(0, 40 * k + 1e-9, len(lengths)), kind="stable")))
    ranked = sorted(population, key=lambda p: worth(lengths, p), reverse=True)
    for _ in range(CHILDREN):
        if ranked[0].max() + 1 <= least:
            break
        a, b = (min(rng.integers(0, len(ranked), 2)) for _ in range(2))
        child = crossover(lengths, ranked[a], ranked[b], rng) if a != b else mutation(lengths, ranked[a], rng)
        ranked = sorted([*ranked, child], key=lambda p: worth(lengths, p), reverse=True)[:POPULATION]
    return ranked


ISLAND = "shard long, island int, lengths binary, population array<binary>, bins int, square double"


def _epoch(number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                population = [np.frombuffer(p, "<i4") for p in row["population"]]
                seed = zlib.crc32(f"{row['shard']} {row['island']} {number}".encode())
                best = evolved(lengths, population, seed)
                bins, square = worth(lengths, best[0])
                out = [row["shard"], row["island"], row["lengths"], [p.astype("<i4").tobytes() for p in best], -bins, square]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v], t)
                        for v, t in zip(
                            out, (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int32(), pa.float64()), strict=True
                        )
                    ],
                    names=["shard", "island", "lengths", "population", "bins", "square"],
                )

    return run


PLACED = "shard long, bin int, fill long, row long, doc_id long, piece int, start long, length long, ids_crc32 long, offset long"


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, sorted items, best packing) to a row per piece with its bin, the bin's fill and the place in it."""
    for batch in batches:
        for row in batch.to_pylist():
            items, bins = row["items"], np.frombuffer(row["best"], "<i4")
            lengths = np.array([i["length"] for i in items], np.int64)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            first = np.r_[True, bins[order][1:] != bins[order][:-1]]
            before = np.maximum.accumulate(np.where(first, ends - lengths[order], 0))
            offset = np.empty(len(bins), np.int64)
            offset[order] = ends - lengths[order] - before
            fill = np.bincount(bins, lengths).astype(np.int64)[bins]
            columns = {name: [i[name] for i in items] for name in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * len(bins), pa.int64()), pa.array(bins, pa.int32()), pa.array(fill, pa.int64())]
                + [pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in columns.items()]
                + [pa.array(offset, pa.int64())],
                names=["shard", "bin", "fill", *columns, "offset"],
            )


def _as_ints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [np.array(v, "<i4").tobytes() for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.binary())], names=["shard", "lengths"])


def _round(small: DataFrame, shards: int, number: int) -> DataFrame:
    """One packing of all rows of ``small``, dealt over ``shards``. Each round, by its ``number``, deals and evolves in its own way."""
    deal = F.pmod(F.xxhash64("row", F.lit(shards), F.lit(number)), F.lit(shards))
    item = F.struct("length", "row", "doc_id", "piece", "start", "ids_crc32")
    dealt = small.select(deal.alias("shard"), item.alias("item")).groupBy("shard")
    dealt = written(dealt.agg(F.array_sort(F.collect_list("item")).alias("items")), "shards")
    lengths = dealt.select("shard", F.transform("items", lambda i: i["length"]).alias("l")).mapInArrow(
        _as_ints, "shard long, lengths binary"
    )
    numbers = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    islands = lengths.select(
        "shard", numbers.alias("island"), "lengths", F.array().cast("array<binary>").alias("population")
    )
    for epoch in range(EPOCHS):
        # One row is one island, and the islands are shared out singly.
        islands = islands.repartition(max(1, min(shards * ISLANDS, 20_000)), "shard", "island")
        islands = written(islands.select("shard", "island", "lengths", "population").mapInArrow(_epoch(number * EPOCHS + epoch), ISLAND), "islands")
        if epoch + 1 < EPOCHS:
            elite = islands.select(
                "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.element_at("population", 1).alias("elite")
            )
            islands = islands.join(elite, ["shard", "island"]).withColumn(
                "population", F.concat(F.array("elite"), F.slice("population", 1, POPULATION - 1))
            )
    rank = F.struct(-F.col("bins"), F.col("square"), -F.col("island"))
    best = islands.groupBy("shard").agg(F.max_by(F.element_at("population", 1), rank).alias("best"))
    return written(dealt.join(best, "shard").mapInArrow(_collect, PLACED), "placed")


def pack(cut: DataFrame, shard: int = SHARD) -> DataFrame:
    """A place for every row of ``pieces``: its columns, ``sequence_id`` and ``offset``. Sequences hold at most ``CAPACITY`` ids.

    A piece of the full length is a sequence of its own. The others go through rounds: in each, shards of about ``shard``
    pieces are packed, bins filled to ``WELL_FILLED`` are done, and the rest goes to the next round, until one shard holds what is
    left. Where the bins that are done hold less than ``PROGRESS`` of a round's pieces, small pieces to fill up the others are missing,
    and all bins of the round are taken. So the number of rounds grows with the logarithm of the number of pieces at most. No pieces give no rows. The number of shards follows the number of pieces, and a piece's shard its row
    number, so neither equal lengths nor copies gather anywhere.
    """
    cut = written(cut, "pieces")
    names = [c for c in cut.columns if c != "ids"]
    # Full pieces take the odd numbers. The others have 13 bits for the bin, 40 for the shard and the rest for the round.
    done = cut.filter(F.col("length") == CAPACITY).select(
        *names, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left, number = cut.filter(F.col("length") < CAPACITY).select(*names), 0
    while n := left.count():
        shards = -(-n // shard)
        placed = _round(left, shards, number)
        well = F.col("fill") >= WELL_FILLED * CAPACITY
        last = shards == 1 or placed.filter(well).count() < PROGRESS * n
        ready = placed if last else placed.filter(well)
        bin_number = F.lit(number << 53) + F.shiftleft(F.col("shard"), 13) + F.col("bin")
        done = done.unionByName(ready.select(*names, (bin_number * 2).alias("sequence_id"), "offset"))
        if last:
            break
        left, number = placed.filter(~well).select(*names), number + 1
    return done


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` (bytes): the packed sequences. ``with_ids`` is the table of pieces that was packed, with ids.

    A sequence is at most ``CAPACITY`` ids, so a group is small however many there are.
    """
    both = placed.select("row", "sequence_id", "offset").join(with_ids.select("row", "ids"), "row")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    text = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return both.groupBy("sequence_id").agg(text.alias("ids"))
