"""Cross-tokenizer alignment: the ends of two tokenizers' tokens, merged in independent pieces of equal work.

A text's tokens by A and by B each cut the same bytes into parts. Merging the two sorted lists of ends gives it all: where both have
an end, a group of tokens closes, and every end stands for the one overlap of an A and a B token that ends there. The merge
is cut along diagonals: a binary search finds how many ends of A and of B are among the first so many, so each piece has
the same number of steps however long the text is, and is a row of its own. Pieces emit overlaps and closed groups; what is open
at a piece's borders is stitched together with its neighbours.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import _byte_signs
from millrace.session import new_path

# Steps of a piece of the merge.
PIECE = 32_768
# Frequent id pairs hold at least one of so many links, so there are at most so many. Their counts are broadcast.
HEAD = 1 << 18
# Runs of blanks and the letters after them, kept with their tokens; characters that are encoded together.
CACHED, CACHED_CHARS, STRETCH = 500_000, 48, 1_000_000
PAIRS_AT_ONCE = 2_000_000

RUN = re.compile(r"[ \n\t]*[^ \n\t]+|[ \n\t]+")
OTHER_BLANK = re.compile(r"[^\S \n\t]")
# Fixed value: the published pattern by which byte-level files of this kind part a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BORDER = re.compile(r"(?<=[^ \n\t])(?=[ \n\t])")


class Tokenizers:
    """A byte-level BPE file (A) and a sentencepiece model (B), with the bytes of each of their tokens.

    Where the files allow it, runs of blanks with the letters after them are encoded once and kept: no token crosses from a letter to a
    blank. A parts its text there by its pattern, and no piece of B holds a letter and then a blank, so no merge can join them. Texts with other
    blanks than spaces, line ends and tabs, and all texts if the files are of another kind, are encoded whole.
    """

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte = {sign: b for b, sign in enumerate(_byte_signs())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.b_bytes = [self._b_entry(k) for k in range(len(self.b))]
        self.a_lengths, self.b_lengths = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.kind = "H" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "I"
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes | None] = {}
        model = sentencepiece_model_pb2.ModelProto()
        with open(b_file, "rb") as file:
            model.ParseFromString(file.read())
        with open(a_file, encoding="utf-8") as file:
            given = json.load(file)
        self.splits = _splits(given, model)
        self.joins = self._by_rank(given["model"]) if self.splits else None
        self.blank = self.b.piece_to_id("▁")

    def _by_rank(self, model: dict):
        """A's merges for an encoder that joins any two neighbours whose bytes are an entry, the entry of least id first; None if that may differ.

        It can't if each merge makes the next id out of lesser ones and every entry, taken alone, is merged to itself: when an entry's turn comes, its
        bytes are then in just the two parts that its merge joins, whatever stands around them.
        """
        import tiktoken

        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        vocab, first = model["vocab"], len(model["vocab"]) - len(pairs)
        ordered = all(vocab[x + y] == first + k > max(vocab[x], vocab[y]) for k, (x, y) in enumerate(pairs))
        if not ordered or any([t.id for t in self.a.model.tokenize(entry)] != [number] for entry, number in vocab.items()):
            return None
        ranks = {self.a_bytes[number]: number for number in vocab.values()}
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _b_entry(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def _spelt(self, text: bytes, a: list[int], b: list[int]) -> bool:
        """Whether both lists of tokens spell ``text``."""
        return b"".join(map(self.a_bytes.__getitem__, a)) == text == b"".join(map(self.b_bytes.__getitem__, b))

    def _learn(self, runs: list[str]) -> None:
        """Encode new runs. What B doesn't spell is kept as None."""
        self._learn_a(runs)
        theirs = self.b.encode([r[1:] if r[0] == " " else r for r in runs], num_threads=1)
        spell, kind = self.b_bytes.__getitem__, self.kind
        for run, b in zip(runs, theirs, strict=True):
            if run == " ":
                b = [self.blank]
            elif run[0] != " ":
                # B puts a blank before what it is given.
                b = b[1:] if b[:1] == [self.blank] else []
            self.known_b[run] = array(kind, b).tobytes() if b"".join(map(spell, b)) == run.encode() else None

    def _learn_a(self, runs: list[str]) -> None:
        if not self.joins:
            for run, found in zip(runs, self.a.encode_batch(runs, add_special_tokens=False), strict=True):
                self.known_a[run] = array(self.kind, found.ids).tobytes()
            return
        # One call for all runs that end in a letter: they part from the next one's blanks.
        ends_open = [r for r in runs if r.isspace()]
        for run in ends_open:
            self.known_a[run] = array(self.kind, self.joins.encode_ordinary(run)).tobytes()
        rest = [r for r in runs if not r.isspace()] if ends_open else runs
        ids = np.array(self.joins.encode_ordinary("".join(rest)), np.int64)
        sizes = np.cumsum([len(r.encode()) for r in rest])
        cuts = np.searchsorted(np.cumsum(self.a_lengths[ids]), sizes, "right").tolist()
        flat, width, low = array(self.kind, ids.tolist()).tobytes(), array(self.kind).itemsize, 0
        for run, high in zip(rest, cuts, strict=True):
            self.known_a[run] = flat[low * width : high * width]
            low = high

    def _whole(self, text: str) -> tuple[bytes, bytes] | None:
        spaced = " " + text
        a, b = self.a.encode(spaced, add_special_tokens=False).ids, self.b.encode(text, num_threads=1)
        return (array(self.kind, a).tobytes(), array(self.kind, b).tobytes()) if self._spelt(spaced.encode(), a, b) else None

    def encode(self, text: bytes | None) -> tuple[bytes, bytes] | None:
        """Ids of a space and the text by A, and of the text by B, as bytes. None without text, or if one doesn't spell it."""
        try:
            said = (text or b"").decode()
        except UnicodeDecodeError:
            return None
        if not said:
            return None
        if not self.splits or OTHER_BLANK.search(said):
            return self._whole(said)
        parts_a, parts_b = [], []
        at, spaced = 0, " " + said
        while at < len(spaced):
            end = BORDER.search(spaced, at + STRETCH) if len(spaced) - at > STRETCH else None
            upto = end.start() if end else len(spaced)
            runs = RUN.findall(spaced, at, upto)
            at = upto
            new = set(runs).difference(self.known_b)
            if new:
                if len(self.known_b) > CACHED:
                    self.known_a.clear()
                    self.known_b.clear()
                    new = set(runs)
                self._learn(list(new))
            try:
                parts_a.append(b"".join(map(self.known_a.__getitem__, runs)))
                parts_b.append(b"".join(map(self.known_b.__getitem__, runs)))
            except TypeError:
                return self._whole(said)
            finally:
                for run in [r for r in new if len(r) > CACHED_CHARS]:
                    del self.known_a[run], self.known_b[run]
        return b"".join(parts_a), b"".join(parts_b)


def _splits(a: dict, b) -> bool:
    """Whether both tokenizers part texts before a space, line end or tab that follows another character."""
    shaped = a.get("normalizer") is None and a.get("post_processor") is None and a["model"]["type"] == "BPE"
    parted = a.get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    spec = b.normalizer_spec
    plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
    bpe = b.trainer_spec.model_type == b.trainer_spec.BPE and not b.trainer_spec.treat_whitespace_as_suffix
    kinds = type(b.pieces[0])
    given = any(p.type == kinds.USER_DEFINED for p in b.pieces)
    crossing = any(
        (y == "▁" and x != "▁") or y in " \n\t" or x in " \n\t"
        for p in b.pieces if p.type == kinds.NORMAL
        for x, y in zip(p.piece, p.piece[1:])  # noqa: B905
    )
    return bool(shaped and parted and plain and bpe) and not given and not crossing


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_file: str, b_file: str) -> Tokenizers:
    if (a_file, b_file) not in _loaded:
        _loaded[a_file, b_file] = Tokenizers(a_file, b_file)
    return _loaded[a_file, b_file]


def diagonals(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """How many ends of ``a`` and of ``b`` come before each border of the merge's pieces, first and last included.

    A piece has ``size`` steps, or one more or less so that equal ends stay in one piece. All borders are searched at once.
    """
    d = np.arange(size, len(a) + len(b), size)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        ahead = np.zeros(len(d), bool)
        ahead[open_] = a[mid[open_]] <= b[(d - mid - 1)[open_]]
        low, high = np.where(open_ & ahead, mid + 1, low), np.where(open_ & ~ahead, mid, high)
    other = d - low
    split = (low > 0) & (other < len(b))
    split[split] = a[low[split] - 1] == b[other[split]]
    return [(0, 0), *zip(low.tolist(), (other + split).tolist(), strict=True), (len(a), len(b))]


PIECES = "row long, doc_id long, piece int, n_pieces int, a_from long, b_from long, a binary, b binary, a_next int, b_next int"


def pieces(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """Documents as token ids, cut along diagonals into rows of ``size`` steps; one empty row for a text without tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(a_file, b_file)
        row = TaskContext.get().partitionId() << 40
        out: dict[str, list] = {f.name: [] for f in kinds}
        held = 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = known.encode(value.as_py()) or (b"", b"")
                a, b = (np.frombuffer(x, f"<u{width}") for x in ids)
                ends = np.cumsum(known.a_lengths[a]), np.cumsum(known.b_lengths[b])
                borders = diagonals(*ends, size)
                for number, ((i, j), (k, m)) in enumerate(zip(borders, borders[1:])):  # noqa: B905
                    values = (
                        row, name, number, len(borders) - 1, int(ends[0][i - 1]) if i else 0, int(ends[1][j - 1]) if j else 0,
                        a[i:k].tobytes(), b[j:m].tobytes(), int(a[k]) if k < len(a) else -1, int(b[m]) if m < len(b) else -1,
                    )
                    for column, v in zip(out.values(), values, strict=True):
                        column.append(v)
                    held += len(values[6]) + len(values[7])
                row += 1
                if held > 1 << 22:
                    yield pa.RecordBatch.from_pydict(out, schema=kinds)
                    out, held = {f.name: [] for f in kinds}, 0
        yield pa.RecordBatch.from_pydict(out, schema=kinds)

    whole, small = pa.int64(), pa.int32()
    kinds = pa.schema(
        [("row", whole), ("doc_id", whole), ("piece", small), ("n_pieces", small), ("a_from", whole), ("b_from", whole)]
        + [("a", pa.binary()), ("b", pa.binary()), ("a_next", small), ("b_next", small)]
    )
    width = array(tokenizers(a_file, b_file).kind).itemsize
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return given.mapInArrow(encode, PIECES)


def _digits(n: int) -> np.ndarray:
    """Each number below ``n`` as decimal digits, padded in front by zero bytes, with room for a sign after them."""
    width = len(str(max(n - 1, 0)))
    return np.array([list(str(k).encode().rjust(width, b"\0")) + [0] for k in range(n)], np.uint8)


class Merged:
    """One piece: its links as id pairs with counts, and the text of its groups."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends: tuple[np.ndarray, np.ndarray], following: tuple[int, int], n_b: int):
        both = np.sort(np.concatenate(ends), kind="stable")
        twice = both[1:] == both[:-1]
        self.cuts = both[1:][twice]
        distinct = both[np.concatenate([[True], ~twice])] if len(both) else both
        # Past the piece's last token of a side, the side's next token covers an end.
        at_a, at_b = (np.append(x, max(f, 0)).astype(np.int64)[np.searchsorted(e, distinct)] for x, e, f in zip((a, b), ends, following))  # noqa: B905
        self.n_links = len(distinct)
        self.keys, self.counts = np.unique(at_a * n_b + at_b, return_counts=True)
        self.a, self.b, self.ends = a, b, ends

    def text(self, digits: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, ...]:
        """``head of A, head of B, closed groups, tail of A, tail of B``: the first group may go on from the piece before, the tail is open.

        Without cuts all is head. Every number is followed by its sign: a comma, or after the last of a closed group's side a bar or semicolon.
        """
        at = [np.searchsorted(self.cuts, e) for e in self.ends]
        counts = [np.bincount(g, minlength=len(self.cuts) + 1) for g in at]
        place_a = np.arange(len(self.a)) + (np.cumsum(counts[1]) - counts[1])[at[0]]
        place_b = np.arange(len(self.b)) + np.cumsum(counts[0])[at[1]]
        out = np.zeros((len(self.a) + len(self.b), max(d.shape[1] for d in digits)), np.uint8)
        for ids, table, place, g, sign in zip((self.a, self.b), digits, (place_a, place_b), at, b"|;"):  # noqa: B905
            if not len(ids):
                continue
            rows = table[ids]
            last = np.append(g[1:] != g[:-1], True) & (g < len(self.cuts))
            rows[:, -1] = np.where(last, sign, ord(","))
            out[place, out.shape[1] - table.shape[1] :] = rows

        def spelt(low: int, high: int) -> bytes:
            flat = out[low:high].ravel()
            return flat[flat != 0].tobytes()

        n_a, n_b = counts
        first = (int(n_a[0]), int(n_a[0] + n_b[0]))
        if not len(self.cuts):
            return spelt(0, first[0]), spelt(*first), b"", b"", b""
        tail = len(out) - int(n_a[-1] + n_b[-1])
        return spelt(0, first[0]), spelt(*first), spelt(first[1], tail), spelt(tail, tail + int(n_a[-1])), spelt(tail + int(n_a[-1]), len(out))


MERGED = (
    "row long, doc_id long, piece int, n_pieces int, n_a long, n_b long, n_groups long, n_links long, keys binary, counts binary, "
    "groups_sha256 string, head_a binary, head_b binary, closed binary, tail_a binary, tail_b binary"
)


def merged(cut: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Each piece's counts, its links by id pair, and its groups: a digest if the piece is all of its text, else what ``stitched`` needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(a_file, b_file)
        width = array(known.kind).itemsize
        digits = _digits(len(known.a_bytes)), _digits(len(known.b_bytes))
        names = [f.split()[0] for f in MERGED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 2, pa.string(), *[pa.binary()] * 5]
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[x], f"<u{width}") for x in "ab")
                ends = r["a_from"] + np.cumsum(known.a_lengths[a]), r["b_from"] + np.cumsum(known.b_lengths[b])
                piece = Merged(a, b, ends, (r["a_next"], r["b_next"]), len(known.b_bytes))
                head_a, head_b, closed, tail_a, tail_b = piece.text(digits)
                digest = None
                if r["n_pieces"] == 1:
                    digest = hashlib.sha256((head_a + head_b + closed)[:-1]).hexdigest() if len(a) else ""
                    head_a = head_b = closed = tail_a = tail_b = None
                values = (
                    r["row"], r["doc_id"], r["piece"], r["n_pieces"], len(a), len(b), len(piece.cuts), piece.n_links,
                    piece.keys.astype("<i8").tobytes(), piece.counts.astype("<u4").tobytes(), digest, head_a, head_b, closed, tail_a, tail_b,
                )
                for column, v in zip(columns, values, strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return cut.mapInArrow(run, MERGED)


def stitched(parts: DataFrame) -> DataFrame:
    """``row, groups_sha256`` of texts in several pieces. A text's pieces are read one after the other, and only an open group is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, digest, open_a, open_b = None, None, b"", b""
        out: tuple[list, list] = ([], [])

        def put(groups: bytes) -> None:
            if groups:
                digest.update((b";" if started else b"") + groups)

        for batch in batches:
            for r in batch.to_pylist():
                if r["row"] != row:
                    if row is not None:
                        out[0].append(row)
                        out[1].append(digest.hexdigest())
                    row, digest, open_a, open_b, started = r["row"], hashlib.sha256(), b"", b"", False
                # A head's last signs are a bar and a semicolon if its group closes here, else commas.
                open_a += r["head_a"]
                open_b += r["head_b"]
                if r["n_groups"]:
                    put(open_a[:-1] + b"|" + open_b[:-1])
                    started = True
                    put(r["closed"][:-1])
                    open_a, open_b = r["tail_a"], r["tail_b"]
        if row is not None:
            out[0].append(row)
            out[1].append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], names=["row", "groups_sha256"])

    columns = ["row", "piece", "n_groups", "head_a", "head_b", "closed", "tail_a", "tail_b"]
    sorted_ = parts.filter("n_pieces > 1").select(*columns).repartition("row").sortWithinPartitions("row", "piece")
    return sorted_.mapInArrow(run, "row long, groups_sha256 string")


def pair_counts(parts: DataFrame, n_b: int) -> DataFrame:
    """``key, n, best``: over all texts, how many links hold an id pair, and whether no pair of its B id has more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in held]) if held else np.zeros(0, np.int64)
            weights = np.concatenate([n for _, n in held]) if held else np.zeros(0, np.int64)
            known, at = np.unique(keys, return_inverse=True)
            total = np.zeros(len(known), np.int64)
            np.add.at(total, at, weights)
            return pa.RecordBatch.from_arrays([pa.array(known, pa.int64()), pa.array(total, pa.int64())], names=["key", "n"])

        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                held.append((np.frombuffer(keys.as_py(), "<i8"), np.frombuffer(counts.as_py(), "<u4").astype(np.int64)))
                size += len(held[-1][0])
                if size >= PAIRS_AT_ONCE:
                    yield summed()
                    held, size = [], 0
        yield summed()

    counts = _written(parts.select("keys", "counts").mapInArrow(add, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts")
    # One row per B id: as many as its vocabulary has.
    b = (F.col("key") % n_b).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    named = counts.select("key", "n", b).join(F.broadcast(most), "b")
    return _written(named.select("key", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


SUMS = "row long, n_best long, count_sum long, tail array<struct<key:long,n:long>>"


def _summed(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``row, n_best, count_sum`` of each text. Counts of frequent pairs are broadcast, those of all others are joined by pair."""
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * HEAD >= total
    # At most HEAD rows of three numbers.
    found = sorted(tuple(r) for r in pairs.filter(often).select("key", "n", "best").collect())
    head = tuple(np.array([r[k] for r in found], kind) for k, kind in enumerate((np.int64, np.int64, bool)))
    shared = parts.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        kind = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            n_best, sums, tails = [], [], []
            for keys, occurring in zip(batch.column(1), batch.column(2), strict=True):
                k = np.frombuffer(keys.as_py(), "<i8")
                n = np.frombuffer(occurring.as_py(), "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(known, k), max(len(known) - 1, 0))
                seen = known[at] == k if len(known) else np.zeros(len(k), bool)
                n_best.append(int(n[seen][best[at[seen]]].sum()))
                sums.append(int((n[seen] * counts[at[seen]]).sum()))
                tails.append([{"key": x, "n": y} for x, y in zip(k[~seen].tolist(), n[~seen].tolist(), strict=True)])
            columns = [batch.column(0), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), pa.array(tails, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_best", "count_sum", "tail"])

    sums = _written(parts.select("row", "keys", "counts").mapInArrow(run, SUMS), "sums")
    tail = sums.select("row", F.explode("tail").alias("t")).select("row", "t.key", F.col("t.n").alias("times"))
    rare = tail.join(pairs.filter(~often), "key").select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")
    )
    return sums.drop("tail").unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _written(df: DataFrame, label: str) -> DataFrame:
    """Written in small row groups, so that rows of one text are read by several tasks, and packed tightly."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text is aligned with a space before it. A null or empty text, and one whose tokens by A or by B don't spell it, has no tokens: zeros
    and an empty digest. Repeated rows are aligned each, and count each in the counts over all texts. Null ids stay null. An empty
    table gives no rows. Other columns are ignored. A very long text is encoded a stretch at a time where the tokenizers allow it, and merged in
    pieces of ``size`` steps. The largest count of a B id may be shared by several pairs, and links of all of them count.
    """
    known = tokenizers(a_file, b_file)
    cut = _written(pieces(docs, a_file, b_file, doc_id, text, size), "pieces")
    parts = _written(merged(cut, a_file, b_file), "merged")
    sums = _summed(parts, pair_counts(parts, len(known.b_bytes)))
    counted = [F.sum(c).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    whole = parts.groupBy("row").agg(F.min("doc_id").alias("doc_id"), *counted, F.min("groups_sha256").alias("own"))
    joined = whole.join(sums, "row").join(stitched(parts), "row", "left")
    return joined.withColumn("groups_sha256", F.coalesce("groups_sha256", "own")).drop("own")
