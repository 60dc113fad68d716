"""Quality by attention over passages: a small network scores a document from all of its passages.

Every passage is encoded by the same learned layer. A gated attention gives each a weight, learned from labels of whole
documents, and the document's score comes from the weighted mean of its passages. Several such networks, which start from
different weights, are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSAGE = 1_024  # bytes
SLAB = 256  # passages that are encoded at once
SAMPLE, SAMPLE_PASSAGES = 1_500, 12
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE = 30, 64, 0.01
SEEDS = (7, 8, 9)
# Inputs are measured in standard deviations, up to so many.
FAR = 4
CUT = 0.3

# The kinds of bytes: the letters that are frequent in European languages by themselves, other bytes by what they are.
_GROUPS = [b" ", b"\n\t\r", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:'\"()-", b"#*$%&|<>", b"!?", b"e", b"a", b"i", b"o"]
_GROUPS += [b"un", b"tsr", b"dlmcp", b"bfghjkqvwxyz"]
N_KINDS = len(_GROUPS) + 1
KIND = np.full(256, N_KINDS - 1, np.int64)
for _number, _bytes in enumerate(_GROUPS):
    KIND[list(_bytes)] = _number
WIDTH = N_KINDS + N_KINDS * N_KINDS + 2


def encoded(text: str | None, only: int | None = None) -> Iterator[np.ndarray]:
    """The passages of a whole text as vectors, a bounded number at a time; a text without bytes is one empty passage.

    A vector has the shares of the kinds of bytes, the roots of the shares of their pairs, how often the pairs repeat, and the
    share of different byte quartets. With ``only``, so many passages at most are taken, evenly spread.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-len(data) // PASSAGE))
    chosen = np.arange(n) if only is None or n <= only else np.unique(np.linspace(0, n - 1, only).astype(np.int64))
    for at in range(0, len(chosen), SLAB):
        part = chosen[at : at + SLAB]
        block = np.zeros((len(part), PASSAGE), np.uint8)
        sizes = np.zeros(len(part), np.int64)
        for row, number in enumerate(part):
            piece = data[number * PASSAGE : (number + 1) * PASSAGE]
            block[row, : len(piece)] = piece
            sizes[row] = len(piece)
        kinds = KIND[block]
        rows = np.arange(len(part))[:, None]
        inside = np.arange(PASSAGE)[None, :] < sizes[:, None]
        singles = np.bincount((kinds + rows * N_KINDS)[inside], minlength=len(part) * N_KINDS).reshape(len(part), -1)
        codes = kinds[:, :-1] * N_KINDS + kinds[:, 1:]
        pairs = np.bincount((codes + rows * N_KINDS**2)[inside[:, 1:]], minlength=len(part) * N_KINDS**2).reshape(len(part), -1)
        whole = np.maximum(sizes, 1)[:, None]
        shares = pairs / np.maximum(sizes - 1, 1)[:, None]
        quartets = block[:, :-3].astype(np.uint32)
        for k in range(1, 4):
            quartets = quartets << 8 | block[:, k : PASSAGE - 3 + k]
        quartets = np.sort(quartets, axis=1)
        different = 1 + (quartets[:, 1:] != quartets[:, :-1]).sum(1)
        yield np.hstack(
            [singles / whole, np.sqrt(shares), (shares**2).sum(1, keepdims=True) * 4, (different / whole[:, 0])[:, None]]
        ).astype(np.float32)


@dataclass(frozen=True)
class Attention:
    """The weights of each network's encoder, gated attention and score, and the mean and spread of the inputs."""

    members: list[dict[str, np.ndarray]]
    mean: np.ndarray
    spread: np.ndarray

    def inputs(self, passages: np.ndarray) -> np.ndarray:
        return np.clip((passages - self.mean) / self.spread, -FAR, FAR)

    def score(self, text: str | None) -> float:
        """Between 0 and 1. Only the encoded passages and their attention are kept while a text is read."""
        parts: list[list[np.ndarray]] = [[] for _ in self.members]
        for passages in encoded(text):
            x = self.inputs(passages)
            for w, part in zip(self.members, parts, strict=True):
                part.append(np.tanh(x @ w["E"] + w["e"]))
        scores = []
        for w, part in zip(self.members, parts, strict=True):
            h = np.vstack(part)
            s = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]
            a = np.exp(s - s.max())
            scores.append(float(_sigmoid((a / a.sum()) @ h @ w["c"] + w["c0"][0])))
        return sum(scores) / len(scores)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(bags: list[np.ndarray], labels: np.ndarray, seeds: tuple[int, ...] = SEEDS) -> Attention:
    """A network per seed, over inputs brought to one scale. With one label alone, or none, the score is constant."""
    every = np.vstack(bags) if bags else np.zeros((1, WIDTH), np.float32)
    model = Attention([], every.mean(0), every.std(0) + 1e-3)
    scaled = [model.inputs(b) for b in bags]
    model.members.extend(_descend(scaled, labels, seed) for seed in seeds)
    return model


def _descend(bags: list[np.ndarray], labels: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Gradient descent on the log loss, both labels weighing the same."""
    rng = np.random.default_rng(seed)
    w = {
        "E": rng.normal(0, 1 / np.sqrt(WIDTH) * 4, (WIDTH, HIDDEN)), "e": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE),
        "c": rng.normal(0, 0.3, HIDDEN), "c0": np.zeros(1),
    }
    good, bad = labels.sum(), len(labels) - labels.sum()
    if not good or not bad:
        for name in ("c", "c0"):
            w[name] = w[name] * 0
        w["c0"] = np.array([3.0 if good else -3.0 if bad else 0.0])
        return w
    importance = np.where(labels == 1, len(labels) / (2 * good), len(labels) / (2 * bad))
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for name, g in _gradient(w, [bags[i] for i in some], labels[some], importance[some]).items():
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.999 * square[name] + 0.001 * g * g
                w[name] = w[name] - RATE * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _gradient(w: dict, bags: list[np.ndarray], y: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
    x = np.vstack(bags).astype(np.float64)
    counts = np.array([len(b) for b in bags])
    first, own = np.r_[0, np.cumsum(counts)[:-1]], np.repeat(np.arange(len(bags)), counts)
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    s = (t * g) @ w["w"]
    a = np.exp(s - np.maximum.reduceat(s, first)[own])
    a /= np.add.reduceat(a, first)[own]
    z = np.add.reduceat(a[:, None] * h, first)
    do = (_sigmoid(z @ w["c"] + w["c0"]) - y) * importance / len(bags)
    dz = do[:, None] * w["c"]
    da = (dz[own] * h).sum(1)
    ds = a * (da - np.add.reduceat(a * da, first)[own])
    dt, dg = ds[:, None] * w["w"] * g * (1 - t * t), ds[:, None] * w["w"] * t * g * (1 - g)
    dh = a[:, None] * dz[own] + dt @ w["V"].T + dg @ w["U"].T
    dp = dh * (1 - h * h)
    return {
        "E": x.T @ dp + 1e-4 * w["E"], "e": dp.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": ((t * g) * ds[:, None]).sum(0),
        "c": z.T @ do, "c0": np.array([do.sum()]),
    }


def learn_attention(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Attention:
    """Learn from a bounded sample of the labelled documents.

    The bound: at most ``sample`` documents of each label, the least by a hash of the text in ``sample`` classes of that hash,
    so that copies count once, and ``SAMPLE_PASSAGES`` passages of each, evenly spread. Rows without label are left out, and a
    document that is labelled twice counts for both. A very long text gives no more passages than others; of repeated rows one counts.
    """
    marks = labels.filter(F.col(label).isNotNull()).select(F.col(doc_id).alias("id"), (F.col(label) > 0).cast("int").alias("y"))
    keys = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h")).join(marks, "id")
    chosen = keys.groupBy("y", F.pmod("h", F.lit(sample)).alias("class")).agg(F.min(F.struct("h", "id")).alias("x"))
    chosen = chosen.select("y", "x.h", "x.id")
    # At most two times `sample` rows, so they can be sent everywhere. An id may be that of many rows: the text's hash tells
    # the chosen one, and of its copies one stays.
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), ["id", "h"]).groupBy("y", "h").agg(F.first("text").alias("text")).select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [np.vstack(list(encoded(t.as_py(), SAMPLE_PASSAGES))).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], names=["y", "bag"])

    # In an order of their own, so that learning doesn't hang on which task ends first.
    got = sorted(((r["y"], bytes(r["bag"])) for r in rows.mapInArrow(run, "y int, bag binary").collect()))
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for _, b in got]
    return fit(bags, np.array([y for y, _ in got]))


def score_documents(docs: DataFrame, model: Attention, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, from the whole text alone; a null text counts as empty.

    Repeated rows come back repeated, an empty table gives no rows, and other columns are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, "doc_id long, score double")
