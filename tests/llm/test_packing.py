import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import packing
from millrace.llm.queries import tokenizer_file
from tokenizers import Tokenizer

FILE = tokenizer_file()
WHOLE = Tokenizer.from_file(FILE)


@settings(max_examples=300, deadline=None)
@given(st.text("aZé́'st.,!<|endoftext|> \n\t\r\x0b\x1c\x85\xa0 1²Σ#") | st.text())
def test_ids_are_those_of_the_whole_text(text):
    want = np.array([*WHOLE.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert packing.token_ids(text, FILE) == want


def check(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in groups.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return groups


@pytest.mark.parametrize("shard", [4096, 60])
def test_documents(documents, texts, shard):
    placed = packing.pack(packing.pieces(documents, FILE), shard)
    groups = check(placed)
    total = sum(r["length"] for r in placed.collect())
    assert len(groups) <= -(-total // packing.CAPACITY) + 1
    for r in placed.collect():
        ids = np.array([*WHOLE.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1], "<u4")
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["piece"] * packing.CAPACITY == r["start"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_sequences(odd):
    from millrace.session import written

    cut = written(packing.pieces(odd, FILE, with_ids=True), "cut")
    placed = packing.pack(cut)
    check(placed)
    assert placed.count() == cut.count() >= odd.count()
    made = packing.sequences(placed, cut).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * sum(r["length"] for r in cut.collect())


def test_empty(none):
    assert packing.pack(packing.pieces(none, FILE)).count() == 0


@pytest.mark.parametrize("length, small, least", [("3000L", 0, 1200), ("2100 + id % 1900", 300, 1200)])
def test_pieces_that_fill_no_bin(spark, monkeypatch, length, small, least):
    """Pieces above half the capacity, without enough small ones to fill them up: rounds end, and each has one bin."""
    rounds, real = [], packing._round

    def counted(*args):
        rounds.append(args)
        assert len(rounds) < 20
        return real(*args)

    monkeypatch.setattr(packing, "_round", counted)
    monkeypatch.setattr(packing, "CHILDREN", 2)
    cut = spark.range(least + small).selectExpr(
        "id AS row", "id AS doc_id", "0 AS piece", "0L AS start", f"CASE WHEN id < {least} THEN {length} ELSE 40L END AS length", "0L AS ids_crc32"
    )
    placed = packing.pack(cut, 64)
    groups = check(placed)
    assert sorted(r["row"] for r in placed.collect()) == list(range(least + small))
    assert least <= len(groups) <= least + small // 60


def test_operators_keep_every_piece():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 4000, 300)
    a, b = packing.packed(lengths, np.arange(300)), packing.packed(lengths, np.argsort(-lengths))
    for child in (packing.crossover(lengths, a, b, rng), packing.mutation(lengths, a, rng)):
        fills = np.bincount(child, lengths)
        assert (child >= 0).all() and fills.max() <= packing.CAPACITY and (fills > 0).all()
    best = packing.evolved(lengths, [], 1)[0]
    assert packing.worth(lengths, best) >= packing.worth(lengths, b)
