import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.queries import op11_tokenizer_alignment
from tests.llm.conftest import ODD, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as they are, and the bytes of their entries by other means than the operator's."""
    import base64

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        a_bytes = {int(n): base64.b64decode(t) for t, n in map(bytes.split, file)}
    b_bytes = [
        bytes.fromhex(b.id_to_piece(k)[3:5]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in range(len(b))
    ]
    return a, b, a_bytes, b_bytes


def tokens(plain, text):
    a, b, a_bytes, b_bytes = plain
    if not text:
        return [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(a_bytes[i] for i in ids[0]) != want or b"".join(b_bytes[i] for i in ids[1]) != want:
        return [], []
    return ids


def spans(ids, entries):
    out, at = [], 0
    for i in ids:
        out.append((at, at := at + len(entries[i])))
    return out


def brute(plain, rows):
    """All token pairs of each text, one by one."""
    links, groups = [], []
    for _, text in rows:
        a, b = tokens(plain, text)
        x, y = spans(a, plain[2]), spans(b, plain[3])
        links.append([(p, q) for p, (s, e) in zip(a, x, strict=True) for q, (u, v) in zip(b, y, strict=True) if s < v and u < e])
        cuts = sorted({e for _, e in x} & {v for _, v in y})
        low, found = 0, []
        for cut in cuts:
            found.append([[str(i) for i, (_, e) in zip(ids, at, strict=True) if low < e <= cut] for ids, at in ((a, x), (b, y))])
            low = cut
        groups.append((len(a), len(b), found))
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (_, q), n in counts.items():
        most[q] = max(most[q], n)
    out = []
    for (name, _), own, (n_a, n_b, found) in zip(rows, links, groups, strict=True):
        said = ";".join(",".join(p) + "|" + ",".join(q) for p, q in found)
        digest = hashlib.sha256(said.encode()).hexdigest() if n_a else ""
        best = sum(counts[p] == most[p[1]] for p in own)
        out.append((name, n_a, n_b, len(found), len(own), best, sum(counts[p] for p in own), digest))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


TRICKY = [
    (1, "a  b\n c\r\td ﬁ ½ <s> <0x41> "), (2, " "), (3, "\n\nx\t\ty \n"), (4, "<|endoftext|> </s> <unk>"), (5, "x▁y"), (6, "  foo bar"),
    (7, "\U0001f600\U0001f600 naïve 漢字"), (8, "a\x00b\x1cc"), (9, "ab" * 400), (10, "   lead"), (11, "tail   "), (12, "\r\n"), (12, "a  b"), (12, "a  b"),
]


@pytest.mark.parametrize("size", [2, 7, alignment.PIECE])
def test_odd_rows(spark, plain, odd, none, size):
    short = [(i, t if t is None or len(t) < 5000 else t[:3000]) for i, t in ODD] + TRICKY
    df = spark.createDataFrame(short, "doc_id long, text string")
    assert result(alignment.align(df, A, B, size=size)) == brute(plain, short)
    if size == 7:
        assert alignment.align(none, A, B, size=size).collect() == []
        assert alignment.align(odd, A, B).count() == len(ODD)


def test_rare_pairs_are_joined(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "HEAD", 40)
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 50)
    rows = [(k, words(k // 2, 40)) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(alignment.align(df, A, B, size=64)) == brute(plain, rows)


def test_registered_query(spark, plain, small, texts):
    """Whole texts against each other token by token would take too long; ends are merged one by one here."""
    links, want = {}, {}
    for name, text in texts.items():
        a, b = tokens(plain, text)
        x, y = spans(a, plain[2]), spans(b, plain[3])
        i = j = 0
        own, found, group = [], [], ([], [])
        while i < len(a):
            own.append((a[i], b[j]))
            e, v = x[i][1], y[j][1]
            if e <= v:
                group[0].append(str(a[i]))
                i += 1
            if v <= e:
                group[1].append(str(b[j]))
                j += 1
            if e == v:
                found.append(",".join(group[0]) + "|" + ",".join(group[1]))
                group = ([], [])
        links[name] = own
        want[name] = (len(a), len(b), len(found), hashlib.sha256(";".join(found).encode()).hexdigest() if a else "")
    counts = Counter(p for own in links.values() for p in own)
    most = defaultdict(int)
    for (_, q), n in counts.items():
        most[q] = max(most[q], n)
    got = {r["doc_id"]: r for r in op11_tokenizer_alignment(spark, small).collect()}
    assert set(got) == set(texts)
    for name, r in got.items():
        assert (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) == want[name]
        own = links[name]
        assert (r["n_links"], r["n_best"], r["count_sum"]) == (
            len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own)
        )


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r.'sxe1 ▁́<>"), st.characters(codec="utf-8")), max_size=40))
def test_runs_give_the_ids_of_whole_texts(plain, text):
    known = alignment.tokenizers(A, B)
    assert known.splits and known.joins
    a, b = tokens(plain, text)
    got = known.encode(text.encode())
    assert got == ((np.array(a, "<u2").tobytes(), np.array(b, "<u2").tobytes()) if a else None)


def test_long_texts_are_encoded_in_stretches(plain, monkeypatch):
    text = words(5, 3000) + "\n\n" + words(6, 200)
    want = alignment.tokenizers(A, B).encode(text.encode())
    monkeypatch.setattr(alignment, "STRETCH", 100)
    monkeypatch.setattr(alignment, "CACHED", 50)
    assert alignment.tokenizers(A, B).encode(text.encode()) == want


def test_other_ways_of_encoding_agree(monkeypatch, texts):
    known = alignment.Tokenizers(A, B)
    some = [t.encode() for t in list(texts.values())[:40] if t]
    want = [known.encode(t) for t in some]
    known.known_a.clear(), known.known_b.clear()
    known.joins = None
    assert [known.encode(t) for t in some] == want
    known.splits = False
    assert [known.encode(t) for t in some] == want


def test_invalid_bytes_have_no_tokens():
    assert alignment.tokenizers(A, B).encode(b"ab\xff") is None


def test_pieces_have_equal_work_and_keep_equal_ends_together():
    rng = random.Random(4)
    for size in (2, 3, 10):
        a, b = (np.array(sorted({*rng.sample(range(1, 400), n), 400})) for n in (150, 90))
        borders = alignment.diagonals(a, b, size)
        assert borders[0] == (0, 0) and borders[-1] == (len(a), len(b))
        for (i, j), (k, m) in zip(borders, borders[1:]):  # noqa: B905
            assert 0 < k - i + m - j <= size + 1
            if k < len(a) and m < len(b):
                assert max([*a[i:k], *b[j:m]]) < min(a[k], b[m])
