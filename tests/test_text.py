import hashlib
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.text import (
    PII_LABELS,
    WHITESPACE,
    mask_entities,
    pii_engine,
    redact,
    strip,
    term_counts,
    tokens,
    windows,
)

TEXTS = [
    "",
    "   \n\t ",
    "x" * 49,
    "y" * 50,
    "0123456789" * 100,
    "0123456789" * 100 + "z",
    "0123456789" * 250,
    "mä@example.com und jane.doe+tag@mail.example.org",
    "call +1 415 555 0182 anytime",
    "split 415 555\n0182 over lines",
    "on 2024-01-05 it rained",
    "٠١٢٣٤٥٦٧٨٩٠ arabic digits",
    "émoji 😀 " * 200,
    "\x1c\x85\xa0  padded 　\x1f",
    "no-at-sign.example.com",
    "a@b.c a@b.c",
    ("word " * 170 + "\n") * 3,
    None,
]

EMAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
PHONE = re.compile(r"\+?\d[\d\s().-]{7,}\d")


def model_redact(text):
    return PHONE.sub("[PHONE]", EMAIL.sub("[EMAIL]", text or ""))


def model_windows(text, size, overlap, least):
    body = (text or "").strip()
    found, at = [], 0
    while body and (at == 0 or at + overlap < len(body)):
        found.append(body[at : at + size].strip())
        at += size - overlap
    return [w for w in found if len(w) >= least]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "n int, t string").repartition(2)


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_and_redact_follow_the_model(texts):
    got = {r.n: r for r in texts.select("n", strip(F.col("t")).alias("s"), redact(F.col("t")).alias("r")).collect()}
    for n, text in enumerate(TEXTS):
        assert got[n].s == (None if text is None else text.strip())
        assert got[n].r == model_redact(text)


def test_random_texts_follow_the_model(spark):
    pick = random.Random(17)
    letters = ["a", "Z", "é", "ß", "中", "😀", "_", "7", "0", "٣", "²", "@", ".", "-", "+", "(", ")", " ", "\n", "\xa0", "\u2003", "\x1d"]
    made = ["".join(pick.choices(letters, k=pick.randint(0, 60))) for _ in range(3000)]
    made += ["".join(pick.choices("0123456789 ()-.+@ab\n", k=pick.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(made)), "n int, t string")
    got = df.select("n", redact(F.col("t")).alias("r"), windows(F.col("t"), 20, 6, 3).alias("w"), strip(F.col("t")).alias("s"))
    for r in got.collect():
        assert r.r == model_redact(made[r.n]), repr(made[r.n])
        assert r.w == model_windows(made[r.n], 20, 6, 3), repr(made[r.n])
        assert r.s == made[r.n].strip()


def test_redact_is_idempotent(texts):
    twice = texts.select(redact(redact(F.col("t"))).alias("b"), redact(F.col("t")).alias("a"))
    assert twice.filter("a <> b").count() == 0


@pytest.mark.parametrize("size, overlap, least", [(1000, 150, 50), (100, 15, 10), (10, 9, 1), (7, 5, 2), (50, 1, 50)])
def test_windows_follow_the_model(texts, size, overlap, least):
    got = dict(texts.select("n", windows(F.col("t"), size, overlap, least)).collect())
    for n, text in enumerate(TEXTS):
        assert got[n] == model_windows(text, size, overlap, least), (n, size, overlap)


def test_windows_overlap_and_cover(spark):
    body = "".join(str(i % 10) for i in range(2500))
    cut = spark.range(1).select(windows(F.lit(body), 1000, 150, 50)).first()[0]
    assert len(cut) == 3
    assert cut[0][-150:] == cut[1][:150]
    assert cut[-1].endswith(body[-50:])


@pytest.mark.parametrize("size, overlap, least", [(100, 100, 5), (100, 0, 5), (100, 200, 5), (100, 10, 0)])
def test_windows_reject_bad_sizes(size, overlap, least):
    with pytest.raises(ValueError):
        windows(None, size, overlap, least)


def test_entities(spark):
    text = "id 123-45-6789, card 4111 1111 1111 1111, mail a@b.org, phone 415-555-0182"
    got = spark.range(1).select(mask_entities(F.lit(text)), mask_entities(F.lit(text), ["email"])).first()
    assert got[0] == "id [NATIONAL_ID], card [CARD], mail [EMAIL], phone [PHONE]"
    assert got[1] == text.replace("a@b.org", "[EMAIL]")
    with pytest.raises(ValueError, match="street address"):
        mask_entities(F.lit(text), PII_LABELS)
    with pytest.raises(ValueError, match="PII engine"):
        pii_engine("shred")


def test_term_counts_follow_the_model(texts):
    got = dict(texts.select("n", term_counts(tokens(F.col("t")))).collect())
    for n, text in enumerate(TEXTS):
        if text is None:
            assert got[n] is None
            continue
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        assert [(r.term, r.tf) for r in got[n]] == sorted((w, words.count(w)) for w in set(words))


def test_sha1_ids(spark):
    from millrace.operators.documents import chunk_id

    got = spark.range(1).select(chunk_id(F.lit("a/b.pdf"), F.lit(2), F.lit(7))).first()[0]
    assert got == hashlib.sha1(b"a/b.pdf::2::7").hexdigest()
    assert rows(spark.range(2).select(chunk_id(F.lit("p"), F.col("id"), F.lit(0))).distinct()).__len__() == 2
