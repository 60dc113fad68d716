import itertools
import random
import re
import time
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii
from tests.llm.conftest import ODD

# The patterns as they are stated, tried at every place.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        d = re.sub(r"[^0-9]", "", m[0])
        digits = [int(c) for c in d][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


@pytest.fixture(scope="module")
def model(spark, small):
    return pii.learn_field(spark.read.parquet(f"{small}/../sf0.01/documents.parquet"), sample=200)


@settings(max_examples=500, deadline=None)
@given(st.text("ab.@-+ 0124") | st.text("1234.") | st.text("@a.b-") | st.text())
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_documents(texts):
    for text in texts.values():
        assert pii.base_spans(text or "") == brute(text or "")


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1 " * 100_000, "a@" * 100_000):
        pii.spans_of(text, pii.Field())


def number_table(size):
    rnd = random.Random(7)
    return "".join(f"{rnd.randint(0, 99)} {rnd.randint(0, 999)} " for _ in range(size // 6))


def test_number_tables_take_linear_time_with_a_learned_field(model):
    taken = []
    for size in (15_000, 60_000):
        text, began = number_table(size), time.process_time()
        pii.spans_of(text, model)
        taken.append(time.process_time() - began)
    assert taken[1] < 8 * taken[0]


def test_number_tables_take_little_memory(model):
    """A megabyte of digits, spaces and dots in one stretch; with the lists of all candidates it took some 10 GB."""
    text = "12 345 6.7 " * 95_000
    scores = pii.scorer(model)
    pii.spans_of(text[:20_000], model, scores)
    tracemalloc.start()
    pii.spans_of(text, model, scores)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_many_spans_beside_many(model):
    """As many base spans as added ones, in time that grows with their number."""
    line = "call (627) 555-1305 or +1 (826) 555-4081 190.137.2.14 of ten\n"
    base, added = pii.spans_of(line * 4_000, model)
    alone = pii.spans_of(line, model)
    assert alone[0] == [("ip", 41, 53)] and len(alone[1]) == 2  # the long run of digits after the plus sign is no phone number
    for got, one in zip((base, added), alone, strict=True):
        assert got == [(k, a + n * len(line), b + n * len(line)) for n in range(4_000) for k, a, b in one]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["12 ", "345", "+1 ", "(555) ", ".", "a@b.c", " ", "\n", "word ", "4111", "-"]), max_size=60), st.integers(13, 40))
def test_what_is_given_out_early_is_final(model, parts, held):
    text = "".join(parts)
    whole = [list(pii.decode(text, t, pii.scorer(model))) for t in pii.stretches(text)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "HELD", held)
        assert [list(pii.decode(text, t, pii.scorer(model))) for t in pii.stretches(text)] == whole


def test_rare_kinds_are_learned(spark):
    """One text in a thousand with an address, the others with other numbers."""
    rows = [(f"page {n} of {n * 7}",) for n in range(2_000)] + [(f"from 10.2.{n}.1 to me",) for n in range(2)]
    got = pii.learn_field(spark.createDataFrame(rows, "text string"), sample=50)
    assert got.weights.get("ip parts=True", 0) > 0


def test_adds_other_ways_of_writing(model):
    for text, kind, span in [
        ("call (627) 555-1305 now please", "phone", "(627) 555-1305"),
        ("the and +1 (826) 555-4081 190.137.2.14 of ten", "phone", "+1 (826) 555-4081"),
    ]:
        base, added = pii.spans_of(text, model)
        assert (kind, text.index(span), text.index(span) + len(span)) in base + added
    assert pii.spans_of('version 2.0 of 2021, token = "0641917ea4e9feb9cda83477b57ac2654884f485"', model) == ([], [])


def test_spans_added_are_few_and_beside_the_base(model, texts):
    for text in texts.values():
        base, added = pii.spans_of(text or "", model)
        for (_, a, b), (_, x, y) in itertools.product(base, added):
            assert b <= x or y <= a


def test_decoding_is_the_best_segmentation(model):
    """Against all segmentations of a short stretch."""
    text = "x +1 (826) 555 1.2.3.4 y"
    for tokens in map(list, pii.stretches(text)):
        found = pii.candidates(text, tokens)
        scores = {(i, j, k): model.score(n) for i, j, k, n in found}

        def best(at, tokens=tokens, scores=scores):
            if at >= len(tokens):
                return 0.0
            return max([best(at + 1), *(s + best(j) for (i, j, _), s in scores.items() if i == at)])

        got = pii.decode(text, tokens, pii.scorer(model))
        starts, ends = {t[0]: i for i, t in enumerate(tokens)}, {t[1]: i + 1 for i, t in enumerate(tokens)}
        assert abs(sum(scores[starts[a], ends[b], k] for k, a, b in got) - best(0)) < 1e-9


def test_odd(odd, none, model):
    got = pii.find_personal_data(odd, model)
    assert got.count() == len(ODD) and got.filter("size(base) > 0").count() == 0
    masked = pii.mask_personal_data(odd, model)
    assert masked.schema == odd.schema
    assert sorted(map(str, masked.collect())) == sorted(map(str, odd.collect()))
    assert pii.find_personal_data(none, model).count() == 0 and pii.learn_field(none).weights == {}


def test_masked():
    assert pii.masked("a bc def", [("ip", 2, 4), ("card", 3, 6)]) == "a [ip]ef"
