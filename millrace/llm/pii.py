"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole candidate spans.

The field segments a stretch of tokens into entities and single other tokens. An entity is scored as a whole, by its form,
its digits, checks such as Luhn's, and the tokens beside it, and dynamic programming over entities of bounded length
chooses boundaries and kinds together.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base kinds. What stands in front of the first digit run of an address only keeps the search
# from beginning inside a run that has failed as a whole.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

MAX_TOKENS = 12  # of an entity
MAX_CHARACTERS = 80
REACH = 3  # tokens on either side of a digit or an at sign that belong to its stretch
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_|[^\S ]+|\w", re.UNICODE)
MARK = re.compile(r"[0-9@]")
DIGITS, NOT_DIGITS, LETTERS = re.compile(r"[0-9]+"), re.compile(r"[^0-9]+"), re.compile(r"[^\W\d_]+")
HELD = 4_096  # places between two looks for what is decided
SCORES_KEPT = 16_384

SAMPLE = 600
EPOCHS, RATE, DECAY = 5, 0.15, 1e-4

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return NOT_DIGITS.sub("", text)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, kind by kind, in the order of the text. Linear in its length."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and text[left - 1] in LOCAL:
            left -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if left < at else None
        if domain:
            out.append(("email", left, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(_part(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _bounds(text: str) -> Iterator[tuple[int, int]]:
    """Places of the first and last digit or at sign of each stretch: those that are near each other share one."""
    first = last = -1
    for m in MARK.finditer(text):
        if first >= 0 and m.start() - last > 12:
            yield first, last
            first = -1
        first, last = first if first >= 0 else m.start(), m.start()
    if first >= 0:
        yield first, last


def _tokens(text: str, first: int, last: int) -> Iterator[tuple[int, int]]:
    """The tokens of a stretch, as places, with ``REACH`` more on either side."""
    ahead: deque[tuple[int, int]] = deque(maxlen=REACH)
    after = -1  # tokens taken behind the last one inside, -1 before the first
    for m in TOKEN.finditer(text, max(0, first - 48), min(len(text), last + 49)):
        if m.end() > first - 24 and m.start() <= last + 12:
            yield from ahead
            ahead.clear()
            after = 0
            yield m.span()
        elif after < 0:
            ahead.append(m.span())
        elif after < REACH:
            after += 1
            yield m.span()
        else:
            return


def stretches(text: str) -> Iterator[Iterator[tuple[int, int]]]:
    """The tokens, as places, of each stretch of the text that holds a digit or an at sign. Nothing is held but the last few."""
    for first, last in _bounds(text):
        yield _tokens(text, first, last)


def _form(text: str) -> str:
    """The form of a span: runs of letters and digits as one sign each, other characters as they are."""
    return LETTERS.sub("a", DIGITS.sub("0", text))


def span_features(span: str, before: str, after: str) -> list[str]:
    """What is said of a whole span between two characters (empty at the ends of the text)."""
    form = _form(span)
    digits = _digits(span)
    n = len(digits)
    out = [
        "kind",
        f"digits={min(n, 20)}",
        f"form={form[:24]}",
        f"ends={form[0]}{form[-1]}",
        f"plus={span[0] == '+'}",
        f"letters={form.count('a')}",
        f"at={span.count('@')}",
        f"dots={min(form.count('.'), 5)}",
        f"spaces={min(form.count(' '), 5)}",
        f"before={_form(before) if before else '^'}",
        f"after={_form(after) if after else '$'}",
        f"in_number={before.isalnum() or after.isalnum()}",
    ]
    if n >= 12:
        out.append(f"luhn={luhn(digits)}")
    if form == "0.0.0.0":
        out.append(f"parts={all(_part(p) for p in span.split('.'))}")
    return out


def possible(span: str) -> list[str]:
    """The kinds that a span can be: those that have what they cannot do without."""
    n = len(_digits(span))
    mail = span.count("@") == 1
    return [k for k in KINDS if ((mail and "." in span) if k == "email" else not mail and n >= (4 if k == "ip" else 7))]


@dataclass
class Field:
    """Weights by feature. An other token weighs nothing, so an entity must earn its place."""

    weights: dict[str, float] = field(default_factory=dict)

    def score(self, names: list[str]) -> float:
        return sum(self.weights.get(n, 0.0) for n in names)


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, str, list[str]]]:
    """(first token, token after the last, kind, features) of each span that can be an entity: it holds a digit or an at sign."""
    out = []
    for i, (a, _) in enumerate(tokens):
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            b = tokens[j - 1][1]
            span = text[a:b]
            if "\n" in span or b - a > MAX_CHARACTERS:
                break
            kinds = possible(span)
            said = span_features(span, text[a - 1 : a] if a else "", text[b : b + 1]) if kinds else []
            out += [(i, j, kind, [f"{kind} {x}" for x in said]) for kind in kinds]
    return out


def scorer(model: Field) -> Callable[[str, str, str], list[tuple[str, float]]]:
    """Kinds and scores of a span between two characters. The latest ``SCORES_KEPT`` are remembered: number tables repeat themselves."""
    of: dict[str, dict[str, float]] = {kind: {} for kind in KINDS}
    for name, weight in model.weights.items():
        kind, _, said_of = name.partition(" ")
        of[kind][said_of] = weight

    @lru_cache(maxsize=SCORES_KEPT)
    def scores(span: str, before: str, after: str) -> list[tuple[str, float]]:
        kinds = possible(span)
        said = span_features(span, before, after) if kinds else []
        return [(kind, sum([of[kind].get(x, 0.0) for x in said])) for kind in kinds]

    return scores


def decode(text: str, tokens: Iterable[tuple[int, int]], scores: Callable[[str, str, str], list[tuple[str, float]]]) -> Iterator[Span]:
    """The best segmentation: over all ends, the best of an other token or of an entity that ends there.

    Of equal ones the other token is taken, then the longest entity. An entity has ``MAX_TOKENS`` at most, so only the last places are kept,
    and of each place the way that led there. As soon as all ways that can still go on share a place, what lies before it
    is decided and given out, so a stretch of any length takes little memory.
    """
    window: deque[tuple[int, float]] = deque(maxlen=MAX_TOKENS)  # start of a token, best score up to it
    starts, ends, back = array("q"), array("q"), bytearray()  # of tokens not yet given out; 0, or 1 + kind + 4 * (tokens - 1)
    score, due = 0.0, HELD
    for a, b in tokens:
        window.append((a, score))
        starts.append(a)
        ends.append(b)
        way, after = 0, text[b : b + 1]
        n = len(window)
        for i, (x, so_far) in enumerate(window):
            if b - x > MAX_CHARACTERS:
                continue
            span = text[x:b]
            if "\n" in span:
                continue
            for kind, s in scores(span, text[x - 1 : x] if x else "", after):
                if so_far + s > score:
                    score, way = so_far + s, 1 + KINDS.index(kind) + len(KINDS) * (n - i - 1)
        back.append(way)
        if len(back) >= due:
            at = _shared(back)
            yield from _way(starts, ends, back, at)
            del starts[:at], ends[:at], back[:at]
            due = len(back) + HELD
    yield from _way(starts, ends, back, len(back))


def _length(way: int) -> int:
    return (way - 1) // len(KINDS) + 1 if way else 1


def _shared(back: bytearray) -> int:
    """The last place that all ways from the latest places go through; 0 when they go apart from the beginning.

    An entity to come can begin at any of the latest ``MAX_TOKENS`` places; of the ways there, the one that is furthest goes back a step at a time.
    """
    ways = set(range(max(0, len(back) - MAX_TOKENS), len(back) + 1))
    while len(ways) > 1:
        last = max(ways)
        ways.remove(last)
        ways.add(last - _length(back[last - 1]))
    return ways.pop()


def _way(starts: array, ends: array, back: bytearray, at: int) -> Iterator[Span]:
    out = []
    while at:
        way = back[at - 1]
        first = at - _length(way)
        if way:
            out.append((KINDS[(way - 1) % len(KINDS)], starts[first], ends[at - 1]))
        at = first
    return reversed(out)


def learn(examples: list[tuple[str, list[Span]]]) -> Field:
    """Gradient ascent on the likelihood of the given segmentations; sums over segmentations run forward and backward."""
    ready = []
    for text, gold in examples:
        for tokens in map(list, stretches(text)):
            found = candidates(text, tokens)
            known = {(k, a, b) for k, a, b in gold}
            hits = [x for x in found if (x[2], tokens[x[0]][0], tokens[x[1] - 1][1]) in known]
            if found:
                ready.append((len(tokens), found, hits))
    model = Field()
    w = model.weights
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for n, found, hits in ready:
            scores = [model.score(x[3]) for x in found]
            starts, ends = defaultdict(list), defaultdict(list)
            for x, s in zip(found, scores, strict=True):
                ends[x[1]].append((x[0], s))
                starts[x[0]].append((x[1], s))
            ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _sum([ahead[j - 1]] + [ahead[i] + s for i, s in ends[j]])
            for i in range(n - 1, -1, -1):
                back[i] = _sum([back[i + 1]] + [back[j] + s for j, s in starts[i]])
            for x, s in zip(found, scores, strict=True):
                p = math.exp(ahead[x[0]] + s + back[x[1]] - ahead[n])
                if p > 1e-6:
                    for name in x[3]:
                        w[name] = w.get(name, 0.0) * (1 - rate * DECAY) - rate * p
            for x in hits:
                for name in x[3]:
                    w[name] = w.get(name, 0.0) + rate
    return model


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def varied(text: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """The example, and again with its entities written in other ways that the patterns do not know.

    A phone number loses its plus sign, a card number gets other separators. So the field learns what lies in a span
    besides the signs by which the patterns found it.
    """
    clean: list[Span] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not clean or a >= clean[-1][2]:
            clean.append((kind, a, b))
    out = [(text, clean)]
    if not any(kind in ("phone", "card") for kind, _, _ in clean):
        return out
    parts, moved, at = [], [], 0
    for kind, a, b in clean:
        parts.append(text[at:a])
        new = text[a:b]
        if kind == "phone":
            new = re.sub(r"^\+[0-9]+[ .-]?", "", new) or new
        elif kind == "card":
            digits = _digits(new)
            new = ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))
        start = sum(map(len, parts))
        parts.append(new)
        if len(_digits(new)) >= 7 or kind in ("email", "ip"):
            moved.append((kind, start, start + len(new)))
        at = b
    parts.append(text[at:])
    return [*out, ("".join(parts), moved)]


# What a line holds that may be a find of a kind. Bounded, so that long texts cost time in proportion to their length.
HINTS = {
    "email": "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z0-9-]",
    "ip": "[0-9][.][0-9]{1,9}[.][0-9]{1,9}[.][0-9]",
    "card": "[0-9]([ -]?[0-9]){15}",
    "phone": "[+][0-9][ ().0-9-]{6}",
}


def learn_field(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Field:
    """Learn from the patterns' own finds in a bounded sample of texts with digits or at signs.

    The bound: at most ``sample`` texts. A fifth of them for each kind, of texts that hold what looks like one, and a fifth of texts that
    hold none, so that a kind is learned where it is rare, too. In each fifth they are the least by a hash of the text in as many classes of that hash, so that copies count
    once. Of each only the lines with a digit or an at sign are taken, those that look like the kind first, 2,000 characters at most.
    Without such texts the field is empty and adds nothing.
    """
    classes = max(1, sample // (len(HINTS) + 1))
    rows = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    seen = F.filter(F.array(*[F.when(F.col("text").rlike(hint), F.lit(kind)) for kind, hint in HINTS.items()]), lambda k: k.isNotNull())
    rows = rows.withColumn("kind", F.explode(F.when(F.size(seen) > 0, seen).otherwise(F.array(F.lit("none")))))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[0-9@]"))
    hint = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(hint)) for kind, hint in HINTS.items()], F.lit("[0-9@]"))
    first = F.filter(lines, lambda line: F.regexp(line, hint))
    others = F.filter(lines, lambda line: ~F.regexp(line, hint))
    part = F.substr(F.array_join(F.concat(first, others), "\n"), F.lit(1), F.lit(2_000))
    rows = rows.select("kind", F.pmod("h", F.lit(classes)).alias("class"), F.struct("h", part.alias("t")).alias("x"))
    taken = rows.groupBy("kind", "class").agg(F.min("x").alias("x")).select("kind", "class", "x.h", "x.t").collect()
    # A text with several kinds may be taken for each of them; what is the same counts once.
    texts = list(dict.fromkeys(r["t"] for r in sorted(taken, key=lambda r: (r["class"], r["kind"], r["h"]))))
    return learn([example for t in texts for example in varied(t, base_spans(t))])


class Apart:
    """Intervals that lie beside each other, in order."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts, self.ends = array("q"), array("q")
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        """Whether no interval meets the span."""
        place = bisect_left(self.starts, b)
        return not place or self.ends[place - 1] <= a

    def add(self, a: int, b: int) -> None:
        place = bisect_left(self.starts, a)
        self.starts.insert(place, a)
        self.ends.insert(place, b)


def spans_of(text: str, model: Field, scores: Callable | None = None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a whole text. Added ones lie beside all base spans and beside each other."""
    if not MARK.search(text):
        return [], []
    base = base_spans(text)
    added: list[Span] = []
    if model.weights:
        scores = scores or scorer(model)
        taken, own = Apart((a, b) for _, a, b in base), Apart()
        for tokens in stretches(text):
            for kind, a, b in decode(text, tokens, scores):
                if taken.free(a, b) and own.free(a, b):
                    added.append((kind, a, b))
                    own.add(a, b)
    return base, added


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_personal_data(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added`` for every row: spans as kind, start and end in code points, by kind and then start.

    A null or empty text has none. Repeated rows come back repeated; an empty table gives no rows; other columns are never
    read. A very long text takes time in proportion to its length, and beside itself only its spans are held. Of segmentations with equal
    scores, the one with fewer entities at the end is taken.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    kinds = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(span)), ("added", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(model)
        for batch in batches:
            out: dict[str, list] = {"base": [], "added": []}
            for value in batch.column(1):
                for name, spans in zip(("base", "added"), spans_of(value.as_py() or "", model, scores), strict=True):
                    out[name].append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in ordered(spans)])
            columns = [batch.column(0), pa.array(out["base"], kinds.field(1).type), pa.array(out["added"], kinds.field(2).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = "array<struct<kind:string,start:int,end:int>>"
    return given.mapInArrow(run, f"doc_id long, base {kind}, added {kind}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets. Spans that overlap are replaced together, by the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with all personal data in ``text`` masked. Other columns, and null texts, stay as they are.

    Repeated rows come back repeated, an empty table gives no rows, and a very long text takes time in proportion to its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(model)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = []
            for value in batch.column(at):
                t = value.as_py()
                values.append(t if not t else masked(t, sum(spans_of(t, model, scores), [])))
            yield batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
