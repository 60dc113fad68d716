"""Text clean-up, redaction and tokens as built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode-aware stripping removes, and that \s stands for in the phone pattern.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The e-mail and phone patterns, with \w, \d and \s written out because Java's are ASCII only.
EMAIL_PATTERN = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+"
PHONE_PATTERN = r"\+?\p{Nd}[\p{Nd}" + WHITESPACE + r"().-]{7,}\p{Nd}"
EMAIL_MARK = "[EMAIL]"
PHONE_MARK = "[PHONE]"

# The labels a caller may ask to have masked.
PII_LABELS = ["email", "phone number", "person name", "street address", "credit card number", "national id"]

# The labels that a pattern can find, in the order the rules run. The phone rule takes any long run of digits, so it is last.
ENTITY_RULES = {
    "email": (EMAIL_PATTERN, EMAIL_MARK),
    "credit card number": (r"\p{Nd}(?:[ -]?\p{Nd}){12,18}", "[CARD]"),
    "national id": (r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}", "[NATIONAL_ID]"),
    "phone number": (PHONE_PATTERN, PHONE_MARK),
}

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Inside a lambda, an ordinary column expression would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def redact(text: Column) -> Column:
    """Mask e-mail addresses, then phone numbers. NULL becomes the empty string."""
    given = F.coalesce(text, F.lit(""))
    # Most texts hold no address; looking for the sign first saves trying the pattern at every letter.
    masked = F.when(F.contains(given, F.lit("@")), F.regexp_replace(given, EMAIL_PATTERN, EMAIL_MARK)).otherwise(given)
    return F.regexp_replace(masked, PHONE_PATTERN, PHONE_MARK)


def mask_entities(text: Column, labels: Sequence[str] | None = None) -> Column:
    """Mask every kind of entity in ``labels`` by pattern; by default all that have one.

    Names of people and street addresses have no pattern, so asking for them is an error rather than a silent gap.
    """
    wanted = list(ENTITY_RULES) if labels is None else list(labels)
    unknown = [label for label in wanted if label not in ENTITY_RULES]
    if unknown:
        raise ValueError(f"no pattern for {unknown}; known: {list(ENTITY_RULES)}")
    out = F.coalesce(text, F.lit(""))
    for label, (pattern, mark) in ENTITY_RULES.items():
        if label in wanted:
            out = F.regexp_replace(out, pattern, mark)
    return out


PII_ENGINES = {"regex": redact, "entities": mask_entities}


def pii_engine(name: str) -> Callable[[Column], Column]:
    if name not in PII_ENGINES:
        raise ValueError(f"PII engine must be one of {sorted(PII_ENGINES)}, not {name!r}")
    return PII_ENGINES[name]


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order, repeats kept."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def term_counts(words: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of words, sorted by term. Works inside the row, without a shuffle."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        firsts = F.filter(
            F.transform(ordered, lambda _, i: i),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            firsts,
            lambda starts: F.transform(
                starts,
                lambda start, n: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(starts, n + 1), size) - start).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(words), runs)


def windows(text: Column, size: int, overlap: int, min_chars: int) -> Column:
    """Overlapping windows of ``size`` characters, stripped, without those shorter than ``min_chars``.

    The text is first cut into pieces of ``size - overlap`` characters and each window joins the pieces it covers,
    so the cost grows with the length of the text, not with length times windows.
    """
    check_window(size, overlap, min_chars)
    step = size - overlap
    pieces_per_window = -(-size // step)

    def cut(stripped: Column) -> Column:
        length = F.length(stripped)
        count = F.when(length <= size, F.lit(1)).otherwise(1 + F.ceil((length - size) / step)).cast("int")
        return let(
            F.regexp_extract_all(stripped, F.lit("(?s).{1,%d}" % step), F.lit(0)),
            lambda pieces: F.filter(
                F.transform(
                    F.slice(pieces, F.lit(1), count),
                    lambda _, i: strip(
                        F.substring(F.array_join(F.slice(pieces, i + 1, F.lit(pieces_per_window)), ""), 1, size)
                    ),
                ),
                lambda window: F.length(window) >= min_chars,
            ),
        )

    return let(strip(F.coalesce(text, F.lit(""))), cut)


def check_window(size: int, overlap: int, min_chars: int) -> None:
    if not 0 < overlap < size:
        raise ValueError(f"overlap must lie between 0 and the window size, got overlap={overlap}, size={size}")
    if min_chars <= 0:
        raise ValueError(f"the minimum length must be positive, got {min_chars}")
