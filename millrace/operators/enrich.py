"""Rules that stand in for hosted models: document type by keywords, fields by patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.functions.text import let, term_counts, tokens
from millrace.operators.documents import readable
from millrace.session import written
from millrace.sizing import lookup_join

# The names of the types and fields. The words and patterns are examples; other rules come as arguments or as a table.
# The first type wins a tie.
SUPPORT_TYPES = {
    "return_policy": ["return", "returns", "returned", "returnable", "refund", "refunds", "exchange", "sale"],
    "faq": ["q", "a", "faq", "question", "questions", "answer", "answers", "shipping"],
    "complaint_letter": ["complaint", "complain", "broken", "cracked", "replacement", "disappointed", "regards"],
}
SUPPORT_FIELDS = {
    "complaint_type": r"(?i)(cracked|broken|defective|late|missing|wrong|damaged)",
    "severity": r"(?i)severity:\s*([\p{L}]+)",
    "product_id": r"(?i)model\s+([A-Z0-9]+-[A-Z0-9]+)",
}


def classify(text: Column, keywords: Mapping[str, Sequence[str]]) -> Column:
    """The label with the most matching words, ties to the first label given, NULL when nothing matches."""
    if not keywords:
        raise ValueError("give at least one label")

    def matches(words: Column, known: Sequence[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(list(known))))

    def best(words: Column) -> Column:
        scored = [
            F.struct((-matches(words, known)).alias("rank"), F.lit(place).alias("place"), F.lit(label).alias("label"))
            for place, (label, known) in enumerate(keywords.items())
        ]
        return F.array_min(F.array(*scored))

    winner = let(tokens(text), best)
    return let(winner, lambda w: F.when(w["rank"] < 0, w["label"]))


def classify_by_rules(docs: DataFrame, rules: DataFrame, text: str = "text", label: str = "doc_type") -> DataFrame:
    """``docs`` with the label that speaks most for each text, by a table of rules ``term, label, weight`` of any size.

    A term counts as often as it occurs, with its whole-numbered weight; several rows for a term and label add up. Ties go to the first label
    in order, and a text without any known term (or a null one) gets NULL. A label can win with a negative sum, if it alone matches.

    Sums are made by digest of the text, and combined before the shuffle. A text that occurs often has its sums multiplied, all by the same number, so
    the verdict is that of a single one. Beyond a small broadcast, verdicts and rows are joined by shuffling both, of the rows only columns that are read later.
    """
    if not isinstance(rules.schema["weight"].dataType, IntegralType):
        raise ValueError("weights must be whole numbers, so that sums and ties don't depend on their order")
    known = rules.groupBy("term", "label").agg(F.sum("weight").alias("weight")).filter("term is not null and label is not null")
    digest = F.unhex(F.sha2(F.col(text), 256))
    said = docs.select(digest.alias("_digest"), F.explode(term_counts(tokens(F.col(text)))).alias("_t"))
    said = said.select("_digest", F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))
    sums = lookup_join(said, known, ["term"], spread_by=F.col("_digest")).groupBy("_digest", "label").agg(F.sum(F.col("weight") * F.col("tf")).alias("sum"))
    best = sums.groupBy("_digest").agg(F.min(F.struct((-F.col("sum")).alias("rank"), "label"))["label"].alias("_label"))
    names = [c for c in docs.columns if c != label]
    marked = docs.select(F.struct(*names).alias("_row"), digest.alias("_digest"))
    # There are as many verdicts as texts. A text has one, so where many rows share it, Spark can split them.
    found = lookup_join(marked, written(best, "verdicts"), ["_digest"], "left", spread=1)
    return found.select("_row.*", F.col("_label").alias(label))


def extract(text: Column, patterns: Mapping[str, str]) -> dict[str, Column]:
    """The first match of each pattern's group; NULL when there is none."""
    return {name: F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")) for name, pattern in patterns.items()}


def enrich_documents(
    parsed: DataFrame,
    keywords: Mapping[str, Sequence[str]] = SUPPORT_TYPES,
    patterns: Mapping[str, str] = SUPPORT_FIELDS,
    enabled: bool = True,
) -> DataFrame | None:
    """One row per readable document: its type and fields. ``None`` when switched off."""
    if not enabled:
        return None
    full = F.array_join(F.transform("elements", lambda e: e["text"]), "\n")
    passed = [c for c in ("ingest_time",) if c in parsed.columns]
    texts = readable(parsed).select("path", *passed, full.alias("text"))
    fields = extract(F.col("text"), patterns)
    return texts.select(
        "path",
        *passed,
        classify(F.col("text"), keywords).alias("doc_type"),
        *[column.alias(name) for name, column in fields.items()],
    )
