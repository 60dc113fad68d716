"""Inputs that are derived from the given tables to exercise an operator: dirt, second versions, nested forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.sizing import lookup_join

# Orders before this day are the old version of the features.
FEATURE_CUT = "1998-01-01"
# Events are moved back so that they fall among the order dates.
LABEL_SHIFT_YEARS = 25
FRESHNESS_AS_OF = "2024-02-01 00:00:00"
FAILING_VALUE = 150


def dirty_orders(orders: DataFrame) -> DataFrame:
    """Orders with negative and missing prices, missing keys and an unknown status."""
    price, priority, status = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return orders.withColumns(
        {
            "o_totalprice": F.when((priority == "5-LOW") & (price < 60000), -price)
            .when(price > 495000, None)
            .otherwise(price),
            "o_orderkey": F.when((priority == "1-URGENT") & (price < 20000), None).otherwise(F.col("o_orderkey")),
            "o_orderstatus": F.when((priority == "2-HIGH") & (price > 400000), "X").otherwise(status),
        }
    )


def second_documents(documents: DataFrame) -> DataFrame:
    """A later version: one source is gone, French texts have a new sentence, one source has new keys."""
    moved = F.when(F.col("source") == "src5", F.col("doc_id") + 1_000_000_000_000).otherwise(F.col("doc_id"))
    longer = F.when(F.col("lang") == "fr", F.concat("text", F.lit("\nThis sentence was added later.")))
    return documents.filter("source <> 'src3'").withColumns(
        {"doc_id": moved, "text": longer.otherwise(F.col("text"))}
    )


def language_rules(documents: DataFrame, least: int = 3) -> DataFrame:
    """``term, label, weight``: the terms of at least ``least`` documents of a language, weighted by their share of its documents in thousandths."""
    labelled = documents.filter("lang is not null")
    terms = labelled.select("lang", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    counted = terms.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    totals = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    weight = F.expr("1000 * n div total")
    return lookup_join(counted, totals, ["lang"]).select("term", F.col("lang").alias("label"), weight.alias("weight"))


def doc_path(doc_id: str | Column = "doc_id") -> Column:
    return F.concat(F.lit("documents/"), F.col(doc_id) if isinstance(doc_id, str) else doc_id)


def quality_events(events: DataFrame) -> DataFrame:
    """A quality log from the events: per hour and type, how many values were too large."""
    failed = F.col("value") > FAILING_VALUE
    return events.groupBy(F.date_trunc("hour", "ts").alias("timestamp"), F.col("event_type").alias("name")).agg(
        F.lit("events").alias("dataset"),
        F.count_if(~failed).alias("passed_records"),
        F.count_if(failed).alias("failed_records"),
    )


def point_in_time_labels(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").alias("customer_key"),
        (F.col("ts") - F.make_ym_interval(F.lit(LABEL_SHIFT_YEARS))).alias("label_time"),
    )


def page_levels() -> Column:
    """So many objects around a document: 0 to 19, by its path."""
    return F.pmod(F.length(F.regexp_replace("path", "[^0-9]", "")) * 7 + F.length("path"), F.lit(20)).cast("int")


def nested_parse(parsed: DataFrame, levels: Column | None = None) -> DataFrame:
    """Parse results as a nested VARIANT, with a note that has its page on a higher level, inside ``levels`` more objects."""
    element = lambda e: F.struct(
        e["type"].alias("type"), e["text"].alias("content"), e["page"].alias("page_id")
    )
    document = F.struct(
        F.transform("elements", element).alias("elements"),
        F.struct(F.lit("3").alias("pageIndex"), F.array(F.struct(F.col("path").alias("text"))).alias("notes")).alias(
            "meta"
        ),
    )
    json = F.to_json(F.struct(document.alias("document")))
    if levels is not None:
        json = F.concat(F.repeat(F.lit('{"in":'), levels), json, F.repeat(F.lit("}"), levels))
    return parsed.select("path", F.parse_json(json).alias("parsed"))


def line_contents(documents: DataFrame) -> DataFrame:
    """Each line of a document as a ready-made chunk in a VARIANT list."""
    path = doc_path()
    items = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat_ws("#", path, i.cast("string")).alias("chunk_id"),
            i.alias("chunk_position"),
            line.alias("chunk_content"),
            F.concat_ws("\n", F.col("lang"), line).alias("chunk_to_embed"),
        ),
    )
    return documents.select(path.alias("path"), "source", F.parse_json(F.to_json(items)).alias("contents"))


# Frequent words of four languages: labels for the keyword classifier.
LANGUAGE_WORDS = {
    "english": ["the", "of", "and", "that", "with", "this", "from"],
    "french": ["de", "le", "et", "les", "des", "une", "dans"],
    "german": ["der", "die", "und", "den", "von", "mit", "ist"],
    "spanish": ["que", "el", "los", "del", "para", "por", "con"],
}
DOCUMENT_FIELDS = {
    "license": r"(?:Licensed under|Released under|licensed under) (?:the )?([A-Z][A-Za-z -]*[A-Za-z])",
    "mail_host": r"@([a-z0-9]+\.example\.[a-z]+)",
    "address": r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})",
}
