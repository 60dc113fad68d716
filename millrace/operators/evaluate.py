"""Retrieval quality: ground truth, hit rate and the gate that must hold."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written
from millrace.sizing import is_small, lookup_join

MIN_HIT_RATE = 0.80
WORD_BREAK = "[ \n]+"
# The anchors are hashed anew for every document, so only a short list pays.
ANCHORS_IN_ROW = 2_000


def passage_sources(passages: DataFrame, documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """``query_id, path`` for every document (``path, text``) that contains a passage word for word.

    A word inside the passage, neither first nor last, has the same breaks around it in the document. So documents are
    matched on the longest such word first, and only those that hold it are searched for the whole passage. Passages without such a
    word are looked for in every document, a bounded number at a time. Null and empty passages are nowhere.
    """
    words = F.split(F.col(text), WORD_BREAK)
    inner = F.filter(F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))), lambda w: w != "")
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    every = passages.filter(F.coalesce(F.col(text), F.lit("")) != "").select(
        F.col(id_col).alias("query_id"), F.col(text).alias("passage"), longest.alias("anchor")
    )
    anchors = every.filter("anchor is not null")
    short = written(every.filter("anchor is null").select("query_id", "passage"), "short")
    held = F.array_distinct(F.split("text", WORD_BREAK))
    if is_small(anchors.select("anchor"), ANCHORS_IN_ROW):
        # Few passages: cut each document's words down to the anchors before making rows of them.
        held = F.array_intersect(held, anchors.agg(F.collect_set("anchor")).scalar())
    found = documents.select("path", "text", F.explode(held).alias("anchor"))
    hits = lookup_join(found, anchors, ["anchor"], spread_by=F.col("path")).filter(F.contains("text", "passage"))
    hits = hits.select("query_id", "path")
    blocks = -(-short.count() // ANCHORS_IN_ROW)
    for number in range(blocks):
        block = short.filter(F.pmod(F.xxhash64("passage", "query_id"), F.lit(blocks)) == number)
        # One row; a subquery cannot stand inside a lambda.
        listed = F.broadcast(block.agg(F.collect_list(F.struct("query_id", "passage")).alias("_listed")))
        held = F.explode(F.filter("_listed", lambda p: F.contains(F.col("text"), p["passage"])))
        hits = hits.unionByName(documents.select("path", "text").crossJoin(listed).select(held.alias("p"), "path").select("p.query_id", "path"))
    return hits.distinct()


def hit_rates(
    answers: Mapping[str, DataFrame], truth: DataFrame, paths: DataFrame, asked: DataFrame | None = None
) -> DataFrame:
    """Per method, the share of questions with at least one right document among their hits.

    ``answers`` are ranked hits with ``chunk_id``, ``truth`` has ``query_id, path``, and ``paths`` gives the document of
    each chunk. ``asked`` has the ``query_id`` of every question that counts. Without it, those of ``truth`` count, and
    questions without a right answer in the corpus do not.
    """
    tagged = reduce(
        DataFrame.unionAll,
        [hits.select(F.lit(name).alias("method"), "query_id", "chunk_id") for name, hits in answers.items()],
    )
    documents = lookup_join(paths.select("chunk_id", "path"), tagged, ["chunk_id"]).select("method", "query_id", "path")
    right = documents.join(truth, ["query_id", "path"], "left_semi").select("method", "query_id").distinct()
    total = (truth if asked is None else asked).agg(F.count_distinct("query_id")).scalar()
    names = truth.sparkSession.createDataFrame([(name,) for name in answers], "method string")
    return (
        names.join(right.groupBy("method").agg(F.count(F.lit(1)).alias("hits")), "method", "left")
        .select("method", F.coalesce("hits", F.lit(0)).alias("hits"), total.alias("questions"))
        .withColumn("hit_rate", F.try_divide("hits", "questions"))
    )


def gate(metrics: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    """``metric, value, minimum, passed`` for each required metric. One that was not measured fails.

    ``metrics`` has ``metric, value``.
    """
    for name, minimum in minimums.items():
        if not 0.0 <= minimum <= 1.0:
            raise ValueError(f"the minimum for {name} must lie between 0 and 1, got {minimum}")
    wanted = metrics.sparkSession.createDataFrame(list(minimums.items()), "metric string, minimum double")
    return wanted.join(metrics.select("metric", "value"), "metric", "left").select(
        "metric", "value", "minimum", F.coalesce(F.col("value") >= F.col("minimum"), F.lit(False)).alias("passed")
    )
