"""Documents to packed training sequences, in five stages. Each works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, packing, pii, rules
from millrace.llm.queries import tokenizer_file
from millrace.session import written
from millrace.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go. A null or empty text goes, having too few words.

    Repeated rows get equal verdicts. Documents without label, and columns of any name, are kept as they are. An empty table stays empty.
    """
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id, then the least digest of its text.

    Documents without words, null texts among them, are in no group and stay. Of repeated rows one stays.
    """
    return jaccard.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside windows of benchmark items are cut out; documents with no other words go. Others, and nulls, are unchanged.

    ``n_chars`` follows the text where that was cut.
    """
    found = written(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")), "contamination")
    return _measured(docs, decontaminate.without_hits(docs, found))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets. No document goes; null and empty texts are unchanged."""
    return _measured(docs, pii.mask_personal_data(docs, pii.learn_field(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is a piece of the end id alone; repeated rows are packed each; an empty table gives no rows.
    """
    return packing.pack(packing.pieces(docs, tokenizer_file())).drop("row")


def _measured(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` counted anew, if there is such a column and the text is not null."""
    if "n_chars" not in before.columns:
        return after
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(*before.columns)


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal_data),
    ("best-fit packing", pack),
]

# Learned rules, a learned field and packings cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
