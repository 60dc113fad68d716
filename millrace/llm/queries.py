"""The registered queries of these operators. Each applies its operator to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, chat, decontaminate, jaccard, language, licenses, neighbours, packing, passages, pii, resampling, rules, suffixes
from millrace.session import written
from millrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), tokenizer_file())
    return packing.pack(cut).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op2_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one more whose texts hold the template's own control strings."""
    tricky = r"\### Assistant: </turn> ok"
    said = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.prefix_examples(given.unionByName(said)))


def _fold(n: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Dictionaries come from the documents outside the held-out fold; every document is predicted from its text alone."""
    docs = table(spark, folder, "documents")
    model = language.learn_dictionaries(docs.filter(_fold(4) != 2))
    return language.predict_language(docs, model).select(
        "doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"), licenses.known_table(spark))
    return found.select(
        "doc_id", "digest", "license",
        F.size("notices").cast("long").alias("n_notices"), F.array_join("notices", ",").alias("notices"),
    )


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "n_links", "n_copies", "class"
    )


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics are computed once, learned from where there is a label, and judged everywhere."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = written(rules.text_statistics(docs).drop("text"), "statistics")
    learned = rules.learn_from(stats, table(spark, folder, "labels"))
    return rules.judged(stats, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find_personal_data(docs, pii.learn_field(docs))

    def written_out(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    # By kind in the order of the list, then by place.
    rank = F.create_map(*[F.lit(x) for k, kind in enumerate(pii.KINDS) for x in (kind, k)])
    keyed = F.transform(
        F.concat("base", "added"),
        lambda s: F.struct(rank[s["kind"]].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return found.select(
        "doc_id", *map(count, pii.KINDS),
        F.sha2(written_out(F.col("base")), 256).alias("base_sha256"),
        written_out(F.array_sort(keyed)).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op9_quality_attention(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the held-out fold are never read; every document is scored from its text alone."""
    docs = table(spark, folder, "documents")
    model = passages.learn_attention(docs, table(spark, folder, "labels").filter(_fold(5) != 0))
    return passages.score_documents(docs, model).select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= passages.CUT).cast("int").alias("predicted"),
    )


@query
def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_passages(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_repeated",
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["last"])), ",").alias("spans"),
        (F.col("n_repeated") > 0).alias("repeated"),
    )


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, drawn to be like the benchmark's texts."""
    found = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, folder, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query
def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, folder, "documents"), *files).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
