"""The registered queries: each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.nested import walk_any_depth, walk_elements
from millrace.functions.text import mask_entities, redact
from millrace.operators import changes, documents as docs, evaluate, expectations, features, health, orders, search
from millrace.operators.enrich import classify_by_rules, enrich_documents
from millrace.operators.metrics import SALES_METRICS
from millrace.operators.postings import KeywordIndex
from millrace.plans import derived
from millrace.session import new_path, written
from millrace.sizing import lookup_join, spread
from millrace.sources import files
from millrace.sources.sinks import ChangeLogTable, leftover_files
from millrace.sources.tables import TABLES, table, table_stream
from millrace.streaming.runs import run_to_end

K = 5
RERANK_POOL = 20
DIMS = 64

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = lambda spark, folder: _comparable(run(spark, folder))
    return run


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, so that other engines' clients show the same value. Library functions keep decimals."""
    money = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(money) if money else df


# --- orders ------------------------------------------------------------------------------------------------------


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return orders.clean_orders(table(spark, folder, "orders"))


def _dirty(spark: SparkSession, folder: str) -> DataFrame:
    return derived.dirty_orders(table(spark, folder, "orders"))


@query
def orders_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return orders.land_orders(table(spark, folder, "orders"), "tpch").drop("ingest_time")


@query
def orders_silver(spark: SparkSession, folder: str) -> DataFrame:
    return orders.clean_orders(_dirty(spark, folder))


@query
def expectation_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.rule_counts(_dirty(spark, folder), orders.ORDER_RULES, "orders")


@query
def quality_log(spark: SparkSession, folder: str) -> DataFrame:
    """The counts come from the run that writes the clean orders, not from a second pass."""
    seen = Observation("orders_silver")
    checked = expectations.observed(_dirty(spark, folder), orders.ORDER_RULES, seen)
    orders.normalize_orders(checked).write.parquet(new_path(spark, "orders_silver"))
    log = expectations.log_rows(spark, seen.get, orders.ORDER_RULES, "orders_silver", datetime(2024, 1, 1))
    return health.quality_by_failures(log)


@query
def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return orders.daily_sales(_clean(spark, folder))


@query
def daily_sales_first_days(spark: SparkSession, folder: str) -> DataFrame:
    return orders.first_days(orders.daily_sales(_clean(spark, folder)), 5)


@query
def sales_metrics_total(spark: SparkSession, folder: str) -> DataFrame:
    return SALES_METRICS.query(_clean(spark, folder), ["total_revenue", "AOV"])


@query
def sales_metrics_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return SALES_METRICS.query(_clean(spark, folder), ["total_revenue", "avg_order_value"], ["order_status"])


@query
def sales_metrics_by_status_date(spark: SparkSession, folder: str) -> DataFrame:
    return SALES_METRICS.query(_clean(spark, folder), ["turnover", "basket size"], ["order_status", "order_date"])


@query
def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.customer_features(_clean(spark, folder))


@query
def customer_features_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return features.customer_features(_clean(spark, folder), high_value=250_000)


@query
def features_lookup_json(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_key"))
    return features.lookup_json(keys, features.customer_features(_clean(spark, folder)))


@query
def features_lookup_function(spark: SparkSession, folder: str) -> DataFrame:
    features.register_lookup(
        features.customer_features(_clean(spark, folder)), "lookup_customer_features", "customer_features"
    )
    table(spark, folder, "customer").createOrReplaceTempView("lookup_keys")
    return spark.sql("SELECT c_custkey AS customer_key, lookup_customer_features(c_custkey) AS features_json FROM lookup_keys")


@query
def features_lookup_smallest(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup of the smallest key, found by a scalar subquery."""
    table_ = features.customer_features(_clean(spark, folder))
    features.register_lookup(table_, "lookup_customer_features", "customer_features")
    return spark.sql(
        "SELECT lookup_customer_features((SELECT min(customer_key) FROM customer_features)) AS features_json"
    )


def _old_and_new_features(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    clean = _clean(spark, folder)
    cut = F.lit(derived.FEATURE_CUT).cast("timestamp_ntz")
    old = features.customer_features(clean.filter(F.col("o_orderdate") < cut))
    new = features.customer_features(clean.filter(F.col("o_orderdate") >= cut))
    return old, new


@query
def features_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return features.upsert(*_old_and_new_features(spark, folder), "customer_key")


@query
def features_publish_changes(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _old_and_new_features(spark, folder)
    return features.publish_set(old, features.upsert(old, new, "customer_key"), "customer_key", "TRIGGERED")


@query
def features_publish_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _old_and_new_features(spark, folder)
    return features.publish_set(old, features.upsert(old, new, "customer_key"), "customer_key", "SNAPSHOT")


@query
def features_as_of(spark: SparkSession, folder: str) -> DataFrame:
    labels = derived.point_in_time_labels(table(spark, folder, "events"))
    history = features.order_day_features(_clean(spark, folder))
    return features.as_of_join(labels, history, "customer_key", "label_time", "feature_time")


# --- documents ---------------------------------------------------------------------------------------------------


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def _plain(documents: DataFrame) -> DataFrame:
    return docs.parse_plain(documents, derived.doc_path(), F.col("text"))


def _parsed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_documents(spark, folder))


def _parsed_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(table(spark, folder, "pages"), "page_id")
    return docs.parse_html(pages, F.col("url"), F.col("html"))


@query
def docs_binary_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents land as files of JSON lines, are ingested as binary rows by a stream, and decoded again."""
    landing = new_path(spark, "landing")
    source = table(spark, folder, "documents").select("doc_id", "text")
    source.write.option("maxRecordsPerFile", 5_000).json(landing)
    stream = files.binary_stream(spark, landing, "*.json")
    landed = run_to_end(stream, new_path(spark, "docs_bronze"), new_path(spark, "docs_bronze_checkpoint"))
    records = files.line_records(landed, source.schema)
    return records.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@query
def parse_errors(spark: SparkSession, folder: str) -> DataFrame:
    return health.parse_error_count(_parsed_pages(spark, folder))


@query
def doc_elements(spark: SparkSession, folder: str) -> DataFrame:
    return docs.elements(_parsed_pages(spark, folder))


@query
def element_walk(spark: SparkSession, folder: str) -> DataFrame:
    parsed = written(derived.nested_parse(_parsed_pages(spark, folder)), "parsed")
    return docs.elements(walk_elements(parsed, "parsed"))


@query
def element_walk_deep(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents, each nested in up to 19 more objects."""
    nested = derived.nested_parse(_parsed_pages(spark, folder), levels=derived.page_levels())
    return docs.elements(walk_any_depth(written(nested, "parsed"), "parsed"))


@query
def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Access by path into a semi-structured column, with a safe cast."""
    props = table(spark, folder, "events").select("event_id", F.parse_json("props").alias("v"))
    return props.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query
def doc_pages(spark: SparkSession, folder: str) -> DataFrame:
    return docs.document_pages(_parsed_pages(spark, folder))


@query
def docs_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", redact(F.col("text")).alias("text"))


@query
def docs_masked_entities(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", mask_entities(F.col("text")).alias("text"))


def _doc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return docs.chunk_documents(_parsed_documents(spark, folder))


@query
def doc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return _doc_chunks(spark, folder)


@query
def page_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return docs.chunk_documents(_parsed_pages(spark, folder), skip_types=docs.FRAME_TYPES)


@query
def prechunked(spark: SparkSession, folder: str) -> DataFrame:
    given = derived.line_contents(_documents(spark, folder))
    return docs.prechunked(given, F.col("path"), F.col("contents"), F.col("source"))


@query
def doc_chunks_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same chunks, from a stream; a second run over the same files adds nothing."""
    chunks = docs.chunk_documents(_plain(table_stream(spark, folder, "documents")))
    path, checkpoint = new_path(spark, "chunks"), new_path(spark, "chunks_checkpoint")
    run_to_end(chunks, path, checkpoint)
    return run_to_end(chunks, path, checkpoint)


@query
def docs_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_documents(_parsed_documents(spark, folder), derived.LANGUAGE_WORDS, derived.DOCUMENT_FIELDS)


@query
def docs_classified(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's likeliest language by a table of weighted terms, which is made of all documents."""
    documents = _documents(spark, folder).select(derived.doc_path().alias("path"), "lang", "text")
    rules = written(derived.language_rules(documents), "rules")
    return classify_by_rules(documents, rules).select("path", "lang", "doc_type")


# --- index and search --------------------------------------------------------------------------------------------


def _both_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    second = derived.second_documents(_documents(spark, folder))
    return _doc_chunks(spark, folder), docs.chunk_documents(_plain(second))


@query
def index_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes.diff(*_both_versions(spark, folder), "chunk_id")


@query
def index_synced(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _both_versions(spark, folder)
    changed = written(changes.change_rows(new, changes.diff(old, new, "chunk_id"), "chunk_id"), "changes")
    return changes.apply_changes(old, changed, "chunk_id").select("chunk_id", F.md5("chunk_to_embed").alias("digest"))


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    return search.question_terms(table(spark, folder, "benchmark"), "item_id", "text")


def _keyword_index(chunks: DataFrame) -> KeywordIndex:
    index = KeywordIndex(chunks.sparkSession, new_path(chunks.sparkSession, "keyword"))
    index.sync(chunks)
    return index


@query
def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _keyword_index(_doc_chunks(spark, folder)).top_k(_questions(spark, folder), K)


@query
def search_after_sync(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the first version, brought up to date by what changed, answers like one of the second."""
    old, new = _both_versions(spark, folder)
    index = _keyword_index(old)
    index.sync(new)
    return index.top_k(_questions(spark, folder), K)


@query
def hashed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    terms = written(search.index_terms(_doc_chunks(spark, folder)), "terms")
    index = search.add_vectors(terms.select("chunk_id", "terms"), search.term_weights(terms))
    return index.select("chunk_id", F.inline("vector")).select("chunk_id", "dim", F.round("value", 6).alias("value"))


@query
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    index = search.build_index(_doc_chunks(spark, folder))
    return search.vector_top_k(index.vectors, search.question_vectors(_questions(spark, folder), index.weights), K)


@query
def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    chunks = written(_doc_chunks(spark, folder), "chunks")
    hits = search.search_all(search.build_index(chunks), _questions(spark, folder), K)["HYBRID"]
    return search.with_citations(hits, chunks)


@query
def reranked_topk(spark: SparkSession, folder: str) -> DataFrame:
    index = search.build_index(_doc_chunks(spark, folder))
    questions = _questions(spark, folder)
    candidates = written(index.keyword.top_k(questions, RERANK_POOL), "candidates")
    return search.rerank(candidates, index.vectors, search.question_vectors(questions, index.weights), K)


@query
def cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return search.dense_top_k(vectors, "vec_id", search.centroids(vectors, "label"), K)


def _sketch_hits(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    index = search.SketchIndex(spark, new_path(spark, "sketches"), "vec_id", DIMS).write(vectors)
    return index.top_k(search.centroids(vectors, "label"), K)


@query
def ann_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _sketch_hits(spark, folder)


@query
def ann_recall(spark: SparkSession, folder: str) -> DataFrame:
    """How many of the exact hits the approximate search finds."""
    vectors = table(spark, folder, "embeddings")
    exact = search.dense_top_k(vectors, "vec_id", search.centroids(vectors, "label"), K)
    return search.recall(_sketch_hits(spark, folder), exact, "vec_id")


def _hit_rates(spark: SparkSession, folder: str) -> DataFrame:
    index = search.build_index(_doc_chunks(spark, folder))
    answers = search.search_all(index, _questions(spark, folder), K)
    corpus = _documents(spark, folder).select(derived.doc_path().alias("path"), "text")
    truth = written(evaluate.passage_sources(table(spark, folder, "benchmark"), corpus, "item_id", "text"), "truth")
    return evaluate.hit_rates(answers, truth, index.terms)


@query
def hit_rate_at_k(spark: SparkSession, folder: str) -> DataFrame:
    return _hit_rates(spark, folder)


@query
def retrieval_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The hybrid hit rate must reach its minimum. A metric nobody measured, like groundedness here, fails."""
    measured = _hit_rates(spark, folder).select(
        F.concat_ws("_", F.lit("hit_rate"), F.lower("method")).alias("metric"), F.col("hit_rate").alias("value")
    )
    return evaluate.gate(measured, {"hit_rate_hybrid": evaluate.MIN_HIT_RATE, "groundedness": 0.80})


# --- operations --------------------------------------------------------------------------------------------------


@query
def failures_24h(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return health.recent_failures(derived.quality_events(events), events.agg(F.max("ts")).scalar())


@query
def freshness_hours(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit(derived.FRESHNESS_AS_OF).cast("timestamp_ntz")
    return health.freshness(table(spark, folder, "events"), "ts", as_of, ("event_type",))


@query
def table_health(spark: SparkSession, folder: str) -> DataFrame:
    return health.table_health({name: table(spark, folder, name) for name in TABLES})


@query
def retrieval_canary(spark: SparkSession, folder: str) -> DataFrame:
    return health.canary(
        {
            "chunk_count": _doc_chunks(spark, folder),
            "feature_count": features.customer_features(_clean(spark, folder)),
        }
    )


def _forgotten(spark: SparkSession, folder: str) -> DataFrame:
    """Documents labelled toxic have to go."""
    return table(spark, folder, "labels").filter("toxic = 1").select(derived.doc_path().alias("path")).distinct()


@query
def forget_documents(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _parsed_documents(spark, folder)
    before = {
        "parsed": (parsed.select("path", "error_status"), "path"),
        "enriched": (enrich_documents(parsed).select("path"), "path"),
        "chunks": (_doc_chunks(spark, folder).select("path", "chunk_id"), "path"),
    }
    forgotten = _forgotten(spark, folder)
    # Both states are written, so that what is counted is what the files hold.
    before = {name: (written(df, f"before-{name}"), key) for name, (df, key) in before.items()}
    after = {name: written(df, f"after-{name}") for name, df in changes.forget(before, forgotten).items()}
    return changes.forget_report(before, after, forgotten)


@query
def forget_proof(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks are indexed, documents forgotten and old files removed. By state: rows that files below the index hold of forgotten
    documents, and of chunks with the same text as one of theirs under another name, which stay."""
    index = ChangeLogTable(spark, new_path(spark, "proof"), "chunk_id")
    chunks = written(_doc_chunks(spark, folder).select("chunk_id", "path", F.sha2("chunk_to_embed", 256).alias("text_hash")), "chunks")
    index.sync(chunks)
    forgotten = written(_forgotten(spark, folder), "forgotten")
    gone = written(lookup_join(chunks, forgotten, ["path"], "left_semi", F.col("chunk_id")), "gone")
    keys = {"path": forgotten, "chunk_id": gone.select("chunk_id"), "text_hash": gone.select("text_hash")}

    def state(name: str) -> DataFrame:
        held = leftover_files(spark, index.root, keys).groupBy("key_column").agg(F.sum("rows").alias("rows"))
        counts = [F.coalesce(F.sum(F.when(F.col("key_column") == key, F.col("rows"))), F.lit(0)).alias(f"rows_by_{key}") for key in keys]
        return written(held.agg(*counts).select(F.lit(name).alias("state"), "*"), f"state-{name}")

    states = [state("indexed")]
    index.sync(changes.without(chunks, "path", forgotten))
    states.append(state("synced"))
    index.drop_before(index.compact())
    return states[0].unionByName(states[1]).unionByName(state("purged"))


@query
def forget_search(spark: SparkSession, folder: str) -> DataFrame:
    """Search after the deletion: the best hits without the forgotten documents."""
    index = _keyword_index(_doc_chunks(spark, folder))
    index.remove(_forgotten(spark, folder))
    hits = index.top_k(_questions(spark, folder), K)
    return lookup_join(index.live().select("chunk_id", "path"), hits, ["chunk_id"]).select("query_id", "chunk_id", "path", "rank")
