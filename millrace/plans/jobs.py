"""The jobs from raw input to products: each writes the tables that the next one and the checks read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators import changes, documents, evaluate, expectations, features, health, orders, search
from millrace.operators.enrich import enrich_documents
from millrace.operators.metrics import SALES_METRICS
from millrace.sources import files
from millrace.sources.sinks import ChangeLogTable, VersionedTable, append, leftover_files, overwrite, publish_view, remove_folder
from millrace.streaming.runs import start_each

ORDER_TABLES = ("orders_bronze", "orders_silver", "daily_sales", "quality_log")
# Every table that holds rows of documents, and the column that names the document.
DOCUMENT_TABLES = {"docs_bronze": "path", "docs_parsed": "path", "docs_enriched": "path", "chunks": "path"}


class Lake:
    """Where each table is. Writers and checks ask the same place, so they cannot disagree on names.

    Document tables are kept by generation: a deletion writes the next generation without the deleted documents and
    switches to it when all tables are there, so readers never see a half-finished deletion. Each micro-batch has a folder
    of its own, which a repeated batch overwrites.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.generations = VersionedTable(spark, f"{self.root}/generations", "generation")
        self.features = VersionedTable(spark, f"{self.root}/customer_features", "customer_key")
        self.index = ChangeLogTable(spark, f"{self.root}/index", "chunk_id")

    @property
    def search(self) -> search.Index:
        """The search index of the present base of the chunk index."""
        known = self.index.base.versions()
        return search.Index(self.spark, f"{self.root}/search/base={known[-1] if known else 0}")

    def generation(self) -> int:
        known = self.generations.versions()
        return known[-1] if known else 0

    def path(self, name: str, generation: int | None = None) -> str:
        if name not in DOCUMENT_TABLES:
            return f"{self.root}/{name}"
        return f"{self.root}/documents/g={self.generation() if generation is None else generation}/{name}"

    def read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.drop("batch") if name in DOCUMENT_TABLES else df

    def forgotten(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "path string, forgotten_at timestamp_ntz")
        if self.generation() == 0:
            return empty
        return self.spark.read.schema(empty.schema).parquet(self.path("forgotten"))


def refine_orders(lake: Lake, source: DataFrame, source_system: str, at: datetime) -> None:
    """Land the orders, check and count them, and write the mart and the features."""
    ingest_time = F.lit(at).cast("timestamp")
    overwrite(orders.land_orders(source, source_system, ingest_time), lake.path("orders_bronze"))
    seen = Observation("orders_silver")
    checked = expectations.observed(lake.read("orders_bronze"), orders.ORDER_RULES, seen)
    overwrite(orders.normalize_orders(checked), lake.path("orders_silver"))
    log = expectations.log_rows(lake.spark, seen.get, orders.ORDER_RULES, "orders_silver", at)
    append(log, lake.path("quality_log"))
    silver = lake.read("orders_silver")
    overwrite(orders.daily_sales(silver), lake.path("daily_sales"))
    lake.features.create_or_merge(features.customer_features(silver))


def publish_quality(lake: Lake, view: str = "orders_quality_log") -> None:
    """Make the quality log queryable by name for everybody in the session."""
    publish_view(lake.read("quality_log"), view)


def refine_documents(lake: Lake, landing: str, pattern: str = "*.html", elements_per_page: int = 10) -> None:
    """Take in new files: bronze, parsed, enriched and chunks. Files of forgotten documents stay out."""

    def take_in(batch: DataFrame, number: int) -> None:
        def write(df: DataFrame, name: str) -> DataFrame:
            path = f"{lake.path(name)}/batch={number}"
            df.write.mode("overwrite").parquet(path)
            return batch.sparkSession.read.schema(df.schema).parquet(path)

        bronze = write(batch, "docs_bronze")
        text = files.file_text(bronze)
        parsed = documents.parse_html(text, F.col("path"), F.col("text"), elements_per_page, keep=("ingest_time",))
        parsed = write(parsed, "docs_parsed")
        write(enrich_documents(parsed), "docs_enriched")
        write(documents.chunk_documents(parsed, documents.FRAME_TYPES), "chunks")

    stream = files.without_forgotten(files.binary_stream(lake.spark, landing, pattern), lake.forgotten())
    start_each(stream, take_in, f"{lake.root}/checkpoints/documents").awaitTermination()


def sync_index(lake: Lake) -> None:
    """Bring the index to the state of the chunks; only what changed is written, apart from vectors."""
    lake.index.sync(lake.read("chunks"))
    lake.search.sync(lake.read("chunks"))


def ask(lake: Lake, questions: DataFrame, k: int = 5, method: str = "HYBRID") -> DataFrame:
    """Answers with citations for ``query_id, query``."""
    asked = search.question_terms(questions, "query_id", "query")
    found = search.search_all(lake.search, asked, k)
    if method not in found:
        raise ValueError(f"method must be one of {sorted(found)}, not {method!r}")
    return search.with_citations(found[method], lake.index.read())


def evaluate_retrieval(lake: Lake, questions: DataFrame, k: int = 5) -> DataFrame:
    """Hit rates by method for ``query_id, query, expected_source``, as ``eval_questions`` reads them; a source is a file name.

    Every question counts, whether its source is in the index or not.
    """
    chunks = lake.index.read()
    found = search.search_all(lake.search, search.question_terms(questions, "query_id", "query"), k)
    # A question expects a file name, which every path ends with after a slash.
    named = chunks.select("path").distinct().withColumn("file", F.substring_index("path", "/", -1))
    truth = questions.join(named, questions["expected_source"] == named["file"]).select("query_id", "path")
    return evaluate.hit_rates(found, truth, chunks, questions.select("query_id"))


def forget_documents(lake: Lake, paths: DataFrame, at: datetime) -> DataFrame:
    """Delete documents from every table and the index, and report what is left of them, which must be nothing.

    The next generation counts only after the report is clean. Earlier files still hold the documents until :func:`purge` removes them.
    """
    wanted = paths.select("path").distinct().withColumn("forgotten_at", F.lit(at).cast("timestamp_ntz"))
    now, following = lake.generation(), lake.generation() + 1
    before = {name: (lake.read(name), key) for name, key in DOCUMENT_TABLES.items()}
    for name, kept in changes.forget(before, wanted).items():
        kept.write.mode("overwrite").parquet(f"{lake.path(name, following)}/batch=-1")
    after = {
        name: lake.spark.read.parquet(lake.path(name, following)).drop("batch") for name in DOCUMENT_TABLES
    }
    report = changes.forget_report(before, after, wanted)
    if report.agg(F.sum("rows_leftover")).first()[0]:
        raise RuntimeError(f"generation {following} still holds forgotten documents; staying with {now}")
    append(wanted, lake.path("forgotten"))
    marker = lake.spark.createDataFrame([(following,)], "generation int")
    lake.generations.replace(marker)
    sync_index(lake)
    return report


def drop_generation(lake: Lake, generation: int) -> None:
    """Remove the files of a generation that is no longer in use, and with them the bytes of forgotten documents."""
    if generation >= lake.generation():
        raise ValueError(f"generation {generation} is in use")
    remove_folder(lake.spark, f"{lake.root}/documents/g={generation}")


def proof_of_deletion(lake: Lake, paths: DataFrame, chunk_ids: DataFrame) -> DataFrame:
    """``file, key_column, rows`` of the lake's files that hold rows of documents or chunks; none when they are gone.

    The list of what had to be forgotten keeps the names, so that the files are not taken in again, and isn't counted.
    """
    held = leftover_files(lake.spark, lake.root, {"path": paths, "chunk_id": chunk_ids})
    return held.filter(~F.col("file").contains(f"{lake.path('forgotten')}/"))


def purge(lake: Lake, chunk_ids: DataFrame | None = None) -> None:
    """Remove the bytes of all forgotten documents: earlier generations, the chunk index's earlier bases and logs, and the search
    indexes that go with them. New ones are written first. Fails, when a file is left that holds a forgotten path or one of ``chunk_ids``.

    Run it when nobody reads an earlier generation any more. What it did is done again by a second run after a failure.
    Other folders, such as the session's working folder, can be looked through with :func:`leftover_files`.
    """
    base = lake.index.compact()
    sync_index(lake)
    for old in range(lake.generation()):
        drop_generation(lake, old)
    lake.index.drop_before(base)
    for old in range(base):
        remove_folder(lake.spark, f"{lake.root}/search/base={old}")
    nothing = lake.spark.createDataFrame([], "chunk_id string")
    left = proof_of_deletion(lake, lake.forgotten().select("path"), nothing if chunk_ids is None else chunk_ids).limit(1).collect()
    if left:
        raise RuntimeError(f"{left[0].file} still holds {left[0].rows} rows of what was forgotten")


def _there(lake: Lake, path: str) -> bool:
    jvm = lake.spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(lake.spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def verify(lake: Lake) -> DataFrame:
    """``table_name, row_count, status`` of all tables, and of a question to each product: a metric, a lookup by key and a search.

    What is empty fails, and what is not there is a failed row like any other.
    """
    tables: dict[str, DataFrame | None] = {
        name: lake.read(name) if _there(lake, lake.path(name)) else None for name in (*ORDER_TABLES, *DOCUMENT_TABLES)
    }
    tables["customer_features"] = lake.features.read() if lake.features.versions() else None
    tables["index"] = lake.index.read() if lake.index.base.versions() else None
    silver, customers = tables["orders_silver"], tables["customer_features"]
    tables["ask: metric"] = silver if silver is None else SALES_METRICS.query(silver, ["sales"]).filter("total_revenue is not null")
    tables["ask: lookup"] = None
    if customers is not None:
        smallest = customers.agg(F.min("customer_key").alias("customer_key"))
        tables["ask: lookup"] = features.lookup_json(smallest, customers).filter("features_json is not null")
    tables["ask: search"] = None
    if lake.search.keyword.segments():
        # A chunk must be found by its own words.
        known = lake.search.terms.filter("n_terms > 0").limit(1).select(F.col("chunk_id").alias("query_id"), "terms")
        tables["ask: search"] = lake.search.keyword.top_k(known, 1)
    missing = [(name, 0, "FAIL") for name, df in tables.items() if df is None]
    found = {name: df for name, df in tables.items() if df is not None}
    failed = lake.spark.createDataFrame(missing, "table_name string, row_count long, status string")
    return health.table_health(found).unionByName(failed) if found else failed
