import json
import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.operators import search
from millrace.operators.expectations import Rule, rule_counts
from millrace.operators.orders import ORDER_RULES, normalize_orders
from millrace.session import new_path
from millrace.sources import files
from millrace.sources.tables import eval_questions, table, table_stream
from millrace.streaming.runs import run_checked, run_to_end, start, start_each


def paths(spark):
    return new_path(spark, "out"), new_path(spark, "checkpoint")


def html(text):
    return f"<html><title>T</title><p>{text}</p></html>"


def test_new_files_are_read_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "_schema").write_text("skipped")
    (landing / "a.html").write_bytes("é".encode())
    (landing / "b.html").write_bytes(b"\xff broken")
    stream = files.binary_stream(spark, str(landing), files_per_trigger=1, ingest_time=F.lit("2024-01-01").cast("timestamp"))
    out = paths(spark)
    first = run_to_end(stream, *out)
    assert first.columns == ["path", "modificationTime", "length", "content", "ingest_time"]
    assert sorted(os.path.basename(r.path) for r in first.collect()) == ["a.html", "b.html"]
    assert {r.text for r in files.file_text(first).collect()} == {"é", "� broken"}
    assert run_to_end(stream, *out).count() == 2
    (landing / "c.html").write_text("new")
    assert run_to_end(stream, *out).count() == 3


def test_documents_from_files_to_chunks_and_terms(spark, tmp_path):
    landing = tmp_path / "docs"
    landing.mkdir()
    for n in range(5):
        (landing / f"{n}.html").write_text(html(f"document {n} is about things that matter to somebody somewhere"))
    (landing / "cut.html").write_text("<html><p>this one was cut off before it came to its end, but long after it had begun")
    stream = files.binary_stream(spark, str(landing), "*.html")
    text = files.file_text(stream)
    chunks = docs.chunk_documents(docs.parse_html(text, F.col("path"), F.col("text")))
    written = run_to_end(chunks, *paths(spark))
    assert written.count() == 6 and written.filter(F.col("path").endswith("cut.html")).count() == 1
    terms = run_to_end(search.index_terms(chunks), *paths(spark))
    assert terms.filter("n_terms > 5").count() == 6


def test_forgotten_files_stay_out(spark, tmp_path):
    landing = tmp_path / "some"
    landing.mkdir()
    (landing / "a.txt").write_text("a")
    (landing / "b.txt").write_text("b")
    stream = files.binary_stream(spark, str(landing))
    gone = spark.createDataFrame([(f"file:{landing}/a.txt",)], "path string")
    kept = run_to_end(files.without_forgotten(stream, gone), *paths(spark))
    assert [os.path.basename(r.path) for r in kept.collect()] == ["b.txt"]


def test_stream_equals_batch(spark, small):
    plain = lambda df: docs.parse_plain(df, F.col("doc_id").cast("string"), F.col("text"))
    batch = docs.chunk_documents(plain(table(spark, small, "documents")))
    out = paths(spark)
    stream = docs.chunk_documents(plain(table_stream(spark, small, "documents")))
    assert rows(run_to_end(stream, *out)) == rows(batch)
    assert rows(run_to_end(stream, *out)) == rows(batch)


def test_rules_on_a_stream(spark, small):
    at = datetime(2024, 1, 1)
    stream = table_stream(spark, small, "orders", files_per_trigger=1)
    data, log = run_checked(stream, ORDER_RULES, "orders", *paths(spark), at)
    batch = table(spark, small, "orders")
    assert rows(log.drop("timestamp")) == rows(rule_counts(batch, ORDER_RULES, "orders"))
    assert data.count() == batch.count()
    assert normalize_orders(data).count() == batch.count()


def test_rules_on_more_batches_than_spark_remembers(spark, tmp_path):
    landing, out, rules = tmp_path / "many", paths(spark), [Rule("small", "id < 55"), Rule("odd", "id % 2 = 1", drop=True)]
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")

    def run():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(landing))
        data, log = run_checked(stream, rules, "many", *out, datetime(2024, 1, 1))
        return data.count(), log.count(), rows(log.groupBy("name").agg(F.sum("passed_records"), F.sum("failed_records")))

    try:
        landing.mkdir()
        assert run() == (0, 0, [])
        spark.range(0, 60, 1, 6).write.mode("append").parquet(str(landing))
        assert run() == (30, 12, [("odd", 30, 30), ("small", 55, 5)])
        assert run() == (30, 0, [])
        spark.range(60, 70, 1, 1).write.mode("append").parquet(str(landing))
        assert run() == (35, 2, [("odd", 5, 5), ("small", 0, 10)])
    finally:
        spark.conf.unset(key)


def test_batches_to_a_merging_sink(spark, small):
    seen = []
    start_each(table_stream(spark, small, "nation"), lambda df, n: seen.append(df.count()), new_path(spark, "c")).awaitTermination()
    assert sum(seen) == 25


def test_run_modes(spark, small):
    stream = table_stream(spark, small, "region")
    with pytest.raises(ValueError, match="mode"):
        start(stream, *paths(spark), mode="sometimes")
    with pytest.raises(ValueError, match="mode"):
        start_each(stream, print, new_path(spark, "c"), mode="sometimes")
    query = start(stream, *paths(spark), mode="continuous", interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()


def test_eval_questions(spark, tmp_path):
    file = tmp_path / "eval.jsonl"
    items = [{"query": "what?", "expected_source": "a.pdf"}, {"query": "why?", "expected_source": "b.pdf"}]
    file.write_text("\n".join(json.dumps(i) for i in items) + "\n")
    read = eval_questions(spark, str(file))
    assert read.columns == ["query_id", "query", "expected_source"]
    assert rows(read.drop("query_id")) == [("what?", "a.pdf"), ("why?", "b.pdf")]
    assert read.select("query_id").distinct().count() == 2
