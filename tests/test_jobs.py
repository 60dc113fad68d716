from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import jobs
from millrace.session import new_path
from millrace.sources.tables import eval_questions, table

AT = datetime(2024, 1, 1)
PAGES = {
    "tides": "Spring tides follow the new and the full moon, when the pull of sun and moon adds up along one line through the earth.",
    "bread": "A sourdough loaf rises slowly at room temperature, since wild yeast needs many hours to fill the crumb with gas.",
    "glass": "Window glass is poured on molten tin, where it spreads into a ribbon that is flat on both sides without polishing.",
    "letter": "The reading room keeps my umbrella, so tell the porter please, at mila.b@library.example or +49 30 7654 3210.",
}
QUESTIONS = [
    (1, "when do spring tides follow the moon", "tides.html"),
    (2, "why does a sourdough loaf rise slowly", "bread.html"),
    (3, "what is window glass poured on", "glass.html"),
]


def page(title, text):
    return f"<html><title>{title}</title><nav><ul><li>menu</li></ul></nav><h1>{title}</h1><p>{text}</p></html>"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory, small):
    landing = tmp_path_factory.mktemp("landing")
    for name, text in PAGES.items():
        (landing / f"{name}.html").write_text(page(f"About {name}", text))
    (landing / "cut.html").write_text("<html><p>" + "this page was cut off in the middle " * 3)
    made = jobs.Lake(spark, new_path(spark, "lake"))
    made.landing = landing
    jobs.refine_orders(made, table(spark, small, "orders"), "test", AT)
    jobs.refine_documents(made, str(landing))
    jobs.sync_index(made)
    return made


def test_tables_and_checks(lake):
    health = {r.table_name: r.row_count for r in jobs.verify(lake).collect()}
    asks = {"ask: metric", "ask: lookup", "ask: search"}
    assert set(health) == {*jobs.ORDER_TABLES, *jobs.DOCUMENT_TABLES, "customer_features", "index", *asks}
    assert {r.status for r in jobs.verify(lake).collect()} == {"PASS"} and {health[a] for a in asks} == {1}
    nothing = jobs.Lake(lake.spark, new_path(lake.spark, "nothing"))
    assert {(r.table_name, r.row_count, r.status) for r in jobs.verify(nothing).collect()} == {(name, 0, "FAIL") for name in health}
    assert (health["docs_bronze"], health["docs_parsed"], health["docs_enriched"], health["chunks"]) == (5, 5, 5, 5)
    assert lake.read("chunks").filter(F.col("chunk_to_embed").rlike("@|7654")).count() == 0
    jobs.publish_quality(lake)
    assert lake.spark.sql("SELECT sum(failed_records) FROM orders_quality_log WHERE name = 'valid_price'").first()[0] == 0
    assert rows(lake.read("quality_log").select("name")) == [("known_status",), ("valid_order_key",), ("valid_price",)]


def test_a_second_run_adds_nothing(lake):
    jobs.refine_documents(lake, str(lake.landing))
    assert lake.read("docs_bronze").count() == 5


def test_questions_and_hit_rates(lake, spark):
    questions = spark.createDataFrame(QUESTIONS, "query_id int, query string, expected_source string")
    best = jobs.ask(lake, questions, k=1).collect()
    assert {r.query_id: r.source_uri.split("/")[-1] for r in best} == {
        1: "tides.html (p.0)",
        2: "bread.html (p.0)",
        3: "glass.html (p.0)",
    }
    assert {r.method: r.hit_rate for r in jobs.evaluate_retrieval(lake, questions).collect()}["HYBRID"] == 1.0
    with pytest.raises(ValueError, match="method"):
        jobs.ask(lake, questions, method="GUESS")
    # A question whose source is not in the index was asked all the same, and fails.
    lost = questions.union(spark.createDataFrame([(4, "how deep is the lake", "lake.html")], questions.schema))
    path = new_path(spark, "eval")
    lost.drop("query_id").write.json(path)
    lost = eval_questions(spark, path)
    measured = {r.method: (r.hits, r.questions) for r in jobs.evaluate_retrieval(lake, lost).collect()}
    assert measured["HYBRID"] == (3, 4)


def test_forgetting_reaches_every_table_and_lasts(lake, spark):
    gone = lake.read("docs_bronze").filter(F.col("path").endswith("/letter.html")).select("path")
    path = gone.first().path
    gone_paths = spark.createDataFrame([(path,)], "path string")
    ids = spark.createDataFrame(lake.read("chunks").filter(F.col("path") == path).select("chunk_id").collect(), "chunk_id string")
    report = {r.table_name: (r.rows_before, r.rows_removed, r.rows_leftover) for r in jobs.forget_documents(lake, gone, AT).collect()}
    assert report == {"docs_bronze": (5, 1, 0), "docs_parsed": (5, 1, 0), "docs_enriched": (5, 1, 0), "chunks": (5, 1, 0)}
    for df in [*(lake.read(name) for name in jobs.DOCUMENT_TABLES), lake.index.read()]:
        assert df.filter(F.col("path") == path).count() == 0 and df.count() > 0
    question = spark.createDataFrame([(9, "umbrella in the reading room")], "query_id int, query string")
    assert jobs.ask(lake, question, k=10).filter(F.col("source_uri").contains("letter")).count() == 0
    with pytest.raises(ValueError, match="in use"):
        jobs.drop_generation(lake, lake.generation())
    # Readers no longer see the document, but earlier files hold it: bronze, parsed, enriched, chunks, index and search.
    held = {r.file.split(lake.root)[1].split("/")[1] for r in jobs.proof_of_deletion(lake, gone_paths, ids).collect()}
    assert held == {"documents", "index", "search"}
    jobs.purge(lake, ids)
    assert jobs.proof_of_deletion(lake, gone_paths, ids).count() == 0
    assert not [f for f in Path(lake.root).rglob("*.parquet") if b"umbrella" in f.read_bytes()]
    assert jobs.ask(lake, question, k=10).count() > 0 and lake.index.read().count() == 4
    jobs.purge(lake, ids)
    # The file comes in again, changed and under the same name; another one is new.
    (lake.landing / "letter.html").write_text(page("About letter", PAGES["letter"] + " Again."))
    (lake.landing / "more.html").write_text(page("More", "One more page that is long enough to become a chunk of its own."))
    jobs.refine_documents(lake, str(lake.landing))
    names = sorted(r.path.split("/")[-1] for r in lake.read("docs_bronze").collect())
    assert names == ["bread.html", "cut.html", "glass.html", "more.html", "tides.html"]
    jobs.sync_index(lake)
    assert lake.index.read().filter(F.col("path").endswith("/more.html")).count() == 1
