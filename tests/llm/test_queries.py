import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES
from tests.llm.conftest import NEAR, ODD


def plain(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in (tuple(r) for r in rows))


def test_all_are_registered():
    known = driver.queries()
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in QUERIES)] == []
    assert set(QUERIES) | {"pipeline"} <= set(known)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    connection = duckdb.connect()
    for file in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, small)
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), columns)


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = corpus_pipeline.run(spark, small).collect()
    kept = {r["doc_id"] for r in got}
    good = {r["doc_id"] for r in QUERIES["op7_quality_rules"](spark, small).filter("kept").collect()}
    assert kept and kept <= good
    assert len(kept) > 0.5 * docs.count()


def test_stages_on_odd_rows(spark, small, odd, none):
    for df in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, small)
            rows = out.collect()
            assert name == "best-fit packing" or out.columns == df.columns
            if df is none:
                assert rows == []
            elif name == "personal data":
                assert len(rows) == len(ODD)
            elif name == "n-gram jaccard join":
                assert NEAR not in {r["text"] for r in rows} and len(rows) == 10
