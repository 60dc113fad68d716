import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from millrace import session
from millrace.plans.oracles import ORACLES
from millrace.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for file in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


def plain(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in (tuple(r) for r in rows))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, small, name):
    df = driver.queries()[name](spark, small)
    result = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), columns)


def test_entry(spark):
    assert driver.entry(spark).columns[:3] == ["query_id", "rank", "score"]


def test_shared_folder(spark, monkeypatch):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.new_path(spark, "x") != session.new_path(spark, "x")

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "yarn"

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)
