from datetime import datetime
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import expectations as ex
from millrace.operators import features as ft
from millrace.operators import orders as od
from millrace.operators.metrics import SALES_METRICS

SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"


def order(key, cust, status, price, day="2024-01-02"):
    return key, cust, status, price, datetime.fromisoformat(day)


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [
            order(1, 1, "F", 600.0),
            order(2, 1, "O", 400.005),
            order(3, 1, "P", 100.0, "2024-02-02"),
            order(4, 2, None, 900.0),
            order(5, 2, "F", -1.0),
            order(6, 2, "F", None),
            order(None, 2, "F", 5.0),
            order(7, 2, "X", 0.0),
        ],
        SCHEMA,
    )


def test_landing_adds_metadata_only(dirty):
    landed = od.land_orders(dirty, "src", F.lit("2024-01-01").cast("timestamp"))
    assert landed.columns == [*dirty.columns, "ingest_time", "source_system"]
    assert landed.count() == dirty.count()


def test_rules_drop_and_count(spark, dirty):
    clean = od.clean_orders(dirty)
    assert sorted(r.o_orderkey for r in clean.collect()) == [1, 2, 3, 4]
    expected = [("known_status", "o", 6, 2), ("valid_order_key", "o", 7, 1), ("valid_price", "o", 5, 3)]
    assert rows(ex.rule_counts(dirty, od.ORDER_RULES, "o")) == expected
    seen = Observation("run")
    assert ex.observed(dirty, od.ORDER_RULES, seen).count() == 4
    log = ex.log_rows(spark, seen.get, od.ORDER_RULES, "o", datetime(2024, 1, 1))
    assert rows(log.drop("timestamp")) == expected


def test_status(dirty):
    got = {r.o_orderkey: r.order_status for r in od.clean_orders(dirty).collect()}
    assert got == {1: "Fulfilled", 2: "Open", 3: "Unknown", 4: "Unknown"}


def test_rules_reach_the_scan(spark, small):
    text = plan(od.daily_sales(od.clean_orders(spark.read.parquet(f"{small}/orders.parquet"))))
    assert "GreaterThan(o_totalprice,0.0)" in text and "IsNotNull(o_orderkey)" in text
    assert "o_orderpriority" not in text


def test_daily_sales(dirty):
    got = rows(od.daily_sales(od.clean_orders(dirty)))
    assert got == [(2024, 1, 2, Decimal("1900.01"), 3), (2024, 2, 2, Decimal("100.00"), 1)]
    assert od.first_days(od.daily_sales(od.clean_orders(dirty)), 1).count() == 1


def test_customer_features(dirty):
    got = {r.customer_key: r for r in ft.customer_features(od.clean_orders(dirty)).collect()}
    assert tuple(got[1])[1:] == (3, Decimal("366.67"), 2, pytest.approx(1 / 3))
    assert tuple(got[2])[1:] == (1, Decimal("900.00"), 1, 1.0)


def test_lookups(spark, dirty):
    features = ft.customer_features(od.clean_orders(dirty))
    keys = spark.createDataFrame([(1,), (99,)], "customer_key long")
    got = dict(ft.lookup_json(keys, features).collect())
    assert got[99] is None
    assert got[1].startswith('{"total_orders":3,"avg_order_value":366.67,"months_active":2')
    ft.register_lookup(features, "look_up", "features_view")
    assert spark.sql("SELECT look_up(1), look_up(99)").first()[:] == (got[1], None)
    found = {r.customer_key: r.total_orders for r in ft.features_for(keys, features, "customer_key").collect()}
    assert found == {1: 3, 99: None}


def test_metrics(dirty):
    clean = od.clean_orders(dirty)
    assert SALES_METRICS.query(clean, ["sales"]).first().total_revenue == Decimal("2000.01")
    by_status = {r.order_status: r for r in SALES_METRICS.query(clean, ["income", "aov"], ["order_status"]).collect()}
    assert by_status["Unknown"].avg_order_value == Decimal("500.00")
    for bad in (lambda: SALES_METRICS.query(clean, ["margin"]), lambda: SALES_METRICS.query(clean, ["sales"], ["region"])):
        with pytest.raises(ValueError):
            bad()
