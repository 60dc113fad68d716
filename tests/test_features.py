from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import features as ft

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("unit", ["hour", "day", "month", None])
def test_as_of_equals_a_sorted_merge_with_a_hot_key(spark, unit):
    rng = np.random.default_rng(5)
    keys = np.where(rng.random(3000) < 0.4, 0, rng.integers(1, 40, 3000))
    times = [START + timedelta(minutes=int(m)) for m in rng.integers(0, 60 * 24 * 90, 3000)]
    features = pd.DataFrame({"k": keys, "t": times, "v": np.arange(3000)}).drop_duplicates(["k", "t"])
    labels = pd.DataFrame(
        {
            "id": np.arange(2000),
            "k": np.where(rng.random(2000) < 0.4, 0, rng.integers(1, 45, 2000)),
            "at": [START + timedelta(minutes=int(m)) for m in rng.integers(-500, 60 * 24 * 95, 2000)],
        }
    )
    labels.loc[:50, ["k", "at"]] = features[["k", "t"]].iloc[:51].to_numpy()
    labels.loc[60:80, "at"] = labels.loc[60, "at"]
    labels["at"] = pd.to_datetime(labels["at"])
    labels["k"] = labels["k"].astype("int64")
    expected = pd.merge_asof(labels.sort_values("at"), features.sort_values("t"), left_on="at", right_on="t", by="k")
    want = {r.id: None if pd.isna(r.v) else int(r.v) for r in expected.itertuples()}
    f = spark.createDataFrame(features, "k long, t timestamp_ntz, v long")
    l = spark.createDataFrame(labels, "id long, k long, at timestamp_ntz")
    got = ft.as_of_join(l, f, "k", "at", "t", unit)
    assert got.columns == ["id", "k", "at", "t", "v"]
    assert {r.id: r.v for r in got.collect()} == want


def test_slices_are_as_fine_as_the_busiest_key_needs(spark):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    times = spark.range(7200).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"),
        (start + F.make_dt_interval(secs=F.col("id"))).alias("t"),
    )
    assert [ft.fine_enough(times, "k", "t", most) for most in (4000, 3600, 60, 1)] == ["month", "hour", "minute", "second"]


def test_upsert_and_publish(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, v string")
    merged = ft.upsert(old, new, "k")
    assert rows(merged) == [(1, "a"), (2, "B"), (3, None), (4, "d")]
    assert rows(ft.publish_set(old, merged, "k")) == [(2, "B", "update"), (4, "d", "insert")]
    assert rows(ft.publish_set(old, new, "k", "CONTINUOUS")) == [(1, None, "delete"), (2, "B", "update"), (4, "d", "insert")]
    assert {r.change_type for r in ft.publish_set(old, new, "k", "SNAPSHOT").collect()} == {"snapshot"}
    with pytest.raises(ValueError, match="publish mode"):
        ft.publish_set(old, new, "k", "SOMETIMES")


def test_unique_keys(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    ft.require_unique(ok, "k")
    for bad in (ok.union(ok), ok.withColumn("k", F.lit(None).cast("int"))):
        with pytest.raises(ValueError, match="unique"):
            ft.require_unique(bad, "k")
