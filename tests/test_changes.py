import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from millrace import sizing
from millrace.operators import changes as ch
from millrace.operators import health
from millrace.session import new_path
from millrace.sizing import is_small, lookup_join, spread
from millrace.sources.sinks import ChangeLogTable, VersionedTable, leftover_files
from millrace.streaming.runs import run_to_end


def frame(spark, data):
    return spark.createDataFrame(data, "k string, a string, b string")


def test_diff_tells_nulls_apart(spark):
    old = frame(spark, [("1", None, "x"), ("2", "y", None), ("3", "same", None), ("4", "gone", "g")])
    new = frame(spark, [("1", "x", None), ("2", "y", "z"), ("3", "same", None), ("5", "new", "n")])
    got = ch.diff(old, new, "k")
    assert rows(got) == [("1", "update"), ("2", "update"), ("4", "delete"), ("5", "insert")]
    assert rows(ch.apply_changes(old, ch.change_rows(new, got, "k"), "k")) == rows(new)


def test_change_log_table(spark):
    table = ChangeLogTable(spark, new_path(spark, "log"), "k")
    states = [
        [("1", "a", None), ("2", "b", None)],
        [("1", "A", None), ("2", "b", None), ("3", "c", None)],
        [("3", "C", "x")],
        [("1", "back", None), ("3", "C", "x")],
    ]
    for state in states:
        table.sync(frame(spark, state))
        assert rows(table.read()) == sorted(state)
    assert table.change_feed().count() == 2 + 3 + 1
    followed = run_to_end(table.change_stream(), new_path(spark, "feed"), new_path(spark, "feed_checkpoint"))
    assert followed.count() == 6
    table.compact()
    assert rows(table.read()) == sorted(states[-1])
    assert table.change_feed().count() == 0


def test_versioned_table(spark):
    table = VersionedTable(spark, new_path(spark, "versions"), "k")
    with pytest.raises(ValueError):
        table.read()
    assert table.create_or_merge(frame(spark, [("1", "a", None), ("2", "b", None)])) == 1
    assert table.create_or_merge(frame(spark, [("2", "B", None), ("3", "c", None)])) == 2
    assert rows(table.read()) == [("1", "a", None), ("2", "B", None), ("3", "c", None)]
    assert rows(table.read(1)) == [("1", "a", None), ("2", "b", None)]
    assert rows(table.changes(1).select("k", "change_type")) == [("2", "update"), ("3", "insert")]
    with pytest.raises(ValueError, match="unique"):
        table.replace(frame(spark, [("1", "a", None), ("1", "b", None)]))


def test_forget_matches_whole_keys_only(spark):
    chunks = spark.createDataFrame([("complaint_letter.pdf", 1), ("complaintXletter.pdf", 2), ("b", 3)], "path string, n int")
    parsed = chunks.select(F.col("path").alias("file"), "n")
    tables = {"chunks": (chunks, "path"), "parsed": (parsed, "file")}
    gone = spark.createDataFrame([("complaint_letter.pdf",)], "path string")
    kept = ch.forget(tables, gone)
    assert rows(kept["chunks"].select("n")) == [(2,), (3,)]
    assert rows(ch.forget_report(tables, kept, gone)) == [("chunks", 3, 1, 0), ("parsed", 3, 1, 0)]
    untouched = {name: df for name, (df, _) in tables.items()}
    assert rows(ch.forget_report(tables, untouched, gone)) == [("chunks", 3, 0, 1), ("parsed", 3, 0, 1)]


def test_latest_change_wins(spark):
    log = spark.createDataFrame([("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", "x", 1)], "k string, v string, batch int")
    assert rows(ch.latest_changes(log, "k", "batch")) == [("1", "b", 3), ("2", "x", 1)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_broadcast_join(spark, how):
    big = spark.range(5000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(0, 40).select((F.col("id") * 2).alias("k"), F.lit("x").alias("v"))
    assert is_small(small) and not is_small(small, max_rows=10) and not is_small(small, max_bytes=10)
    near = lookup_join(big, small, ["k"], how)
    wide = lookup_join(big, small, ["k"], how, spread_by=F.col("id"), spread=7, max_rows=1)
    assert rows(near) == rows(wide)
    with pytest.raises(ValueError):
        lookup_join(big, small, ["k"], "right")


@pytest.mark.parametrize("wide", [1, 32])
def test_side_beyond_a_broadcast_is_not_broadcast_by_a_guess(spark, wide):
    """Spark takes the copies for as small as the file below them; the driver would hold all of them."""
    path = new_path(spark, "small")
    spark.range(500).select(F.col("id").alias("k")).write.parquet(path)
    small, big = spark.read.parquet(path), spark.range(50_000).select((F.col("id") % 1000).alias("k"), "id")
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = lookup_join(big, small, ["k"], how, spread_by=F.col("id"), spread=wide, max_rows=100)
        assert joined.count() == (50_000 if how == "left" else 25_000)
        assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)


def test_keys_beyond_a_broadcast_are_looked_for_without_copies(spark, monkeypatch):
    folder = new_path(spark, "left")
    held = spark.range(3000).select(F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("path"))
    held.coalesce(1).write.parquet(f"{folder}/a")
    held.filter("path <> 'hot'").coalesce(1).write.parquet(f"{folder}/b")
    keys = {"path": spark.createDataFrame([("hot",), ("1500",), ("1500",), (None,), ("none",)], "p string")}
    monkeypatch.setattr(sizing, "is_small", lambda *_: False)
    left = leftover_files(spark, folder, keys)
    assert sorted(r.rows for r in left.collect()) == [1, 1001]
    assert "Broadcast" not in plan(left) and "Generate" not in plan(left)


def test_spread_keeps_rows(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() > 1
    assert rows(spread(one, "id")) == rows(one)


def test_health(spark):
    log = spark.createDataFrame(
        [("2024-01-01 00:00:00", "r", "d", 5, 1), ("2024-01-02 12:00:00", "r", "d", 5, 2), ("2024-01-02 13:00:00", "s", "d", 9, 0)],
        "timestamp string, name string, dataset string, passed_records long, failed_records long",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    now = F.lit("2024-01-02 14:30:00").cast("timestamp_ntz")
    assert rows(health.recent_failures(log, now)) == [("r", "d", 2, 5)]
    assert [r.failed_records for r in health.quality_by_failures(log).collect()] == [2, 1, 0]
    assert health.freshness(log, "timestamp", now).first().hours_since_change == 1
    empty = spark.range(0)
    assert rows(health.table_health({"a": spark.range(3), "b": empty})) == [("a", 3, "PASS"), ("b", 0, "FAIL")]
    assert tuple(health.canary({"x": spark.range(3), "y": empty}).first()) == (3, 0)


def test_null_keys_are_compared(spark):
    df = spark.createDataFrame([(None, "a"), ("k", "b")], "k string, v string")
    assert rows(ch.diff(df, df, "k")) == []
    assert rows(ch.diff(df, df.filter("k = 'k'"), "k")) == [(None, "delete")]


@pytest.mark.parametrize("max_rows", [1, 100])
def test_spread_join_of_any_column_type(spark, max_rows):
    big = spark.range(60).select(
        (F.col("id") % 6).alias("k"), F.parse_json(F.lit('{"a": 1}')).alias("v"), F.create_map(F.lit("x"), "id").alias("m"),
        F.encode(F.col("id").cast("string"), "utf-8").alias("b"),
    )
    small = spark.range(3).select(F.col("id").alias("k"))
    assert lookup_join(big, small, ["k"], "left_anti", max_rows=max_rows).count() == 30
