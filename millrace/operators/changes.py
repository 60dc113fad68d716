"""Differences between two versions of a keyed table, their application, and deletion on request."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sizing import lookup_join


def content_hash(df: DataFrame, key: str) -> DataFrame:
    """``key`` and a digest of all other columns. JSON names the fields, so NULLs cannot be confused."""
    others = [c for c in df.columns if c != key]
    return df.select(key, F.md5(F.to_json(F.struct(*others))).alias("_hash"))


def diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key, change_type`` for every key that was inserted, updated or deleted. Only keys and digests are shuffled."""
    before = content_hash(old, key).toDF("_old_key", "_old")
    after = content_hash(new, key).toDF("_new_key", "_new")
    change = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(
            F.col("_old") != F.col("_new"), "update"
        )
    )
    # A NULL key is the same as another NULL key.
    return (
        before.join(after, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
        .select(F.coalesce("_old_key", "_new_key").alias(key), change.alias("change_type"))
        .filter(F.col("change_type").isNotNull())
    )


def change_rows(new: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The changes with their new rows: what an index has to read to catch up. Deleted keys carry NULLs."""
    return changes.join(new, key, "left")


def apply_changes(old: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``old`` brought up to date by ``change_rows``."""
    untouched = lookup_join(old, changed.select(key), [key], "left_anti", spread=1)
    current = changed.filter(F.col("change_type") != "delete").select(*old.columns)
    return untouched.unionByName(current)


def latest_changes(log: DataFrame, key: str, order: str) -> DataFrame:
    """Of several changes to one key, the last one. Combined before the shuffle."""
    others = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_last")).select(key, "_last.*")


def without(df: DataFrame, key: str, forgotten: DataFrame) -> DataFrame:
    """``df`` without the rows of the forgotten documents. Keys are compared as a whole, never as a pattern."""
    keys = forgotten.select(F.col(forgotten.columns[0]).alias(key))
    return lookup_join(df, keys, [key], "left_anti")


def forget(tables: Mapping[str, tuple[DataFrame, str]], forgotten: DataFrame) -> dict[str, DataFrame]:
    """Every table without the forgotten documents. ``tables`` gives each table and the column that names its document."""
    return {name: without(df, key, forgotten) for name, (df, key) in tables.items()}


def forget_report(
    before: Mapping[str, tuple[DataFrame, str]], after: Mapping[str, DataFrame], forgotten: DataFrame
) -> DataFrame:
    """Per table: rows before, rows removed, and rows of forgotten documents that are still there, which must be 0."""
    keys = forgotten.select(F.col(forgotten.columns[0]).alias("_key")).distinct()

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    def one(name: str) -> DataFrame:
        df, key = before[name]
        renamed = lambda d: d.select(F.col(key).alias("_key"))
        left = lookup_join(renamed(after[name]), keys, ["_key"], "left_semi")
        counts = count(df, "rows_before").withColumns(
            {"rows_after": count(after[name], "n").scalar(), "rows_leftover": count(left, "n").scalar()}
        )
        return counts.select(
            F.lit(name).alias("table_name"),
            "rows_before",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
            "rows_leftover",
        )

    return reduce(DataFrame.unionByName, [one(name) for name in before])
