"""Counts, freshness and failures of the tables that the jobs write."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_health(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, status`` per table; an empty table fails."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    status = F.when(F.col("row_count") > 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, counts).withColumn("status", status)


def canary(counts: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a count per table, each from its own subquery."""
    spark = next(iter(counts.values())).sparkSession
    columns = {name: df.agg(F.count(F.lit(1))).scalar() for name, df in counts.items()}
    return spark.range(1).select(*[value.alias(name) for name, value in columns.items()])


def quality_by_failures(log: DataFrame) -> DataFrame:
    return log.select("name", "dataset", "passed_records", "failed_records").orderBy(F.desc("failed_records"), "name")


def recent_failures(log: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Rules that failed in the ``hours`` up to ``as_of``, with both counts. Older log rows are skipped by the scan."""
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return (
        log.filter(F.col("timestamp") > since)
        .groupBy("name", "dataset")
        .agg(F.sum("failed_records").alias("failed_24h"), F.sum("passed_records").alias("passed_24h"))
        .filter("failed_24h > 0")
    )


def parse_error_count(parsed: DataFrame) -> DataFrame:
    """How many documents could not be parsed whole: those with an error, and those that were cut off and kept with a ``warning``."""
    failed = F.col("error_status").isNotNull()
    if "warning" in parsed.columns:
        failed = failed | F.col("warning").isNotNull()
    return parsed.agg(F.count_if(failed).alias("parse_errors"))


def freshness(log: DataFrame, time: str, as_of: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """When each group last changed, and how many whole hours ago that was."""
    return log.groupBy(*by).agg(F.max(time).alias("last_commit")).withColumn(
        "hours_since_change", F.timestamp_diff("HOUR", F.col("last_commit"), as_of)
    )
