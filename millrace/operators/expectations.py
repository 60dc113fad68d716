"""Named quality rules: counted on every run, and dropping rows where asked."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Rule(NamedTuple):
    name: str
    condition: str
    drop: bool = False


LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("name", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("passed_records", T.LongType()),
        T.StructField("failed_records", T.LongType()),
    ]
)


def _holds(rule: Rule) -> Column:
    """True only where the condition is TRUE: an unknown result counts as a failure."""
    return F.coalesce(F.expr(rule.condition), F.lit(False))


def _counts(rules: Sequence[Rule]) -> list[Column]:
    out = []
    for rule in rules:
        out.append(F.count_if(_holds(rule)).alias(f"{rule.name}_passed"))
        out.append(F.count_if(~_holds(rule)).alias(f"{rule.name}_failed"))
    return out


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Drop the rows that break a dropping rule. The conditions stay as they are, so that the scan can use them."""
    conditions = [F.expr(rule.condition) for rule in rules if rule.drop]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def observed(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """``keep_valid`` that also counts, in the same pass, how many rows passed and failed each rule.

    Give an ``Observation`` for a batch, or a name for a stream, whose progress then carries the counts.
    """
    return keep_valid(df.observe(observation, *_counts(rules)), rules)


def rule_counts(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: ``name, dataset, passed_records, failed_records``, from one pass over ``df``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("name"),
                F.lit(dataset).alias("dataset"),
                F.col(f"{rule.name}_passed").alias("passed_records"),
                F.col(f"{rule.name}_failed").alias("failed_records"),
            )
            for rule in rules
        ]
    )
    return df.agg(*_counts(rules)).select(F.inline(rows))


def log_rows(
    spark: SparkSession, counts: dict[str, int], rules: Sequence[Rule], dataset: str, at: datetime
) -> DataFrame:
    """Rows for the quality log from the counts of one run (an observation, or a stream's progress)."""
    rows = [
        (at, rule.name, dataset, counts[f"{rule.name}_passed"], counts[f"{rule.name}_failed"]) for rule in rules
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)
