"""Joins whose strategy depends on a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# The driver builds and holds what is broadcast, at 250 bytes a row or more. The small side of a lookup often grows with the input, so few rows go that way.
LOOKUP_ROWS = 20_000
LOOKUP_BYTES = 4 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` is known to fit in one broadcast. Reads at most ``max_rows + 1`` rows to find out."""
    size = (
        df.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes"),
        )
        .first()
    )
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: Column | None = None,
    spread: int = 32,
    max_rows: int = LOOKUP_ROWS,
    max_bytes: int = LOOKUP_BYTES,
) -> DataFrame:
    """Join ``big`` to a side that is usually small.

    A side of checked size is broadcast. Beyond that, every key of ``big`` is spread over ``spread`` reducers by a hash of
    ``spread_by`` and ``small`` is copied to each of them, so that a key holding much of ``big`` is not one task.
    Only joins that keep or drop rows of ``big`` (inner, left, left_semi, left_anti) can be spread this way. With a ``spread`` of 1, for keys
    that few rows of ``big`` share, nothing is copied. Spark is told to merge: it guesses the size of the copies from the files below, and would broadcast
    all of them where these are small.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"cannot spread a {how} join")
    if is_small(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    if spread == 1:
        return big.join(small.hint("merge"), on, how)
    # The salt depends on row content only, so a recomputed task puts each row in the same place. JSON can be hashed for columns
    # of any type, VARIANT and MAP among them.
    salt = F.pmod(F.xxhash64(spread_by if spread_by is not None else F.to_json(F.struct("*"))), F.lit(spread)).cast("int")
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return big.withColumn("_salt", salt).join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share out rows by ``keys`` when a table comes in fewer pieces than there are cores.

    Work on texts is slow per row, and a small table may be one file with one row group, which is one task. A large table is
    read in many pieces anyway and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *keys)
