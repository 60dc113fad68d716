"""Running a stream to the end of its input, or on and on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.expectations import LOG_SCHEMA, Rule, log_rows, observed

RUN_MODES = ("triggered", "continuous")


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "triggered",
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append a stream to a Parquet table. ``triggered`` reads what is there and ends; ``continuous`` goes on.

    The checkpoint remembers what has been read: a run after a crash or without new files adds nothing twice.
    """
    if mode not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}, not {mode!r}")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if mode == "triggered" else writer.trigger(processingTime=interval)
    return writer.start(path)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything that is available and return the table written so far."""
    start(stream, path, checkpoint).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_checked(
    stream: DataFrame, rules: Sequence[Rule], dataset: str, path: str, checkpoint: str, at: datetime
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`run_to_end` with quality rules; also returns the log rows of this run, one per batch and rule.

    Each batch writes a folder of its own in ``path``, and its log rows to one in ``<checkpoint>-rules``, so a stream may have any number of
    batches. A batch that is run again after a failure replaces both. The log rows of a run that failed are not returned by a later run,
    but stay in that folder with those of all others. A table that :func:`start` wrote cannot be continued, since its own list of files hides others.
    """
    spark, log, seen = stream.sparkSession, f"{checkpoint}-rules", []
    listed = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    files = listed.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(listed):
        raise ValueError(f"{path} was written by start() and cannot be continued with counts")
    files.mkdirs(listed.getParent())

    def handle(df: DataFrame, number: int) -> None:
        counts = Observation(f"{dataset} {number}")
        observed(df, rules, counts).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
        rows = log_rows(df.sparkSession, counts.get, rules, dataset, at).withColumn("batch", F.lit(number).cast("long"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch-{number}")
        seen[:] = seen or [number]

    start_each(stream, handle, checkpoint).awaitTermination()
    found = log_rows(spark, {}, [], dataset, at)
    if seen:
        kept = StructType([*LOG_SCHEMA.fields, StructField("batch", LongType())])
        rows = spark.read.schema(kept).option("recursiveFileLookup", "true").parquet(log)
        found = rows.filter(F.col("batch") >= seen[0]).drop("batch")
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(path), found


def start_each(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "triggered"
) -> StreamingQuery:
    """Hand each micro-batch to ``handle``, for sinks that merge instead of append. ``handle`` may see a batch again
    after a failure and must then give the same result."""
    if mode not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}, not {mode!r}")
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if mode == "triggered" else writer.trigger(processingTime="1 minute")
    return writer.start()
