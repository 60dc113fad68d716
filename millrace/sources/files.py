"""Whole files as binary rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def binary_stream(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    files_per_trigger: int | None = None,
    ingest_time: Column | None = None,
) -> DataFrame:
    """New files of ``folder`` as ``path, modificationTime, length, content, ingest_time``, each exactly once.

    Files whose names start with an underscore or a dot are skipped.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).withColumn("ingest_time", F.current_timestamp() if ingest_time is None else ingest_time)


def without_forgotten(files: DataFrame, forgotten: DataFrame, key: str = "path") -> DataFrame:
    """Skip files on the list of forgotten documents, so that deleted ones do not come back with the next run."""
    return files.join(forgotten.select(key), key, "left_anti")


def file_text(files: DataFrame) -> DataFrame:
    """The content as UTF-8 text. Bytes that are not valid are replaced, so that one bad file does not stop a stream."""
    return files.withColumn("text", _text(F.col("content"))).drop("content")


def _text(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def line_records(files: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Files of JSON lines to one row per record, with the file they came from."""
    lines = files.select("path", F.explode(F.split(_text(F.col("content")), "\n")).alias("line"))
    return lines.filter("line <> ''").select("path", F.from_json("line", schema).alias("r")).select("path", "r.*")
