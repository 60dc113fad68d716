"""Reading the given tables, in batches and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUESTION_SCHEMA = T.StructType(
    [T.StructField("query", T.StringType()), T.StructField("expected_source", T.StringType())]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The files of a table as a stream, with the schema of the batch table."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A pattern instead of a plain name lets the source read a table that is one file as well as one that is a folder.
    return reader.parquet(f"{folder}/{name}.parque[t]")


def eval_questions(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with ``query`` and ``expected_source``, and a ``query_id`` from both, so that the same question has the same id in every run."""
    given = spark.read.schema(QUESTION_SCHEMA).json(path).distinct()
    name = F.to_json(F.struct("query", "expected_source"))
    return given.select(F.md5(name).alias("query_id"), "query", "expected_source")
