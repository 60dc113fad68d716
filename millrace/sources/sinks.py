"""Writing tables: whole, in versions, and as logs of changes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from millrace.operators.changes import apply_changes, change_rows, diff, latest_changes
from millrace.operators.features import require_unique, upsert
from millrace.sizing import lookup_join


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all that is in it, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def leftover_files(spark: SparkSession, folder: str, keys: Mapping[str, DataFrame]) -> DataFrame:
    """``file, key_column, rows`` of every Parquet file below ``folder`` that still holds a row with one of the given keys.

    ``keys`` gives for a column the values that must be gone, in the only column of a table. All files are read as they lie, whatever
    table, version or log they belong to and whether readers still see them; of each only the key columns. A file without
    such a column holds none. Files of one column name must agree in its type, which is that of the keys.
    """
    found = []
    for name, df in keys.items():
        wanted = df.select(F.col(df.columns[0]).alias(name)).filter(F.col(name).isNotNull()).distinct()
        reader = spark.read.schema(wanted.schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        rows = reader.parquet(folder).select(name, F.col("_metadata.file_path").alias("file")).filter(F.col(name).isNotNull())
        # Rows are counted by file and key first, so that a key in many rows is few rows of the join, at most one for each file.
        counted = rows.groupBy("file", name).agg(F.count(F.lit(1)).alias("n"))
        held = lookup_join(counted, wanted, [name], "left_semi", spread=1)
        found.append(held.groupBy("file", F.lit(name).alias("key_column")).agg(F.sum("n").alias("rows")))
    return reduce(DataFrame.unionByName, found)


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a recomputed table. ``path`` must not be an input of ``df``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


class VersionedTable:
    """A keyed table kept as numbered snapshots, so that nothing that is being read is overwritten.

    The newest finished snapshot counts: Spark marks a folder as finished with a ``_SUCCESS`` file after the last task.
    For tables with a row per customer or the like. A large index uses :class:`ChangeLogTable` instead.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        marks = jvm.org.apache.hadoop.fs.Path(f"{self.path}/v=*/_SUCCESS")
        fs = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(marks)
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            raise ValueError(f"{self.path} has no finished version")
        return self.spark.read.parquet(f"{self.path}/v={known[-1] if version is None else version}")

    def _write(self, df: DataFrame, version: int) -> int:
        require_unique(df, self.key).write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return version

    def create_or_merge(self, df: DataFrame) -> int:
        """The first time, create the table; later, merge ``df`` into it by key. Returns the version written."""
        known = self.versions()
        if not known:
            return self._write(df, 1)
        return self._write(upsert(self.read(), df, self.key), known[-1] + 1)

    def replace(self, df: DataFrame) -> int:
        known = self.versions()
        return self._write(df, known[-1] + 1 if known else 1)

    def changes(self, since: int) -> DataFrame:
        """What changed between version ``since`` and now, with the new rows."""
        new = self.read()
        return change_rows(new, diff(self.read(since), new, self.key), self.key)


class ChangeLogTable:
    """A base table and a log of later changes: a sync writes what changed, not the whole table again.

    Readers merge the two by key. ``compact`` writes a new base once the log has grown.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.key, self.root = spark, key, path.rstrip("/")
        self.base = VersionedTable(spark, f"{self.root}/base", key)
        self.log_root = f"{self.root}/log"

    def _log_path(self) -> str:
        return f"{self.log_root}/base={self.base.versions()[-1]}"

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._log_path())
        except AnalysisException:
            return None

    def read(self) -> DataFrame:
        log, base = self._log(), self.base.read()
        if log is None:
            return base
        return apply_changes(base, latest_changes(log, self.key, "batch"), self.key)

    def sync(self, new: DataFrame) -> None:
        """Bring the table to the state of ``new``, by appending the difference to the log."""
        if not self.base.versions():
            self.base.replace(new)
            return
        log = self._log()
        last = log.agg(F.max("batch")).first()[0] if log is not None else 0
        changed = change_rows(new, diff(self.read(), new, self.key), self.key)
        append(changed.withColumn("batch", F.lit(last + 1).cast("long")), self._log_path())

    def change_feed(self) -> DataFrame:
        """All changes since the base was written, with their batch number."""
        log = self._log()
        if log is None:
            empty = self.base.read().limit(0)
            return empty.withColumns({"change_type": F.lit(""), "batch": F.lit(0).cast("long")})
        return log

    def change_stream(self) -> DataFrame:
        """The changes as a stream, for consumers that follow the table continuously. Needs at least one change."""
        return self.spark.readStream.schema(self.spark.read.parquet(self._log_path()).schema).parquet(self._log_path())

    def compact(self) -> int:
        return self.base.replace(self.read())

    def drop_before(self, version: int) -> None:
        """Delete the files of all bases before ``version``, and their logs. Who still reads them fails."""
        for old in self.base.versions():
            if old < version:
                remove_folder(self.spark, f"{self.log_root}/base={old}")
                remove_folder(self.spark, f"{self.base.path}/v={old}")


def publish_view(df: DataFrame, name: str) -> None:
    """A view that the whole session can query."""
    df.createOrReplaceTempView(name)
