"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job wants from the session. Partition counts are left to the cluster; AQE merges and splits them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_own_folder: dict[str, str] = {}


def local_session(
    app: str, cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks, with ``shared`` as its working folder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster, a folder on one machine is lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        folder = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folder[app] = folder
    return _own_folder[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several later steps read: they are computed once and survive the loss of executors.
    """
    return written_to(new_path(df.sparkSession, label), df)


def written_to(path: str, df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to a path from :func:`new_path` and read it back; who knows the path can :func:`release` it."""
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete working files that nobody reads any more, and have Spark delete its shuffle files of tables that are gone.

    Spark does that when the driver happens to collect its garbage; until then, the files of all steps lie there together.
    """
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
