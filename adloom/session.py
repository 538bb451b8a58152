"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the reports rely on. All are session-level, so they can be applied to
# a running session as well as to a builder.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions are put together up to this size. Rows take several times their compressed
    # bytes in the sorts and hash maps of a task, so Spark's 64 MB would hold over a gigabyte.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The JVM never compiles methods over 8000 bytes. Above that, the wide period
    # aggregate runs faster as several small generated methods than as a fused one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def reach_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where they see the driver's folder.

    On a cluster the package is installed or sent with ``--py-files``; there the
    added entry of the search path is just not found.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])
    return spark


_fallback: dict[str, str] = {}


def use_dir(path: str) -> None:
    """Folder to use where the session names none; the caller vouches that every worker sees it."""
    _fallback["dir"] = path


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster; never a local one made up here."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or _fallback.get("dir")
    if not named:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    return named.rstrip("/")


def _run_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/adloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and the file system it lies on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what this application has stored; frames built on it can't be read any more."""
    path, fs = file_system(spark, _run_dir(spark))
    fs.delete(path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of another one."""
    (old, fs), (new, _) = file_system(spark, source), file_system(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several passes follow over one expensive result: the lineage is
    cut, later passes prune columns from Parquet, and a lost executor costs a
    re-read instead of a re-run.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
