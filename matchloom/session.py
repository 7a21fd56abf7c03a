"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "matchloom", **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling switched on.

    ``master`` stays unset on a cluster, where spark-submit names it and the scratch folder. On one machine
    the scratch folder is a temporary one unless ``conf`` names another.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.scheduler.mode": "FAIR",
        **conf,
    }
    if (master or "").startswith("local"):
        settings.setdefault(SETTING, tempfile.mkdtemp(prefix="matchloom-"))
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names.

    Where a session of one machine names none, its scratch folder is one below the warehouse.
    """
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors can reach")
        base = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def held(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: what several steps read is worked out once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def result_path(spark: SparkSession, label: str, *of: str) -> str:
    """A path below the scratch folder that is the same whenever this application asks for it with the same words, so
    that what was begun there can go on."""
    name = hashlib.md5("|".join((spark.sparkContext.applicationId, *of)).encode()).hexdigest()
    return f"{scratch_path(spark, label).rpartition('/')[0]}/{label}-{name}"


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path`` and the path itself, as Spark sees them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's own that nothing reads any more."""
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that lies in the session's scratch folder, once no result is read any more."""
    files, folder = _hadoop(spark, scratch_path(spark, "x").rpartition("/")[0])
    if files.exists(folder):
        for entry in files.listStatus(folder):
            files.delete(entry.getPath(), True)
