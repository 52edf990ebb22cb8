"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the transforms assume; ``apply_settings`` sets only session-level ones.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where it runs from a folder and is not installed; the workers' machines must see
    that folder then.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local master may leave it unset: its one
    process uses a temporary folder then, and records that in the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(
                f"spark.checkpoint.dir must name a folder that all executors of {master} share"
            )
        configured = tempfile.mkdtemp(prefix="goldrow-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is cleared."""
    return f"{shared_folder(spark).rstrip('/')}/goldrow/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the re-read table.

    Used where several outputs share one expensive plan. The files survive a lost
    executor, and the returned plan starts at a scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_scan(df: DataFrame) -> DataFrame:
    """Give a plain scan at least one partition per core, for costly work per row.

    A few files with few row groups would keep most cores idle. A scan that already has
    as many partitions, as any large one has, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= cores else df.repartition(cores)
