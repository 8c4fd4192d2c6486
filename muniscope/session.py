"""Session defaults. On a cluster the submitter's settings win; these only fill gaps."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # longer methods are never compiled by the JVM: wide rule packs run several times faster without fusing them
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "muniscope", master: str | None = None, **extra: str) -> SparkSession:
    """Session with adaptive execution on and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors see: ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may do without it and gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault("root", tempfile.mkdtemp(prefix="muniscope-"))
