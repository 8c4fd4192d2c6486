"""Layer tables (raw, clean, features, models, tidy, semantic) as Parquet under one root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..operators.quality import stamp

LAYERS = ["raw", "clean", "features", "models", "tidy", "semantic"]


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name.lower()}"


def scan_layer(spark: SparkSession, root: str, layer: str, name: str, fallback: str | None = "raw") -> DataFrame:
    """Read a layer table; when it does not exist read the ``fallback`` layer's table unchanged."""
    try:
        return spark.read.parquet(layer_path(root, layer, name))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or fallback is None or fallback == layer:
            raise
        return spark.read.parquet(layer_path(root, fallback, name))


def write_layer(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite a layer table."""
    path = layer_path(root, layer, name)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Overwrite a layer table that is laid out for joins: its rows are dealt by ``keys`` into ``buckets`` files, each sorted.

    Tables of equal keys (of equal types) and bucket numbers are joined and grouped without a shuffle. The layout is known to
    the session's catalog (table ``layer__name``), the files lie below ``root`` like those of any other layer table; another
    session makes them known by ``open_bucketed``.
    """
    path, table = layer_path(root, layer, name), f"{layer}__{name.lower()}"
    df.sparkSession.sql(f"DROP TABLE IF EXISTS `{table}`")
    # dealt before the write, each task holds whole buckets: as many files as buckets
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, root: str, layer: str, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` wrote, with its layout; the catalog learns of it where it does not know it."""
    path, table = layer_path(root, layer, name), f"{layer}__{name.lower()}"
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**options).format(fmt).save(path)


def append_period(df: DataFrame, path: str, data_date: str, suffix: str, ts, ts_name: str = "loaded_at") -> None:
    """Load one period. The period is a partition that a rerun replaces, so nothing is ever loaded twice."""
    stamped = stamp(df, ts, data_date, suffix, ts_name)
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("data_date")
        .parquet(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = False, mode: str = "append") -> None:
    df.write.mode(mode).csv(path, sep=sep, header=header)


def copy_layer(spark: SparkSession, root: str, src: str, dst: str, name: str) -> str:
    """Copy a table to another layer under its lower-case name."""
    return write_layer(scan_layer(spark, root, src, name, fallback=None), root, dst, name)


def publish(df: DataFrame, targets: Sequence[str]) -> None:
    """Write one result to several targets from a single computation: the others are copied from the first, so that they
    hold the same rows also where an executor was lost between the writes."""
    first, *others = targets
    df.write.mode("overwrite").parquet(first)
    stored = df.sparkSession.read.schema(df.schema).parquet(first)
    for path in others:
        stored.write.mode("overwrite").parquet(path)


def checkpoint_root(spark: SparkSession) -> str | None:
    """Shared folder the cluster names for checkpoints."""
    return spark.conf.get("spark.checkpoint.dir", None)
