"""Incremental period load: new files once, safe to restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layers import checkpoint_root


def ingest_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    schema,
    checkpoint: str | None = None,
    sep: str = "|",
    header: bool = True,
    period_pattern: str = r"(\d{4}(?:-\d+)?-[a-z]+)",
    path_period: bool = False,
    prepare=None,
    max_files: int = 1000,
) -> None:
    """Load files that arrived since the last run, then stop.

    The period comes from the file name, or with ``path_period`` from the whole path. Each micro-batch owns the partition (data_date, load_batch), so a
    batch repeated after a failure replaces itself and later files of the same period are added beside it.
    ``prepare`` is an optional DataFrame -> DataFrame step.
    """
    place = checkpoint or (f"{checkpoint_root(spark)}/streams/{target.rstrip('/').split('/')[-1]}" if checkpoint_root(spark) else None)
    if place is None:
        raise ValueError("give a checkpoint folder or set spark.checkpoint.dir")
    files = (
        spark.readStream.schema(schema)
        .options(sep=sep, header=header, maxFilesPerTrigger=max_files)
        .csv(source)
        .withColumn("source_file", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1))
        .withColumn("data_date", F.regexp_extract("_metadata.file_path" if path_period else "source_file", period_pattern, 1))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        (
            rows.withColumn("load_batch", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("data_date", "load_batch")
            .parquet(target)
        )

    query = (
        files.writeStream.trigger(availableNow=True).option("checkpointLocation", place).foreachBatch(load).start()
    )
    query.awaitTermination()
