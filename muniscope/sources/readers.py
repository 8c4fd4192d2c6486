"""Delimited text, raw lines and JSON."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scale import running, sort_key


def read_delimited(
    spark: SparkSession,
    path,
    sep: str = "|",
    header: bool = True,
    schema=None,
    encoding: str = "UTF-8",
    **options,
) -> DataFrame:
    """Delimited file(s). Without a schema every column is text; types come from later casts, not inference."""
    reader = spark.read.options(sep=sep, header=header, encoding=encoding, mode="PERMISSIVE", **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_key, value): raw lines; ``line_key`` sorts lines of a file in file order."""
    raw = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return raw.select(
        F.col("file_path").alias("file"),
        F.struct(F.col("file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("line_key"),
        "value",
    )


def read_lines_split(spark: SparkSession, path, sep: str, positions: Mapping[str, int]) -> DataFrame:
    """Lines cut at ``sep``; each name takes the field at its position (0-based), null when the line is short."""
    return split_lines(spark.read.text(path), sep, positions)


def split_lines(lines: DataFrame, sep: str, positions: Mapping[str, int], value: str = "value") -> DataFrame:
    fields = F.split(F.col(value), re.escape(sep))
    return lines.select(*[F.get(fields, F.lit(i)).alias(n) for n, i in positions.items()])


def read_folder(
    spark: SparkSession, path, sep: str = "|", schema=None, encoding: str = "UTF-8", source: str = "source_file"
) -> DataFrame:
    """All files of a folder or glob in one read, with the file name; repeated header lines are dropped."""
    df = read_delimited(spark, path, sep, True, schema, encoding)
    repeated = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) == c for c in df.columns])
    return df.select("*", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias(source)).where(~repeated)


def first_lines(spark: SparkSession, path) -> DataFrame:
    """(file, value): the first line of each file of a folder."""
    lines = read_lines(spark, path).where(F.col("line_key.block") == 0)
    return lines.groupBy("file").agg(F.min_by("value", "line_key").alias("value"))


def field_count_filter(lines: DataFrame, sep: str, n: int, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad): lines with exactly ``n`` fields, and all others with their field count."""
    counted = lines.withColumn("n_fields", F.size(F.split(F.coalesce(F.col(value), F.lit("")), re.escape(sep), -1)))
    return counted.where(F.col("n_fields") == n).drop("n_fields"), counted.where(F.col("n_fields") != n)


def stack_sections(
    lines: DataFrame, marker: str, labels: Sequence[str], label: str = "tipo", file: str = "file", order: str = "line_key", value: str = "value"
) -> DataFrame:
    """Label the sections of each file: lines before the first marker line get the first label, and so on.

    Marker lines themselves are dropped. Markers are counted along the lines in ranges, with the count carried from range to
    range, so a long file is labelled by many tasks.
    """
    marked = lines.withColumn("__marker", F.coalesce(F.col(value).contains(marker), F.lit(False)))
    is_marker = F.col("__marker").cast("int")
    told = running(
        marked, [file], sort_key(order),
        local={"__here": lambda w: F.sum(is_marker).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))}, block={"__all": lambda k: F.sum(is_marker)},
        carry={"__before": lambda w: F.sum("__all").over(w.rowsBetween(Window.unboundedPreceding, -1))},
    )
    section = (F.col("__here") + F.coalesce("__before", F.lit(0))).cast("int")
    names = F.array(*[F.lit(x) for x in labels])
    return told.where(~F.col("__marker")).select(*lines.columns, F.get(names, section).alias(label))


def read_json(spark: SparkSession, path, where: str | None = None, schema=None) -> DataFrame:
    """JSON lines, optionally filtered by a SQL condition."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(path)
    return df.where(where) if where else df
