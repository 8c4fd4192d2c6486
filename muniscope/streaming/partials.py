"""Results carried forward by period: each period's partial aggregate is kept, and a result is merged from them.

A period that is loaded again, or gets a late file, is aggregated again and replaces its part; nothing else is read. Parts
are small (a row a group), so a result over many years costs their sum instead of a scan of all rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "data_date"
#: How values of a measure are made from rows, and how parts of it are merged.
MAKE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
Measures = Mapping[str, tuple[str, str]]  # name: (function, SQL of the value)


def part_path(path: str, period: str) -> str:
    """Folder of a period's part."""
    return f"{path.rstrip('/')}/{PERIOD}={quote(period, safe='')}"


def write_part(rows: DataFrame, path: str, period: str, by: Sequence[str], measures: Measures) -> None:
    """Aggregate the rows of one period and put them in place of what its part held; no rows leave an empty part."""
    made = [MAKE[fn](F.expr(value)).alias(name) for name, (fn, value) in measures.items()]
    rows.groupBy(*by).agg(*made).write.mode("overwrite").parquet(part_path(path, period))


def refresh_part(layer: DataFrame, path: str, period: str, by: Sequence[str], measures: Measures, column: str = PERIOD) -> None:
    """The part of one period out of a layer table that is partitioned by ``column``: only that partition is read."""
    write_part(layer.where(F.col(column) == period), path, period, by, measures)


def merged(spark: SparkSession, path: str, by: Sequence[str], measures: Measures, periods: Column | None = None) -> DataFrame:
    """The measures over all parts, or over the parts whose ``data_date`` meets a condition."""
    parts = spark.read.parquet(path)
    parts = parts if periods is None else parts.where(periods)
    return parts.groupBy(*by).agg(*[MERGE[fn](name).alias(name) for name, (fn, _) in measures.items()])
