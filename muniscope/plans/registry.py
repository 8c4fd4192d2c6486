"""User extension points: cleaners and preparers found by source name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.recode import recode
from ..sources.layers import scan_layer, write_layer

Step = Callable[[DataFrame], DataFrame]
CLEANERS: dict[str, Step] = {}
PREPARERS: dict[str, Step] = {}


def cleaner(name: str) -> Callable[[Step], Step]:
    """Register the clean step of a source."""
    def add(fn: Step) -> Step:
        CLEANERS[name] = fn
        return fn
    return add


def preparer(name: str) -> Callable[[Step], Step]:
    """Register the step run on a source file before it is loaded."""
    def add(fn: Step) -> Step:
        PREPARERS[name] = fn
        return fn
    return add


def prepare(name: str, df: DataFrame) -> DataFrame:
    """The source's preparer, or the frame unchanged."""
    return PREPARERS.get(name, lambda d: d)(df)


def clean(name: str, df: DataFrame, recode_df: DataFrame | None = None, declared: Mapping[str, str] | None = None) -> DataFrame:
    """The source's cleaner (or nothing), then the table-driven recode. ``declared``: column types of the source's data
    dictionary, for cleaners whose columns are told by it."""
    step = CLEANERS.get(name, lambda d: d)
    out = step(df, declared) if declared else step(df)
    return recode(out, name, recode_df) if recode_df is not None else out


def clean_layer(spark: SparkSession, root: str, name: str, recode_df: DataFrame | None = None) -> str:
    """Read the raw table, clean, recode, store in the clean layer."""
    return write_layer(clean(name, scan_layer(spark, root, "raw", name), recode_df), root, "clean", name)
