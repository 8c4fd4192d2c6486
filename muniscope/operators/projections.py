"""Row filters and column rewrites that need a whole DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import round_int
from .scale import null_safe

# State, first and last municipality number; state 3 has only the listed ones.
MUNICIPALITIES = [
    (1, 1, 11), (2, 1, 5), (3, 1, 9), (4, 1, 11), (5, 1, 38), (6, 1, 10), (7, 1, 123), (8, 1, 67),
    (9, 2, 17), (10, 1, 39), (11, 1, 46), (12, 1, 81), (13, 1, 84), (14, 1, 125), (15, 1, 125), (16, 1, 113),
    (17, 1, 33), (18, 1, 20), (19, 1, 51), (20, 1, 570), (21, 1, 217), (22, 1, 18), (23, 1, 11), (24, 1, 17),
    (25, 1, 18), (26, 1, 72), (27, 1, 17), (28, 1, 43), (29, 1, 60), (30, 1, 212), (31, 1, 106), (32, 1, 58),
]
LISTED_ONLY = {3: [1, 2, 3, 8, 9]}


def legal_ranges(spark) -> DataFrame:
    """Dimension (cve_ent, lo, hi, only) of legal municipality numbers, one row per state."""
    rows = [(f"{i:02d}", lo, hi, LISTED_ONLY.get(i)) for i, lo, hi in MUNICIPALITIES]
    return spark.createDataFrame(rows, "cve_ent string, lo int, hi int, only array<int>")


def filter_valid_codes(df: DataFrame, range_dim: DataFrame, ent: str = "cve_ent", mun: str = "cve_muni") -> DataFrame:
    """Keep rows without a municipality, or whose municipality number is legal for its state.

    ``range_dim`` has one row per state, so it is joined by key with the range as residual condition.
    """
    dim = range_dim.select(F.col("cve_ent").alias("__e"), "lo", "hi", "only")
    number = F.when(F.trim(F.col(mun)).rlike(r"^\d+$"), F.substring(F.trim(F.col(mun)), 3, 3).try_cast("int"))
    legal = number.between(F.col("lo"), F.col("hi")) & (
        F.col("only").isNull() | F.array_contains(F.col("only"), number)
    )
    return (
        df.join(dim, df[ent] == F.col("__e"), "left")
        .where(F.col(mun).isNull() | legal)
        .drop("__e", "lo", "hi", "only")
    )


def redact_minors(df: DataFrame, age: str, cols: Sequence[str], limit: int = 18) -> DataFrame:
    """Blank the given name columns where age is under ``limit``."""
    return df.withColumns({c: F.when(F.col(age) < limit, F.lit("")).otherwise(F.col(c)) for c in cols})


def fill_default(df: DataFrame, defaults: Mapping[object, Sequence[str]]) -> DataFrame:
    """``{value: columns}``: replace nulls, keeping each column's type."""
    out = {
        c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for value, cols in defaults.items() for c in cols
    }
    return df.withColumns(out)


def fill_mean(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by the column mean, overall or within ``by``."""
    if not by:
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
        return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in cols})
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"__m_{c}") for c in cols])
    means = means.select(*[F.col(b).alias(f"__b_{b}") for b in by], *[f"__m_{c}" for c in cols])
    cond = F.lit(True)
    for b in by:
        cond = cond & df[b].eqNullSafe(means[f"__b_{b}"])
    return (
        df.join(means, cond, "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in cols})
        .select(*df.columns)
    )


def round_columns(df: DataFrame, digits: int = 2, cols: Sequence[str] | None = None) -> DataFrame:
    """Round the listed (default: all floating and decimal) columns."""
    if cols is None:
        cols = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))]
    return df.withColumns({c: F.round(c, digits) for c in cols})


def cast_columns(
    df: DataFrame, ints: Sequence[str] = (), floats: Sequence[str] = (), texts: Sequence[str] = ()
) -> DataFrame:
    """Cast listed columns that exist; unreadable values become null, halves round to even."""
    have = set(df.columns)
    casts = {c: round_int(c) for c in ints if c in have}
    casts |= {c: F.trim(F.col(c).cast("string")).try_cast("double") for c in floats if c in have}
    casts |= {c: F.col(c).cast("string") for c in texts if c in have}
    return df.withColumns(casts) if casts else df


def at_period(df: DataFrame, period: str = "data_date", which: str = "latest") -> DataFrame:
    """Rows of the latest or the earliest period present."""
    pick = F.max(period) if which == "latest" else F.min(period)
    return df.where(F.col(period) == df.agg(pick).scalar())


def with_stamp(df: DataFrame, **literals) -> DataFrame:
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in literals.items()})


__all__ = [
    "legal_ranges", "filter_valid_codes", "redact_minors", "fill_default", "fill_mean", "round_columns",
    "cast_columns", "at_period", "with_stamp", "null_safe",
]
