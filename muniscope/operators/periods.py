"""Period calendars: which (year, fraction) loads exist and which are still due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import period_of

# SQL step between period starts; half-months are two per month.
STEPS = {
    "a": "INTERVAL 1 YEAR", "b": "INTERVAL 6 MONTH", "q": "INTERVAL 3 MONTH",
    "m": "INTERVAL 1 MONTH", "bm": "INTERVAL 1 MONTH", "w": "INTERVAL 7 DAY", "d": "INTERVAL 1 DAY",
}
TRUNC = {"a": "year", "b": "quarter", "q": "quarter", "m": "month", "bm": "month", "w": "week", "d": "day"}


def period_label(date, freq: str) -> Column:
    """``2018-9-m`` style label: year, fraction, suffix (``2018-a`` for years). Weeks use the ISO year."""
    d = F.col(date) if isinstance(date, str) else date
    year = F.extract(F.lit("YEAROFWEEK"), d) if freq == "w" else F.year(d)
    if freq == "a":
        return F.concat(year.cast("string"), F.lit("-a"))
    return F.concat_ws("-", year.cast("string"), period_of(d, freq).cast("string"), F.lit(freq))


def expand_calendar(bounds: DataFrame, freq: str, start: str = "start", end: str = "end") -> DataFrame:
    """(period_start, data_date) for every period that begins by ``end`` and is not over before ``start``."""
    if freq not in STEPS:
        raise ValueError(f"unknown frequency {freq!r}")
    first = F.date_trunc(TRUNC[freq], start).cast("date")
    if freq == "b":
        first = F.make_date(F.year(start), F.when(F.month(start) <= 6, 1).otherwise(7), F.lit(1))
    days = bounds.select(
        F.col(start).cast("date").alias("s"), F.col(end).cast("date").alias("e"),
        F.explode(F.sequence(first, F.col(end).cast("date"), F.expr(STEPS[freq]))).alias("d"),
    )
    if freq == "bm":
        halves = F.explode(F.array(F.col("d"), F.date_add("d", 15)))
        days = days.select("s", "e", halves.alias("d"))
        days = days.where((F.col("d") <= F.col("e")) & (F.when(F.dayofmonth("d") == 1, F.date_add("d", 14)).otherwise(F.last_day("d")) >= F.col("s")))
    return days.select(F.col("d").alias("period_start"), period_label("d", freq).alias("data_date"))


def period_calendar(spark: SparkSession, start: str, end: str, freq: str) -> DataFrame:
    """Every period of the frequency between two dates. Years are complete: 24 half-months, 52 or 53 weeks."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return expand_calendar(bounds, freq)


def pending_periods(calendar: DataFrame, skip: DataFrame | None = None, loaded: DataFrame | None = None) -> DataFrame:
    """Calendar minus skipped minus already loaded periods."""
    out = calendar
    for gone in (skip, loaded):
        if gone is not None:
            out = out.join(gone.select("data_date").distinct(), "data_date", "left_anti")
    return out
