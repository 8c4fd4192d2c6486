"""Dates, periods, ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import col
from .text import pad_left, strip_accents

# First three letters of the Spanish month names.
MONTHS_ES = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]
# Letters used for months ten to twelve in a period code.
LETTER_MONTHS = {"a": 10, "b": 11, "c": 12}


def month_number(c) -> Column:
    """Month 1..12 from a Spanish month name or abbreviation at the start of the text, else null."""
    head = F.lower(F.substring(strip_accents(F.trim(col(c))), 1, 3))
    pos = F.array_position(F.array(*[F.lit(m) for m in MONTHS_ES]), head)
    return F.when(pos > 0, pos.cast("int"))


def parse_es_month(c) -> Column:
    """First day of ``'Ene 2018'`` or ``'Enero 2018'``; null when month or year is missing."""
    year = F.regexp_extract(col(c), r"(\d{4})\s*$", 1).try_cast("int")
    return first_of_month(year, month_number(c))


def first_of_month(year, month) -> Column:
    y, m = col(year), col(month)
    return F.when(y.isNotNull() & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def data_date_to_date(c) -> Column:
    """``'2018-9-m'`` to 2018-09-01; the year alone (``'2018-a'``) to 1 January."""
    year = F.regexp_extract(col(c), r"^(\d{4})-", 1).try_cast("int")
    month = F.regexp_extract(col(c), r"^\d{4}-(\d{1,2})-", 1)
    month = F.when(month == "", 1).otherwise(month.try_cast("int"))
    return first_of_month(year, month)


def period_month(c) -> Column:
    """Month from the third character of a period code: digit, or a/b/c for 10/11/12."""
    mark = F.lower(F.substring(F.trim(F.translate(col(c), "\"'", "")), 3, 1))
    letters = F.when(mark == "a", 10).when(mark == "b", 11).when(mark == "c", 12)
    return F.coalesce(F.when(mark.rlike(r"^\d$"), mark.try_cast("int")), letters)


def valid_month(c) -> Column:
    """Month 1..12 or null."""
    text = F.trim(F.translate(col(c).cast("string"), "\"'", ""))
    n = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    return F.when(n.between(1, 12), n)


def age_at(birth, year, month) -> Column:
    """Full years on the first day of (year, month) for a yyyyMMdd birth date; null on a bad date."""
    text = F.trim(F.translate(col(birth).cast("string"), "\"'", ""))
    born = F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
    return F.floor(F.months_between(first_of_month(col(year).cast("int"), col(month).cast("int")), born) / 12).cast("int")


def age_category(age) -> Column:
    """Fixed labels: 60 and over, 14 and under, between."""
    a = col(age)
    return F.when(a >= 60, "Adulto Mayor").when(a <= 14, "Infante").when(a > 14, "Adulto")


def age_band(age, width: int = 5, top: int = 75) -> Column:
    """``'0-4'`` ... ``'70-74'``, ``'75+'``; null or negative age gives null."""
    a = col(age).cast("int")
    low = F.floor(a / width) * width
    band = F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string"))
    return F.when(a >= top, f"{top}+").when(a >= 0, band)


def excel_serial_date(c) -> Column:
    """Spreadsheet day number to date."""
    days = F.floor(F.trim(col(c).cast("string")).try_cast("double")).cast("int")
    return F.date_add(F.lit("1899-12-30").cast("date"), days)


def agro_calendar(month, year, cycle) -> Column:
    """struct<mes_ag, anio_ag>: month and year inside the crop calendar.

    The autumn-winter cycle ('OI') starts in October, any other in April.
    """
    m, y, autumn = col(month).cast("int"), col(year).cast("int"), col(cycle) == "OI"
    start = F.when(autumn, 10).otherwise(4)
    crop_month = F.pmod(m - start, F.lit(12)) + 1
    crop_year = F.when(autumn, y + (m >= 10).cast("int")).otherwise(y - (m < 4).cast("int"))
    return F.struct(crop_month.cast("int").alias("mes_ag"), crop_year.cast("int").alias("anio_ag"))


def parse_timestamp_cascade(c) -> Column:
    """Timestamp from native text, 14-digit stamp, numeric text of the same, or a bare HHmmss clock time.

    A clock time alone is placed on 1970-01-01.
    """
    text = F.trim(col(c).cast("string"))
    number = text.try_cast("double")
    whole = F.when(number.between(0, 1e15), F.format_string("%.0f", number))
    digits = F.when(F.length(whole) == 14, whole)
    clock = F.when(F.length(whole) <= 6, pad_left(whole, 6))
    native = F.when(~text.rlike(r"^[0-9.+eE-]*$") | text.rlike(r"^\d{4}-\d{1,2}(-\d{1,2})?$"), text.try_cast("timestamp"))
    return F.coalesce(
        native,
        F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")),
        F.try_to_timestamp(F.concat(F.lit("19700101"), clock), F.lit("yyyyMMddHHmmss")),
    )


# Frequencies, coarse to fine.
FREQUENCIES = ["a", "b", "q", "m", "bm", "w", "d"]


def period_of(date, freq: str) -> Column:
    """Number of the period inside the year: half (b), quarter (q), month (m), half-month (bm), week (w), day (d)."""
    d = col(date)
    if freq == "a":
        return F.lit(1)
    if freq == "b":
        return F.when(F.month(d) <= 6, 1).otherwise(2)
    if freq == "q":
        return F.quarter(d)
    if freq == "m":
        return F.month(d)
    if freq == "bm":
        return (F.month(d) - 1) * 2 + F.when(F.dayofmonth(d) <= 15, 1).otherwise(2)
    if freq == "w":
        return F.weekofyear(d)
    if freq == "d":
        return F.dayofyear(d)
    raise ValueError(f"unknown frequency {freq!r}")
