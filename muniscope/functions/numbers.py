"""Number parsing and row-wise arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import col


def to_int(c, missing: str = "zero") -> Column:
    """Whole number from text with thousands commas; other text gives 0 or null."""
    text = F.trim(F.translate(col(c).cast("string"), ",", ""))
    value = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))
    return F.coalesce(value, F.lit(0).cast("long")) if missing == "zero" else value


def round_int(c) -> Column:
    """Text or number to int, rounding halves to even."""
    return F.rint(F.trim(col(c).cast("string")).try_cast("double")).try_cast("int")


def any_in(cols: Sequence, values: Sequence) -> Column:
    """True when any of the columns holds one of the values; nulls never match."""
    wanted = [F.lit(v) for v in values]
    return F.coalesce(F.exists(F.array(*[col(c) for c in cols]), lambda x: x.isin(*wanted)), F.lit(False))


def row_sum(cols: Sequence, skip_null: bool = True) -> Column:
    return reduce(add, [F.coalesce(col(c), F.lit(0)) if skip_null else col(c) for c in cols])


def row_mean(cols: Sequence) -> Column:
    """Mean of the non-null columns, null when all are null."""
    present = reduce(add, [F.when(col(c).isNotNull(), 1).otherwise(0) for c in cols])
    return F.try_divide(row_sum(cols).cast("double"), present)


def geo_mean(cols: Sequence) -> Column:
    """Geometric mean; a null column gives null."""
    return F.pow(reduce(mul, [col(c).cast("double") for c in cols]), F.lit(1.0 / len(cols)))


def weighted_row_sum(weights: Mapping) -> Column:
    """Sum of weight times column."""
    return reduce(add, [col(c) * F.lit(float(w)) for c, w in weights.items()])


def row_argmax(cols: Sequence[str]) -> Column:
    """Name of the column with the largest value; the first listed wins a tie, nulls are ignored."""
    entries = F.array(
        *[
            F.struct(F.col(c).cast("double").alias("v"), F.lit(-i).alias("o"), F.lit(c).alias("name"))
            for i, c in enumerate(cols)
        ]
    )
    return F.array_max(F.filter(entries, lambda e: e["v"].isNotNull())).getField("name")


def bounded_unit(c, invert: bool = False, low: float = 0.0001, high: float = 0.9999) -> Column:
    """Keep a 0-1 score inside (low, high); optionally turn it round."""
    y = F.greatest(F.least(col(c), F.lit(high)), F.lit(low))
    y = F.when(col(c).isNotNull(), y)
    return F.lit(1.0) - y if invert else y
