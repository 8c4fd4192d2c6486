"""Ordered and ranked operators. Global orders and big groups are cut into ranges (see ``scale.running``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import bounded_unit
from .joins import add_group_value
from .scale import descending_key, running, sort_key


def _rows(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def relative_change(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "value_dif",
    denominator: str = "current",
    buckets: int | None = None,
) -> DataFrame:
    """(v - previous v) / v per series; ``denominator='previous'`` divides by the previous value instead.

    The first row of a series and a zero denominator give null.
    """
    wrapped = F.struct(F.col(value).alias("v"))
    out = running(
        df,
        by,
        sort_key(*order),
        local={"__prev": lambda w: F.lag(wrapped).over(w)},
        block={"__last": lambda k: F.max_by(wrapped, k)},
        carry={"__carry": lambda w: F.lag("__last").over(w)},
        buckets=buckets,
    )
    prev = F.coalesce(F.col("__prev"), F.col("__carry").cast(out.schema["__prev"].dataType)).getField("v")
    bottom = F.col(value) if denominator == "current" else prev
    return out.withColumn(name, F.try_divide((F.col(value) - prev).cast("double"), bottom)).drop("__prev", "__carry")


def rank_by(df: DataFrame, score: str, ties: Sequence[str], name: str = "ranking", buckets: int | None = None) -> DataFrame:
    """1..n by descending score (nulls last), ties broken by ``ties``."""
    out = running(
        df,
        [],
        descending_key(score, *ties),
        local={"__rn": lambda w: F.row_number().over(w)},
        block={"__n": lambda k: F.count(F.lit(1))},
        carry={"__before": lambda w: F.sum("__n").over(_before(w))},
        buckets=buckets,
    )
    return out.withColumn(name, F.col("__rn") + F.coalesce(F.col("__before").cast("long"), F.lit(0))).drop("__rn", "__before")


def average_rank(
    df: DataFrame, score: str, by: Sequence[str] = (), name: str = "rango", descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Rank with tied scores sharing the mean of their places, overall or within ``by``.

    Ties are counted first, so only distinct scores are ordered. A null score has no rank.
    """
    by = list(by)
    counts = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count(F.lit(1)).alias("__n"))
    key = sort_key(-F.col(score) if descending else F.col(score))
    placed = running(
        counts,
        by,
        key,
        local={"__sum": lambda w: F.sum("__n").over(_rows(w))},
        block={"__bn": lambda k: F.sum("__n")},
        carry={"__before": lambda w: F.sum("__bn").over(_before(w))},
        buckets=buckets,
    )
    upto = F.col("__sum") + F.coalesce(F.col("__before").cast("long"), F.lit(0))
    ranks = placed.select(
        *[F.col(b).alias(f"__r_{b}") for b in by], F.col(score).alias("__score"), (upto - (F.col("__n") - 1) / 2).alias(name)
    )
    cond = df[score] == ranks["__score"]
    for b in by:
        cond = cond & df[b].eqNullSafe(ranks[f"__r_{b}"])
    return df.join(ranks, cond, "left").drop("__score", *[f"__r_{b}" for b in by])


def average_ranks(
    df: DataFrame, key: str, scores: dict[str, str], by: Sequence[str] = (), descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Several average ranks at once (``name -> score column``) beside rows identified by ``key``.

    All scores are ranked as one long table, so the number of passes does not depend on how many there are.
    """
    by = list(by)
    long = df.unpivot([key, *by], list(scores.values()), "__col", "__s").where(F.col("__s").isNotNull())
    ranked = average_rank(long, "__s", ["__col", *by], "__rank", descending, buckets)
    names = {c: n for n, c in scores.items()}
    wide = ranked.groupBy(key).agg(*[F.max(F.when(F.col("__col") == c, F.col("__rank"))).alias(n) for c, n in names.items()])
    return df.join(wide, key, "left")


def _ends(df: DataFrame, cols: Sequence[str], by: Sequence[str], **stats) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """Statistics of each column beside the rows: a one-row scalar subquery, or a join per group."""
    if not by:
        row = df.agg(
            F.struct(*[F.struct(*[f(c).alias(s) for s, f in stats.items()]).alias(c) for c in cols]).alias("e")
        ).scalar()
        return df, {c: {s: row.getField(c).getField(s) for s in stats} for c in cols}
    joined = add_group_value(df, by, **{f"__{s}_{c}": f(c) for c in cols for s, f in stats.items()})
    return joined, {c: {s: F.col(f"__{s}_{c}") for s in stats} for c in cols}


def minmax(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    clamp: bool = False,
    invert: bool = False,
    suffix: str = "_i",
) -> DataFrame:
    """(x - min) / (max - min). ``clamp`` keeps it inside (.0001, .9999); ``invert`` gives 1 minus it."""
    base, ends = _ends(df, cols, by, lo=F.min, hi=F.max)
    out = {}
    for c in cols:
        lo, hi = ends[c]["lo"], ends[c]["hi"]
        unit = F.try_divide((F.col(c) - lo).cast("double"), hi - lo)
        out[f"{c}{suffix}"] = bounded_unit(unit, invert) if clamp else (F.lit(1.0) - unit if invert else unit)
    return base.withColumns(out).select(*df.columns, *[n for n in out if n not in df.columns])


def zscore(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_z") -> DataFrame:
    """(x - mean) / sample standard deviation."""
    base, stats = _ends(df, cols, by, mu=F.avg, sd=F.stddev_samp)
    out = {f"{c}{suffix}": F.try_divide(F.col(c) - stats[c]["mu"], stats[c]["sd"]) for c in cols}
    return base.withColumns(out).select(*df.columns, *[n for n in out if n not in df.columns])


def fill_down(
    df: DataFrame, order: Sequence[str], cols: Sequence[str], by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Null or blank labels take the last stated label above them in ``order``."""
    stated = {c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c)) for c in cols}
    out = running(
        df.withColumns(stated),
        list(by),
        sort_key(*order),
        local={f"__f_{c}": (lambda w, c=c: F.last(c, ignorenulls=True).over(_rows(w))) for c in cols},
        block={f"__l_{c}": (lambda k, c=c: F.max_by(c, F.when(F.col(c).isNotNull(), k))) for c in cols},
        carry={f"__c_{c}": (lambda w, c=c: F.last(f"__l_{c}", ignorenulls=True).over(_before(w))) for c in cols},
        buckets=buckets,
    )
    filled = {c: F.coalesce(F.col(f"__f_{c}"), F.col(f"__c_{c}").cast(df.schema[c].dataType)) for c in cols}
    return out.withColumns(filled).select(*df.columns)


def group_size(df: DataFrame, by: Sequence[str], name: str = "n_grupo") -> DataFrame:
    """Number of rows of the group beside each row."""
    return add_group_value(df, by, **{name: F.count(F.lit(1))})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], descending: bool = False) -> DataFrame:
    """One whole row per key, the first (or last) in ``order``. A partial aggregate, so hot keys stay cheap.

    Order columns must be ascending-comparable; nulls sort first.
    """
    key = sort_key(*order)
    whole = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    pick = F.max_by(whole, key) if descending else F.min_by(whole, key)
    return df.groupBy(*keys).agg(pick.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def top1(df: DataFrame, by: Sequence[str], score: str, ties: Sequence[str] = (), lowest: bool = False) -> DataFrame:
    """Row with the best score per group: highest, or lowest (nearest). Null scores never win."""
    key = sort_key(score, *ties) if lowest else descending_key(score, *ties)
    return first_per_key(df.where(F.col(score).isNotNull()), by, [key])


def sort_output(df: DataFrame, *keys) -> DataFrame:
    """Total order by range partitioning."""
    return df.orderBy(*keys)


def select_until_target(
    df: DataFrame,
    order: Sequence[str],
    weight: str,
    share: float,
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Rows in priority order until ``share`` of the group's total weight is reached, the crossing row included."""
    by = list(by)
    out = running(
        df,
        by,
        sort_key(*order),
        local={"__prev": lambda w: F.sum(weight).over(_before(w))},
        block={"__w": lambda k: F.sum(weight)},
        carry={"__before": lambda w: F.sum("__w").over(_before(w))},
        buckets=buckets,
    )
    kind = out.schema["__prev"].dataType
    before = F.coalesce(F.col("__prev"), F.lit(0).cast(kind)) + F.coalesce(F.col("__before").cast(kind), F.lit(0).cast(kind))
    if by:
        base = add_group_value(out, by, __total=F.sum(weight))
        total = F.col("__total")
    else:
        base, total = out, df.agg(F.sum(weight)).scalar()
    return base.where(before < total * share).select(*df.columns)
