"""Wide/long reshaping and set operations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_number
from .scale import sorted_parts

# Column headers holding one month each.
MONTH_COLUMNS = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]


def gather(df: DataFrame, key: str, value: str, ids: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Wide to long in one scan, keeping ``ids``."""
    values = list(cols) if cols else [c for c in df.columns if c not in set(ids)]
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], key, value)


def months_long(df: DataFrame, ids: Sequence[str], value: str, months: Sequence[str] = MONTH_COLUMNS) -> DataFrame:
    """Month columns to rows (mes, mes_num, value); the month name stays as text beside its number."""
    present = [m for m in months if m in df.columns]
    return gather(df, "mes", value, ids, present).withColumn("mes_num", month_number("mes"))


def weeks_long(df: DataFrame, ids: Sequence[str], prefix: str = "sem_", mean_column: str = "prom_mes") -> DataFrame:
    """``sem_1..5`` to rows (semana, precio); the monthly mean is dropped and ``--`` is null."""
    weeks = [c for c in df.columns if c.startswith(prefix)]
    texts = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in weeks])
    long = gather(texts, "semana", "precio", ids, weeks)
    return long.select(
        *ids,
        F.regexp_replace("semana", f"^{prefix}", "").cast("int").alias("semana"),
        F.when(F.trim("precio") != "--", F.trim("precio")).try_cast("double").alias("precio"),
    )


def spread(df: DataFrame, key: str, value: str, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Long to wide; ``values`` names the wanted keys, so no extra job looks for them. Of repeated keys the largest value counts."""
    if df.schema[key].dataType.simpleString() != "string" or not all(isinstance(v, str) for v in values):
        return df.groupBy(*ids).pivot(key, list(values)).agg(F.max(value))
    # one hash table by id instead of the pivot's two, of which the first also holds the keys
    return df.groupBy(*ids).agg(*[F.max(F.when(F.col(key) == v, F.col(value))).alias(v) for v in values])


def colpivot(
    df: DataFrame,
    keys: Sequence[str],
    classes: Sequence[str],
    value: Column,
    values: Sequence[Sequence],
    sep: str = "_",
) -> DataFrame:
    """Pivot on the combination of several class columns; ``values`` lists the combinations in output order.

    ``value`` is an aggregate expression.
    """
    label = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in classes])
    names = [sep.join("" if v is None else str(v) for v in combo) for combo in values]
    return df.withColumn("__class", label).groupBy(*keys).pivot("__class", names).agg(value)


def transpose_block(df: DataFrame, id_col: str, names: Sequence[str], out: str = "variable") -> DataFrame:
    """Rows become columns: ``names`` are the values of ``id_col``, one output row per former column."""
    others = [c for c in df.columns if c != id_col]
    texts = df.select(F.col(id_col).cast("string").alias(id_col), *[F.col(c).cast("string").alias(c) for c in others])
    long = texts.unpivot([id_col], others, out, "__v")
    return long.groupBy(out).pivot(id_col, list(names)).agg(F.first("__v"))


def union_aligned(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column | str]]], distinct: bool = True
) -> DataFrame:
    """Union of differently shaped sources; each comes with a map output column -> source column or expression."""
    parts = [d.select(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in m.items()]) for d, m in sources]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.distinct() if distinct else out


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name keeping duplicates; a column missing in one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def new_rows(new: DataFrame, old: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Rows not loaded before: by key, or whole-row multiset difference."""
    return new.join(old, list(on), "left_anti") if on else new.exceptAll(old)


def common_ids(df: DataFrame, by: Sequence[str], row: str, array: str, name: str = "ids", size: int = 100_000, buckets: int | None = None) -> DataFrame:
    """Ids present in every non-empty array of the group, sorted, in arrays of at most ``size``: by, part, ids.

    An id is common when it occurs in as many distinct rows as the group has, so nothing but the common
    ids is ever collected.
    """
    full = df.where(F.size(array) > 0)
    groups = full.groupBy(*by, row).agg(F.lit(1).alias("__one")).groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    seen = full.select(*by, row, F.explode(array).alias("__id")).distinct()
    hits = seen.groupBy(*by, "__id").agg(F.count(F.lit(1)).alias("__hits"))
    common = hits.join(groups, list(by)).where(F.col("__hits") == F.col("__rows"))
    parts = sorted_parts(common.select(*by, "__id"), by, ["__id"], size, buckets)
    return parts.groupBy(*by, "part").agg(F.array_sort(F.collect_list("__id")).alias(name))


def reindex(df: DataFrame, cols: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Exactly the listed columns in order; a missing one is null (string unless a type is given)."""
    types = dict(cols) if isinstance(cols, Mapping) else {c: "string" for c in cols}
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in types.items()])


def rename_regex(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply (pattern, replacement) rules to every column name, in order."""
    names = {}
    for c in df.columns:
        new = c
        for pattern, repl in rules:
            new = re.sub(pattern, repl, new)
        if new != c:
            names[c] = new
    return df.withColumnsRenamed(names) if names else df


def select_period_columns(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Key columns plus the columns whose name holds ``period``, which is stripped from the name."""
    wanted = [c for c in df.columns if period in c and c not in set(keys)]
    return df.select(*keys, *[F.col(f"`{c}`").alias(re.sub(rf"\n|_?{re.escape(period)}", "", c).strip()) for c in wanted])
