"""Schema, quality and metadata checks. Every check returns rows, none raises on bad data."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value.
SENTINELS = ["na", "N/A", "nan", "N/E", "-", "&", "NSS", '"NA"', "--", ""]


def header_drift(lines: DataFrame, expected: Sequence[str], sep: str = "|") -> DataFrame:
    """Compare each file's header with the declared one, position by position.

    ``lines`` has (file, value): the first line of each file. Returns (file, pos, expected, found, status)
    for the positions that differ: missing, extra or changed.
    """
    found = lines.select("file", F.split("value", re.escape(sep)).alias("f"))
    want = F.array(*[F.lit(e) for e in expected])
    width = F.greatest(F.size("f"), F.lit(len(expected)))
    rows = found.select(
        "file", F.explode(F.sequence(F.lit(1), width)).alias("pos"), "f"
    ).select("file", "pos", F.try_element_at(want, F.col("pos")).alias("expected"), F.try_element_at("f", F.col("pos")).alias("found"))
    status = (
        F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("changed")
    )
    return rows.where(~F.col("expected").eqNullSafe(F.col("found"))).withColumn("status", status)


def safe_name(name: str) -> str:
    plain = unicodedata.normalize("NFD", str(name))
    plain = "".join(c for c in plain if unicodedata.category(c) != "Mn").lower().strip()
    plain = re.sub(r"_+", "_", re.sub(r"[^a-z0-9]+", "_", plain)).strip("_") or "col"
    return f"p_{plain}" if plain[0].isdigit() else plain


def safe_names(df: DataFrame) -> DataFrame:
    """Lower-case ASCII column names, ``_`` for other characters, ``p_`` before a digit, numbered when repeated."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = safe_name(c)
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n] - 1}")
    return df.toDF(*names)


def propose_schema(df: DataFrame, all_text: bool = False) -> DataFrame:
    """(column, proposed) from text columns: INT (also for booleans), FLOAT, TIMESTAMP or TEXT. One aggregate."""
    if all_text:
        return df.sparkSession.createDataFrame([(c, "TEXT") for c in df.columns], "column string, proposed string")
    stats = []
    for c in df.columns:
        v = F.trim(F.col(c).cast("string"))
        filled = v != ""
        number = v.try_cast("double")
        stats.append(
            F.struct(
                F.count_if(filled).alias("n"),
                F.count_if(filled & (v.rlike(r"^[+-]?\d{1,18}$") | F.lower(v).isin("true", "false"))).alias("i"),
                F.count_if(filled & number.isNotNull()).alias("f"),
                F.count_if(filled & v.rlike(r"^\d{4}-\d{2}-\d{2}") & v.try_cast("timestamp").isNotNull()).alias("t"),
            ).alias(c)
        )
    row = df.agg(*stats)
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("s")) for c in df.columns]))
    s = row.select(entry.alias("e")).select("e.column", "e.s.*")
    proposed = (
        F.when(F.col("n") == 0, "TEXT")
        .when(F.col("i") == F.col("n"), "INT")
        .when(F.col("f") == F.col("n"), "FLOAT")
        .when(F.col("t") == F.col("n"), "TIMESTAMP")
        .otherwise("TEXT")
    )
    return s.select("column", proposed.alias("proposed"))


def dictionary_gaps(columns_df: DataFrame, dict_df: DataFrame) -> DataFrame:
    """Columns (table_name, column) without a dictionary entry that has a name."""
    named = dict_df.where(F.col("nombre").isNotNull() & (F.trim("nombre") != "")).select(F.col("id").alias("column")).distinct()
    return columns_df.join(named, "column", "left_anti")


def nullify_sentinels(df: DataFrame, cols: Sequence[str] | None = None, values: Sequence[str] = SENTINELS) -> DataFrame:
    """Null for the missing-value texts in the listed (default: all) string columns. Blanks around are ignored."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in (cols or texts) if c in texts]
    return df.withColumns({c: F.when(~F.trim(c).isin(list(values)), F.col(c)) for c in chosen})


def drop_blank_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose listed (default: all) fields are null or blank."""
    filled = [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in (cols or df.columns)]
    return df.where(reduce(lambda a, b: a | b, filled))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each row."""
    return df.dropDuplicates()


def assert_table(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Check rules in one aggregate: (rule, column, passed, observed).

    Rules: ("exists", col), ("not_all_null", col), ("min_rows", n), ("type", col, name),
    ("first", col, predicate over the column, order column).
    """
    have = dict(df.dtypes)
    checks: list[Column] = []

    def entry(rule, column, passed, observed):
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(column).cast("string").alias("column"),
            F.coalesce(passed, F.lit(False)).alias("passed"), observed.cast("string").alias("observed"),
        )

    for rule in rules:
        kind, *args = rule
        if kind == "min_rows":
            n = F.count(F.lit(1))
            checks.append(entry(kind, None, n >= args[0], n))
        elif kind == "exists":
            checks.append(entry(kind, args[0], F.lit(args[0] in have), F.lit(str(args[0] in have).lower())))
        elif args[0] not in have:
            checks.append(entry(kind, args[0], F.lit(False), F.lit("no such column")))
        elif kind == "not_all_null":
            checks.append(entry(kind, args[0], F.count(args[0]) > 0, F.count(args[0])))
        elif kind == "type":
            checks.append(entry(kind, args[0], F.lit(have[args[0]] == args[1]), F.lit(have[args[0]])))
        elif kind == "first":
            name, predicate, order = args
            first = F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(order)))
            ok = F.min_by(F.expr(predicate), F.when(F.col(name).isNotNull(), F.col(order)))
            checks.append(entry(kind, name, ok, first))
        else:
            raise ValueError(f"unknown rule {kind!r}")
    return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): every column's values counted in one pass, without one distinct set per column."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    )
    return df.select(F.explode(entries).alias("e")).select("e.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_cardinality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_distinct), nulls not counted."""
    return _value_counts(df, cols or df.columns).groupBy("column").agg(F.count("value").alias("n_distinct"))


def drop_constant_columns(df: DataFrame, min_distinct: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with fewer than ``min_distinct`` values. The default also drops two-valued columns."""
    few = column_cardinality(df).where(F.col("n_distinct") < min_distinct).select("column").collect()
    return df.drop(*[r["column"] for r in few if r["column"] not in set(keep)])


def profile_table(df: DataFrame) -> DataFrame:
    """(column, type, measure, value): num_records, num_distinct_values, count_nulls, mode, and min/max of numbers.

    The mode is the most frequent value, the smallest text on a tie.
    """
    types = dict(df.dtypes)
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    counts = _value_counts(df, df.columns)
    filled = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))
    number = F.when(F.col("column").isin(list(numeric)), F.col("value").try_cast("double"))
    per = counts.groupBy("column").agg(
        F.sum("n").cast("string").alias("num_records"),
        F.count("value").cast("string").alias("num_distinct_values"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).cast("string").alias("count_nulls"),
        F.min(filled).getField("v").alias("mode"),
        F.min_by("value", number).alias("min"),
        F.max_by("value", number).alias("max"),
    )
    names = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    long = per.unpivot(["column"], ["num_records", "num_distinct_values", "count_nulls", "mode", "min", "max"], "measure", "value")
    ordinary = ~F.col("measure").isin("min", "max") | F.col("column").isin(list(numeric))
    return long.where(ordinary).select("column", F.element_at(names, F.col("column")).alias("type"), "measure", "value")


def complete_for_period(df: DataFrame, key: str, value: str, expected: DataFrame) -> DataFrame:
    """All rows when every expected key has a value, none otherwise."""
    present = df.where(F.col(value).isNotNull()).select(key).distinct()
    missing = expected.select(key).distinct().join(present, key, "left_anti").agg(F.count(F.lit(1))).scalar()
    return df.where(missing == 0)


def domain_violations(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """(column value, n) of the values outside the allowed list."""
    bad = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return bad.where(F.col(column).isNotNull()).join(allowed.select(column), column, "left_anti")


def lineage_edges(dict_df: DataFrame, table: Column | str, data_date: str, suffix: str) -> DataFrame:
    """(source_kind, source, edge, target_kind, target): column to table and tag, fraction to year, table to fraction."""
    tab = F.lit(table) if isinstance(table, str) else table
    parts = data_date.split("-")
    fraction = f"{parts[0]}-{parts[1] if len(parts) > 1 else ''}-{suffix}"

    def edge(frame, sk, s, e, tk, t):
        return frame.select(
            F.lit(sk).alias("source_kind"), s.alias("source"), F.lit(e).alias("edge"),
            F.lit(tk).alias("target_kind"), t.alias("target"),
        )

    tagged = dict_df.where(F.coalesce(F.col("tipo"), F.lit("")) != "")
    tag = F.concat_ws("/", "tipo", "subtipo")
    parts_ = [
        edge(dict_df, "Column", F.col("id"), "from_table", "Table", tab),
        edge(tagged, "Column", F.col("id"), "with_tag", "Tag", tag),
        edge(dict_df, "Fraction", F.lit(fraction), "for_fraction", "Year", F.lit(parts[0])),
        edge(dict_df, "Table", tab, "for_year", "Fraction", F.lit(fraction)),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts_).distinct()


def dictionary_catalog(dfs: dict[str, DataFrame], present: DataFrame | None = None) -> DataFrame:
    """One entry per id over all dictionaries, the first table in name order winning.

    ``present`` (column) restricts the catalog to columns of a table.
    """
    parts = [d.select(F.lit(t).alias("table_name"), "id", "nombre", "fuente") for t, d in dfs.items()]
    every = reduce(lambda a, b: a.unionByName(b), parts)
    if present is not None:
        every = every.join(present.select(F.col("column").alias("id")), "id", "left_semi")
    best = F.min_by(F.struct("table_name", "nombre", "fuente"), F.struct("table_name", "nombre", "fuente"))
    return every.groupBy("id").agg(best.alias("e")).select("id", "e.*")


def stamp(df: DataFrame, ts, data_date: str, suffix: str, ts_name: str = "loaded_at") -> DataFrame:
    """Load time and period (``data_date-suffix``) columns."""
    moment = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    return df.withColumn(ts_name, moment).withColumn("data_date", F.lit(f"{data_date}-{suffix}"))
