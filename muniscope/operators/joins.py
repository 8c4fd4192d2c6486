"""Join shapes. No join here is a cross join; broadcasts are hinted only after a size check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geography import EARTH_RADIUS_KM
from .scale import pack_blocks, probe_blocks


def assemble(base: DataFrame, parts: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Left-join each part to ``base``. All joins share the key, so one shuffle of ``base`` serves them all."""
    return reduce(lambda acc, part: acc.join(part, on, "left"), parts, base)


def natural_left(a: DataFrame, b: DataFrame) -> DataFrame:
    """Left join on every shared column name."""
    shared = [c for c in a.columns if c in set(b.columns)]
    return a.join(b, shared, "left")


def outer_assemble(dfs: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Full outer join of all frames with the key coalesced."""
    return reduce(lambda acc, d: acc.join(d, on, "full"), dfs)


def join_codes(df: DataFrame, codes: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join with a code list."""
    return df.join(codes, on, "inner")


def left_join_between(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    between: tuple[str, object, object] | None = None,
    right_name: str = "right",
    append_names: bool = True,
) -> DataFrame:
    """Left join, then keep rows with a left column in a range.

    Right columns become ``right_name__col``; without ``append_names`` a right column whose name exists on
    the left is discarded. The range is on a left column, so Catalyst pushes it below the join.
    """
    if append_names:
        renamed = right.select(*[F.col(c).alias(f"{right_name}__{c}") for c in right.columns])
        joined = left.join(renamed, left[left_key] == renamed[f"{right_name}__{right_key}"], "left")
    else:
        extra = [c for c in right.columns if c not in left.columns]
        slim = right.select(F.col(right_key).alias("__rk"), *extra)
        joined = left.join(slim, left[left_key] == slim["__rk"], "left").drop("__rk")
    if between:
        name, low, high = between
        joined = joined.where(F.col(name).between(low, high))
    return joined


def downscale(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Give each child place the values of its parent place."""
    return children.join(parents, key, "left")


def name_to_key(df: DataFrame, dim: DataFrame, name: str, key: str, clean=lambda c: c) -> DataFrame:
    """Look a cleaned name up in (name, key)."""
    lookup = dim.select(clean(F.col(name)).alias("__n"), F.col(key)).dropDuplicates(["__n"])
    return df.join(lookup, clean(df[name]) == F.col("__n"), "left").drop("__n")


def add_group_value(df: DataFrame, by: Sequence[str], **aggs: Column) -> DataFrame:
    """Put group aggregates beside each row.

    Aggregate first (map-side partial), then join: a hot group costs one aggregate row, not one sorted task.
    """
    grouped = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    grouped = grouped.select(*[F.col(b).alias(f"__g_{b}") for b in by], *aggs)
    cond = F.lit(True)
    for b in by:
        cond = cond & df[b].eqNullSafe(grouped[f"__g_{b}"])
    return df.join(grouped, cond, "left").drop(*[f"__g_{b}" for b in by])


def with_total(df: DataFrame, totals: DataFrame, on: str | Sequence[str], value: str, total: str, share: str) -> DataFrame:
    """Join totals of another level and add ``value / total`` (null when the total is zero)."""
    return df.join(totals, on, "left").withColumn(share, F.try_divide(F.col(value).cast("double"), F.col(total)))


def missing_keys(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b``."""
    return a.join(b, on, "left_anti")


def restrict_to(df: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is present in ``members``."""
    return df.join(members, on, "left_semi")


def donor_fill(df: DataFrame, key: str, value: str, donors: DataFrame) -> DataFrame:
    """Keys without a value, or absent altogether, take the value of their donor key; ``donors`` is (key, donor)."""
    pairs = donors.select(F.col(key).alias("__k"), "donor")
    values = df.groupBy(key).agg(F.max(value).alias("__v"))
    given = (
        values.join(pairs, F.col(key) == F.col("donor"))
        .where(F.col("__v").isNotNull())
        .select(F.col("__k").alias(key), "__v")
    )
    return df.join(given, key, "full").withColumn(value, F.coalesce(F.col(value), F.col("__v"))).drop("__v")


def pair_distances(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str, lat: str = "lat", lon: str = "lon", block: int = 2048
) -> DataFrame:
    """Distance matrix by rows: for each point of ``a`` the distances to the points of ``b``.

    One output row per (point of ``a``, block of ``b``) with ``distances`` array<struct<id, km>>, ordered by id.
    ``b`` is packed into blocks, so no row pairs are produced. A block is sorted once, before the points of ``a`` meet it,
    and what depends on one point alone is computed with that point, not with each pair.
    """
    def at(df, point):
        return df.select(*point, F.radians(lat).alias("__y"), F.radians(lon).alias("__x"))

    placed = at(b, [F.col(b_id).alias("id")]).withColumn("__cos", F.cos("__y"))
    points = F.struct("id", F.col("__y").alias("y"), F.col("__x").alias("x"), F.col("__cos").alias("cos"))
    packed = pack_blocks(placed, [], points, ["id"], block).withColumn("items", F.sort_array("items"))
    met = probe_blocks(at(a, [a_id]).withColumn("__cos", F.cos("__y")), packed, [])

    def km(p):
        """As ``haversine``, from radians."""
        half = F.pow(F.sin((p["y"] - F.col("__y")) / 2), 2) + F.col("__cos") * p["cos"] * F.pow(F.sin((p["x"] - F.col("__x")) / 2), 2)
        return F.asin(F.least(F.lit(1.0), F.sqrt(half))) * (2 * EARTH_RADIUS_KM)

    row = F.transform("items", lambda p: F.struct(p["id"].alias("id"), km(p).alias("km")))
    return met.select(a_id, "block", row.alias("distances"))
