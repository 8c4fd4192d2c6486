"""Distance weighting, imputation, point classification, variogram."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geography import EARTH_RADIUS_KM, haversine, wkt_to_geojson
from .scale import pack_blocks, partitions, settle, sorted_parts


SENT = 1 << 20  # source positions (of 40 bytes) that may be sent to every task
PER_CELL = 8  # source positions a cell of the finest grid holds on average


def _on_globe(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the place's unit vector: ux, uy, uz."""
    y, x = F.radians(lat), F.radians(lon)
    return df.withColumns({"ux": F.cos(y) * F.cos(x), "uy": F.cos(y) * F.sin(x), "uz": F.sin(y)})


def _arc(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Great-circle distance in km of two unit vectors, from their chord."""
    quarter = sum(((p - q) * (p - q) for p, q in zip(a, b, strict=True)), F.lit(0.0)) / 4
    return F.asin(F.least(F.lit(1.0), F.sqrt(quarter))) * (2 * EARTH_RADIUS_KM)


def idw(
    targets: DataFrame,
    sources: DataFrame,
    value: str,
    target_id: str,
    source_id: str,
    lat: str = "lat",
    lon: str = "lon",
    name: str | None = None,
    k: int | None = None,
    block: int = 2048,
) -> DataFrame:
    """Inverse-distance weighted ``value`` at each target: sum(v/d) / sum(1/d) over all (or the k nearest) sources.

    A target on top of a source takes that source's value (the mean if several share the point). Targets that share a
    position are computed once, and so are sources when all of them count. Without ``k`` every target position is weighed
    against every source position, as the definition asks; with ``k`` it meets only the cells around it. A target
    without a position, or with no source at all, gets null.
    """
    name = name or value
    known = sources.where(F.col(value).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), F.col(value).cast("double").alias("v"), F.col(source_id).alias("id")
    )
    asked = targets.select(target_id, F.col(lat).cast("double").alias("__lat"), F.col(lon).cast("double").alias("__lon"))
    places = asked.where(F.col("__lat").isNotNull() & F.col("__lon").isNotNull()).select("__lat", "__lon").distinct()
    per = _weigh_all(places, known, block) if k is None else _weigh_nearest(places, known, k, block)
    value_at = F.when(F.col("hits") > 0, F.col("hit") / F.col("hits")).otherwise(F.try_divide("num", "den"))
    return asked.join(per.select("__lat", "__lon", value_at.alias(name)), ["__lat", "__lon"], "left").select(target_id, name)


def _weigh_all(places: DataFrame, known: DataFrame, block: int) -> DataFrame:
    """Sums (num, den, hit, hits) over all sources. Source positions travel in packed blocks, which are opened beside each
    place and summed up at once, so pairs of places never leave a task."""
    spots = settle(_on_globe(known.groupBy("lat", "lon").agg(F.sum("v").alias("v"), F.count(F.lit(1)).cast("double").alias("n")), "lat", "lon"))
    n = spots.count()
    blocks, salts = max(-(-n // block), 1), partitions(places)
    item = F.struct("ux", "uy", "uz", "v", "n")
    packed = spots.withColumn("block", F.pmod(F.xxhash64("lat", "lon"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.collect_list(item).alias("items"))
    probe = _on_globe(places.repartition(salts), "__lat", "__lon").withColumnsRenamed({"ux": "tx", "uy": "ty", "uz": "tz"})
    probe = probe.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if n <= SENT:
        met = probe.join(F.broadcast(packed), "block")
    else:  # each block is copied to all salts, so that a block is met by all tasks
        copies = packed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = probe.withColumn("salt", F.pmod(F.xxhash64("__lat", "__lon"), F.lit(salts)).cast("int")).join(copies, ["block", "salt"])
    pairs = met.select("__lat", "__lon", "tx", "ty", "tz", F.explode("items").alias("p"))
    far = pairs.select("__lat", "__lon", "p.v", "p.n", _arc([F.col("tx"), F.col("ty"), F.col("tz")], [F.col("p.ux"), F.col("p.uy"), F.col("p.uz")]).alias("d"))
    away, here = F.col("d") > 0, F.col("d") == 0
    return far.groupBy("__lat", "__lon").agg(
        F.sum(F.when(away, F.col("v") / F.col("d"))).alias("num"), F.sum(F.when(away, F.col("n") / F.col("d"))).alias("den"),
        F.sum(F.when(here, F.col("v"))).alias("hit"), F.sum(F.when(here, F.col("n"))).alias("hits"),
    )


def nearest(places: DataFrame, known: DataFrame, k: int, block: int = 2048) -> DataFrame:
    """(__lat, __lon, near): the k nearest sources of each place as sorted structs of distance, id and value. Exact.

    Sources lie in cells: cubes around the globe, as a chord is never longer than its arc. A place looks into the 27 cells
    around it. What is found there is final if its k-th lies within one cell's width, since all that was not looked at is
    farther; the other places look again with cells of twice the width, until 27 cells hold the globe. The first width is
    chosen so that a cell holds some ``PER_CELL`` sources, so most places end in the first rounds, and how much a place
    looks at does not depend on the number of sources.
    """
    sources = settle(_on_globe(known, "lat", "lon"))
    axes = ["ux", "uy", "uz"]
    size = sources.agg(F.count(F.lit(1)).alias("n"), F.greatest(*[F.max(a) - F.min(a) for a in axes]).alias("wide")).first()
    left = settle(_on_globe(places, "__lat", "__lon"))
    width = max((size["wide"] or 2.0) * (PER_CELL * max(k, 1) / max(size["n"], 1)) ** 0.5, 1e-6)
    around = F.array(*[F.struct(*[F.lit(d).alias(c) for c, d in zip(axes, o, strict=True)]) for o in product((-1, 0, 1), repeat=3)])
    cell = ["cx", "cy", "cz"]
    done: DataFrame | None = None
    while True:
        at = {c: F.floor(F.col(a) / width) for c, a in zip(cell, axes, strict=True)}
        packed = pack_blocks(sources.withColumns(at), cell, F.struct("lat", "lon", "id", "v"), ["id", "lat", "lon"], block)
        looked = left.withColumns(at).withColumn("o", F.explode(around)).withColumns({c: F.col(c) + F.col(f"o.{a}") for c, a in zip(cell, axes, strict=True)}).drop("o")
        met = looked.join(packed, cell)
        dist = F.transform("items", lambda p: F.struct(haversine(F.col("__lat"), F.col("__lon"), p["lat"], p["lon"]).alias("d"), p["id"].alias("id"), p["v"].alias("v")))
        best = met.select("__lat", "__lon", F.slice(F.array_sort(dist), 1, k).alias("near")).groupBy("__lat", "__lon").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
        last = width >= 2
        # the chord of the k-th, with a margin for rounding
        chord = 2 * F.sin(F.element_at("near", k)["d"] / (2 * EARTH_RADIUS_KM)) if not last else F.lit(0.0)
        sure = F.lit(True) if last else (F.size("near") >= k) & (F.when(F.size("near") >= k, chord) * 1.000001 + 1e-12 <= width)
        found = settle(left.join(best, ["__lat", "__lon"], "left").withColumn("sure", F.coalesce(sure, F.lit(False))))
        part = found.where("sure").select("__lat", "__lon", "near")
        done = part if done is None else done.unionByName(part)
        left = found.where("NOT sure").drop("near", "sure")
        if last or left.isEmpty():
            return done
        width *= 2


def _weigh_nearest(places: DataFrame, known: DataFrame, k: int, block: int) -> DataFrame:
    """Sums (num, den, hit, hits) over the k nearest sources."""
    each = nearest(places, known, k, block).select("__lat", "__lon", F.explode("near").alias("p")).select("__lat", "__lon", "p.d", "p.v")
    away, here = F.col("d") > 0, F.col("d") == 0
    return each.groupBy("__lat", "__lon").agg(
        F.sum(F.when(away, F.col("v") / F.col("d"))).alias("num"), F.sum(F.when(away, F.lit(1.0) / F.col("d"))).alias("den"),
        F.sum(F.when(here, F.col("v"))).alias("hit"), F.sum(F.when(here, F.lit(1.0))).alias("hits"),
    )


def spatial_impute(
    df: DataFrame, key: str, value: str, lat: str = "lat", lon: str = "lon", k: int | None = None
) -> DataFrame:
    """Fill missing values at places from the places that have one, by inverse distance."""
    unknown = df.where(F.col(value).isNull())
    known = df.where(F.col(value).isNotNull())
    guess = idw(unknown, known, value, key, key, lat, lon, name="__guess", k=k)
    return df.join(guess, key, "left").withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("__guess"))).drop("__guess")


def collect_geometries(df: DataFrame, by: Sequence[str], wkt: str, order: str, size: int = 20_000) -> DataFrame:
    """GeometryCollection texts of the child shapes per parent in ``order``: (by, part, geometry) with at most ``size`` shapes a part."""
    rows = df.where(F.col(wkt).isNotNull()).select(*by, F.col(order).alias("__o"), wkt_to_geojson(wkt).alias("__g"))
    parts = sorted_parts(rows, by, ["__o", "__g"], size)
    shapes = F.transform(F.array_sort(F.collect_list(F.struct("__o", "__g"))), lambda s: s["__g"])
    body = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), F.array_join(shapes, ","), F.lit("]}"))
    return parts.groupBy(*by, "part").agg(body.alias("geometry"), F.count(F.lit(1)).alias("n_geometries"))


def classify_points(
    df: DataFrame, code: str, classes: Sequence[tuple[str, str]], clave: str, element: str, keep: Sequence[str], lat: str, lon: str
) -> DataFrame:
    """Points whose code starts with a listed prefix as (nivel, clave, element_id, type, kept columns, lat, long)."""
    kind = F.lit(None).cast("string")
    for prefix, label in reversed(classes):
        kind = F.when(F.col(code).startswith(prefix), label).otherwise(kind)
    return df.withColumn("type", kind).where(F.col("type").isNotNull()).select(
        F.lit("georreferencia").alias("nivel"),
        F.col(clave).alias("clave"),
        F.col(element).alias("element_id"),
        "type",
        *keep,
        F.col(lat).alias("lat"),
        F.col(lon).alias("long"),
    )


# Establishment codes of education and of health services.
SERVICE_CLASSES = [("61", "Servicios Educativos"), ("62", "Servicios de Salud")]


def variogram_bins(
    df: DataFrame, value: str, width_km: float, max_km: float, lat: str = "lat", lon: str = "lon", block: int = 512
) -> DataFrame:
    """(bin, pairs, gamma): mean half squared difference of value over point pairs by distance bin.

    Points sharing a position are first reduced to (n, sum, sum of squares), from which all their pairs follow
    by arithmetic; so copies of a place cost one row. Positions meet only positions of neighbouring cells: cubes of
    ``max_km`` around the globe, as a chord is never longer than its arc, so poles and the date line are like any place.
    A cell with many positions is cut into blocks that meet block by block (both numbers are in the key) and add up
    their bins inside the array, so pairs are never rows and a crowded cell is spread over many tasks.
    """
    globe = EARTH_RADIUS_KM * 1.001
    y, x = F.radians("y"), F.radians("x")
    axes = {"cx": F.cos(y) * F.cos(x), "cy": F.cos(y) * F.sin(x), "cz": F.sin(y)}
    spots = (
        df.where(F.col(value).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
        .withColumns({c: F.floor(a * globe / max_km) for c, a in axes.items()})
    )
    own = spots.where(F.col("n") > 1).select(
        F.lit(0).cast("long").alias("bin"),
        (F.col("n") * (F.col("n") - 1) / 2).alias("pairs"),
        ((F.col("n") * F.col("q") - F.col("s") * F.col("s")) / 2).alias("half"),
    )
    item = F.struct(F.col("y").cast("double").alias("y"), F.col("x").alias("x"), F.col("n").cast("double").alias("n"), F.col("s").cast("double").alias("s"), F.col("q").cast("double").alias("q"))
    cell = list(axes)
    packed = pack_blocks(spots, cell, item, ["y", "x"], block)
    steps = F.array(*[F.struct(*[F.lit(d).alias(c) for c, d in zip(cell, o, strict=True)]) for o in product((-1, 0, 1), repeat=3)])
    around = packed.select(*cell, "block", F.col("items").alias("li"), F.explode(steps).alias("o")).select(*[(F.col(c) + F.col(f"o.{c}")).alias(c) for c in cell], "block", "li")
    there = packed.groupBy(*cell).agg(F.max("blocks").alias("n_blocks"))
    left = around.join(there, cell).withColumn("r_block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    met = left.join(packed.select(*cell, F.col("block").alias("r_block"), F.col("items").alias("ri")), [*cell, "r_block"])
    zero = F.transform(F.sequence(F.lit(0), F.lit(int(-(-max_km // width_km)) - 1)), lambda _: F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("h")))

    def add(acc, p):
        def one(acc2, r):
            d = haversine(p["y"], p["x"], r["y"], r["x"])
            here = (d < max_km) & ((p["y"] < r["y"]) | ((p["y"] == r["y"]) & (p["x"] < r["x"])))
            slot = F.floor(d / width_km)
            return F.when(
                here,
                F.transform(
                    acc2,
                    lambda b, i: F.when(
                        i == slot,
                        F.struct(
                            (b["p"] + p["n"] * r["n"]).alias("p"),
                            (b["h"] + (r["n"] * p["q"] + p["n"] * r["q"] - F.lit(2.0) * p["s"] * r["s"]) / 2).alias("h"),
                        ),
                    ).otherwise(b),
                ),
            ).otherwise(acc2)

        return F.aggregate("ri", acc, one)

    across = met.select(F.posexplode(F.aggregate("li", zero, add)).alias("bin", "b")).select(
        F.col("bin").cast("long").alias("bin"), F.col("b.p").alias("pairs"), F.col("b.h").alias("half")
    )
    every = own.unionByName(across).where(F.col("pairs") > 0)
    return every.groupBy("bin").agg(F.sum("pairs").alias("pairs"), (F.sum("half") / F.sum("pairs")).alias("gamma"))
