"""Place keys, great-circle distance and WKT geometry."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import pad_left
from . import col

EARTH_RADIUS_KM = 6371.0088


def _whole(c: Column) -> Column:
    text = F.trim(F.translate(c.cast("string"), "\"'", ""))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def geo_key(ent, mun=None, loc=None) -> Column:
    """Zero-padded state (2), municipality (2+3) or locality (2+3+4) key. Null part gives null."""
    parts = [pad_left(col(ent).cast("string"), 2)]
    if mun is not None:
        parts.append(pad_left(col(mun).cast("string"), 3))
    if loc is not None:
        parts.append(pad_left(col(loc).cast("string"), 4))
    return F.concat(*parts)


def valid_state(ent) -> Column:
    """Two-digit state key, null outside 1..32."""
    n = _whole(col(ent))
    return F.when(n.between(1, 32), pad_left(n.cast("string"), 2))


def valid_municipality(ent, mun) -> Column:
    """Five-digit key, null unless state is 1..32 and municipality 1..998."""
    e, m = _whole(col(ent)), _whole(col(mun))
    key = F.concat(pad_left(e.cast("string"), 2), pad_left(m.cast("string"), 3))
    return F.when(e.between(1, 32) & m.between(1, 998), key)


def valid_locality(loc) -> Column:
    """Four-digit locality part, null outside 1..9998."""
    n = _whole(col(loc))
    return F.when(n.between(1, 9998), pad_left(n.cast("string"), 4))


def parent_key(child, width: int = 2) -> Column:
    """Key of the containing place: the first ``width`` characters."""
    return F.substring(col(child), 1, width)


def program_key(modality, number) -> Column:
    """Programme id: modality letter followed by the number padded to three."""
    return F.concat(col(modality), pad_left(col(number).cast("string"), 3))


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km."""
    la1, lo1, la2, lo2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(half))) * (2 * EARTH_RADIUS_KM)


def _rings(wkt) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON as array<struct<outer, pts>>.

    A polygon starts after ``((``; its first ring is the outer one, later rings are holes.
    """
    text = F.regexp_replace(F.upper(col(wkt)), r"\s*([(),])\s*", "$1")
    body = F.regexp_replace(F.regexp_replace(text, r"^[^(]*\(+", ""), r"\)+$", "")
    polygons = F.split(body, r"\)\),\(\(")

    def points(ring: Column) -> Column:
        return F.transform(
            F.split(ring, ","),
            lambda p: F.struct(
                F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"),
                F.split(F.trim(p), r"\s+")[1].try_cast("double").alias("y"),
            ),
        )

    return F.flatten(
        F.transform(
            polygons,
            lambda poly: F.transform(
                F.split(poly, r"\),\("),
                lambda ring, i: F.struct((i == 0).alias("outer"), points(ring).alias("pts")),
            ),
        )
    )


def wkt_centroid(wkt) -> Column:
    """Area centroid struct<x,y> of a POLYGON/MULTIPOLYGON (holes subtracted), of a POINT itself.

    Shoelace sums per ring. A hole counts against the area whatever way its points run.
    """
    def sums(ring: Column) -> Column:
        pts = ring.getField("pts")
        edges = F.zip_with(
            F.slice(pts, 1, F.greatest(F.size(pts) - 1, F.lit(0))),
            F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))),
            lambda p, q: F.struct(
                (p["x"] * q["y"] - q["x"] * p["y"]).alias("a"),
                ((p["x"] + q["x"]) * (p["x"] * q["y"] - q["x"] * p["y"])).alias("cx"),
                ((p["y"] + q["y"]) * (p["x"] * q["y"] - q["x"] * p["y"])).alias("cy"),
            ),
        )
        total = F.aggregate(
            edges,
            F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")),
            lambda s, e: F.struct(
                (s["a"] + e["a"]).alias("a"), (s["cx"] + e["cx"]).alias("cx"), (s["cy"] + e["cy"]).alias("cy")
            ),
        )
        # same sign for all outer rings, opposite for holes
        return F.transform(
            F.array(total),
            lambda t: F.transform(
                F.array(F.when(ring.getField("outer"), F.signum(t["a"])).otherwise(-F.signum(t["a"]))),
                lambda g: F.struct((t["a"] * g).alias("a"), (t["cx"] * g).alias("cx"), (t["cy"] * g).alias("cy")),
            )[0],
        )[0]

    whole = F.aggregate(
        F.transform(_rings(wkt), sums),
        F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")),
        lambda s, e: F.struct(
            (s["a"] + e["a"]).alias("a"), (s["cx"] + e["cx"]).alias("cx"), (s["cy"] + e["cy"]).alias("cy")
        ),
        lambda s: F.struct(
            F.try_divide(s["cx"], s["a"] * 3).alias("x"), F.try_divide(s["cy"], s["a"] * 3).alias("y")
        ),
    )
    point = F.split(F.regexp_extract(col(wkt), r"\(\s*(.*?)\s*\)", 1), r"\s+")
    return F.when(
        F.upper(col(wkt)).startswith("POINT"),
        F.struct(point[0].try_cast("double").alias("x"), point[1].try_cast("double").alias("y")),
    ).otherwise(whole)


def wkt_to_geojson(wkt) -> Column:
    """GeoJSON geometry text of a POINT, POLYGON or MULTIPOLYGON."""
    text = F.regexp_replace(F.trim(col(wkt)), r"\s*([(),])\s*", "$1")
    kind = F.initcap(F.lower(F.regexp_extract(text, r"^([A-Za-z]+)", 1)))
    kind = F.when(kind == "Multipolygon", "MultiPolygon").otherwise(kind)
    body = F.regexp_replace(text, r"^[A-Za-z]+\s*", "")
    number = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pairs = F.regexp_replace(body, number + r"\s+" + number, "[$1,$2]")
    coords = F.translate(pairs, "()", "[]")
    coords = F.when(kind == "Point", F.regexp_replace(coords, r"^\[(.*)\]$", "$1")).otherwise(coords)
    return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}"))
