"""Findings of round 3: the whole job in bounded memory and disk."""

import math

from pyspark.sql import functions as F

from muniscope.functions.geography import EARTH_RADIUS_KM
from muniscope.operators import cube as C
from muniscope.operators import documents as D
from muniscope.operators import joins as J
from muniscope.operators import reshape as R
from muniscope.operators.rules import Rule, Step, needed, run_chunk
from muniscope.operators.scale import ordered_buckets
from muniscope.plans import places as P


def _persons(spark):
    rows = [(w, a, b, c, 1 + i % 5) for i, (w, a, b, c) in enumerate(
        [(f"p{i % 7}", i % 3, None if i % 5 == 0 else i % 4, "xy"[i % 2]) for i in range(60)] + [(None, 1, 2, "x"), (None, 1, 2, "x"), (None, None, None, None)] + [("p0", 1, 1, "y")] * 3
    )]
    return rows, spark.createDataFrame(rows, "who string, a int, b int, c string, v long")


def _brute(rows, used, known):
    out = {}
    for w, a, b, c, v in rows:
        key = tuple({"a": a, "b": b, "c": c}[k] if k in used else None for k in "abc")
        if known and any({"a": a, "b": b, "c": c}[k] is None for k in used):
            continue
        who, total = out.setdefault(key, (set(), [0]))
        who.update([w] if w is not None else [])
        total[0] += v
    return {k: (len(w), t[0]) for k, (w, t) in out.items()}


def test_copies_mark_one_row_of_a_person_in_each_group(spark):
    rows, df = _persons(spark)
    masks = {0: "", 1: "a", 3: "ab", 4: "c", 7: "abc"}
    for known in (True, False):
        for small in (1, 3, 200):  # persons of more rows take the other way
            copies = C._marked_copies(df, ["a", "b", "c"], "who", "v", list(masks), known, small)
            got = copies.groupBy("__gid", "a", "b", "c").agg(F.sum("__new").alias("n"), F.sum("__amount").alias("s")).collect()
            for m, used in masks.items():
                assert {(r.a, r.b, r.c): (r.n, r.s) for r in got if r["__gid"] == m} == _brute(rows, used, known)


def test_copies_without_a_table_of_key_sets(spark, monkeypatch):
    rows, df = _persons(spark)
    monkeypatch.setattr(C, "TABLE_KEYS", 0)
    monkeypatch.setattr(C, "WORD", 2)
    got = C._marked_copies(df, ["a", "b", "c"], "who", "v", [0, 1, 3, 4, 7], True).groupBy("__gid", "a", "b", "c").agg(F.sum("__new").alias("n"), F.sum("__amount").alias("s"))
    assert {(r.a, r.b, r.c): (r.n, r.s) for r in got.collect() if r["__gid"] == 3} == _brute(rows, "ab", True)


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_distances_are_dealt_out_though_their_points_are_few_bytes(spark):
    a = spark.range(200).select(F.col("id").alias("a"), (F.col("id") % 90).cast("double").alias("lat"), (F.col("id") * 1.5 - 150).alias("lon"))
    b = spark.range(50).select((49 - F.col("id")).alias("b"), (F.col("id") % 45).cast("double").alias("lat"), F.lit(20.0).alias("lon"))
    rows = J.pair_distances(a, b, "a", "b", block=20)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    where_b = {r.b: (r.lat, r.lon) for r in b.collect()}
    where_a = {r.a: (r.lat, r.lon) for r in a.collect()}
    met = {}
    for r in rows.collect():
        ids = [d.id for d in r.distances]
        assert ids == sorted(ids)
        met.setdefault(r.a, []).extend(ids)
        for d in r.distances[:3]:
            (y, x), (v, u) = (tuple(map(math.radians, p)) for p in (where_a[r.a], where_b[d.id]))
            half = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
            assert abs(d.km - 2 * EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(half)))) < 1e-6
    assert len(met) == 200 and all(sorted(ids) == list(range(50)) for ids in met.values())


def test_shared_documents_are_read_once(spark):
    long = spark.createDataFrame([(1, "p", "e1", "v", "5"), (1, "p", "e2", "v", "6"), (2, "p", "e1", "v", "7")], "ent int, plot string, element_id string, variable string, valor string")
    members = spark.createDataFrame([("m", "a", 1), ("m", "b", 1), ("m", "b", 1), ("m", "c", 2), ("m", "d", 3)], "nivel string, nivel_clave string, ent int")
    plots = spark.createDataFrame([("p", "i")], "plot string, info string")
    docs = D.map_document(long, plots, shared_by="ent", members=members)
    assert docs.columns == ["nivel", "nivel_clave", "values"]
    size = D.map_document(long, plots, shared_by="ent", members=members, read=lambda d: d.select("ent", F.length("values").alias("n")))
    assert sorted((r.nivel_clave, len(r["values"])) for r in docs.collect()) == sorted((r.nivel_clave, r.n) for r in size.collect())
    assert size.count() == 3


def test_few_asked_ranges_do_not_hold_more_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    assert ordered_buckets(df, F.col("v"), buckets=2).select("__bucket").distinct().count() == 4
    assert ordered_buckets(df, F.col("v"), buckets=6).select("__bucket").distinct().count() == 6


def test_spread_needs_one_aggregate(spark, capsys):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (1, "z", 9.0), (2, "b", None), (None, "b", 4.0), (2, None, 1.0)], "id int, k string, v double")
    out = R.spread(df, "k", "v", ["id"], ["a", "b"])
    assert "pivotfirst" not in _plan(out, capsys)
    assert {r.id: (r.a, r.b) for r in out.collect()} == {1: (3.0, None), 2: (None, None), None: (None, 4.0)}


def test_census_pyramid_comes_with_the_other_indicators(spark, capsys):
    flags = ["poblacion_mun", *P.GROUPS, "migrantes_internos_recientes", "migrantes"]
    unpaid = [f"acti_sin_pago{i}" for i in range(1, 9)]
    base = spark.createDataFrame([("01001", 1, 4, 10), ("01001", 3, 75, 5), ("01001", 1, None, 3), ("01002", 3, 5, 2), (None, 1, 4, 1)], "cve_muni string, sexo int, edad int, poblacion_mun int")
    df = base.withColumns({**{f: F.lit(1) for f in flags[1:]}, **{u: F.lit(0) for u in unpaid}, **{c: F.lit("01") for c in ["ent_pais_asi", "ent_pais_trab"]}, **{c: F.lit("001") for c in ["mun_asi", "mun_trab"]}, "conact": F.lit(10), "factor": F.lit(1)})
    out = P.census_indicators(df)
    assert "Join" not in _plan(out, capsys)
    got = {r.cve_muni: (r.h0_4, r.m75, r.m5_9, r.poblacion_mun) for r in out.collect()}
    assert got == {"01001": (10, 5, None, 18), "01002": (None, None, 2, 2), None: (None, None, None, 1)}


def test_grouped_rules_share_a_join_wherever_they_stand(spark, capsys):
    df = spark.createDataFrame([(1, 5, None), (1, 6, 2), (2, None, 3), (None, 7, 4)], "h int, x int, old int")
    chunk = [Rule.grouped("sx", "sum", "x", ["h"]), Rule.dummy("rich", "sx > 10"), Rule.cases("y", ("old IS NULL", 1)), Rule.grouped("ny", "sum", "y", ["h"]), Rule("old", "old + sx")]
    out = run_chunk(df, chunk, None, ["h"])
    assert _plan(out, capsys).count("Join") == 1
    assert sorted((r.h or 0, r.sx, r.rich, r.ny, r.old) for r in out.collect() if r.old is not None) == [(0, 0, 0, 0, 4), (1, 11, 1, 1, 13), (2, 0, 0, 0, 3)]
    every = run_chunk(df, chunk, None, return_all=True)
    assert every.columns == ["h", "x", "old", "sx", "rich", "y", "ny"]


def test_steps_hold_no_more_than_they_read(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "id int, a int, b int, c int")
    steps = {"one": Step([Rule("x", "a + 1"), Rule("y", "c")], ["x"]), "two": Step([Rule.grouped("z", "sum", "x", ["b"])], after="one")}
    assert needed(df, steps, ["id"]).columns == ["id", "a", "b"]
