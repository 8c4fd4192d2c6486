"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import cube as C
from .core import query, shape_sql


@query("group_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice FROM lineitem GROUP BY 1, 2")
def _(t):
    df = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    out = A.group_summary(df, ["l_returnflag", "l_linestatus"], "sum")
    return out.withColumns({c: F.round(c, 2) for c in ["l_quantity", "l_extendedprice"]})


_CENSUS_SQL = ", ".join(f"CAST(sum(CASE WHEN {p} THEN factor ELSE 0 END) AS BIGINT) AS {n}" for n, p in A.CENSUS_FLAGS.items())


@query("weighted_flags", f"SELECT ent, {_CENSUS_SQL} FROM ({shape_sql('census')}) GROUP BY 1")
def _(t):
    return A.weighted_flags(t.shape("census"), ["ent"], "factor", A.CENSUS_FLAGS)


@query("weighted_indicator", """
WITH b AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS pob, sum(l_quantity * l_discount) AS l_discount, sum(l_quantity * l_tax) AS l_tax FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, pob AS pob_tot, 'l_discount' AS variable, round(l_discount, 4) AS nominal, round(l_discount / pob, 8) AS porcentaje FROM b
UNION ALL SELECT l_returnflag, l_linestatus, pob, 'l_tax', round(l_tax, 4), round(l_tax / pob, 8) FROM b""")
def _(t):
    out = A.weighted_indicator(t.lineitem, ["l_returnflag", "l_linestatus"], "l_quantity", ["l_discount", "l_tax"])
    return out.withColumns({"nominal": F.round("nominal", 4), "porcentaje": F.round("porcentaje", 8)})


@query("proportions", """
SELECT c_nationkey, CAST(sum(t) AS BIGINT) AS total, CAST(sum(a) AS BIGINT) AS deudor, CAST(sum(b) AS BIGINT) AS auto, sum(a) / sum(t) AS prop_deudor, sum(b) / sum(t) AS prop_auto
FROM (SELECT c_nationkey, 1 AS t, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS a, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS b FROM customer) GROUP BY 1""")
def _(t):
    df = t.customer.select("c_nationkey", F.lit(1).alias("total"), (F.col("c_acctbal") < 0).cast("int").alias("deudor"), (F.col("c_mktsegment") == "AUTOMOBILE").cast("int").alias("auto"))
    return A.proportions(df, ["c_nationkey"], "total", ["deudor", "auto"])


@query("event_rate", """
WITH e AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS n_errores, count(*) FILTER (value > 50) AS n_altos FROM events GROUP BY 1), p AS (SELECT c_custkey AS user_id, 1.0e0 + c_nationkey AS poblacion FROM customer)
SELECT user_id, n_errores, n_altos, poblacion, n_errores / poblacion AS errores, n_altos / poblacion AS altos FROM e LEFT JOIN p USING (user_id)""")
def _(t):
    pop = t.customer.select(F.col("c_custkey").alias("user_id"), (1.0 + F.col("c_nationkey")).alias("poblacion"))
    return A.event_rate(t.events, pop, ["user_id"], {"errores": "event_type = 'error'", "altos": F.col("value") > 50})


@query("rate_per_100k", """
WITH e AS (SELECT CAST(day(ts) AS INT) AS dia, user_id, sum(value) FILTER (event_type = 'error') AS robo_total, sum(value) FILTER (event_type = 'purchase') AS dolo_total FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1, 2)
SELECT dia, user_id, round(robo_total, 4) AS robo_total, round(dolo_total, 4) AS dolo_total, round(robo_total * 100000 / (1.0e0 + c_nationkey), 4) AS robo_tasa, round(dolo_total * 100000 / (1.0e0 + c_nationkey), 4) AS dolo_tasa
FROM e LEFT JOIN customer ON user_id = c_custkey""")
def _(t):
    pop = t.customer.select(F.col("c_custkey").alias("user_id"), (1.0 + F.col("c_nationkey")).alias("poblacion"))
    events = t.events.withColumn("dia", F.dayofmonth("ts"))
    out = A.rate_per_100k(events, pop, ["dia", "user_id"], ["user_id"], "event_type", "value", {"error": "robo", "purchase": "dolo"})
    return out.select("dia", "user_id", *[F.round(c, 4).alias(c) for c in out.columns if c not in ("dia", "user_id")])


@query("density", "SELECT l_suppkey, round(avg((l_quantity + l_linenumber) / 1000.0e0), 8) AS densidad, round(avg((l_tax + l_discount) / 1000.0e0), 8) AS otra FROM lineitem GROUP BY 1")
def _(t):
    out = A.density(t.lineitem, ["l_suppkey"], {"densidad": ["l_quantity", "l_linenumber"], "otra": ["l_tax", "l_discount"]})
    return out.withColumns({c: F.round(c, 8) for c in ["densidad", "otra"]})


@query("beneficiaries", "SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS n_beneficiarios, round(sum(o_totalprice), 2) AS suma_importe FROM orders GROUP BY 1, 2")
def _(t):
    out = A.beneficiaries(t.orders, ["o_orderstatus", "o_orderpriority"], "o_custkey", "o_totalprice")
    return out.withColumn("suma_importe", F.round("suma_importe", 2))


@query("beneficiaries_approximate")
def _(t):
    return A.beneficiaries(t.orders, ["o_orderstatus"], "o_custkey", "o_totalprice", approximate=True)


# three levels x three groups x three types x three time grains over orders and customers
AXES = {
    "nivel": {"nacional": [], "estatal": ["c_nationkey"], "municipal": ["c_nationkey", "c_mktsegment"]},
    "grupo": {"programa": ["o_orderstatus"], "padron": ["o_orderstatus", "clerk"], "todo": []},
    "tipos": {"prioridad": ["o_orderpriority"], "saldo": ["saldo"], "total": []},
    "temporalidad": {"mes_pago": ["anio", "mes"], "trimestre": ["anio", "trimestre"], "anual": ["anio"]},
}
_CUBE_BASE = """SELECT CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey END AS c_nationkey, c_mktsegment, o_orderstatus, CAST(o_orderkey % 3 AS INT) AS clerk, o_orderpriority,
 CASE WHEN c_acctbal < 0 THEN 'debe' ELSE 'haber' END AS saldo, CAST(year(o_orderdate) AS INT) AS anio, CAST(month(o_orderdate) AS INT) AS mes, CAST(quarter(o_orderdate) AS INT) AS trimestre, o_custkey, o_totalprice
 FROM orders JOIN customer ON o_custkey = c_custkey"""


def _cube_sql():
    from itertools import product

    keys = list(dict.fromkeys(k for o in AXES.values() for c in o.values() for k in c))
    parts = []
    for names in product(*AXES.values()):
        used = list(dict.fromkeys(k for a, n in zip(AXES, names) for k in AXES[a][n]))
        labels = ", ".join(f"'{n}' AS {a}" for a, n in zip(AXES, names))
        cols = ", ".join(k if k in used else f"NULL AS {k}" for k in keys)
        known = " AND ".join(f"{k} IS NOT NULL" for k in used)
        parts.append(f"SELECT {labels}, {cols}, count(DISTINCT o_custkey) AS n_beneficiarios, round(sum(o_totalprice), 2) AS suma_importe FROM b WHERE {known} GROUP BY {', '.join(used)}")
    return f"WITH b AS ({_CUBE_BASE}) " + " UNION ALL ".join(parts)


def cube_base(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return df.select(
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("c_nationkey"), "c_mktsegment", "o_orderstatus", (F.col("o_orderkey") % 3).cast("int").alias("clerk"), "o_orderpriority",
        F.when(F.col("c_acctbal") < 0, "debe").otherwise("haber").alias("saldo"), F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"), F.quarter("o_orderdate").alias("trimestre"),
        "o_custkey", "o_totalprice",
    )


@query("dimension_cube", _cube_sql())
def _(t):
    out = C.dimension_cube(cube_base(t), AXES, "o_custkey", "o_totalprice")
    return out.withColumn("suma_importe", F.round("suma_importe", 2))


@query("multi_level", f"""
WITH b AS ({_CUBE_BASE})
SELECT 'n' AS nivel, 'nacional' AS cvenivel, anio, o_orderstatus, count(DISTINCT o_custkey) AS beneficiarios, round(sum(o_totalprice), 2) AS monto FROM b GROUP BY anio, o_orderstatus, clerk
UNION SELECT 'e', CAST(c_nationkey AS VARCHAR), anio, o_orderstatus, count(DISTINCT o_custkey), round(sum(o_totalprice), 2) FROM b GROUP BY c_nationkey, anio, o_orderstatus
UNION SELECT 'm', c_mktsegment, anio, o_orderstatus, count(DISTINCT o_custkey), round(sum(o_totalprice), 2) FROM b GROUP BY c_mktsegment, anio, o_orderstatus""")
def _(t):
    levels = {"n": (None, ["clerk"]), "e": ("c_nationkey", []), "m": ("c_mktsegment", [])}
    out = C.multi_level(cube_base(t), levels, ["anio", "o_orderstatus"], "o_custkey", "o_totalprice")
    return out.withColumn("monto", F.round("monto", 2))


@query("with_grand_total", """
SELECT CAST(c_nationkey AS VARCHAR) AS c_nationkey, round(avg(c_acctbal), 4) AS c_acctbal FROM customer GROUP BY c_nationkey UNION ALL SELECT '00', round(sum(c_acctbal), 4) FROM customer""")
def _(t):
    df = t.customer.select(F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_acctbal")
    return A.with_grand_total(df, "c_nationkey", "00", ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 4))


@query("dedupe_max", "SELECT l_partkey, l_suppkey, l_returnflag, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2, 3")
def _(t):
    return A.dedupe_max(t.lineitem, ["l_partkey", "l_suppkey", "l_returnflag"], "l_extendedprice")


@query("distinct_flag_score", """
SELECT l_suppkey, round(sum(CASE WHEN l_linenumber IN (1, 3, 6) THEN 1 / 3.0e0 ELSE 0 END), 8) AS l_linenumber FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem) GROUP BY 1""")
def _(t):
    out = A.distinct_flag_score(t.lineitem, "l_suppkey", "l_linenumber", [1, 3, 6], 1 / 3)
    return out.withColumn("l_linenumber", F.round("l_linenumber", 8))


@query("gap_ratio", """
SELECT l_suppkey, round(a, 6) AS brecha_num, round(b, 6) AS brecha_den, round(CASE WHEN b = 0 THEN a ELSE a / nullif(b, 0) END, 6) AS brecha
FROM (SELECT l_suppkey, avg(l_extendedprice) FILTER (l_returnflag = 'A') AS a, avg(l_extendedprice) FILTER (l_returnflag = 'R') AS b FROM lineitem GROUP BY 1)""")
def _(t):
    out = A.gap_ratio(t.lineitem, ["l_suppkey"], "l_returnflag", "A", "R", "l_extendedprice")
    return out.withColumns({c: F.round(c, 6) for c in ["brecha_num", "brecha_den", "brecha"]})


@query("floating_population", """
WITH b AS (SELECT c_nationkey AS casa, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 25 AS INT) END AS otro FROM orders JOIN customer ON o_custkey = c_custkey), p AS (SELECT c_nationkey AS casa, count(*) AS pob FROM customer GROUP BY 1)
SELECT casa, count(*) FILTER (otro <> casa) AS pob_flot_esc, count(*) FILTER (otro <> casa) / any_value(pob) AS tasa_flot_esc FROM b LEFT JOIN p USING (casa) GROUP BY 1""")
def _(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("casa"), F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_orderkey") % 25).cast("int")).alias("otro")
    )
    pop = t.customer.groupBy(F.col("c_nationkey").alias("casa")).agg(F.count(F.lit(1)).alias("pob"))
    return A.floating_population(df, "casa", "otro", pop, "pob", "esc")


@query("two_stage", """
WITH h AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS dev, sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS gr FROM lineitem GROUP BY 1)
SELECT o_orderpriority, round(sum(dev * o_totalprice), 2) AS dev, round(sum(gr * o_totalprice), 2) AS gr FROM h LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    weights = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_totalprice")
    out = A.two_stage(t.lineitem, ["l_orderkey"], ["o_orderpriority"], weights, "o_totalprice", {"dev": "l_returnflag = 'R'", "gr": "l_quantity > 25"})
    return out.withColumns({c: F.round(c, 2) for c in ["dev", "gr"]})


@query("collapse_max", "SELECT l_orderkey, max(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1")
def _(t):
    return A.collapse_max(t.lineitem, ["l_orderkey"], ["l_quantity", "l_returnflag"])


@query("median_of_sums", """
SELECT o_custkey, round(median(s), 4) AS volatilidad FROM (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS s FROM orders GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    df = t.orders.withColumn("y", F.year("o_orderdate"))
    return A.median_of_sums(df, ["o_custkey"], ["y"], "o_totalprice", "volatilidad").withColumn("volatilidad", F.round("volatilidad", 4))


@query("weighted_rollup", """
WITH s AS (SELECT l_suppkey, sum(l_discount * l_quantity) AS d, sum(l_tax * l_quantity) AS x FROM lineitem GROUP BY 1)
SELECT l_suppkey, round((d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()), 6) AS l_discount, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()), 6) AS l_tax FROM s""")
def _(t):
    out = A.weighted_rollup(t.lineitem, ["l_suppkey"], "l_quantity", ["l_discount", "l_tax"])
    return out.withColumns({c: F.round(c, 6) for c in ["l_discount", "l_tax"]})


@query("count_pivot", """
SELECT user_id, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""")
def _(t):
    return A.count_pivot(t.events, ["user_id"], "event_type", ["error", "click", "view"]).na.fill(0)


_BANDS = [f"{a}-{a + 4}" for a in range(0, 75, 5)] + ["75+"]


def _band_case(sex, label):
    out = []
    for b in _BANDS:
        low, high = (75, 999) if b == "75+" else map(int, b.split("-"))
        out.append(f"CAST(sum(factor) FILTER (sexo = {sex} AND edad BETWEEN {low} AND {high}) AS BIGINT) AS {label}{b.replace('-', '_').replace('+', '')}")
    return ", ".join(out)


@query("population_pyramid", f"SELECT ent, {_band_case(1, 'h')}, {_band_case(3, 'm')} FROM ({shape_sql('census')}) GROUP BY 1")
def _(t):
    return A.population_pyramid(t.shape("census"), ["ent"], "sexo", "edad", "factor", {1: "h", 3: "m"})


@query("sum_over_splits", "SELECT l_orderkey, l_returnflag, sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice FROM lineitem GROUP BY 1, 2")
def _(t):
    out = A.sum_over_splits(t.lineitem, ["l_orderkey", "l_returnflag"], ["l_quantity", "l_extendedprice"])
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@query("concat_values", "SELECT c_nationkey, CAST(0 AS INT) AS part, string_agg(c_name, ', ' ORDER BY c_name) AS c_name FROM (SELECT DISTINCT c_nationkey, c_name FROM customer) GROUP BY 1")
def _(t):
    return A.concat_values(t.customer, ["c_nationkey"], "c_name")


@query("weighted_table", f"""
SELECT ent, round(100 * sum(ic_rezedu * factor) / sum(factor) FILTER (ic_rezedu IS NOT NULL), 8) AS ic_rezedu_p, coalesce(sum(factor) FILTER (ic_rezedu = 1), 0) AS ic_rezedu_n,
  round(100 * sum(ic_ali * factor) / sum(factor) FILTER (ic_ali IS NOT NULL), 8) AS ic_ali_p, coalesce(sum(factor) FILTER (ic_ali = 1), 0) AS ic_ali_n
FROM ({shape_sql('home')}) WHERE plb IS NOT NULL GROUP BY 1""")
def _(t):
    out = A.weighted_table(t.shape("home"), ["ent"], "factor", ["ic_rezedu", "ic_ali"], "plb")
    return out.withColumns({c: F.round(c, 8) for c in ["ic_rezedu_p", "ic_ali_p"]})
