"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import geography as G
from ..functions import numbers as N
from ..functions import text as X
from ..operators import projections as P
from .core import query


@query("geo_key", """
SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') AS ent,
  lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 1000 AS VARCHAR)) AS INTEGER)), '0') AS muni,
  lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 1000 AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey AS VARCHAR), greatest(4, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS loc
FROM customer""")
def _(t):
    mun = F.col("c_custkey") % 1000
    return t.customer.select(
        "c_custkey", G.geo_key("c_nationkey").alias("ent"), G.geo_key("c_nationkey", mun).alias("muni"),
        G.geo_key("c_nationkey", mun, "c_custkey").alias("loc"),
    )


@query("valid_geo_key", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_suppkey % 36 BETWEEN 1 AND 32 THEN lpad(CAST(l_suppkey % 36 AS VARCHAR), greatest(2, CAST(length(CAST(l_suppkey % 36 AS VARCHAR)) AS INTEGER)), '0') END AS ent,
  CASE WHEN l_suppkey % 36 BETWEEN 1 AND 32 AND l_partkey BETWEEN 1 AND 998
    THEN lpad(CAST(l_suppkey % 36 AS VARCHAR), greatest(2, CAST(length(CAST(l_suppkey % 36 AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(l_partkey AS VARCHAR), greatest(3, CAST(length(CAST(l_partkey AS VARCHAR)) AS INTEGER)), '0') END AS muni,
  CASE WHEN l_orderkey BETWEEN 1 AND 9998 THEN lpad(CAST(l_orderkey AS VARCHAR), greatest(4, CAST(length(CAST(l_orderkey AS VARCHAR)) AS INTEGER)), '0') END AS loc
FROM lineitem""")
def _(t):
    ent = F.concat(F.lit(" "), (F.col("l_suppkey") % 36).cast("string"), F.lit("\""))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", G.valid_state(ent).alias("ent"), G.valid_municipality(ent, "l_partkey").alias("muni"),
        G.valid_locality("l_orderkey").alias("loc"),
    )


_LEGAL = ", ".join(
    f"('{i:02d}', {lo}, {hi})" for i, lo, hi in P.MUNICIPALITIES
)


@query("filter_valid_codes", f"""
WITH dim(e, lo, hi) AS (VALUES {_LEGAL}),
b AS (SELECT c_custkey, lpad(CAST(c_nationkey + 1 AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey + 1 AS VARCHAR)) AS INTEGER)), '0') AS cve_ent,
  CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE lpad(CAST(c_nationkey + 1 AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey + 1 AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 140 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 140 AS VARCHAR)) AS INTEGER)), '0') END AS cve_muni
  FROM customer)
SELECT c_custkey, cve_ent, cve_muni FROM b LEFT JOIN dim ON cve_ent = e
WHERE cve_muni IS NULL OR (CAST(substring(cve_muni, 3, 3) AS INT) BETWEEN lo AND hi
  AND (cve_ent <> '03' OR CAST(substring(cve_muni, 3, 3) AS INT) IN (1, 2, 3, 8, 9)))""")
def _(t):
    df = t.customer.select(
        "c_custkey", G.geo_key(F.col("c_nationkey") + 1).alias("cve_ent"),
        F.when(F.col("c_custkey") % 50 != 0, G.geo_key(F.col("c_nationkey") + 1, F.col("c_custkey") % 140)).alias("cve_muni"),
    )
    return P.filter_valid_codes(df, P.legal_ranges(t.spark))


@query("parent_key", "SELECT c_name, substring(c_name, 1, 2) AS padre, substring(c_name, 1, 5) AS padre5 FROM customer")
def _(t):
    return t.customer.select("c_name", G.parent_key("c_name").alias("padre"), G.parent_key("c_name", 5).alias("padre5"))


@query("composite_id", """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus END) AS id, l_quantity FROM lineitem""")
def _(t):
    part = F.when(F.col("l_returnflag") != "R", F.col("l_linestatus"))
    return t.lineitem.select(X.composite_id(["l_orderkey", "l_linenumber", part]).alias("id"), "l_quantity")


_CLEAN = (
    f"lower(trim(regexp_replace(regexp_replace(regexp_replace(translate(text, '{X.ACCENTED}', '{X.PLAIN}'), '\\p{{Mn}}', '', 'g'), "
    "'[^\\p{L}\\p{N}_\\s]', '', 'g'), '[^a-zA-Z]+', ' ', 'g')))"
)


@query("clean_text", f"SELECT doc_id, {_CLEAN} AS texto FROM documents")
def _(t):
    return t.documents.select("doc_id", X.clean_text("text").alias("texto"))


@query("strip_chars", """
SELECT p_partkey, trim(translate(p_name, 'ae#', '')) AS limpio, CAST(translate(CAST(p_size AS VARCHAR) || '.5%', '%', '') AS DOUBLE) / 100 AS fraccion FROM part""")
def _(t):
    pct = F.concat(F.col("p_size").cast("string"), F.lit(".5%"))
    return t.part.select("p_partkey", X.strip_chars("p_name", "ae#").alias("limpio"), X.pct_to_fraction(pct).alias("fraccion"))


@query("digits_or_null", """
SELECT o_orderkey, CASE WHEN regexp_matches(v, '\\D') THEN NULL ELSE v END AS digitos
FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS v FROM orders)""")
def _(t):
    v = F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return t.orders.select("o_orderkey", X.digits_or_null(v).alias("digitos"))


@query("to_int", """
SELECT l_orderkey, l_linenumber, coalesce(n, 0) AS cero, n AS nulo
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS n FROM lineitem)""")
def _(t):
    text = F.when(F.col("l_linenumber") == 3, F.lit("sin dato")).otherwise(F.concat(F.lit(" "), F.format_number(F.floor("l_extendedprice"), 0)))
    return t.lineitem.select("l_orderkey", "l_linenumber", N.to_int(text).alias("cero"), N.to_int(text, "null").alias("nulo"))


@query("recode_values", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'alta' WHEN '5-LOW' THEN 'baja' ELSE o_orderpriority END AS prioridad,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'alta' WHEN '5-LOW' THEN 'baja' END AS solo_listadas FROM orders""")
def _(t):
    m = {"1-URGENT": "alta", "5-LOW": "baja"}
    return t.orders.select(
        "o_orderkey", X.recode_values("o_orderpriority", m).alias("prioridad"),
        X.recode_values("o_orderpriority", m, keep_other=False).alias("solo_listadas"),
    )


@query("first_match_code", """
SELECT p_partkey, CASE WHEN contains(p_type, 'M') THEN 'M' WHEN contains(p_type, 'E') THEN 'E' END AS clave FROM part""")
def _(t):
    return t.part.select("p_partkey", X.first_match_code("p_type", [("M", "M"), ("E", "E")]).alias("clave"))


@query("period_month", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE month(o_orderdate)::INT END AS mes,
  CASE WHEN o_custkey % 15 BETWEEN 1 AND 12 THEN (o_custkey % 15)::INT END AS mes_valido FROM orders""")
def _(t):
    m = F.month("o_orderdate")
    mark = F.when(m < 10, m.cast("string")).when(m == 10, "a").when(m == 11, "B").otherwise("c")
    period = F.concat(F.lit("18"), F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(mark))
    return t.orders.select("o_orderkey", D.period_month(period).alias("mes"), D.valid_month(F.col("o_custkey") % 15).alias("mes_valido"))


@query("age_at", """
SELECT o_orderkey, edad, CASE WHEN edad >= 60 THEN 'Adulto Mayor' WHEN edad <= 14 THEN 'Infante' WHEN edad > 14 THEN 'Adulto' END AS categoria,
  CASE WHEN edad >= 75 THEN '75+' ELSE CAST(edad // 5 * 5 AS VARCHAR) || '-' || CAST(edad // 5 * 5 + 4 AS VARCHAR) END AS grupo_edad
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(2024 - b - CASE WHEN month(o_orderdate) > 6 OR (month(o_orderdate) = 6 AND day(o_orderdate) > 1) THEN 1 ELSE 0 END AS INT) END AS edad
  FROM (SELECT *, 1940 + o_custkey % 83 AS b FROM orders))""")
def _(t):
    born = F.concat((1940 + F.col("o_custkey") % 83).cast("string"), F.date_format("o_orderdate", "MM"), F.date_format("o_orderdate", "dd"))
    born = F.when(F.date_format("o_orderdate", "MMdd") == "0229", F.concat(F.substring(born, 1, 4), F.lit("0228"))).otherwise(born)
    born = F.when(F.col("o_orderkey") % 10 == 0, F.lit("19900231")).otherwise(born)
    age = D.age_at(born, F.lit(2024), F.lit(6))
    return t.orders.select("o_orderkey", age.alias("edad"), D.age_category(age).alias("categoria"), D.age_band(age).alias("grupo_edad"))


@query("redact_minors", """
SELECT c_custkey, CASE WHEN c_custkey % 90 < 18 THEN '' ELSE c_name END AS c_name, CAST(c_custkey % 90 AS INT) AS edad FROM customer""")
def _(t):
    return P.redact_minors(t.customer.select("c_custkey", "c_name", (F.col("c_custkey") % 90).cast("int").alias("edad")), "edad", ["c_name"])


@query("fill_default", """
SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal END, 2) AS saldo, coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey END, 0) AS pais FROM supplier""")
def _(t):
    df = t.supplier.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 4 != 0, F.col("s_acctbal")).alias("saldo"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey")).alias("pais")
    )
    return P.fill_default(df, {2: ["saldo"], 0: ["pais"]})


@query("fill_mean", """
WITH b AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS v FROM customer)
SELECT c_custkey, round(coalesce(v, avg(v) OVER ()), 6) AS total, round(coalesce(v, avg(v) OVER (PARTITION BY c_nationkey)), 6) AS por_pais FROM b""")
def _(t):
    v = F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal"))
    df = t.customer.select("c_custkey", "c_nationkey", v.alias("total"), v.alias("por_pais"))
    out = P.fill_mean(P.fill_mean(df, ["total"]), ["por_pais"], ["c_nationkey"])
    return P.round_columns(out.drop("c_nationkey"), 6)


@query("round_columns", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 1) AS l_extendedprice, round(l_discount, 1) AS l_discount FROM lineitem")
def _(t):
    return P.round_columns(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"), 1)


@query("cast_columns", """
SELECT l_orderkey, CAST(round_even(l_extendedprice, 0) AS INT) AS entero, l_extendedprice AS real, CAST(l_linenumber AS VARCHAR) AS texto FROM lineitem""")
def _(t):
    df = t.lineitem.select(
        "l_orderkey", F.col("l_extendedprice").cast("string").alias("entero"), F.concat(F.lit(" "), F.col("l_extendedprice").cast("string")).alias("real"), F.col("l_linenumber").alias("texto")
    )
    return P.cast_columns(df, ["entero"], ["real"], ["texto"])


_MES = "list_extract(['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'], month(o_orderdate))"


@query("parse_es_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS mes, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS fecha FROM orders")
def _(t):
    from ..operators.reshape import MONTH_COLUMNS

    names = F.array(*[F.lit(m) for m in MONTH_COLUMNS])
    text = F.concat(F.element_at(names, F.month("o_orderdate")), F.lit(" "), F.year("o_orderdate").cast("string"))
    short = F.concat(F.substring(F.element_at(names, F.month("o_orderdate")), 1, 3), F.lit(" "), F.year("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", D.month_number(text).alias("mes"), D.parse_es_month(short).cast("string").alias("fecha"))


@query("data_date_to_date", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes, CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS anual FROM orders""")
def _(t):
    y, m = F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    return t.orders.select(
        "o_orderkey", D.data_date_to_date(F.concat_ws("-", y, m, F.lit("m"))).cast("string").alias("mes"),
        D.data_date_to_date(F.concat(y, F.lit("-a"))).cast("string").alias("anual"),
    )


@query("excel_serial_date", """
SELECT o_orderkey, strftime(DATE '1899-12-30' + CAST(30000 + o_custkey % 9000 AS INT), '%Y-%m-%d') AS fecha FROM orders""")
def _(t):
    serial = F.concat((30000 + F.col("o_custkey") % 9000).cast("string"), F.lit(".0"))
    return t.orders.select("o_orderkey", D.excel_serial_date(serial).cast("string").alias("fecha"))


@query("agro_calendar", """
SELECT o_orderkey, CAST(CASE WHEN c = 'OI' THEN CASE WHEN m > 9 THEN m - 9 ELSE m + 3 END ELSE CASE WHEN m < 4 THEN m + 9 ELSE m - 3 END END AS INT) AS mes_ag,
  CAST(CASE WHEN c = 'OI' THEN CASE WHEN m > 9 THEN y + 1 ELSE y END ELSE CASE WHEN m < 4 THEN y - 1 ELSE y END END AS INT) AS anio_ag
FROM (SELECT o_orderkey, month(o_orderdate) AS m, year(o_orderdate) AS y, CASE WHEN o_orderstatus = 'F' THEN 'OI' ELSE 'PV' END AS c FROM orders)""")
def _(t):
    cycle = F.when(F.col("o_orderstatus") == "F", "OI").otherwise("PV")
    return t.orders.select("o_orderkey", D.agro_calendar(F.month("o_orderdate"), F.year("o_orderdate"), cycle).alias("a")).select("o_orderkey", "a.*")


@query("short_hash", "SELECT c_custkey, substring(sha1(c_name), 1, 12) AS corto FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.short_hash("c_name", 12).alias("corto"))


@query("shorten_identifier", """
SELECT p_partkey, CASE WHEN length(v) <= 30 THEN v WHEN length(regexp_replace(v, '[aeiouAEIOU]', '', 'g')) <= 30 THEN regexp_replace(v, '[aeiouAEIOU]', '', 'g')
  ELSE substring(v, 1, 5) || substring(sha1(v), 1, 15) END AS corto
FROM (SELECT p_partkey, p_name || '_' || p_type || '_' || p_brand || CASE WHEN p_partkey % 2 = 0 THEN '_largo_largo' ELSE '' END AS v FROM part)""")
def _(t):
    v = F.concat_ws("_", "p_name", "p_type", F.concat("p_brand", F.when(F.col("p_partkey") % 2 == 0, "_largo_largo").otherwise("")))
    return t.part.select("p_partkey", X.shorten_identifier(v, 30, 20).alias("corto"))


@query("split_variable", """
SELECT o_orderkey, replace(replace(v, '_porcentaje', ''), '_num', '') AS variable,
  CASE WHEN contains(v, '_porcentaje') OR contains(v, 'int_') THEN 'porcentaje' WHEN contains(v, '_num') OR contains(v, '_carencias') THEN 'nominal' ELSE '' END AS tipo
FROM (SELECT o_orderkey, lower(substring(o_orderpriority, 3)) || CASE o_orderstatus WHEN 'F' THEN '_porcentaje' WHEN 'O' THEN '_num' ELSE '_carencias' END AS v FROM orders)""")
def _(t):
    s = F.col("o_orderstatus")
    v = F.concat(F.lower(F.substring("o_orderpriority", 3, 100)), F.when(s == "F", "_porcentaje").when(s == "O", "_num").otherwise("_carencias"))
    return t.orders.select("o_orderkey", X.split_variable(v).alias("s")).select("o_orderkey", "s.*")


@query("basic_filters", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND regexp_matches(o_orderpriority, '^[12]-') AND o_orderdate <= TIMESTAMP '1999-06-30'""")
def _(t):
    return t.orders.where(
        F.col("o_orderstatus").isin("F", "O") & F.col("o_orderpriority").rlike("^[12]-") & (F.col("o_orderdate") <= F.lit("1999-06-30").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_orderpriority")


@query("any_in", """
SELECT l_orderkey, l_linenumber, CAST(coalesce(a IN (1, 5), FALSE) OR coalesce(b IN (1, 5), FALSE) AS INT) AS alguna
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_partkey % 9 END AS a, l_suppkey % 11 AS b FROM lineitem)""")
def _(t):
    df = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey") % 9).alias("a"), (F.col("l_suppkey") % 11).alias("b")
    )
    return df.select("l_orderkey", "l_linenumber", N.any_in(["a", "b"], [1, 5]).cast("int").alias("alguna"))


@query("row_mean", """
SELECT l_orderkey, l_linenumber, (coalesce(d, 0) + l_tax) / ((CASE WHEN d IS NULL THEN 0 ELSE 1 END) + 1) AS media, coalesce(d, 0) + l_tax AS suma,
  pow(l_quantity * l_extendedprice, 0.5) AS geometrica, 0.4 * l_quantity + 0.6 * l_tax AS ponderada
FROM (SELECT *, CASE WHEN l_discount < 0.03 THEN NULL ELSE l_discount END AS d FROM lineitem)""")
def _(t):
    d = F.when(F.col("l_discount") >= 0.03, F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", N.row_mean([d, "l_tax"]).alias("media"), N.row_sum([d, "l_tax"]).alias("suma"),
        N.geo_mean(["l_quantity", "l_extendedprice"]).alias("geometrica"), N.weighted_row_sum({"l_quantity": 0.4, "l_tax": 0.6}).alias("ponderada"),
    )


@query("row_argmax", """
SELECT l_orderkey, l_linenumber, CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS mayor
FROM (SELECT l_orderkey, l_linenumber, l_partkey % 7 AS a, l_suppkey % 6 AS b, l_linenumber AS c FROM lineitem)""")
def _(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 7).alias("a"), (F.col("l_suppkey") % 6).alias("b"), F.col("l_linenumber").alias("c"))
    return df.select("l_orderkey", "l_linenumber", N.row_argmax(["a", "b", "c"]).alias("mayor"))


@query("program_key", "SELECT p_partkey, substring(p_brand, 1, 1) || lpad(CAST(p_size AS VARCHAR), greatest(3, CAST(length(CAST(p_size AS VARCHAR)) AS INTEGER)), '0') AS cve_programa FROM part")
def _(t):
    return t.part.select("p_partkey", G.program_key(F.substring("p_brand", 1, 1), "p_size").alias("cve_programa"))


@query("at_period", """
WITH b AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS data_date FROM orders)
SELECT o_orderkey, data_date, 'ultimo' AS cual FROM b WHERE data_date = (SELECT max(data_date) FROM b)
UNION ALL SELECT o_orderkey, data_date, 'primero' FROM b WHERE data_date = (SELECT min(data_date) FROM b)""")
def _(t):
    b = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("data_date"))
    last = P.at_period(b, which="latest").withColumn("cual", F.lit("ultimo"))
    return last.unionByName(P.at_period(b, which="earliest").withColumn("cual", F.lit("primero")))


@query("parse_timestamp_cascade", """
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 4 = 3 THEN TIMESTAMP '1970-01-01 01:02:03' ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS momento FROM orders""")
def _(t):
    stamp = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    k = F.col("o_orderkey") % 4
    text = (
        F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k == 1, stamp).when(k == 2, F.concat(stamp, F.lit(".0"))).otherwise("10203")
    )
    return t.orders.select("o_orderkey", F.date_format(D.parse_timestamp_cascade(text), "yyyy-MM-dd HH:mm:ss").alias("momento"))


@query("haversine", """
SELECT s_suppkey, 2 * 6371.0088e0 * asin(least(1.0e0, sqrt(pow(sin((radians(19.43e0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(19.43e0)) * pow(sin((radians(-99.13e0) - radians(lon)) / 2), 2)))) AS km
FROM (SELECT s_suppkey, CAST(14 + (s_suppkey * 37) % 180 / 10.0e0 AS DOUBLE) AS lat, CAST(-117 + (s_suppkey * 53) % 300 / 10.0e0 AS DOUBLE) AS lon FROM supplier)""")
def _(t):
    return t.shape("supplier_place").select("s_suppkey", G.haversine("lat", "lon", F.lit(19.43), F.lit(-99.13)).alias("km"))


@query("wkt_centroid", """
SELECT s_suppkey, s_suppkey + 2.0e0 AS x, s_nationkey + 2.0e0 AS y FROM supplier""")
def _(t):
    x, y = F.col("s_suppkey"), F.col("s_nationkey")

    def corner(dx, dy):
        return F.concat((x + dx).cast("string"), F.lit(" "), (y + dy).cast("string"))

    def ring(lo, hi):
        return F.concat(F.lit("("), F.concat_ws(", ", corner(lo, lo), corner(hi, lo), corner(hi, hi), corner(lo, hi), corner(lo, lo)), F.lit(")"))

    square = F.concat(F.lit("POLYGON("), ring(0, 4), F.lit(","), ring(1, 3), F.lit(")"))
    return t.supplier.select("s_suppkey", G.wkt_centroid(square).alias("c")).select("s_suppkey", "c.*")
