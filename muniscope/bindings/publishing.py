"""Documents, profiles and semantic tables. JSON is checked by its leaves, read back from the text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..operators import documents as D
from ..operators.reshape import gather
from ..plans import semantic as S
from .core import query


@query("pack_json", """SELECT s_suppkey, '{"s_name":"' || s_name || '","s_nationkey":' || CAST(s_nationkey AS VARCHAR) || '}' AS extra FROM supplier""")
def _(t):
    return D.pack_json(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), ["s_name", "s_nationkey"], "extra")


_NESTED = "struct<tipo:string,value:double,hijos:array<struct<tipo:string,value:double>>>"


@query("nested_totals", """
WITH c AS (SELECT o_custkey, o_orderstatus AS p, o_orderpriority AS h, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3)
SELECT o_custkey, p, round(sum(v) OVER (PARTITION BY o_custkey, p), 2) AS total, h, round(v, 2) AS v FROM c""")
def _(t):
    docs = D.nested_totals(t.orders, ["o_custkey"], "o_orderstatus", "o_orderpriority", "o_totalprice")
    d = docs.select("o_custkey", F.from_json("documento", _NESTED).alias("d")).select("o_custkey", "d.tipo", "d.value", F.explode("d.hijos").alias("k"))
    return d.select("o_custkey", F.col("tipo").alias("p"), F.round("value", 2).alias("total"), F.col("k.tipo").alias("h"), F.round("k.value", 2).alias("v"))


def _budget(t):
    line = t.orders.select(
        F.year("o_orderdate").alias("ciclo"), F.lit(20).alias("id_ramo"), F.lit("Desarrollo").alias("desc_ramo"), F.substring("o_orderpriority", 3, 1).alias("id_modalidad"),
        F.col("o_orderpriority").alias("desc_modalidad"), (F.col("o_custkey") % 15).alias("id_pp"), F.col("o_orderstatus").alias("desc_tipogasto"),
        F.concat(F.lit("Concepto "), (F.col("o_custkey") % 4).cast("string")).alias("concepto"), F.round("o_totalprice", -3).alias("monto_modificado"),
    )
    annual = line.withColumnRenamed("concepto", "desc_objeto_del_gasto")
    quarterly = line.withColumn("cve_programa", F.concat("id_modalidad", pad_left(F.col("id_pp").cast("string"), 3))).withColumnRenamed("concepto", "desc_concepto")
    return annual, quarterly


@query("budget_semantic", """
WITH l AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS ciclo, substring(o_orderpriority, 3, 1) || lpad(CAST(o_custkey % 15 AS VARCHAR), greatest(3, CAST(length(CAST(o_custkey % 15 AS VARCHAR)) AS INTEGER)), '0') AS cve_programa, o_orderpriority, o_orderstatus AS p, 'Concepto ' || CAST(o_custkey % 4 AS VARCHAR) AS h, round(o_totalprice, -3) AS m FROM orders),
c AS (SELECT ciclo, cve_programa, p, h, sum(m) AS v FROM l GROUP BY 1, 2, 3, 4)
SELECT ciclo, cve_programa, p, sum(v) OVER (PARTITION BY ciclo, cve_programa, p) AS total, h, v FROM c""")
def _(t):
    docs = S.budget_semantic(*_budget(t))
    d = docs.select("ciclo", "cve_programa", F.from_json("documento", _NESTED).alias("d")).select("ciclo", "cve_programa", "d.tipo", "d.value", F.explode("d.hijos").alias("k"))
    return d.select("ciclo", "cve_programa", F.col("tipo").alias("p"), F.col("value").alias("total"), F.col("k.tipo").alias("h"), F.col("k.value").alias("v"))


def _facts(t):
    """(nivel, nivel_clave, fecha, plot, variable, valor) per customer and year."""
    yearly = t.orders.groupBy(pad_left(F.col("o_custkey").cast("string"), 5).alias("nivel_clave"), F.year("o_orderdate").cast("string").alias("fecha")).agg(
        F.count(F.lit(1)).cast("string").alias("n"), F.floor(F.max("o_totalprice")).cast("long").cast("string").alias("maximo"), F.max("o_orderpriority").alias("prioridad")
    )
    long = gather(yearly, "variable", "valor", ["nivel_clave", "fecha"])
    plot = F.when(F.col("variable") == "n", "conteos").otherwise("montos")
    return long.withColumns({"nivel": F.lit("m"), "plot": plot, "element_id": F.col("fecha")})


_FACTS = """f AS (SELECT lpad(CAST(o_custkey AS VARCHAR), greatest(5, CAST(length(CAST(o_custkey AS VARCHAR)) AS INTEGER)), '0') AS nivel_clave, CAST(year(o_orderdate) AS VARCHAR) AS fecha, CAST(count(*) AS VARCHAR) AS n, CAST(max(o_orderpriority) AS VARCHAR) AS prioridad, max(o_totalprice) AS maximo FROM orders GROUP BY 1, 2),
l AS (SELECT nivel_clave, fecha, 'conteos' AS plot, 'n' AS variable, n AS valor FROM f UNION ALL SELECT nivel_clave, fecha, 'montos', 'prioridad', prioridad FROM f UNION ALL SELECT nivel_clave, fecha, 'montos', 'maximo', CAST(CAST(floor(maximo) AS BIGINT) AS VARCHAR) FROM f)"""


def _dictionary(t):
    return t.orders.select("o_orderpriority").distinct().select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "n").when(F.col("o_orderpriority") == "2-HIGH", "prioridad").otherwise("otra").alias("id"),
        F.concat(F.lit("Nombre \"de\" "), "o_orderpriority").alias("nombre"), F.lit("INEGI").alias("fuente"),
    )


def _plots(t):
    base = t.orders.select(F.when(F.col("o_orderstatus") == "F", "conteos").when(F.col("o_orderstatus") == "O", "montos").alias("plot")).where("plot IS NOT NULL").distinct()
    variables = F.when(F.col("plot") == "conteos", '"n"').otherwise('"prioridad","maximo"')
    meta = F.concat(F.lit('{"vars":['), variables, F.lit('],"schema":"features","table_name":"t","title":"Título","palette":"azul","subtext":"s","section":"1"}'))
    return base.select("plot", F.lit("bar").alias("plot_type"), meta.alias("metadata"))


_DIC = "d(variable, nombre) AS (VALUES ('n', 'Nombre \"de\" 1-URGENT'), ('prioridad', 'Nombre \"de\" 2-HIGH'))"
_LEAF = "struct<values:string,name:string,source:string>"


@query("profile_document", f"""
WITH {_FACTS}, {_DIC}
SELECT 'm' AS nivel, nivel_clave, plot, variable, max(valor) AS valor, any_value(nombre) AS nombre, 'INEGI' AS fuente, 'Título' AS titulo FROM l JOIN d USING (variable) GROUP BY nivel_clave, plot, variable""")
def _(t):
    docs = D.profile_document(_facts(t), _dictionary(t), S.plot_info(_plots(t), _dictionary(t)))
    parsed = F.from_json("values", f"map<string,struct<values:map<string,{_LEAF}>,info:struct<title:string>>>")
    rows = docs.select("nivel", "nivel_clave", F.explode(parsed).alias("plot", "p")).select("nivel", "nivel_clave", "plot", F.col("p.info.title").alias("titulo"), F.explode("p.values").alias("variable", "l"))
    return rows.select("nivel", "nivel_clave", "plot", "variable", F.col("l.values").alias("valor"), F.col("l.name").alias("nombre"), F.col("l.source").alias("fuente"), "titulo")


@query("series_document", f"""
WITH {_FACTS}, {_DIC} SELECT 'm' AS nivel, nivel_clave, plot, fecha, variable, valor, nombre FROM l JOIN d USING (variable)""")
def _(t):
    docs = D.series_document(_facts(t), _dictionary(t), S.plot_info(_plots(t), _dictionary(t)))
    parsed = F.from_json("values", f"map<string,struct<values:map<string,struct<values:map<string,{_LEAF}>>>>>")
    rows = docs.select("nivel", "nivel_clave", F.explode(parsed).alias("plot", "p")).select("nivel", "nivel_clave", "plot", F.explode("p.values").alias("fecha", "v"))
    rows = rows.select("nivel", "nivel_clave", "plot", "fecha", F.explode("v.values").alias("variable", "l"))
    return rows.select("nivel", "nivel_clave", "plot", "fecha", "variable", F.col("l.values").alias("valor"), F.col("l.name").alias("nombre"))


_MAP = "map<string,struct<values:map<string,map<string,struct<valor:string>>>>>"


@query("map_document", f"""WITH {_FACTS} SELECT 'm' AS nivel, nivel_clave, plot, fecha AS elemento, variable, valor FROM l""")
def _(t):
    docs = D.map_document(_facts(t), S.plot_info(_plots(t), _dictionary(t)))
    rows = docs.select("nivel", "nivel_clave", F.explode(F.from_json("values", _MAP)).alias("plot", "p")).select("nivel", "nivel_clave", "plot", F.explode("p.values").alias("elemento", "v"))
    return rows.select("nivel", "nivel_clave", "plot", "elemento", F.explode("v").alias("variable", "l")).select("nivel", "nivel_clave", "plot", "elemento", "variable", F.col("l.valor").alias("valor"))


@query("map_document_shared", """
WITH s AS (SELECT c_nationkey, s_suppkey, max(s_acctbal) AS v FROM supplier JOIN (SELECT DISTINCT c_nationkey FROM customer) ON s_nationkey = c_nationkey GROUP BY 1, 2)
SELECT 'm' AS nivel, CAST(c_custkey AS VARCHAR) AS nivel_clave, CAST(s_suppkey AS VARCHAR) AS elemento, round(v, 2) AS saldo FROM customer JOIN s USING (c_nationkey)""")
def _(t):
    long = t.supplier.select(F.col("s_nationkey").alias("cve_ent"), F.lit("conteos").alias("plot"), F.col("s_suppkey").alias("element_id"), F.lit("saldo").alias("variable"), F.col("s_acctbal").alias("valor"))
    members = t.customer.select(F.lit("m").alias("nivel"), F.col("c_custkey").cast("string").alias("nivel_clave"), F.col("c_nationkey").alias("cve_ent"))

    def leaves(docs):
        rows = docs.select("cve_ent", F.explode(F.from_json("values", _MAP)).alias("plot", "p")).select("cve_ent", F.explode("p.values").alias("elemento", "v"))
        return rows.select("cve_ent", "elemento", F.explode("v").alias("variable", "l")).select("cve_ent", "elemento", F.round(F.col("l.valor").cast("double"), 2).alias("saldo"))

    return D.map_document(long, S.plot_info(_plots(t), _dictionary(t)), shared_by="cve_ent", members=members, read=leaves)


@query("program_document", """
SELECT o_custkey, o_orderstatus AS programa, CAST(year(o_orderdate) AS VARCHAR) AS periodo, count(*) AS beneficiarios, round(sum(o_totalprice), 2) AS monto FROM orders GROUP BY 1, 2, 3""")
def _(t):
    agg = t.orders.groupBy("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("anio")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("monto"))
    docs = D.program_document(agg, ["o_custkey"], "o_orderstatus", "anio", "n", "monto")
    parsed = F.from_json("values", "map<string,map<string,struct<beneficiarios:bigint,monto:double>>>")
    rows = docs.select("o_custkey", F.explode(parsed).alias("programa", "p")).select("o_custkey", "programa", F.explode("p").alias("periodo", "l"))
    return rows.select("o_custkey", "programa", "periodo", "l.*")


def _profiles(t):
    facts = _facts(t)
    return S.place_profiles(facts, facts, facts, _dictionary(t), _plots(t))


@query("place_profiles", f"""
WITH {_FACTS}, {_DIC}
SELECT 'perfil_ubicaciones' AS tipo, 'm' AS nivel, nivel_clave, plot, CAST(NULL AS VARCHAR) AS fecha, variable, max(valor) AS valor FROM l JOIN d USING (variable) GROUP BY nivel_clave, plot, variable
UNION ALL SELECT 'temporal_ubicaciones', 'm', nivel_clave, plot, fecha, variable, valor FROM l JOIN d USING (variable)
UNION ALL SELECT 'maps_ubicaciones', 'm', nivel_clave, plot, fecha, variable, valor FROM l""")
def _(t):
    """Every leaf of the three kinds of documents."""
    docs = _profiles(t)
    key = ["tipo", "nivel", "nivel_clave"]
    kind = lambda name, schema: docs.where(F.col("tipo") == name).select(*key, F.explode(F.from_json("values", schema)).alias("plot", "p"))
    flat = kind("perfil_ubicaciones", f"map<string,struct<values:map<string,{_LEAF}>>>").select(*key, "plot", F.lit(None).cast("string").alias("fecha"), F.explode("p.values").alias("variable", "l"))
    series = kind("temporal_ubicaciones", f"map<string,struct<values:map<string,struct<values:map<string,{_LEAF}>>>>>").select(*key, "plot", F.explode("p.values").alias("fecha", "v"))
    series = series.select(*key, "plot", "fecha", F.explode("v.values").alias("variable", "l"))
    maps = kind("maps_ubicaciones", _MAP).select(*key, "plot", F.explode("p.values").alias("fecha", "v")).select(*key, "plot", "fecha", F.explode("v").alias("variable", "l"))
    return flat.unionByName(series).select(*key, "plot", "fecha", "variable", F.col("l.values").alias("valor")).unionByName(maps.select(*key, "plot", "fecha", "variable", F.col("l.valor").alias("valor")))


@query("place_profiles_json")
def _(t):
    return _profiles(t)


@query("profile_table", """
WITH a AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
SELECT 'clientes' AS tipo, 'e' AS nivel, CAST(c_nationkey AS VARCHAR) AS nivel_clave, '{"n":' || CAST(n AS VARCHAR) || '}' AS values FROM a UNION ALL SELECT 'proveedores', 'e', CAST(s_nationkey AS VARCHAR), '{"n":' || CAST(n AS VARCHAR) || '}' FROM b""")
def _(t):
    def doc(df, key):
        counts = df.groupBy(F.col(key).cast("string").alias("nivel_clave")).agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.lit("e").alias("nivel"), "nivel_clave", F.to_json(F.struct("n")).alias("values"))

    return D.profile_table(clientes=doc(t.customer, "c_nationkey"), proveedores=doc(t.supplier, "s_nationkey"))


def _square(key):
    x, y = (F.col(key) % 30).cast("string"), (F.col(key) % 20).cast("string")
    x1, y1 = (F.col(key) % 30 + 1).cast("string"), (F.col(key) % 20 + 1).cast("string")

    def pt(a, b):
        return F.concat(a, F.lit(" "), b)

    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", pt(x, y), pt(x1, y), pt(x1, y1), pt(x, y1), pt(x, y)), F.lit("))"))


_RING = "'{\"type\":\"Polygon\",\"coordinates\":[[[' || x || ',' || y || '],[' || x1 || ',' || y || '],[' || x1 || ',' || y1 || '],[' || x || ',' || y1 || '],[' || x || ',' || y || ']]]}'"
_SQUARES = "SELECT *, CAST(c_custkey % 30 AS VARCHAR) AS x, CAST(c_custkey % 20 AS VARCHAR) AS y, CAST(c_custkey % 30 + 1 AS VARCHAR) AS x1, CAST(c_custkey % 20 + 1 AS VARCHAR) AS y1 FROM customer"


@query("features", f"""SELECT c_custkey, '{{"type":"Feature","geometry":' || {_RING} || ',"properties":{{"c_name":"' || c_name || '"}}}}' AS feature FROM ({_SQUARES})""")
def _(t):
    return D.features(t.customer.withColumn("wkt", _square("c_custkey")), "wkt", ["c_name"], ["c_custkey"])


@query("feature_collection", f"""
WITH f AS (SELECT c_nationkey, '{{"type":"Feature","geometry":' || {_RING} || ',"properties":{{"c_name":"' || c_name || '"}}}}' AS feature FROM ({_SQUARES}))
SELECT c_nationkey, CAST(0 AS INT) AS part, count(*) AS n_features, '{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"EPSG:4326"}}}},"features":[' || string_agg(feature, ',' ORDER BY feature) || ']}}' AS collection FROM f GROUP BY 1""")
def _(t):
    return D.feature_collection(t.customer.withColumn("wkt", _square("c_custkey")), "wkt", ["c_name"], ["c_nationkey"])


@query("collect_geometries", f"""
WITH f AS (SELECT c_nationkey, c_custkey, {_RING} AS g FROM ({_SQUARES}))
SELECT c_nationkey, CAST(0 AS INT) AS part, '{{"type":"GeometryCollection","geometries":[' || string_agg(g, ',' ORDER BY c_custkey) || ']}}' AS geometry, count(*) AS n_geometries FROM f GROUP BY 1""")
def _(t):
    from ..operators.spatial import collect_geometries

    return collect_geometries(t.customer.withColumn("wkt", _square("c_custkey")), ["c_nationkey"], "wkt", "c_custkey")


@query("explode_plot_vars", """
WITH p AS (SELECT DISTINCT o_orderpriority, CASE WHEN o_orderpriority < '3' THEN ['o_totalprice', 'otra'] ELSE ['o_custkey'] END AS vs FROM orders), e AS (SELECT o_orderpriority AS plot, unnest(vs) AS variable FROM p)
SELECT plot, variable, 'Título' AS title, CASE WHEN variable <> 'otra' THEN 'Nombre de ' || variable END AS nombre, CASE WHEN variable <> 'otra' THEN 'f' END AS fuente FROM e""")
def _(t):
    names = F.when(F.col("o_orderpriority") < "3", '"o_totalprice","otra"').otherwise('"o_custkey"')
    plots = t.orders.select(F.col("o_orderpriority").alias("plot"), F.concat(F.lit('{"vars":['), names, F.lit('],"title":"Título"}')).alias("metadata")).distinct()
    dic = t.orders.select(F.explode(F.array(F.lit("o_totalprice"), F.lit("o_custkey"))).alias("id")).distinct().select("id", F.concat(F.lit("Nombre de "), "id").alias("nombre"), F.lit("f").alias("fuente"))
    return D.explode_plot_vars(plots, dic).select("plot", "variable", "title", "nombre", "fuente")


@query("plot_table", """
WITH l AS (SELECT CAST(s_nationkey AS VARCHAR) AS nivel_clave, CAST(s_suppkey AS VARCHAR) AS e, unnest(['s_name', 's_nationkey']) AS variable, unnest([s_name, CAST(s_nationkey AS VARCHAR)]) AS valor FROM supplier)
SELECT 'e' AS nivel, nivel_clave, 'saldos' AS plot, e || '-' || variable AS element_id, unnest(['x', 'y']) AS vartype, unnest(['variable', 'valor']) AS varname, unnest([variable, valor]) AS value FROM l""")
def _(t):
    return D.plot_table(t.supplier, "e", "saldos", "s_nationkey", ["s_name", "s_nationkey"], ["s_suppkey"])


_POV = "SELECT lpad(CAST({k} AS VARCHAR), greatest({n}, CAST(length(CAST({k} AS VARCHAR)) AS INTEGER)), '0') AS clave, '{v}' AS variable, '{p}' AS tipo, {nivel} AS nivel, {x} AS valor, CAST(count(*) AS DOUBLE) AS pob_tot, CAST(year(o_orderdate) AS VARCHAR) || '-a' AS data_date, CAST(year(o_orderdate) AS INT) AS anio FROM o GROUP BY 1, 7, 8"


@query("poverty_semantic", f"""
WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey), a AS ({_POV.format(k='c_nationkey', n=2, v='pobreza', p='porcentaje', nivel="'estatal'", x='round(max(o_totalprice), 4)')}
UNION {_POV.format(k='c_custkey', n=5, v='carencias', p='porcentaje', nivel="'municipal'", x='round(max(o_totalprice) / 100, 4)')})
SELECT a.*, CASE WHEN nivel = 'estatal' THEN 'Estimaciones del CONEVAL con base en ENIGH ' || CAST(anio AS VARCHAR) ELSE 'Censo de Población y Vivienda 2010, INEGI' END AS metadata,
  CASE WHEN variable = 'pobreza' THEN 'pobreza' END AS id, CASE WHEN variable = 'pobreza' THEN 'Pobreza total' END AS nombre, CASE WHEN variable = 'pobreza' THEN 'C' END AS fuente FROM a""")
def _(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))

    def level(key, width, name, variable):
        date = F.concat(F.year("o_orderdate").cast("string"), F.lit("-a")).alias("data_date")
        out = df.groupBy(pad_left(F.col(key).cast("string"), width).alias(name), date).agg(F.max("o_totalprice").alias("valor"), F.count(F.lit(1)).cast("double").alias("pob_tot"))
        return out.withColumns({"variable": F.lit(variable), "tipo": F.lit("porcentaje")})

    dic = t.orders.select(F.when(F.col("o_orderstatus") == "F", "pobreza").otherwise("x").alias("id"), F.when(F.col("o_orderstatus") == "F", "Pobreza total").otherwise("y").alias("nombre"), F.lit("C").alias("fuente"))
    out = S.poverty_semantic(level("c_nationkey", 2, "cve_ent", "pobreza"), level("c_custkey", 5, "cve_muni", "carencias"), dic)
    return out.withColumn("valor", F.round("valor", 4))


@query("tidy_municipal", """
WITH w AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS a, max(o_totalprice) AS b, min(o_totalprice) AS c FROM orders GROUP BY 1)
SELECT o_custkey, unnest(['pobreza', 'pobreza', 'gini']) AS variable, unnest(['nominal', 'porcentaje', '']) AS tipo, unnest([a, b, c]) AS valor FROM w""")
def _(t):
    wide = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("pobreza_num"), F.max("o_totalprice").alias("pobreza_porcentaje"), F.min("o_totalprice").alias("gini"))
    return S.tidy_municipal(wide, ["o_custkey"])
