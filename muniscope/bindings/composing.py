"""Composite indices and per-source cleaners."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..plans import indices as I
from ..plans import loads, registry
from ..plans import places as P
from ..plans.cleaners import CLEANERS, STATE_NAMES, imco_corrupcion_partidos, sequia
from ..session import shared_folder
from ..sources.layers import write_bucketed
from .core import query

_MUNI = "lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey AS VARCHAR), greatest(6, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0')"


def _muni():
    return F.concat(pad_left(F.col("c_nationkey").cast("string"), 2), pad_left(F.col("c_custkey").cast("string"), 6))


# --- food risk: component i is a rational function of the key, null on every 11+i-th key ---------------------
def _component(i: int) -> str:
    return f"CASE WHEN c_custkey % {11 + i} = 0 THEN NULL ELSE (1 + (c_custkey * {7 + i} + c_nationkey) % 97) / 100.0e0 END"


_COMP = {c: _component(i) for i, c in enumerate(I.FOOD_COMPONENTS)}


def _food_sql():
    filled = ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in _COMP)
    sql = f"SELECT cve_muni, {filled} FROM (SELECT {_MUNI} AS cve_muni, {', '.join(f'{e} AS {c}' for c, e in _COMP.items())} FROM customer)"
    for name, parts in I.FOOD_SUBINDICES.items():
        sql = f"SELECT *, pow({' * '.join(parts)}, 1.0e0 / {len(parts)}) AS {name} FROM ({sql})"
    sql = f"SELECT *, (temperaturas_i + inundaciones_i + sequia_i) / 3 AS estabilidad_natural_i FROM ({sql})"
    sql = f"SELECT *, 0.4e0 * violencia_i + 0.6e0 * estabilidad_natural_i AS estabilidad_i FROM ({sql})"
    return f"SELECT *, pow(disponibilidad_i * acceso_i * utilizacion_i * estabilidad_i, 0.25e0) AS riesgo_alimentario_i FROM ({sql})"


@query("food_risk", f"""
WITH f AS ({_food_sql()})
SELECT cve_muni, round(disponibilidad_i, 6) AS disponibilidad_i, round(acceso_i, 6) AS acceso_i, round(utilizacion_i, 6) AS utilizacion_i, round(estabilidad_i, 6) AS estabilidad_i, round(riesgo_alimentario_i, 6) AS riesgo_alimentario_i, substring(cve_muni, 1, 2) AS cve_ent, count(*) OVER (PARTITION BY substring(cve_muni, 1, 2)) AS num_muns FROM f""")
def _(t):
    comps = t.customer.select(_muni().alias("cve_muni"), *[F.expr(e).alias(c) for c, e in _COMP.items()])
    out = I.food_risk(comps)
    five = ["disponibilidad_i", "acceso_i", "utilizacion_i", "estabilidad_i", "riesgo_alimentario_i"]
    return out.select("cve_muni", *[F.round(c, 6).alias(c) for c in five], "cve_ent", "num_muns")


@query("food_risk_ranks", f"""
WITH f AS ({_food_sql()}), r AS (SELECT cve_muni, rank() OVER (ORDER BY riesgo_alimentario_i DESC) + (count(*) OVER (PARTITION BY riesgo_alimentario_i) - 1) / 2 AS riesgo_alimentario_rn FROM f)
SELECT count(*) AS n, sum(riesgo_alimentario_rn) AS suma, min(riesgo_alimentario_rn) >= 1 AS desde_uno FROM r""")
def _(t):
    comps = t.customer.select(_muni().alias("cve_muni"), *[F.expr(e).alias(c) for c, e in _COMP.items()])
    out = I.food_risk(comps)
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("riesgo_alimentario_rn").alias("suma"), (F.min("riesgo_alimentario_rn") >= 1).alias("desde_uno"))


# --- hazards --------------------------------------------------------------------------------------------------
_HAZ = ["gp_inundac", "gp_sequia2", "gp_sismico"]
_LEVELS = list(I.HAZARD_POINTS)


def _level(i):
    return "CASE (c_custkey * {k} + {i}) % 7 ".format(k=i + 2, i=i) + " ".join(f"WHEN {j} THEN '{lv}'" for j, lv in enumerate(_LEVELS)) + " END"


_POINTS = "CASE {c} " + " ".join(f"WHEN '{lv}' THEN {v}" for lv, v in I.HAZARD_POINTS.items()) + " END"
_HAZ_SQL = (
    f"WITH l AS (SELECT {_MUNI} AS cve_muni, CAST(1 + c_custkey % 50 AS DOUBLE) AS pob, {', '.join(f'{_level(i)} AS {h}' for i, h in enumerate(_HAZ))} FROM customer), "
    f"p AS (SELECT cve_muni, pob, {', '.join(f'CAST({_POINTS.format(c=h)} AS DOUBLE) AS {h}' for h in _HAZ)} FROM l), "
    f"z AS (SELECT cve_muni, pob, {', '.join(f'({h} - avg({h}) OVER ()) / stddev_samp({h}) OVER () AS {h}' for h in _HAZ)} FROM p), "
    f"n AS (SELECT cve_muni, pob, {', '.join(f'({h} - min({h}) OVER ()) / (max({h}) OVER () - min({h}) OVER ()) AS a_n_{h}_i' for h in _HAZ)} FROM z)"
)


def _levels(t):
    return t.customer.select(_muni().alias("cve_muni"), (1 + F.col("c_custkey") % 50).cast("double").alias("pob"), *[F.expr(_level(i)).alias(h) for i, h in enumerate(_HAZ)])


@query("natural_hazards", f"{_HAZ_SQL} SELECT cve_muni, {', '.join(f'round(a_n_{h}_i, 8) AS a_n_{h}_i' for h in _HAZ)}, round(({' + '.join(f'a_n_{h}_i' for h in _HAZ)}) / {len(_HAZ)}, 8) AS amenazas_naturales_i FROM n")
def _(t):
    out = I.natural_hazards(_levels(t), _HAZ)
    return out.select("cve_muni", *[F.round(c, 8).alias(c) for c in [*[f"a_n_{h}_i" for h in _HAZ], "amenazas_naturales_i"]])


@query("natural_hazards_by_state", f"""{_HAZ_SQL}, s AS (SELECT substring(cve_muni, 1, 2) AS cve_ent, {', '.join(f'sum(a_n_{h}_i * pob) AS a_n_{h}_i' for h in _HAZ)} FROM n GROUP BY 1)
SELECT cve_ent, {', '.join(f'round((a_n_{h}_i - min(a_n_{h}_i) OVER ()) / (max(a_n_{h}_i) OVER () - min(a_n_{h}_i) OVER ()), 7) AS a_n_{h}_i' for h in _HAZ)} FROM s""")
def _(t):
    out = I.natural_hazards_by_state(I.natural_hazards(_levels(t), _HAZ), _HAZ, "pob")
    return out.withColumns({f"a_n_{h}_i": F.round(f"a_n_{h}_i", 7) for h in _HAZ})


_DONOR_SQL = ", ".join(f"('{k}', '{v}')" for k, v in I.PRICE_DONORS.items())
_VOL = f"""y AS (SELECT cve_ent, year(o_orderdate) AS y, sum(o_totalprice) AS s FROM (SELECT *, lpad(CAST(o_custkey % 32 + 1 AS VARCHAR), greatest(2, CAST(length(CAST(o_custkey % 32 + 1 AS VARCHAR)) AS INTEGER)), '0') AS cve_ent FROM orders) WHERE cve_ent NOT IN ({', '.join(f"'{k}'" for k in I.PRICE_DONORS)}) GROUP BY 1, 2),
m AS (SELECT cve_ent, median(s) AS v FROM y GROUP BY 1), n AS (SELECT cve_ent, (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) AS v FROM m),
vol AS (SELECT cve_ent, v FROM n UNION ALL SELECT d.k, n.v FROM (VALUES {_DONOR_SQL}) AS d(k, donor) JOIN n ON n.cve_ent = d.donor)"""


def _volatility(t):
    prices = t.orders.select(pad_left((F.col("o_custkey") % 32 + 1).cast("string"), 2).alias("estado"), F.year("o_orderdate").alias("anio"), F.col("o_totalprice").alias("ipa_n"))
    return I.price_volatility(prices.where(~F.col("estado").isin(list(I.PRICE_DONORS))))


@query("price_volatility", f"WITH {_VOL} SELECT cve_ent, round(v, 8) AS a_h_volatilidad_i FROM vol")
def _(t):
    return _volatility(t).withColumn("a_h_volatilidad_i", F.round("a_h_volatilidad_i", 8))


@query("human_hazards", f"""
WITH {_VOL}, inf AS (SELECT DISTINCT lpad(CAST(n_nationkey + 1 AS VARCHAR), greatest(2, CAST(length(CAST(n_nationkey + 1 AS VARCHAR)) AS INTEGER)), '0') AS cve_ent, (1 + n_regionkey) / 10.0e0 AS p FROM nation), vi AS (SELECT c_custkey AS cve_muni, lpad(CAST(c_nationkey + 1 AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey + 1 AS VARCHAR)) AS INTEGER)), '0') AS cve_ent, (1 + c_custkey % 90) / 100.0e0 AS h FROM customer)
SELECT cve_muni, cve_ent, h AS amenazas_humana_violencia_i, round(v, 8) AS a_h_volatilidad_i, p AS a_h_e_inpc_i, round(pow(h * v * p, 1 / 3.0e0), 7) AS amenazas_humana_i FROM vi LEFT JOIN vol USING (cve_ent) LEFT JOIN inf USING (cve_ent)""")
def _(t):
    violence = t.customer.select(F.col("c_custkey").alias("cve_muni"), pad_left((F.col("c_nationkey") + 1).cast("string"), 2).alias("cve_ent"), ((1 + F.col("c_custkey") % 90) / 100).alias("amenazas_humana_violencia_i"))
    inflation = t.nation.select(pad_left((F.col("n_nationkey") + 1).cast("string"), 2).alias("cve_ent"), ((1 + F.col("n_regionkey")) / 10).alias("a_h_e_inpc_i"))
    out = I.human_hazards(violence, _volatility(t), inflation)
    return out.withColumns({"a_h_volatilidad_i": F.round("a_h_volatilidad_i", 8), "amenazas_humana_i": F.round("amenazas_humana_i", 7)})


# --- vulnerability -----------------------------------------------------------------------------------------------
_VI = I.VULNERABILITY_INPUTS
_VULN = (
    "WITH a AS (SELECT c_custkey AS cve_muni, c_acctbal AS irez_soc15, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 END AS gini_10 FROM customer), "
    "b AS (SELECT c_custkey + 3 AS cve_muni, CAST(c_nationkey AS DOUBLE) AS unprooted, c_acctbal / 7 AS ic_asalud, CAST(c_custkey % 17 AS DOUBLE) AS precio_maiz_2015 FROM customer), "
    "f AS (SELECT * FROM a FULL JOIN b USING (cve_muni)), "
    f"d AS (SELECT cve_muni, {', '.join(f'last_value({c} IGNORE NULLS) OVER (ORDER BY cve_muni ROWS UNBOUNDED PRECEDING) AS {c}' for c in _VI)} FROM f), "
    f"n AS (SELECT cve_muni, {', '.join(f'({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}' for c in _VI)} FROM d)"
)


def _avg2(a, b):
    return f"(coalesce({a}, 0) + coalesce({b}, 0)) / nullif(({a} IS NOT NULL)::INT + ({b} IS NOT NULL)::INT, 0)"


@query("vulnerability_index", f"""{_VULN}, s AS (SELECT *, {_avg2('irez_soc15', 'gini_10')} AS socioeconomica, {_avg2('ic_asalud', 'precio_maiz_2015')} AS o_vulnerable FROM n), g AS (SELECT *, {_avg2('unprooted', 'o_vulnerable')} AS vulnerable_groups FROM s)
SELECT cve_muni, {', '.join(f'round({c}, 7) AS {c}' for c in [*_VI, 'socioeconomica', 'o_vulnerable', 'vulnerable_groups'])}, round({_avg2('socioeconomica', 'vulnerable_groups')}, 7) AS vulnerable FROM g""")
def _(t):
    key = F.col("c_custkey").alias("cve_muni")
    a = t.customer.select(key, F.col("c_acctbal").alias("irez_soc15"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") * 2).alias("gini_10"))
    b = t.customer.select((F.col("c_custkey") + 3).alias("cve_muni"), F.col("c_nationkey").cast("double").alias("unprooted"), (F.col("c_acctbal") / 7).alias("ic_asalud"), (F.col("c_custkey") % 17).cast("double").alias("precio_maiz_2015"))
    out = I.vulnerability_index([a, b])
    return out.select("cve_muni", *[F.round(c, 7).alias(c) for c in out.columns if c != "cve_muni"])


@query("index_by_state", f"""
WITH m AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') AS cve_ent, avg(c_acctbal) AS inform, avg(c_custkey % 10) AS riesgo FROM customer GROUP BY 1)
SELECT cve_ent, round(inform, 6) AS inform, round(riesgo, 6) AS riesgo, row_number() OVER (ORDER BY inform DESC, cve_ent) AS ranking FROM m""")
def _(t):
    index = t.customer.select(_muni().alias("cve_muni"), F.col("c_acctbal").alias("inform"), (F.col("c_custkey") % 10).alias("riesgo"))
    out = I.index_by_state(index, "inform", ["inform", "riesgo"])
    return out.withColumns({c: F.round(c, 6) for c in ["inform", "riesgo"]})


@query("complexity", f"""
WITH w AS (SELECT lpad(CAST(o_custkey AS VARCHAR), greatest(5, CAST(length(CAST(o_custkey AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, avg(o_totalprice) FILTER (year(o_orderdate) = 1996) AS a, avg(o_totalprice) FILTER (year(o_orderdate) = 1997) AS b FROM orders GROUP BY 1)
SELECT cve_muni, round((a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()), 8) AS complejidad_1996, round((b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()), 8) AS complejidad_1997, substring(cve_muni, 1, 2) AS cve_ent FROM w""")
def _(t):
    products = t.orders.select(pad_left(F.col("o_custkey").cast("string"), 5).alias("cve_muni"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("pci"))
    out = I.complexity(products, [1996, 1997])
    return out.withColumns({c: F.round(c, 8) for c in ["complejidad_1996", "complejidad_1997"]})


_INFRA = """a AS (SELECT lpad(CAST(c_custkey AS VARCHAR), greatest(9, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS cve_locc, CAST(c_custkey % 5 AS BIGINT) AS tot_tiendas FROM customer), b AS (SELECT lpad(CAST(c_custkey + 5 AS VARCHAR), greatest(9, CAST(length(CAST(c_custkey + 5 AS VARCHAR)) AS INTEGER)), '0') AS cve_locc, CAST(c_custkey % 7 AS BIGINT) AS tot_comedores FROM customer),
l AS (SELECT *, substring(cve_locc, 1, 5) AS cve_muni FROM a FULL JOIN b USING (cve_locc))"""


@query("infrastructure", f"""WITH {_INFRA} SELECT cve_locc, cve_muni, tot_tiendas, tot_comedores FROM l
UNION ALL SELECT NULL, cve_muni, CAST(sum(tot_tiendas) AS BIGINT), CAST(sum(tot_comedores) AS BIGINT) FROM l GROUP BY cve_muni""")
def _(t):
    key = pad_left(F.col("c_custkey").cast("string"), 9).alias("cve_locc")
    a = t.customer.select(key, (F.col("c_custkey") % 5).alias("tot_tiendas"))
    b = t.customer.select(pad_left((F.col("c_custkey") + 5).cast("string"), 9).alias("cve_locc"), (F.col("c_custkey") % 7).alias("tot_comedores"))
    local, muni = I.infrastructure([a, b])
    return local.unionByName(muni, allowMissingColumns=True)


@query("price_index_by_state", """
WITH m AS (SELECT n_regionkey AS cve_ent, CAST(month(o_orderdate) AS INT) AS mes, avg(o_totalprice) AS inpc FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT cve_ent, mes, round(inpc, 4) AS inpc, round((inpc - min(inpc) OVER w) / nullif(max(inpc) OVER w - min(inpc) OVER w, 0), 6) AS inpc_norm FROM m WINDOW w AS (PARTITION BY mes)""")
def _(t):
    cities = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("ciudad"), F.month("o_orderdate").alias("mes"), F.col("o_totalprice").alias("valor"))
    states = t.nation.select(F.col("n_nationkey").alias("ciudad"), F.col("n_regionkey").alias("cve_ent"))
    out = I.price_index_by_state(cities, states, "ciudad", "valor", "mes")
    return out.withColumns({"inpc": F.round("inpc", 4), "inpc_norm": F.round("inpc_norm", 6)})


@query("physicians_rate", """
WITH r AS (SELECT c.c_custkey AS cve_muni, c.c_nationkey AS medicos, CAST(1000 + p.c_custkey % 300 AS DOUBLE) AS pob FROM customer c LEFT JOIN customer p ON c.c_custkey = p.c_custkey + 4), x AS (SELECT cve_muni, medicos, pob, coalesce(medicos * 100000.0e0 / pob, 0) AS t FROM r)
SELECT cve_muni, medicos, pob, round(t, 6) AS personal_medico_100_h, round((t - min(t) OVER ()) / (max(t) OVER () - min(t) OVER ()), 8) AS personal_medico_100_h_norm FROM x""")
def _(t):
    medics = t.customer.select(F.col("c_custkey").alias("cve_muni"), F.col("c_nationkey").alias("medicos"))
    pop = t.customer.select((F.col("c_custkey") + 4).alias("cve_muni"), (1000 + F.col("c_custkey") % 300).cast("double").alias("pob"))
    out = I.physicians_rate(medics, pop, "medicos", "pob")
    return out.withColumns({"personal_medico_100_h": F.round("personal_medico_100_h", 6), "personal_medico_100_h_norm": F.round("personal_medico_100_h_norm", 8)})


_MATRIX = """
WITH a AS (SELECT o_custkey AS cve_muni, max(o_totalprice) AS ipc_dif FROM orders GROUP BY 1), v AS (SELECT c_custkey + 7 AS cve_muni, c_acctbal AS pobreza_porcentaje FROM customer), k AS (SELECT s_suppkey AS cve_muni, s_acctbal AS cobertura_dren FROM supplier)
SELECT cve_muni, ipc_dif, pobreza_porcentaje, cobertura_dren FROM a LEFT JOIN v USING (cve_muni) LEFT JOIN k USING (cve_muni)"""


def _matrix_inputs(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("cve_muni")).agg(F.max("o_totalprice").alias("ipc_dif"))
    v = t.customer.select((F.col("c_custkey") + 7).alias("cve_muni"), F.col("c_acctbal").alias("pobreza_porcentaje"))
    k = t.supplier.select(F.col("s_suppkey").alias("cve_muni"), F.col("s_acctbal").alias("cobertura_dren"))
    return {"precios": a, "pobreza": v, "drenaje": k}


@query("assemble_matrix", _MATRIX)
def _(t):
    return P.assemble_matrix(*[[x] for x in _matrix_inputs(t).values()])


@query("assemble_matrix_stored", _MATRIX)
def _(t):
    """The same over layer tables that are laid out for the key."""
    spark = t.orders.sparkSession
    root = f"{shared_folder(spark)}/matrix-{uuid4().hex}"
    stored = [write_bucketed(df, root, "features", f"{name}_{uuid4().hex}", ["cve_muni"], 8) for name, df in _matrix_inputs(t).items()]
    return P.assemble_matrix(*[[x] for x in stored])


# --- per-source cleaners -------------------------------------------------------------------------------------------
def clean_query(name: str, source: str, columns: dict[str, str], sql: str, declared: dict[str, str] | None = None):
    """Cleaner ``name`` over raw columns derived from a table."""
    @query(f"clean_{name}", sql)
    def run(t):
        raw = getattr(t, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        return registry.clean(name, raw, declared=declared)


_S = "s_suppkey"
clean_query("cfe", "orders", {"tipo": "CASE WHEN o_orderstatus = 'F' THEN 'Ventas' ELSE 'Usuarios' END", "cveinegi": "o_custkey % 32", "cvemun": "o_custkey % 100", "num": "CAST(o_totalprice AS STRING)"},
    "SELECT lpad(CAST(o_custkey % 32 AS VARCHAR), greatest(2, CAST(length(CAST(o_custkey % 32 AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(o_custkey % 100 AS VARCHAR), greatest(3, CAST(length(CAST(o_custkey % 100 AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, sum(o_totalprice) AS n_usuarios FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
clean_query("cngmd_drenaje", "customer", {"aps_folio": "c_custkey", "sd_dren_cab": "c_nationkey", "sd_dren_resto": "CAST(c_custkey % 9 AS STRING)"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, (c_nationkey + c_custkey % 9) / 2 / 100 AS cobertura_dren FROM customer")
clean_query("cngmd_participacion_ciudadana", "customer", {"ubic_geo": "c_nationkey", "nd_nsnn1": "CAST(c_custkey % 3 AS STRING)"},
    "SELECT CAST(c_nationkey AS VARCHAR) AS cve_muni, CAST(sum(f) AS INT) AS nd_nsnn1 FROM (SELECT DISTINCT c_nationkey, CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS f FROM customer) GROUP BY 1")
clean_query("cngmd_predial", "customer", {"ubic_geo": "CAST(c_custkey AS STRING)", "aut_cobr": "CASE WHEN c_custkey % 4 = 0 THEN 'NSS' ELSE CAST(c_nationkey AS STRING) END", "totalpo1": "CASE WHEN c_custkey % 5 = 0 THEN '\"NA\"' ELSE CAST(c_acctbal AS STRING) END"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS aut_cobr, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 100 END AS totalpo1 FROM customer")
clean_query("cngmd_proteccion_civil", "customer", {"ubic_geo": "c_custkey", "nd_spnn1": "CAST(c_nationkey AS STRING)", "nd_nsnn4": "concat(CAST(c_nationkey AS STRING), '.0')"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, c_nationkey AS nd_spnn1, c_nationkey AS nd_nsnn4 FROM customer")
clean_query("cngmd_recoleccion_basura", "customer", {"rsu_folio": "c_custkey", "basura_porcent_cab": "CAST(c_nationkey AS STRING)"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, c_nationkey / 100 AS basura_porcent_cab FROM customer")
clean_query("cngmd_transparencia", "lineitem", {"ubic_geo": "l_suppkey", "mec_tran": "l_linenumber", "inf_publ": "l_partkey % 50"},
    "SELECT cve_muni, mec_tran, inf_publ FROM (SELECT CAST(l_suppkey AS VARCHAR) AS cve_muni, sum(CASE WHEN m IN (1, 3, 6) THEN 1 / 3.0e0 ELSE 0 END) AS mec_tran FROM (SELECT DISTINCT l_suppkey, l_linenumber AS m FROM lineitem) GROUP BY 1) LEFT JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS cve_muni, sum(CASE WHEN m IN (5, 22, 23, 42, 44) THEN 0.2e0 ELSE 0 END) AS inf_publ FROM (SELECT DISTINCT l_suppkey, l_partkey % 50 AS m FROM lineitem) GROUP BY 1) USING (cve_muni)")
clean_query("cenapred", "customer", {"cve_muni": "c_custkey", "data_date": "'2018-a'", "gp_nevadas": "c_mktsegment", "otra": "1"},
    "SELECT lpad(CAST(c_custkey AS VARCHAR), greatest(5, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, '2018-a' AS data_date, c_mktsegment AS gp_nevadas FROM customer")
clean_query("coneval_municipios", "customer", {"cve_muni": "c_custkey", "data_date": "'2015-a'", "pob_tot": "c_acctbal"},
    "SELECT c_custkey AS cve_muni, '2015-a' AS data_date, c_acctbal AS pob_tot, '2015-a' AS fecha FROM customer")
clean_query("coneval_estados", "lineitem", {"folioviv": "l_orderkey", "data_date": "'2014-a'", "ictpc": "l_extendedprice / 7", "profun": "l_tax"},
    "SELECT l_orderkey AS folioviv, '2014-a' AS data_date, round(l_extendedprice / 7, 2) AS ictpc, round(l_tax, 2) AS profun, '2014-a' AS fecha FROM lineitem")
clean_query("complejidad_municipios", "customer", {"cve_muni": "c_custkey", "nom_muni": "c_name", "complejidad_2010": "CAST(c_acctbal AS STRING)"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, c_name AS nom_muni, c_acctbal AS complejidad_2010 FROM customer")
clean_query("cuaps_componentes", "part", {"cuaps_folio": "p_partkey", "nom_prog": "p_name", "tiene_componentes": "1 + p_partkey % 2", "id_componente": "p_size % 3", "tipo_pob_apo": "CAST(p_size % 8 AS INT)"},
    "SELECT p_partkey AS cuaps_folio, p_name AS nom_prog, CASE WHEN p_partkey % 2 = 1 THEN '0' ELSE '1' END AS tiene_componentes, CASE WHEN p_size % 3 = 0 THEN '1' ELSE CAST(p_size % 3 AS VARCHAR) END AS id_componente, list_extract(['Personas', 'Hogar', 'Vivienda', 'Actor social', 'Área de atención social', 'Otro'], p_size % 8) AS tipo_pob_apo_txt FROM part WHERE p_size % 8 BETWEEN 1 AND 6")
clean_query("cuenta_publica_anual", "part", {"id_modalidad": "substring(p_type, 1, 1)", "id_pp": "p_size"}, "SELECT substring(p_type, 1, 1) AS id_modalidad, p_size AS id_pp, substring(p_type, 1, 1) || lpad(CAST(p_size AS VARCHAR), greatest(3, CAST(length(CAST(p_size AS VARCHAR)) AS INTEGER)), '0') AS cve_programa FROM part")
clean_query("cuenta_publica_trimestral", "part", {"id_modalidad": "substring(p_brand, 1, 1)", "id_pp": "p_size"}, "SELECT substring(p_brand, 1, 1) AS id_modalidad, p_size AS id_pp, substring(p_brand, 1, 1) || lpad(CAST(p_size AS VARCHAR), greatest(3, CAST(length(CAST(p_size AS VARCHAR)) AS INTEGER)), '0') AS cve_programa FROM part")
_REG = {"llave_hogar_h": "CAST(l_orderkey AS STRING)", "c_integrante": "CAST(l_linenumber AS STRING)", "fch_creacion": "concat('01/02/', CAST(2013 + l_linenumber AS STRING))", "edad": "CAST(l_quantity AS STRING)", "padre": "'x'"}
clean_query("cuis_historico_integrante", "lineitem", _REG,
    "SELECT CAST(l_orderkey AS VARCHAR) AS llave_hogar_h, CAST(l_linenumber AS VARCHAR) AS c_integrante, '01/02/' || CAST(2013 + l_linenumber AS VARCHAR) AS fch_creacion, CAST(l_quantity AS INT) AS edad, CAST(NULL AS INT) AS padre, CAST(l_orderkey AS VARCHAR) AS hogar_id, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS person_id, CAST(2013 + l_linenumber AS INT) AS anio FROM lineitem")
clean_query("cuis_historico_se_integrante", "lineitem", {"llave_hogar_h": "CAST(l_orderkey AS STRING)", "c_integrante": "CAST(l_linenumber AS STRING)", "monto": "CAST(l_tax AS STRING)", "jubilado": "CAST(l_linenumber AS STRING)", "nota": "l_returnflag"},
    "SELECT CAST(l_orderkey AS VARCHAR) AS llave_hogar_h, CAST(l_linenumber AS VARCHAR) AS c_integrante, l_tax AS monto, l_linenumber AS jubilado, l_returnflag AS nota, CAST(l_orderkey AS VARCHAR) AS hogar_id, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS person_id FROM lineitem")
clean_query("cuis_historico_se_vivienda", "orders", {"llave_hogar_h": "CAST(o_orderkey AS STRING)", "seg_alim_1": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '1' END", "gas_alim": "CAST(o_totalprice AS STRING)", "cuart": "CAST(o_custkey AS STRING)", "nota": "o_orderpriority"},
    "SELECT CAST(o_orderkey AS VARCHAR) AS llave_hogar_h, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS INT) AS seg_alim_1, o_totalprice AS gas_alim, CAST(o_custkey AS INT) AS cuart, o_orderpriority AS nota, CAST(o_orderkey AS VARCHAR) AS hogar_id FROM orders")
clean_query("cuis_historico_vivienda", "orders", {"llave_hogar_h": "CAST(o_orderkey AS STRING)", "fch_creacion": "date_format(o_orderdate, 'dd/MM/yyyy')", "tot_per": "concat(CAST(o_custkey AS STRING), ' ')"},
    "SELECT CAST(o_orderkey AS VARCHAR) AS llave_hogar_h, strftime(o_orderdate, '%d/%m/%Y') AS fch_creacion, CAST(o_custkey AS INT) AS tot_per, CAST(o_orderkey AS VARCHAR) AS hogar_id, CAST(year(o_orderdate) AS INT) AS anio FROM orders")
clean_query("defunciones_fetales", "customer", {"ent_ocurr": "c_nationkey", "mun_ocurr": "c_custkey % 900", "causa_def": "c_mktsegment"}, "SELECT lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 900 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 900 AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, c_mktsegment AS causa_def FROM customer")
clean_query("defunciones_generales", "customer", {"ent_ocurr": "c_nationkey", "mun_ocurr": "c_custkey % 900", "edad": "c_custkey"}, "SELECT lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 900 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 900 AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, CAST(c_custkey AS VARCHAR) AS edad FROM customer")
clean_query("encaseh_familias", "orders", {"folio": "CAST(o_orderkey AS STRING)", "folio_enca": "'e'", "familia_id": "concat(CAST(o_custkey AS STRING), '.0')", "programa": "concat(CAST(o_custkey AS STRING), '.0')", "coord_x": "CAST(o_totalprice AS STRING)", "nota": "o_orderpriority", "data_date": "'2012-a'"},
    "SELECT CAST(o_orderkey AS VARCHAR) AS folio, 'e' AS folio_enca, CAST(o_custkey AS VARCHAR) AS familia_id, CAST(o_custkey AS INT) AS programa, o_totalprice AS coord_x, o_orderpriority AS nota, '2012-a' AS data_date, CAST(o_orderkey AS VARCHAR) || '-e-' || CAST(o_custkey AS VARCHAR) AS hogar_id, '2012' AS fecha_creacion FROM orders", declared={"programa": "int", "folio": "int"})
_HOMEKEY = {"folioviv": "l_orderkey", "foliohog": "l_linenumber % 3", "data_date": "'2016-a'"}
_HK = "l_orderkey AS folioviv, CAST(l_linenumber % 3 AS INT) AS foliohog, '2016-a' AS data_date"
_HID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 3 AS VARCHAR) AS hogar_id, '2016' AS fecha_creacion"
_PID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 3 AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS person_id"
clean_query("enigh_concentrados", "lineitem", {**_HOMEKEY, "ing_cor": "l_extendedprice"}, f"SELECT {_HK}, l_extendedprice AS ing_cor, {_HID} FROM lineitem")
clean_query("enigh_hogares", "lineitem", {**_HOMEKEY, "acc_alim1": "CASE WHEN l_linenumber = 2 THEN '&' ELSE '1' END", "num_refri": "CAST(l_linenumber AS STRING)", "anio_auto": "l_linenumber"},
    f"SELECT {_HK}, CAST(CASE WHEN l_linenumber = 2 THEN 2 ELSE 1 END AS INT) AS acc_alim1, l_linenumber AS num_refri, CAST(l_linenumber AS VARCHAR) AS anio_auto, {_HID} FROM lineitem")
clean_query("enigh_ingresos", "lineitem", {**_HOMEKEY, "numren": "l_linenumber", "ing_1": "CAST(l_extendedprice AS STRING)", "ing_tri": "CAST(l_extendedprice AS STRING)", "clave": "CASE WHEN l_linenumber = 1 THEN '&' ELSE 'P001' END"},
    f"SELECT {_HK}, l_linenumber AS numren, CAST(round_even(l_extendedprice, 0) AS INT) AS ing_1, l_extendedprice AS ing_tri, CASE WHEN l_linenumber <> 1 THEN 'P001' END AS clave, {_HID}, {_PID} FROM lineitem")
clean_query("enigh_poblacion", "lineitem", {**_HOMEKEY, "numren": "l_linenumber", "atemed": "CASE WHEN l_linenumber = 3 THEN '  ' ELSE ' 1 ' END", "inst_1": "CASE WHEN l_linenumber = 4 THEN '&' ELSE '5' END", "residencia": "CASE WHEN l_linenumber = 5 THEN ' ' ELSE ' r ' END"},
    f"SELECT {_HK}, l_linenumber AS numren, CAST(CASE WHEN l_linenumber = 3 THEN 2 ELSE 1 END AS INT) AS atemed, CAST(CASE WHEN l_linenumber = 4 THEN 0 ELSE 5 END AS INT) AS inst_1, CASE WHEN l_linenumber <> 5 THEN 'r' END AS residencia, {_HID}, {_PID}, CAST(2016 AS INT) AS anio FROM lineitem")
clean_query("enigh_trabajos", "lineitem", {**_HOMEKEY, "numren": "l_linenumber", "pres_7": "CASE WHEN l_linenumber = 3 THEN '' ELSE ' 7' END", "htrab": "CAST(l_quantity AS STRING)"},
    f"SELECT {_HK}, l_linenumber AS numren, CAST(CASE WHEN l_linenumber = 3 THEN 2 ELSE 7 END AS INT) AS pres_7, CAST(l_quantity AS INT) AS htrab, {_HID}, {_PID} FROM lineitem")
clean_query("enigh_viviendas", "orders", {"folioviv": "o_orderkey", "data_date": "'2016-a'", "mat_pisos": "CASE WHEN o_custkey % 3 = 0 THEN '&' ELSE CAST(o_custkey AS STRING) END", "ageb": "o_custkey"},
    "SELECT o_orderkey AS folioviv, '2016-a' AS data_date, CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey AS INT) END AS mat_pisos, CAST(o_custkey AS VARCHAR) AS ageb, '2016' AS fecha_creacion FROM orders")
clean_query("imco_corrupcion_estatal", "supplier", {"entidad_federativa": "s_name", "poblacion_18_mas_2011": "CASE WHEN s_suppkey % 3 = 0 THEN 'NA' ELSE CAST(s_suppkey AS STRING) END", "nunca_relativo_2011": "CASE WHEN s_suppkey % 4 = 0 THEN '0.0*' ELSE '1.5' END", "data_date": "'x'"},
    "SELECT s_name AS nom_ent, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey AS INT) END AS poblacion_18_mas_2011, CASE WHEN s_suppkey % 4 = 0 THEN 0.0e0 ELSE 1.5e0 END AS nunca_relativo_2011 FROM supplier")
clean_query("imco_equidad_congreso", "supplier", {"entidad_federativa": "s_name", "diputadas_2015": "CAST(s_suppkey AS STRING)", "participacion_mujeres_julio_2014": "CAST(s_nationkey AS STRING)", "data_date": "'x'"},
    "SELECT s_name AS nom_ent, CAST(s_suppkey AS INT) AS diputadas_2015, s_nationkey / 100 AS participacion_mujeres_julio_2014 FROM supplier")
clean_query("imco_ice", "supplier", {"clavedeentidad": "s_nationkey", "anio": "'2016'", "general": "CAST(s_acctbal AS STRING)", "entidad": "s_name"},
    "SELECT s_nationkey AS clavedeentidad, CAST(2016 AS INT) AS anio, s_acctbal AS general, s_name AS entidad, lpad(CAST(s_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(s_nationkey AS VARCHAR)) AS INTEGER)), '0') AS cve_ent FROM supplier")
clean_query("imco_info_publica", "supplier", {"entidad": "s_nationkey", "acc_info_est": "CAST(s_nationkey AS STRING)", "data_date": "'x'"}, "SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS cve_ent, s_nationkey AS acc_info_est FROM supplier")
clean_query("imco_matrimonio_igualitario", "supplier", {"estado": "s_name", "legislacion_reconoce_matrimonio_igualitario": "CAST(s_suppkey % 2 AS STRING)", "link": "1"}, "SELECT s_name AS nom_ent, CAST(s_suppkey % 2 AS INT) AS legislacion_reconoce_matrimonio_igualitario, '1' AS link FROM supplier")
clean_query("imco_participacion_ciudadana", "supplier", {"entidad": "CAST(s_nationkey AS STRING)", "gobernador": "CASE WHEN s_nationkey % 2 = 0 THEN 'NA' ELSE '1.5' END", "loaded_at": "1"}, "SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS nom_ent, CASE WHEN s_nationkey % 2 <> 0 THEN 1.5e0 END AS gobernador FROM supplier")
clean_query("imco_periodistas", "supplier", {"entidad_federativa": "s_name", "agresiones_a_periodistas_2009": "concat(CAST(s_suppkey AS STRING), ' ')"}, "SELECT s_name AS nom_ent, CAST(s_suppkey AS INT) AS agresiones_a_periodistas_2009 FROM supplier")
clean_query("indicadores_financieros_municipios", "customer", {"cve_muni": "c_custkey", "anio": "'2014'", "autonomia_financiera": "CAST(c_acctbal AS STRING)", "faism_per_capita": "CAST(c_nationkey AS STRING)"},
    "SELECT CAST(c_custkey AS VARCHAR) AS cve_muni, CAST(2014 AS INT) AS anio, c_acctbal AS autonomia_financiera, CAST(c_nationkey AS DOUBLE) AS faism_per_capita FROM customer")
clean_query("inegi_jueces", "nation", {"entidadfederativa": "CASE n_nationkey WHEN 1 THEN 'Querétaro' WHEN 2 THEN 'Ciudad de México' ELSE n_name END", "num_jueces": "CAST(n_regionkey AS STRING)", "anio": "2016"},
    "SELECT CASE n_nationkey WHEN 1 THEN 'Querétaro de Arteaga' WHEN 2 THEN 'Distrito Federal' ELSE n_name END AS nom_ent, CAST(n_regionkey AS DOUBLE) AS num_jueces, CAST(2016 AS INT) AS anio FROM nation")
clean_query("inegi_agentes_fiscales", "nation", {"entidad_federativa": "CASE n_nationkey WHEN 1 THEN 'Querétaro' ELSE n_name END", "indicador": "'i'", "num_agentes_fiscales": "CAST(n_regionkey AS STRING)", "anio": "'2016'"},
    "SELECT CASE n_nationkey WHEN 1 THEN 'Querétaro de Arteaga' ELSE n_name END AS nom_ent, 'i' AS indicador, CAST(n_regionkey AS DOUBLE) AS num_agentes_fiscales, CAST(2016 AS INT) AS anio FROM nation")
clean_query("ipc_ciudades", "customer", {"nom_cd": "concat('  ', c_name, ' ')", "value": "c_acctbal"}, "SELECT c_name AS nom_cd, c_acctbal AS value FROM customer")
clean_query("recursos_hospitales", "customer", {"claveentidad": "CAST(c_nationkey AS STRING)", "clavemunicipio": "CAST(c_custkey % 300 AS STRING)", "e14": "concat(CAST(c_custkey AS STRING), '.0')", "clues": "c_name"},
    "SELECT c_nationkey AS claveentidad, CAST(c_custkey % 300 AS INT) AS clavemunicipio, CAST(c_custkey AS INT) AS e14, c_name AS clues, lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 300 AS VARCHAR), greatest(3, CAST(length(CAST(c_custkey % 300 AS VARCHAR)) AS INTEGER)), '0') AS cve_muni FROM customer")
clean_query("shcp_ici_estados", "supplier", {"id_entidad_federativa": "s_nationkey", "ciclo": "'2016'", "valor_ici": "CAST(s_acctbal AS STRING)"},
    "SELECT CAST(s_nationkey AS VARCHAR) AS id_entidad_federativa, CAST(2016 AS INT) AS ciclo, s_acctbal AS valor_ici, lpad(CAST(s_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(s_nationkey AS VARCHAR)) AS INTEGER)), '0') AS cve_ent FROM supplier")
_BOX = "concat('POLYGON((', CAST({k} % 20 AS STRING), ' ', CAST({k} % 15 AS STRING), ', ', CAST({k} % 20 + 2 AS STRING), ' ', CAST({k} % 15 AS STRING), ', ', CAST({k} % 20 + 2 AS STRING), ' ', CAST({k} % 15 + 2 AS STRING), ', ', CAST({k} % 20 AS STRING), ' ', CAST({k} % 15 + 2 AS STRING), ', ', CAST({k} % 20 AS STRING), ' ', CAST({k} % 15 AS STRING), '))')"
clean_query("geoms_estados", "nation", {"cve_ent": "lpad(CAST(n_nationkey AS STRING), greatest(2, CAST(length(CAST(n_nationkey AS STRING)) AS INTEGER)), '0')", "nom_ent": "n_name", "wkt": _BOX.format(k="n_nationkey")},
    f"SELECT lpad(CAST(n_nationkey AS STRING), greatest(2, CAST(length(CAST(n_nationkey AS STRING)) AS INTEGER)), '0') AS cve_ent, n_name AS nom_ent, {_BOX.format(k='n_nationkey')} AS wkt, n_nationkey % 20 + 1.0e0 AS longitud, n_nationkey % 15 + 1.0e0 AS latitud FROM nation")
clean_query("geoms_municipios", "customer", {"cve_ent": "c_nationkey", "cve_mun": "c_custkey % 500", "wkt": _BOX.format(k="c_custkey")},
    f"SELECT lpad(CAST(c_nationkey AS STRING), greatest(2, CAST(length(CAST(c_nationkey AS STRING)) AS INTEGER)), '0') || lpad(CAST(c_custkey % 500 AS STRING), greatest(3, CAST(length(CAST(c_custkey % 500 AS STRING)) AS INTEGER)), '0') AS cve_muni, {_BOX.format(k='c_custkey')} AS wkt, c_custkey % 20 + 1.0e0 AS longitud, c_custkey % 15 + 1.0e0 AS latitud, 'POINT(' || CAST(c_custkey % 20 + 1 AS STRING) || '.0 ' || CAST(c_custkey % 15 + 1 AS STRING) || '.0)' AS centroide FROM customer")


@query("clean_sequia", """
WITH b AS (SELECT o_orderkey AS cve_muni, o_orderpriority AS declaratoria, strftime(o_orderdate, '%Y-%m') AS d FROM orders)
SELECT cve_muni, declaratoria, 'primera' AS cual FROM b WHERE d = (SELECT min(d) FROM b) UNION ALL SELECT cve_muni, declaratoria, 'ultima' FROM b WHERE d = (SELECT max(d) FROM b)""")
def _(t):
    empty = [F.lit(None).cast("string").alias(c) for c in ["org_cuenca", "clv_oc", "con_cuenca", "cve_conc", "fecha"]]
    raw = t.orders.select(F.col("o_orderkey").alias("cve_muni"), *empty, F.col("o_orderpriority").alias("declaratoria"), F.date_format("o_orderdate", "yyyy-MM").alias("data_date"))
    first = sequia(raw).select("cve_muni", "declaratoria", F.lit("primera").alias("cual"))
    return first.unionByName(sequia(raw, "latest").select("cve_muni", "declaratoria", F.lit("ultima").alias("cual")))


@query("clean_imco_corrupcion_partidos", """
SELECT list_extract([{}], CAST(s_suppkey % 32 + 1 AS INT)) AS nom_ent, CAST(s_suppkey AS INT) AS pan_2006, s_nationkey / 100 AS participacion_2012, CAST(s_suppkey % 32 + 1 AS INT) AS orden FROM supplier""".format(", ".join(f"'{n}'" for n in STATE_NAMES)))
def _(t):
    raw = t.supplier.select(F.lit("?").alias("entidadfederativa"), F.col("s_suppkey").cast("string").alias("pan_2006"), F.concat(F.col("s_nationkey").cast("string"), F.lit("%")).alias("participacion_2012"), (F.col("s_suppkey") % 32 + 1).cast("int").alias("orden"))
    return imco_corrupcion_partidos(raw, "orden")


# --- preparers ---------------------------------------------------------------------------------------------------------
@query("prepare_delitos_comun", """
SELECT lpad(CAST(c_nationkey AS VARCHAR), greatest(2, CAST(length(CAST(c_nationkey AS VARCHAR)) AS INTEGER)), '0') AS clave_ent, lpad(CAST(c_custkey AS VARCHAR), greatest(5, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS cve_municipio, m AS mes, CASE WHEN m = 'Enero' THEN c_acctbal ELSE c_acctbal * 2 END AS incidencia_delictiva FROM customer, (SELECT unnest(['Enero', 'Febrero']) AS m)""")
def _(t):
    raw = t.customer.select(F.col("c_nationkey").alias("Clave_Ent"), F.col("c_custkey").alias("Cve. Municipio"), F.col("c_acctbal").alias("Enero"), (F.col("c_acctbal") * 2).alias("Febrero"))
    return registry.prepare("delitos_comun", raw).toDF("clave_ent", "cve_municipio", "mes", "incidencia_delictiva")


@query("prepare_grain_prices", """
SELECT event_id, last_value(p IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS producto, CAST(s AS INT) AS semana, CASE WHEN (event_id + s) % 3 <> 0 THEN value END AS precio
FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type END AS p, value FROM events), (SELECT unnest([1, 2]) AS s)""")
def _(t):
    def week(i):
        return F.when((F.col("event_id") + i) % 3 == 0, "--").otherwise(F.col("value").cast("string")).alias(f"sem_{i}")

    raw = t.events.select("event_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise("").alias("producto"), week(1), week(2), F.lit("0").alias("prom_mes"))
    return loads.grain_prices(raw, "event_id")


@query("prepare_evaluaciones", """
SELECT s_suppkey, a AS "ACTIVIDAD", CASE a WHEN '1' THEN s_name ELSE 'x' END AS "EDO_ACTIVIDAD", '{"1T":"' || s_name || '","2P":null}' AS "INFORMES" FROM supplier, (SELECT unnest(['1', '2']) AS a)""")
def _(t):
    raw = t.supplier.select("s_suppkey", F.col("s_name").alias("ACTIVIDAD_1"), F.lit("x").alias("ACTIVIDAD_2"), F.col("s_name").alias("INFORME 1 EN TIEMPO"), F.lit(None).cast("string").alias("INFORME 2 PRESENTADO"))
    return registry.prepare("evaluaciones", raw)


assert CLEANERS
