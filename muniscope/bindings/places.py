"""Spatial operators and results per place."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..functions.geography import EARTH_RADIUS_KM
from ..operators import aggregates as A
from ..operators import spatial as G
from ..plans import beneficiaries as B
from ..plans import places as P
from ..plans.cleaners import CLEANERS
from ..session import shared_folder
from ..streaming.partials import merged, refresh_part, write_part
from .core import query, shape_sql
from .projections import _LEGAL


def distance(a, b):
    return (
        f"2 * {EARTH_RADIUS_KM}e0 * asin(least(1.0e0, sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + "
        f"cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2))))"
    )


_IDW = "CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(v) FILTER (d = 0) ELSE sum(v / nullif(d, 0)) / sum(1 / nullif(d, 0)) END"


@query("idw", f"""
WITH a AS ({shape_sql('customer_place')}), b AS ({shape_sql('supplier_place')})
SELECT c_custkey, round({_IDW}, 6) AS saldo FROM (SELECT c_custkey, {distance('a', 'b')} AS d, b.value AS v FROM a CROSS JOIN b WHERE b.value IS NOT NULL) GROUP BY 1""")
def _(t):
    sources = t.shape("supplier_place").withColumnRenamed("value", "saldo")
    out = G.idw(t.shape("customer_place"), sources, "saldo", "c_custkey", "s_suppkey", block=16)
    return out.withColumn("saldo", F.round("saldo", 6))


@query("idw_nearest", f"""
WITH a AS ({shape_sql('customer_place')}), b AS ({shape_sql('supplier_place')}),
n AS (SELECT c_custkey, v, d, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS rn FROM (SELECT c_custkey, b.s_suppkey, {distance('a', 'b')} AS d, b.value AS v FROM a CROSS JOIN b WHERE b.value IS NOT NULL))
SELECT c_custkey, round({_IDW}, 6) AS saldo FROM n WHERE rn <= 3 GROUP BY 1""")
def _(t):
    sources = t.shape("supplier_place").withColumnRenamed("value", "saldo")
    out = G.idw(t.shape("customer_place"), sources, "saldo", "c_custkey", "s_suppkey", k=3, block=16)
    return out.withColumn("saldo", F.round("saldo", 6))


@query("spatial_impute", f"""
WITH a AS ({shape_sql('supplier_place')}),
g AS (SELECT s, {_IDW} AS v FROM (SELECT a.s_suppkey AS s, {distance('a', 'b')} AS d, b.value AS v FROM a JOIN a AS b ON a.value IS NULL AND b.value IS NOT NULL) GROUP BY 1)
SELECT s_suppkey, round(coalesce(value, v), 6) AS value FROM a LEFT JOIN g ON s_suppkey = s""")
def _(t):
    out = G.spatial_impute(t.shape("supplier_place"), "s_suppkey", "value")
    return out.select("s_suppkey", F.round("value", 6).alias("value"))


@query("classify_points", """
SELECT 'georreferencia' AS nivel, CAST(c_nationkey AS VARCHAR) AS clave, c_custkey AS element_id, CASE WHEN c_custkey % 10 = 1 THEN 'Servicios Educativos' ELSE 'Servicios de Salud' END AS type, c_name, CAST(c_custkey AS DOUBLE) AS lat, c_acctbal AS long
FROM customer WHERE c_custkey % 10 IN (1, 2)""")
def _(t):
    df = t.customer.select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("clave"), F.concat(F.lit("6"), (F.col("c_custkey") % 10).cast("string"), F.lit("11")).alias("scian"), F.col("c_custkey").cast("double").alias("y"), F.col("c_acctbal").alias("x")
    )
    return G.classify_points(df, "scian", G.SERVICE_CLASSES, "clave", "c_custkey", ["c_name"], "y", "x")


@query("variogram_bins", f"""
WITH p AS (SELECT s_suppkey, s_nationkey, lat, lon, coalesce(value, 100.0) AS v FROM ({shape_sql('supplier_place')})),
q AS (SELECT {distance('a', 'b')} AS d, a.v - b.v AS z FROM p AS a JOIN p AS b ON a.s_suppkey < b.s_suppkey)
SELECT CAST(floor(d / 100) AS BIGINT) AS bin, CAST(count(*) AS DOUBLE) AS pairs, round(avg(z * z) / 2, 2) AS gamma FROM q WHERE d < 500 GROUP BY 1""")
def _(t):
    df = t.shape("supplier_place").withColumn("v", F.coalesce("value", F.lit(100.0)))
    return G.variogram_bins(df, "v", 100, 500, block=16).select("bin", F.col("pairs").cast("double").alias("pairs"), F.round("gamma", 2).alias("gamma"))


# --- crime ---------------------------------------------------------------------------------------------
_KINDS = {"error": "danio_prop", "click": "secuestro", "view": "feminicidio", "signup": "violencia_familiar", "purchase": "robo_vehiculos"}


_RATES = f"""
WITH c AS ({shape_sql('crime')}), p AS (SELECT lpad(CAST(c_custkey AS VARCHAR), greatest(5, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, 100.0e0 + c_nationkey AS poblacion FROM customer),
w AS (SELECT anio, mes, cve_muni, {', '.join(f"sum(incidencia_delictiva) FILTER (subtipodedelito = '{k}') AS {n}" for k, n in _KINDS.items())} FROM c GROUP BY 1, 2, 3)
SELECT anio, mes, cve_muni, {', '.join(f'round({n}, 4) AS {n}_total, round({n} * 100000 / poblacion, 4) AS {n}_tasa' for n in _KINDS.values())}, '2024-6-m' AS data_date,
  CASE mes WHEN 'Enero' THEN '2024-01-01' WHEN 'Abril' THEN '2024-04-01' END AS fecha FROM w LEFT JOIN p USING (cve_muni) WHERE mes <> 'Agosto'"""


def _crime_table(t, crimes):
    pop = t.customer.select(pad_left(F.col("c_custkey").cast("string"), 5).alias("cve_muni"), (100.0 + F.col("c_nationkey")).alias("poblacion"))
    out = P.crime_rates(crimes, pop, "2024-6-m", kinds=_KINDS)
    numbers = [f"{n}_{s}" for n in _KINDS.values() for s in ("total", "tasa")]
    return out.withColumns({**{c: F.round(c, 4) for c in numbers}, "fecha": F.col("fecha").cast("string")})


@query("crime_rates", _RATES)
def _(t):
    return _crime_table(t, t.shape("crime"))


@query("crime_rates_by_period", _RATES)
def _(t):
    """The same from parts by period, loaded out of order, one of them twice: at first without its last rows."""
    spark = t.customer.sparkSession
    root = f"{shared_folder(spark)}/crime-{uuid4().hex}"
    t.shape("crime").withColumn("data_date", F.concat_ws("-", "anio", "mes")).write.partitionBy("data_date").parquet(f"{root}/events")
    events = spark.read.parquet(f"{root}/events")
    by, measures = ["anio", "mes", "cve_muni", "subtipodedelito"], {"incidencia_delictiva": ("sum", "incidencia_delictiva")}
    periods = sorted(r["data_date"] for r in events.select("data_date").distinct().collect())  # a row a period
    early = events.where(F.col("cve_muni") > "00100")
    write_part(early.where(F.col("data_date") == periods[-1]), f"{root}/parts", periods[-1], by, measures)
    for period in periods[::-1]:
        refresh_part(events, f"{root}/parts", period, by, measures)
    return _crime_table(t, merged(spark, f"{root}/parts", by, measures))


# --- census ---------------------------------------------------------------------------------------------
_CLEAN_KEYS = ["ent_pais_asi", "ent_pais_trab", "mun_asi", "mun_trab", "factor", "sexo", "edad", "conact", *[f"acti_sin_pago{i}" for i in range(1, 9)]]
_LP = {"ent_pais_asi": 2, "ent_pais_trab": 2, "mun_asi": 3, "mun_trab": 3}
_PROFILE_SQL = (
    "SELECT lpad(CAST(ent AS VARCHAR), greatest(2, CAST(length(CAST(ent AS VARCHAR)) AS INTEGER)), '0') AS cve_ent, lpad(CAST(ent AS VARCHAR), greatest(2, CAST(length(CAST(ent AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(mun AS VARCHAR), greatest(3, CAST(length(CAST(mun AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, "
    + ", ".join(f"lpad(CAST({k} AS VARCHAR), {_LP[k]}, '0') AS {k}" if k in _LP else k for k in _CLEAN_KEYS)
    + ", CAST(sum(factor) AS BIGINT) AS poblacion_mun, "
    + ", ".join(f"CAST(sum(CASE WHEN {p} THEN factor ELSE 0 END) AS BIGINT) AS {n}" for n, p in A.CENSUS_FLAGS.items())
    + f" FROM ({shape_sql('census')}) GROUP BY ALL"
)


@query("clean_intercensal_personas", _PROFILE_SQL)
def _(t):
    return CLEANERS["intercensal_personas_2015"](t.shape("census"))


_UNPAID = " + ".join(f"acti_sin_pago{i}" for i in range(1, 9))
_BANDS = [(f"{a}_{a + 4}", a, a + 4) for a in range(0, 75, 5)] + [("75", 75, 999)]


def _census_sql():
    emp = lambda s: f"CAST(sum(CASE WHEN sexo = {s} AND conact BETWEEN 10 AND 16 THEN factor ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN sexo = {s} AND edad > 13 THEN factor ELSE 0 END), 0)"
    parts = [
        "cve_muni", "CAST(sum(poblacion_mun) AS BIGINT) AS poblacion_mun", *[f"CAST(sum({g}) AS BIGINT) AS {g}" for g in P.GROUPS],
        "avg(migrantes_internos_recientes / nullif(poblacion_mun, 0)) AS migracion_interna_reciente", "avg(migrantes / nullif(poblacion_mun, 0)) AS migracion_externa_reciente",
        "count(*) FILTER (ent_pais_asi || mun_asi <> cve_muni) AS pob_flot_esc", "count(*) FILTER (ent_pais_trab || mun_trab <> cve_muni) AS pob_flot_trab",
        f"avg({_UNPAID}) FILTER (sexo = 1) AS total_horas_h", f"avg({_UNPAID}) FILTER (sexo = 3) AS total_horas_m", f"{emp(1)} AS proporcion_hombres_ocupados", f"{emp(3)} AS proporcion_mujeres_ocupadas",
        *[f"CAST(sum(poblacion_mun) FILTER (sexo = {s} AND edad BETWEEN {lo} AND {hi}) AS BIGINT) AS {l}{b}" for s, l in [(1, "h"), (3, "m")] for b, lo, hi in _BANDS],
    ]
    props = ", ".join(f"{g} / nullif(poblacion_mun, 0) AS prop_{g}" for g in P.GROUPS)
    return f"""WITH b AS (SELECT {', '.join(parts)} FROM ({_PROFILE_SQL}) GROUP BY 1)
SELECT * REPLACE (round(migracion_interna_reciente, 8) AS migracion_interna_reciente, round(migracion_externa_reciente, 8) AS migracion_externa_reciente), {props}, pob_flot_esc / nullif(poblacion_mun, 0) AS tasa_flot_esc, pob_flot_trab / nullif(poblacion_mun, 0) AS tasa_flot_trab,
 CASE WHEN total_horas_h = 0 THEN total_horas_m ELSE total_horas_m / nullif(total_horas_h, 0) END AS brecha_horas_cuidados,
 CASE WHEN proporcion_hombres_ocupados = 0 THEN proporcion_mujeres_ocupadas ELSE proporcion_mujeres_ocupadas / nullif(proporcion_hombres_ocupados, 0) END AS brecha_tasa_ocupados FROM b"""


@query("census_indicators", _census_sql())
def _(t):
    out = P.census_indicators(CLEANERS["intercensal_personas_2015"](t.shape("census")))
    return out.withColumns({c: F.round(c, 8) for c in ["migracion_interna_reciente", "migracion_externa_reciente"]})


_DWELL = "SELECT c_nationkey + 1 AS ent, CAST(c_custkey % 12 AS INT) AS mun, CAST(1 + c_custkey % 9 AS INT) AS factor, CASE WHEN c_acctbal < 3000 THEN 3 ELSE 1 END AS jefe_sexo, CAST(c_custkey % 6 AS INT) AS tipohog FROM customer"


@query("dwelling_indicators", f"""
SELECT lpad(CAST(ent AS VARCHAR), greatest(2, CAST(length(CAST(ent AS VARCHAR)) AS INTEGER)), '0') || lpad(CAST(mun AS VARCHAR), greatest(3, CAST(length(CAST(mun AS VARCHAR)) AS INTEGER)), '0') AS cve_muni, coalesce(sum(factor) FILTER (jefe_sexo = 3), 0) / sum(factor) AS proporcion_jefatura, coalesce(sum(factor) FILTER (tipohog = 5), 0) / sum(factor) AS proporcion_unipersonales FROM ({_DWELL}) GROUP BY 1""")
def _(t):
    df = t.customer.selectExpr("c_nationkey + 1 AS ent", "CAST(c_custkey % 12 AS INT) AS mun", "CAST(1 + c_custkey % 9 AS INT) AS factor", "CASE WHEN c_acctbal < 3000 THEN 3 ELSE 1 END AS jefe_sexo", "CAST(c_custkey % 6 AS INT) AS tipohog")
    out = P.dwelling_indicators(CLEANERS["intercensal_viviendas_2015"](df))
    return out


@query("mortality_rates", """
WITH d AS (SELECT c_nationkey AS cve_muni, count(*) FILTER (o_orderpriority LIKE '1%') AS m, count(*) FILTER (o_orderkey % 6000 < 4000) AS i FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), p AS (SELECT c_nationkey AS cve_muni, sum(CAST(1 + c_custkey % 5 AS DOUBLE)) AS f FROM customer GROUP BY 1)
SELECT cve_muni, m / f AS mortalidad_materna, i / f AS mortalidad_infantil FROM d LEFT JOIN p USING (cve_muni)""")
def _(t):
    deaths = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("cve_muni"), F.when(F.col("o_orderpriority").startswith("1"), "O95").otherwise("I21").alias("causa_def"), (F.col("o_orderkey") % 6000).cast("string").alias("edad")
    )
    census = t.customer.select(F.col("c_nationkey").alias("cve_muni"), (1 + F.col("c_custkey") % 5).alias("factor"))
    return P.mortality_rates(deaths, census)


@query("hospital_density", "SELECT l_suppkey AS cve_muni, round(avg((l_quantity + l_linenumber) / 1000), 8) AS densidad_medicos, round(avg(2 * l_quantity / 1000), 8) AS densidad_hospitales, round(avg(2.0e0 * l_linenumber / 1000), 8) AS densidad_camas FROM lineitem GROUP BY 1")
def _(t):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    out = P.hospital_density(t.lineitem.select(F.col("l_suppkey").alias("cve_muni"), q.alias("e1819"), n.alias("e20"), q.alias("unidades"), q.alias("e13"), n.alias("e14"), n.alias("e15")))
    return out.withColumns({c: F.round(c, 8) for c in ["densidad_medicos", "densidad_hospitales", "densidad_camas"]})


# --- prices ------------------------------------------------------------------------------------------------
_PRICES = """pr AS (SELECT CAST(c_nationkey AS VARCHAR) AS nom_cd, o_orderpriority AS variable, date_trunc('month', o_orderdate) AS f, round(avg(o_totalprice), 4) AS value FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 3 GROUP BY 1, 2, 3),
ch AS (SELECT *, (value - lag(value) OVER (PARTITION BY nom_cd, variable ORDER BY f)) / nullif(value, 0) AS dif FROM pr)"""


def _prices(t):
    from ..operators.reshape import MONTH_COLUMNS

    names = F.array(*[F.lit(m[:3]) for m in MONTH_COLUMNS])
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    city = F.when(F.col("c_nationkey") == 3, "Ciudad de México").otherwise(F.col("c_nationkey").cast("string"))
    stamp = F.concat(F.element_at(names, F.month("o_orderdate")), F.lit(" "), F.year("o_orderdate").cast("string"))
    return df.groupBy(city.alias("nom_cd"), F.col("o_orderpriority").alias("variable"), stamp.alias("fecha")).agg(F.round(F.avg("o_totalprice"), 4).alias("value"))


@query("price_changes", f"WITH {_PRICES} SELECT nom_cd, variable, strftime(f, '%Y-%m-%d') AS fecha, round(dif, 8) AS value_dif FROM ch")
def _(t):
    return P.price_changes(_prices(t)).select("nom_cd", "variable", F.col("fecha_mes").cast("string").alias("fecha"), F.round("value_dif", 8).alias("value_dif"))


@query("municipal_inflation", f"""
WITH {_PRICES}, l AS (SELECT nom_cd, avg(dif) AS v FROM ch WHERE f = (SELECT max(f) FROM ch) GROUP BY 1),
b AS (SELECT l.v, 14.05e0 + n_nationkey / 2.0e0 AS lat, -117.05e0 + n_nationkey AS lon FROM l JOIN nation ON nom_cd = CAST(n_nationkey AS VARCHAR)), a AS ({shape_sql('customer_place')})
SELECT c_custkey AS cve_muni, round({_IDW}, 8) AS ipc_dif, CAST((SELECT year(max(f)) FROM ch) AS INT) AS "year", (SELECT strftime(max(f), '%m') FROM ch) AS "month" FROM (SELECT c_custkey, {distance('a', 'b')} AS d, v FROM a CROSS JOIN b WHERE v IS NOT NULL) GROUP BY 1""")
def _(t):
    cities = t.nation.select(F.col("n_nationkey").cast("string").alias("nom_cd"), (14.05 + F.col("n_nationkey") / 2).alias("lat"), (-117.05 + F.col("n_nationkey")).alias("lon"))
    places = t.shape("customer_place").select(F.col("c_custkey").alias("cve_muni"), "lat", "lon")
    return P.municipal_inflation(_prices(t), cities, places).withColumn("ipc_dif", F.round("ipc_dif", 8))


# --- beneficiaries ---------------------------------------------------------------------------------------
_FIELD = "string_split(value, '|')"
_CLEAN = "SELECT " + ", ".join(f"{_FIELD}[{i + 1}] AS {n}" for i, n in enumerate(B.RAW_FIELDS)) + f" FROM ({shape_sql('raw_beneficiary')})"
_MES = "CASE lower(substring(periodo, 3, 1)) WHEN 'a' THEN 10 WHEN 'b' THEN 11 WHEN 'c' THEN 12 ELSE TRY_CAST(substring(periodo, 3, 1) AS INT) END"
_BORN = "CAST(TRY_CAST(substring(fh_nacimiento, 1, 4) || '-' || substring(fh_nacimiento, 5, 2) || '-' || substring(fh_nacimiento, 7, 2) AS DATE) AS DATE)"
_BENEF = f"""
WITH r AS ({_CLEAN}), a AS (SELECT *, {_MES} AS m, CAST(anio AS INT) AS y, {_BORN} AS born FROM r),
e AS (SELECT *, CASE WHEN m BETWEEN 1 AND 12 THEN CAST(y - year(born) - CASE WHEN m < month(born) OR (m = month(born) AND day(born) > 1) THEN 1 ELSE 0 END AS INT) END AS edad FROM a)
SELECT cd_dependencia, CASE WHEN contains(nb_origen, 'F') THEN 'F' WHEN contains(nb_origen, 'E') THEN 'E' WHEN contains(nb_origen, 'M') THEN 'M' END AS origin, id_admin, cd_programa, cd_padron, y AS anio, periodo,
 CASE WHEN edad < 18 THEN '' ELSE nb_primer_ap END AS nb_primer_ap, CASE WHEN edad < 18 THEN '' ELSE nb_segundo_ap END AS nb_segundo_ap, CASE WHEN edad < 18 THEN '' ELSE nb_nombre END AS nb_nombre, fh_nacimiento, edad,
 CASE WHEN edad >= 60 THEN 'Adulto Mayor' WHEN edad <= 14 THEN 'Infante' WHEN edad > 14 THEN 'Adulto' END AS categoria_edad, CASE WHEN contains(cd_sexo, 'H') THEN 'H' WHEN contains(cd_sexo, 'M') THEN 'M' END AS cd_sexo,
 CASE WHEN TRY_CAST(nu_mes_pago AS INT) BETWEEN 1 AND 12 THEN CAST(nu_mes_pago AS INT) END AS nu_mes_pago, CAST(m AS INT) AS nu_mes_correspondencia, new_id, TRY_CAST(nullif(nu_imp_monetario, '') AS BIGINT) AS nu_imp_monetario,
 CASE WHEN CAST(cve_ent AS INT) BETWEEN 1 AND 32 AND CAST(cve_mun AS INT) BETWEEN 1 AND 998 THEN lpad(cve_ent, 2, '0') || lpad(cve_mun, 3, '0') END AS cve_muni,
 CASE WHEN CAST(cve_ent AS INT) BETWEEN 1 AND 32 THEN lpad(cve_ent, 2, '0') END AS cve_ent, CASE WHEN CAST(cve_loc AS INT) BETWEEN 1 AND 9998 THEN lpad(cve_loc, 4, '0') END AS cve_loc, in_titular, cd_beneficio FROM e"""


def _clean(t):
    return B.clean_beneficiaries(t.shape("raw_beneficiary"))


@query("clean_beneficiaries", _BENEF)
def _(t):
    return _clean(t)


def _cube_sql():
    from itertools import product

    axes = B.BENEFICIARY_AXES
    parts = []
    for names in product(*axes.values()):
        used = list(dict.fromkeys(k for a, n in zip(axes, names) for k in axes[a][n]))
        has = lambda c, cast="VARCHAR": c if c in used else f"CAST(NULL AS {cast})"
        level, group, kind, time = names
        month = next((c for c in used if c.startswith("nu_mes")), "CAST(NULL AS INT)")
        parts.append(
            f"SELECT CAST(anio AS VARCHAR) AS anio, {has('cve_ent')} AS cve_ent, {has('cve_muni')} AS cve_muni, {has('cd_programa')} AS cve_programa, {has('cd_padron')} AS cve_padron, "
            f"{kind if kind in used else chr(39) + 'total' + chr(39)} AS tipo, '{time}' AS temporalidad, {month} AS mes, '{level}' AS nivel, '{group}' AS grupo, count(DISTINCT new_id) AS n_beneficiarios, CAST(sum(nu_imp_monetario) AS BIGINT) AS suma_importe "
            f"FROM b WHERE {' AND '.join(f'{k} IS NOT NULL' for k in used)} GROUP BY {', '.join(used)}"
        )
    return f"WITH b AS ({_BENEF}) " + " UNION ALL ".join(parts)


@query("beneficiary_cube", _cube_sql())
def _(t):
    return B.beneficiary_cube(_clean(t))


@query("clean_cube", f"""
WITH dim(e, lo, hi) AS (VALUES {_LEGAL}), c AS ({_cube_sql()})
SELECT c.* EXCLUDE (suma_importe), max(suma_importe) AS suma_importe FROM c LEFT JOIN dim ON cve_ent = e WHERE cve_muni IS NULL OR (CAST(substring(cve_muni, 3, 3) AS INT) BETWEEN lo AND hi AND (cve_ent <> '03' OR CAST(substring(cve_muni, 3, 3) AS INT) IN (1, 2, 3, 8, 9))) GROUP BY ALL""")
def _(t):
    return B.clean_cube(B.beneficiary_cube(_clean(t)))


@query("aggregated_register", f"""
WITH b AS (SELECT *, origin || '-' || cd_dependencia || '-' || cd_programa AS nomagregado FROM ({_BENEF})), v AS (SELECT count(DISTINCT new_id) AS n FROM b)
SELECT 'n' AS nivel, 'nacional' AS cvenivel, anio AS nomperiodo, nomagregado, count(DISTINCT new_id) AS beneficiarios, coalesce(CAST(sum(nu_imp_monetario) AS BIGINT), 0) AS monto FROM b GROUP BY anio, nomagregado, cd_padron
UNION SELECT 'e', cve_ent, anio, nomagregado, count(DISTINCT new_id), coalesce(CAST(sum(nu_imp_monetario) AS BIGINT), 0) FROM b GROUP BY cve_ent, anio, nomagregado
UNION SELECT 'm', cve_muni, anio, nomagregado, count(DISTINCT new_id), coalesce(CAST(sum(nu_imp_monetario) AS BIGINT), 0) FROM b GROUP BY cve_muni, anio, nomagregado""")
def _(t):
    return B.aggregated_register(_clean(t))
