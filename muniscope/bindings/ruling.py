"""Rules, rule packs and the survey results built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..operators.recode import cast_recoded, recode
from ..operators.rules import Rule, run_chunk
from ..plans import survey as S
from ..plans.packs import DEPRIVATION, INCOME, poverty_rules
from ..plans.packs.deprivation import CARENCIA_SERVICIOS_LIMIT
from .core import query, shape_sql
from .rules_sql import chunk_sql
from .shapes import HOME, PERSON

# SQL sums of integers are wider than Spark's
CASTS = {"num_seguro_popular": "BIGINT", "ingreso_pam": "DOUBLE", "ingreso_pens": "DOUBLE"}


def pack_query(name: str, shape: str, chunk: list[Rule], ids: list[str], rounded: dict[str, int] | None = None, needs: list[Rule] = ()):
    """Row-level check of a whole pack over a derived table; ``needs`` runs first to give its inputs."""
    columns = {"person": PERSON, "home": HOME}[shape]
    out = [*ids, *dict.fromkeys(r.name for r in chunk)]
    rounded = rounded or {}
    listed = [f"round({c}, {rounded[c]}) AS {c}" if c in rounded else c for c in out]
    casts = {r.name: "BIGINT" for r in chunk if r.agg == "count_distinct"} | CASTS
    sql = chunk_sql(shape_sql(shape), list(columns), [*needs, *chunk], listed, casts)

    @query(name, sql)
    def run(t):
        df = t.shape(shape)
        if needs:
            df = run_chunk(df, needs, return_all=True)
        out_df = run_chunk(df, chunk, None, ids)
        return out_df.withColumns({c: F.round(c, d) for c, d in rounded.items()}) if rounded else out_df


PERSON_IDS, HOME_IDS = ["fecha_creacion", "hogar_id", "person_id"], ["fecha_creacion", "hogar_id"]

pack_query("rezago_educativo", "person", DEPRIVATION["rezago_educativo"], PERSON_IDS)
pack_query("carencia_servicios", "home", DEPRIVATION["carencia_servicios"], HOME_IDS)
pack_query("carencia_servicios_limit", "home", CARENCIA_SERVICIOS_LIMIT, HOME_IDS)
pack_query("carencia_vivienda", "home", DEPRIVATION["carencia_vivienda"], HOME_IDS, {"indice_hacinamiento": 8})
pack_query("carencia_alimentaria", "home", DEPRIVATION["carencia_alimentaria"], HOME_IDS)
pack_query("trabajo_enigh", "person", DEPRIVATION["trabajo_enigh"], PERSON_IDS)
pack_query("trabajo_cuis", "person", DEPRIVATION["trabajo_cuis"], PERSON_IDS)
pack_query("carencia_salud", "person", DEPRIVATION["carencia_salud"], PERSON_IDS, needs=DEPRIVATION["trabajo_enigh"])
pack_query("ingresos_enigh", "person", DEPRIVATION["ingresos_enigh"], PERSON_IDS, {c: 4 for c in ["ingreso_pam_temp", "ingreso_pam", "ingreso_pens_temp", "ingreso_pens"]})
pack_query("ingresos_cuis", "person", DEPRIVATION["ingresos_cuis"], PERSON_IDS)
pack_query(
    "carencia_seguridad_social", "person", DEPRIVATION["carencia_seguridad_social"], PERSON_IDS,
    needs=[*DEPRIVATION["trabajo_enigh"], *DEPRIVATION["ingresos_enigh"]],
)
pack_query("educacion", "person", INCOME["educacion"], PERSON_IDS)
pack_query("condicion_laboral", "person", INCOME["condicion_laboral"], PERSON_IDS, {"depen_cociente": 8})
pack_query("seguridad_social", "person", INCOME["seguridad_social"], PERSON_IDS)
pack_query("condiciones_vivienda", "home", INCOME["condiciones_vivienda"], HOME_IDS)
pack_query("condiciones_demograficas1", "person", INCOME["condiciones_demograficas1"], PERSON_IDS, {"log_total_personas": 8, "hacinamiento": 8})
pack_query("condiciones_demograficas2", "person", INCOME["condiciones_demograficas2"], PERSON_IDS, {"dependientes_cociente": 8})
pack_query("enseres_hogar", "home", INCOME["enseres_hogar"], HOME_IDS)
pack_query("seguridad_alimentaria", "home", INCOME["seguridad_alimentaria"], HOME_IDS)
_DEPTH = {c: 8 for c in ["prof_b1", "prof_bm1", "profun", "int_pob", "int_pobe", "int_vulcar", "int_caren"]}
pack_query("pobreza_multidimensional", "home", poverty_rules(), HOME_IDS, _DEPTH)

# one rule of each form
FORMS = [
    Rule("ingreso", "ing_1 + ing_2"),
    Rule.dummy("adulto", "edad >= 18"),
    Rule.cases("grupo", ("edad < 18", 1), ("edad < 65", 2), ("edad >= 65", 3)),
    Rule.grouped("miembros", "count_distinct", "person_id", ("fecha_creacion", "hogar_id")),
    Rule.grouped("mujeres", "count_distinct", "person_id", ("fecha_creacion", "hogar_id"), "sexo = 2"),
    Rule.grouped("edad_max", "max", "edad", ("fecha_creacion", "hogar_id"), "sexo = 2"),
    Rule("ingreso_adulto", "ingreso", where="adulto = 1"),
    Rule.grouped("ingreso_hogar", "sum", "ingreso_adulto", ("hogar_id",)),
    Rule.dummy("grande", "miembros >= 4", where="grupo = 2"),
]
pack_query("run_chunk", "person", FORMS, PERSON_IDS, {"ingreso_hogar": 4})

# --- table-driven recode ----------------------------------------------------------------------------


def _recode_table(t):
    """Recode rows derived from the coded values present."""
    prio = t.orders.select("o_orderpriority").distinct().select(
        F.lit("orders").alias("tabla"), F.lit("o_orderpriority").alias("variable_inicial"), F.lit("prioridad").alias("variable_final"),
        F.col("o_orderpriority").alias("valor_inicial"), F.substring("o_orderpriority", 1, 1).alias("valor_final"),
    ).where("valor_final < '4'")
    status = prio.select("tabla").distinct().select("tabla", F.lit("o_orderstatus").alias("variable_inicial"), F.lit("estado").alias("variable_final"), F.lit(None).cast("string").alias("valor_inicial"), F.lit(None).cast("string").alias("valor_final"))
    return prio.unionByName(status)


@query("recode", """
SELECT o_orderkey, CASE WHEN substring(o_orderpriority, 1, 1) < '4' THEN CAST(substring(o_orderpriority, 1, 1) AS INT) END AS prioridad, o_orderstatus AS estado FROM orders""")
def _(t):
    table = _recode_table(t)
    out = recode(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), "orders", table)
    return cast_recoded(out, "orders", table.where("variable_final = 'prioridad'"))


# --- composite survey tables -------------------------------------------------------------------------
_JOB = ["trabaja_subord", "trabaja_indep", "con_sueldo", "tipo_pago", "prestacion_incapacidad", "prestacion_afore", "id_trabajo"]
_MONEY = ["clave", *[f"ing_{i}" for i in range(1, 7)]]
_KEYS = ["data_date", *S.PERSON]
_ROOMS = ["total_personas", "total_cuartosdor"]
_PEOPLE = [c for c in PERSON if c not in {*_JOB, *_MONEY, *_ROOMS, "remesas", "jubilado"}]
_DWELLING = [
    "servicio_agua", "servicio_drenaje", "servicio_elect", "fuente_combustible", "estufa_sinchimenea", "material_pisos", "material_muros",
    "material_techos", "elimina_basura", "tipo_escusado", "escusado_exclusivo", "tenencia", "ubica_geo", *_ROOMS,
]
_HOMES = [c for c in HOME if c.startswith(("alim_", "num_")) or c == "telefono"]


def _sel(cols, source):
    return f"SELECT {', '.join(cols)} FROM ({source})"


def _collapse(cols, ids, source):
    return f"SELECT {', '.join(ids)}, {', '.join(f'max({c}) AS {c}' for c in cols)} FROM ({source}) GROUP BY {', '.join(ids)}"


def _left(a, b, keys):
    return f"SELECT * FROM ({a}) LEFT JOIN ({b}) USING ({', '.join(keys)})"


_P_SQL, _H_SQL = shape_sql("person"), shape_sql("home")
_MEMBERS = _sel(_PEOPLE, _P_SQL) + f" WHERE parentesco <> {S.VISITOR}"
_WORKER = _left(_MEMBERS, _sel([*_KEYS, *_JOB], _P_SQL), _KEYS)
_WORKER_COLS = [*_PEOPLE, *_JOB]
_HOME_SQL = _sel(["data_date", *S.HOME, *_HOMES], _H_SQL)
_DWELL_SQL = _sel(["data_date", *S.DWELLING, *_DWELLING], _H_SQL)


def _names(chunk):
    return list(dict.fromkeys(r.name for r in chunk))


def _only(chunk, names):
    return [r for r in chunk if r.name in names]


def _survey_sql():
    schooling_vars = ["nivel_edu", "a_nacimiento", "ic_rezago_educativo"]
    food_vars = ["i_menores18", "total_ia", "inseguridad_alimentaria", "ic_alimentacion"]
    schooling = chunk_sql(_MEMBERS, _PEOPLE, _only(DEPRIVATION["rezago_educativo"], schooling_vars), [*S.PERSON, *schooling_vars])
    young = f"SELECT data_date, {', '.join(S.HOME)}, min(edad) AS min_edad FROM ({_MEMBERS}) GROUP BY ALL"
    food = chunk_sql(_left(young, _HOME_SQL, ["data_date", *S.HOME]), ["min_edad"], _only(DEPRIVATION["carencia_alimentaria"], food_vars), [*S.HOME, *food_vars])
    services = chunk_sql(_DWELL_SQL, _DWELLING, DEPRIVATION["carencia_servicios"], [*S.DWELLING, *_names(DEPRIVATION["carencia_servicios"])])
    quality = chunk_sql(_DWELL_SQL, _DWELLING, DEPRIVATION["carencia_vivienda"], [*S.DWELLING, *_names(DEPRIVATION["carencia_vivienda"])])
    work = chunk_sql(_WORKER, _WORKER_COLS, DEPRIVATION["trabajo_enigh"], ["*"])
    work_cols = [*_WORKER_COLS, "pea", "tipo_trab", "jubilado"]
    health = _collapse(S.HEALTH_VARS, S.PERSON, chunk_sql(work, work_cols, _only(DEPRIVATION["carencia_salud"], S.HEALTH_VARS), [*S.PERSON, *S.HEALTH_VARS]))
    money_vars = _names(DEPRIVATION["ingresos_enigh"])
    earner = _left(_sel([*_KEYS, "edad"], _MEMBERS), _sel([*_KEYS, *_MONEY], _P_SQL), _KEYS)
    money = _collapse(money_vars, S.PERSON, chunk_sql(earner, [*_KEYS, "edad", *_MONEY], DEPRIVATION["ingresos_enigh"], [*S.PERSON, *money_vars], CASTS))
    kept = [v for v in S.SECURITY_VARS if v not in ("sm_lab", "sm_cv")]
    insured = chunk_sql(_left(work, money, S.PERSON), [*work_cols, *money_vars], _only(DEPRIVATION["carencia_seguridad_social"], S.SECURITY_VARS), [*S.PERSON, *kept])
    out = schooling
    for part, keys in [(food, S.HOME), (health, S.PERSON), (_collapse(kept, S.PERSON, insured), S.PERSON), (services, S.DWELLING), (quality, S.DWELLING)]:
        out = _left(out, part, keys)
    return f"SELECT * REPLACE (round(indice_hacinamiento, 8) AS indice_hacinamiento) FROM ({out})"


@query("survey_deprivation", _survey_sql())
def _(t):
    p, h = t.shape("person"), t.shape("home")
    out = S.survey_deprivation(
        p.select(*_PEOPLE), h.select("data_date", *S.HOME, *_HOMES), h.select("data_date", *S.DWELLING, *_DWELLING), p.select(*_KEYS, *_JOB), p.select(*_KEYS, *_MONEY)
    )
    return out.withColumn("indice_hacinamiento", F.round("indice_hacinamiento", 8))


_MEMBER = ["hogar_id", "person_id", "edad", "anio", "parentesco"]
_ANSWERS = [c for c in PERSON if c not in {"edad", "anio", "parentesco", "folioviv", "data_date", "antec_esc", "c_salud_hoga", "c_salud_hogb", "total_personas", "total_cuartosdor"}]
_HOME_ANSWERS = ["fecha_creacion", "hogar_id", "c_salud_hoga", "c_salud_hogb", *[c for c in _DWELLING if c != "total_personas"], *[c for c in _HOMES if c.startswith("alim_")]]


def _registry_sql():
    ids = ["hogar_id", "person_id"]
    people = _left(_sel(_ANSWERS, _P_SQL), f"SELECT DISTINCT {', '.join(_MEMBER)} FROM ({_P_SQL})", ids)
    cols = [*_ANSWERS, *_MEMBER]
    home = _sel(_HOME_ANSWERS, _H_SQL)
    pick = DEPRIVATION
    schooling = chunk_sql(people, cols, pick["rezago_educativo"], [*ids, *_names(pick["rezago_educativo"])])
    ages = f"SELECT hogar_id, min(edad) AS edad FROM ({_P_SQL}) GROUP BY 1"
    food = chunk_sql(_left(home, ages, ["hogar_id"]), [*_HOME_ANSWERS, "edad"], pick["carencia_alimentaria"], ["hogar_id", *_names(pick["carencia_alimentaria"])])
    quality = chunk_sql(_left(home, _sel(["hogar_id", "total_personas"], _H_SQL), ["hogar_id"]), [*_HOME_ANSWERS, "total_personas"], pick["carencia_vivienda"], ["hogar_id", *_names(pick["carencia_vivienda"])])
    services = chunk_sql(home, _HOME_ANSWERS, pick["carencia_servicios"], ["hogar_id", *_names(pick["carencia_servicios"])])
    work_vars = ["trabajo", "pea", "tipo_trab"]
    work = chunk_sql(people, cols, _only(pick["trabajo_cuis"], work_vars), ["*"])
    care = _sel(["hogar_id", "c_salud_hoga", "c_salud_hogb"], home)
    full_cols = [*cols, *work_vars, "c_salud_hoga", "c_salud_hogb"]
    full = chunk_sql(_left(work, care, ["hogar_id"]), full_cols, pick["carencia_salud"], ["*"])
    full_cols += _names(pick["carencia_salud"])
    health_vars = [v for v in _names(pick["carencia_salud"]) if v not in ("sm_lab", "sm_cv")]
    kept = [v for v in S.SECURITY_VARS if v not in ("sm_lab", "sm_cv")]
    insured = chunk_sql(full, full_cols, [*pick["ingresos_cuis"], *_only(pick["carencia_seguridad_social"], S.SECURITY_VARS)], ["hogar_id", *kept])
    out = schooling
    for part, keys in [(food, ["hogar_id"]), (quality, ["hogar_id"]), (services, ["hogar_id"]), (_sel([*ids, *health_vars], full), ids), (_collapse(kept, ["hogar_id"], insured), ["hogar_id"])]:
        out = _left(out, part, keys)
    return f"SELECT * REPLACE (round(indice_hacinamiento, 8) AS indice_hacinamiento) FROM ({out})"


@query("registry_deprivation", _registry_sql())
def _(t):
    p, h = t.shape("person"), t.shape("home")
    out = S.registry_deprivation(p.select(*_MEMBER).distinct(), p.select(*_ANSWERS), h.select(*_HOME_ANSWERS), h.select("hogar_id", "total_personas"))
    return out.withColumn("indice_hacinamiento", F.round("indice_hacinamiento", 8))


def _income_sql():
    rooms = _sel([*S.DWELLING, *_ROOMS], _H_SQL)
    summary = _sel([*S.HOME, "remesas"], _H_SQL)
    housed = _left(_left(_MEMBERS, rooms, S.DWELLING), summary, S.HOME)
    housed_cols = [*_PEOPLE, *_ROOMS, "remesas"]
    equipped = _left(_sel([*S.DWELLING, *_DWELLING], _H_SQL), _HOME_SQL, S.DWELLING)

    def per_home(source, cols, chunk, skip=()):
        rules = INCOME[chunk]
        names = [n for n in _names(rules) if n not in skip]
        casts = {r.name: "BIGINT" for r in rules if r.agg == "count_distinct"} | CASTS
        return _collapse(names, S.HOME, chunk_sql(source, cols, rules, [*S.HOME, *names], casts))

    dwell = _sel([*S.DWELLING, *_DWELLING], _H_SQL)
    housing_vars = [n for n in _names(INCOME["condiciones_vivienda"]) if n not in ("no_sanitario", "sanitario_cagua", "total_cuartosdor")]
    housing = chunk_sql(dwell, _DWELLING, INCOME["condiciones_vivienda"], [*S.DWELLING, *housing_vars])
    food = chunk_sql(_HOME_SQL, _HOMES, INCOME["seguridad_alimentaria"], [*S.HOME, *_names(INCOME["seguridad_alimentaria"])])
    out = per_home(_MEMBERS, _PEOPLE, "educacion")
    for part in [
        per_home(_WORKER, _WORKER_COLS, "seguridad_social"), per_home(_WORKER, _WORKER_COLS, "condicion_laboral"),
        per_home(housed, housed_cols, "condiciones_demograficas1"), per_home(housed, housed_cols, "condiciones_demograficas2", ("habla_lenguaind",)),
        per_home(equipped, [*_DWELLING, *_HOMES], "enseres_hogar"), food, _sel([*S.HOME, "ing_cor"], _H_SQL),
    ]:
        out = _left(out, part, S.HOME)
    out = _left(_left(out, housing, S.DWELLING), f"SELECT {', '.join(S.DWELLING)}, ubica_geo AS cve_loc FROM ({_H_SQL})", S.DWELLING)
    rounded = ", ".join(f"round({c}, 8) AS {c}" for c in ["depen_cociente", "log_total_personas", "hacinamiento", "dependientes_cociente"])
    return f"SELECT * REPLACE ({rounded}) FROM ({out})"


@query("income_predictors", _income_sql())
def _(t):
    p, h = t.shape("person"), t.shape("home")
    out = S.income_predictors(
        p.select(*_PEOPLE), h.select("data_date", *S.HOME, *_HOMES), h.select("data_date", *S.DWELLING, *_DWELLING), p.select(*_KEYS, *_JOB), h.select(*S.HOME, "remesas", "ing_cor")
    )
    return out.withColumns({c: F.round(c, 8) for c in ["depen_cociente", "log_total_personas", "hacinamiento", "dependientes_cociente"]})


# --- poverty tables -------------------------------------------------------------------------------------
def _table_sql():
    measured = chunk_sql(_H_SQL, list(HOME), poverty_rules(), ["*"])
    cols = ", ".join(
        f"round(100 * sum({c} * factor) / sum(factor) FILTER ({c} IS NOT NULL), 6) AS {n}_p, coalesce(sum(factor) FILTER ({c} = 1), 0) AS {n}_n" for c, n in S.TABLE_FLAGS.items()
    )
    return f"SELECT ent, {cols} FROM ({measured}) WHERE pobreza IS NOT NULL GROUP BY 1"


@query("poverty_table", _table_sql())
def _(t):
    out = S.poverty_table(t.shape("home"))
    return out.withColumns({f"{n}_p": F.round(f"{n}_p", 6) for n in S.TABLE_FLAGS.values()})


_STATE_SQL = f"SELECT ent AS cve_ent, data_date, factor, {', '.join(S.STATE_INDICATORS)} FROM ({chunk_sql(_H_SQL, list(HOME), poverty_rules(), ['*'])})"


@query("poverty_by_state", "SELECT cve_ent, data_date AS fecha, " + ", ".join(f"round(sum(factor * {v}) / sum(factor), 8) AS {v}_porcentaje, CAST(sum(factor * {v}) AS DOUBLE) AS {v}_num" for v in S.STATE_INDICATORS) + f" FROM ({_STATE_SQL}) GROUP BY 1, 2")
def _(t):
    people = run_chunk(t.shape("home"), poverty_rules(), return_all=True).withColumnRenamed("ent", "cve_ent")
    out = S.poverty_by_state(people)
    return out.withColumns({f"{v}_porcentaje": F.round(f"{v}_porcentaje", 8) for v in S.STATE_INDICATORS})


@query("poverty_long", " UNION ALL ".join(
    f"SELECT cve_ent, data_date, '{v}' AS variable, sum(factor) AS pob_tot, unnest(['nominal', 'porcentaje']) AS tipo, round(unnest([CAST(sum(factor * {v}) AS DOUBLE), sum(factor * {v}) / sum(factor)]), 8) AS valor FROM s GROUP BY 1, 2"
    for v in S.STATE_INDICATORS
).join([f"WITH s AS ({_STATE_SQL}) ", ""]))
def _(t):
    people = run_chunk(t.shape("home"), poverty_rules(), return_all=True).withColumnRenamed("ent", "cve_ent")
    return S.poverty_long(people).withColumn("valor", F.round("valor", 8))


# --- household vulnerability ------------------------------------------------------------------------------


@query("household_vulnerability", f"""
WITH p AS (SELECT substring(lpad(CAST(folioviv AS VARCHAR), greatest(10, CAST(length(CAST(folioviv AS VARCHAR)) AS INTEGER)), '0'), 9, 2) AS cve_ent, * FROM ({_P_SQL})),
m AS (SELECT cve_ent, folioviv, person_id, max(sexo) AS sexo, {', '.join(f"max(CASE WHEN {' OR '.join(f'coalesce(disc{i} IN ({chr(44).join(map(str, codes))}), FALSE)' for i in range(1, 8))} THEN 1 ELSE 0 END) AS {n}" for n, codes in S.DISABILITIES.items())} FROM p GROUP BY 1, 2, 3),
h AS (SELECT cve_ent, folioviv, count(*) AS n, {', '.join(f'sum({n}) AS {n}' for n in S.DISABILITIES)} FROM m GROUP BY 1, 2),
g AS (SELECT cve_ent, folioviv, sum(CASE WHEN realiza_act_lab = 6 THEN 1 ELSE 0 END) AS g FROM p GROUP BY 1, 2),
w AS (SELECT o_orderkey AS folioviv, 1.0e0 + o_custkey % 40 AS w FROM orders),
t AS (SELECT h.cve_ent, sum(n * w) AS personas, sum(g * w) AS guar, {', '.join(f'sum({n} * w) AS {n}' for n in S.DISABILITIES)} FROM h LEFT JOIN w USING (folioviv) LEFT JOIN g USING (cve_ent, folioviv) GROUP BY 1),
b AS (SELECT p.cve_ent, avg(ing_1) FILTER (m.sexo = 2) AS mm, avg(ing_1) FILTER (m.sexo = 1) AS mh FROM p JOIN m USING (cve_ent, folioviv, person_id) WHERE clave IN ('P031', 'P041', 'P048') GROUP BY 1)
SELECT cve_ent, {', '.join(f'round(100 * {n} / nullif(personas, 0), 8) AS {n}' for n in S.DISABILITIES)}, round(guar / nullif(personas, 0), 8) AS proporcion_guar,
  round(CASE WHEN mh = 0 THEN mm ELSE mm / nullif(mh, 0) END, 6) AS brecha_salario_mensual, round(mm, 6) AS media_salario_m, round(mh, 6) AS media_salario_h FROM t LEFT JOIN b USING (cve_ent)""")
def _(t):
    # the state sits at the end of the order key, so it is moved to the front of the dwelling number
    state_first = F.concat(F.substring(pad_left(F.col("folioviv").cast("string"), 10), 9, 2), pad_left(F.col("folioviv").cast("string"), 8))
    p = t.shape("person").withColumns({"folioviv": state_first, "foliohog": F.lit(1), "numren": F.col("person_id")})
    weights = t.orders.select(F.col("o_orderkey").alias("folioviv"), (1.0 + F.col("o_custkey") % 40).alias("factor_hog")).withColumns({"folioviv": state_first, "foliohog": F.lit(1)})
    jobs = p.withColumnRenamed("realiza_act_lab", "pres_6")
    income = p.withColumn("clave", F.when(F.col("clave") == "P031", "P001").when(F.col("clave") == "P041", "P011").when(F.col("clave") == "P048", "P018"))
    out = S.household_vulnerability(p, weights, jobs, income)
    eight = [*S.DISABILITIES, "proporcion_guar"]
    return out.withColumns({**{c: F.round(c, 8) for c in eight}, **{c: F.round(c, 6) for c in ["brecha_salario_mensual", "media_salario_m", "media_salario_h"]}})
