"""Household survey and registry results: deprivation, income predictors, poverty, vulnerability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..functions.numbers import any_in
from ..operators.aggregates import collapse_max, gap_ratio, weighted_indicator, weighted_table
from ..operators.joins import natural_left
from ..operators.rules import Step, needed, run_chunk, run_steps
from ..operators.scale import settle_step
from .packs import DEPRIVATION, INCOME, poverty_rules

DWELLING = ["fecha_creacion", "folioviv"]
HOME = [*DWELLING, "hogar_id"]
PERSON = [*HOME, "person_id"]
VISITOR = 12  # relationship code of people who are not household members

HEALTH_VARS = [
    "sm_lab", "sm_cv", "salud_dir", "jefe_sm", "cony_sm", "hijo_sm", "acceso_jefe_sm", "acceso_cony_sm",
    "acceso_hijo_sm", "acceso_otros_sm", "asalud", "ic_asalud",
]
SECURITY_VARS = [
    "sm_lab", "jubilado", "sm_cv", "afore_cv", "ss_dir", "jefe_ss", "cony_ss", "hijo_ss", "acceso_jefe_ss",
    "acceso_cony_ss", "acceso_hijo_ss", "acceso_otros_ss", "seguridad_social", "ic_seguridad_social",
]


def _names(pack: Mapping, chunk: str) -> list[str]:
    return list(dict.fromkeys(r.name for r in pack[chunk]))


def _picked(df: DataFrame, held: Mapping[str, Mapping[str, str]], wanted: Mapping[str, Sequence[str]], ids: Sequence[str]) -> DataFrame:
    """Id columns and the wanted variables of several steps; a variable of two steps is taken from the first."""
    columns: dict[str, str] = {}
    for step, names in wanted.items():
        for name in names:
            columns.setdefault(name, held[step][name])
    return df.select(*ids, *[F.col(c).alias(n) for n, c in columns.items()])


def survey_deprivation(people: DataFrame, homes: DataFrame, dwellings: DataFrame, jobs: DataFrame, income: DataFrame) -> DataFrame:
    """Deprivation flags per person from the five survey tables (after cleaning and recoding).

    Work, health and social security run as steps of one table of persons and jobs, which holds no more than they read:
    their grouped layers are one aggregate and one join by household, and they are collapsed to persons together. Each step
    that moves persons is settled, so that the disk never holds the shuffles of more than one.
    """
    members = people.where(F.col("parentesco") != VISITOR)
    youngest = members.groupBy("data_date", *HOME).agg(F.min("edad").alias("min_edad"))
    home = youngest.join(homes, ["data_date", *HOME], "left")
    earner = members.select("data_date", *PERSON, "edad").join(income, ["data_date", *PERSON], "left")

    schooling = run_chunk(members, DEPRIVATION["rezago_educativo"], ["nivel_edu", "a_nacimiento", "ic_rezago_educativo"], PERSON)
    food = run_chunk(home, DEPRIVATION["carencia_alimentaria"], ["i_menores18", "total_ia", "inseguridad_alimentaria", "ic_alimentacion"], HOME)
    roofed, told = run_steps(dwellings, {n: Step(DEPRIVATION[n]) for n in ("carencia_servicios", "carencia_vivienda")})
    dwelled = _picked(roofed, told, {n: _names(DEPRIVATION, n) for n in told}, DWELLING)

    money_vars = _names(DEPRIVATION, "ingresos_enigh")
    earned, told = run_steps(earner, {"money": Step(DEPRIVATION["ingresos_enigh"])})
    money = settle_step(collapse_max(_picked(earned, told, {"money": money_vars}, PERSON), PERSON, money_vars))
    steps = {
        "work": Step(DEPRIVATION["trabajo_enigh"]),
        "health": Step(DEPRIVATION["carencia_salud"], HEALTH_VARS, after="work"),
        "security": Step(DEPRIVATION["carencia_seguridad_social"], SECURITY_VARS, after="work"),
    }
    worker = settle_step(needed(members.join(jobs, ["data_date", *PERSON], "left"), steps, PERSON))
    worker = settle_step(needed(worker.join(money, PERSON, "left"), steps, PERSON))
    flagged, told = run_steps(worker, steps)
    security_vars = [v for v in SECURITY_VARS if v not in ("sm_lab", "sm_cv")]
    covered = _picked(flagged, told, {"health": HEALTH_VARS, "security": security_vars}, PERSON)
    covered = settle_step(collapse_max(covered, PERSON, covered.columns[len(PERSON):]))
    fed = settle_step(schooling.join(food, HOME, "left"))
    return settle_step(fed.join(covered, PERSON, "left")).join(dwelled, DWELLING, "left")


def registry_deprivation(members: DataFrame, answers: DataFrame, home_answers: DataFrame, home_size: DataFrame) -> DataFrame:
    """Deprivation flags per person from the registry tables.

    members: hogar_id, person_id, edad, anio, parentesco. answers: person questionnaire. home_answers: home
    questionnaire. home_size: hogar_id, total_personas. One registry round, so ``fecha_creacion`` is constant
    where the tables lack it.

    Work, health, income and social security run as steps of one table, which holds no more than they read: their grouped
    layers are one aggregate and one join by household. Each step that moves persons is settled, so that the disk never holds
    the shuffles of more than one. What is joined by household comes first: where ids repeat, the join by person has more
    rows than its inputs, and these are never moved again.
    """
    def dated(df):
        return df if "fecha_creacion" in df.columns else df.withColumn("fecha_creacion", F.lit("r"))

    ids = ["hogar_id", "person_id"]
    steps = {
        "work": Step(DEPRIVATION["trabajo_cuis"], ["trabajo", "pea", "tipo_trab"]),
        "health": Step(DEPRIVATION["carencia_salud"], after="work"),
        "income": Step(DEPRIVATION["ingresos_cuis"], after="health"),
        "security": Step(DEPRIVATION["carencia_seguridad_social"], SECURITY_VARS, after="income"),
    }
    people = dated(natural_left(answers, members.drop("fecha_creacion")))
    people = settle_step(needed(people, {**steps, "schooling": Step(DEPRIVATION["rezago_educativo"])}, ids))
    home = dated(home_answers)
    ages = members.groupBy("hogar_id").agg(F.min("edad").alias("edad"))
    food = run_chunk(home.join(ages, "hogar_id", "left"), DEPRIVATION["carencia_alimentaria"], None, ["hogar_id"])
    quality = run_chunk(natural_left(home, home_size), DEPRIVATION["carencia_vivienda"], None, ["hogar_id"])
    services = run_chunk(home, DEPRIVATION["carencia_servicios"], None, ["hogar_id"])
    care = home_answers.select("hogar_id", "c_salud_hoga", "c_salud_hogb")
    worker = settle_step(needed(people.join(care, "hogar_id", "left"), steps, ids))
    flagged, told = run_steps(worker, steps)
    security_vars = [v for v in SECURITY_VARS if v not in ("sm_lab", "sm_cv")]
    health_vars = [v for v in _names(DEPRIVATION, "carencia_salud") if v not in ("sm_lab", "sm_cv")]
    covered = settle_step(_picked(flagged, told, {"health": health_vars, "security": security_vars}, ids))
    security = collapse_max(covered, ["hogar_id"], security_vars)
    schooling = run_chunk(people, DEPRIVATION["rezago_educativo"], None, ids)
    housed = (
        schooling.join(food, "hogar_id", "left").join(quality, "hogar_id", "left").join(services, "hogar_id", "left")
        .join(security, "hogar_id", "left")
    )
    out = settle_step(housed).join(covered.select(*ids, *health_vars), ids, "left")
    return out.select(*[c for c in out.columns if c not in security_vars], *security_vars)


def income_predictors(
    people: DataFrame, homes: DataFrame, dwellings: DataFrame, jobs: DataFrame, summary: DataFrame
) -> DataFrame:
    """One row per household with the income predictors, current income and locality.

    What reads persons runs as steps of one table, what reads persons and jobs as steps of another: grouped layers are one
    aggregate and one join a level and key, and each table is collapsed to households once. Each step that moves persons is
    settled, so that the disk never holds the shuffles of more than one.
    """
    members = people.where(F.col("parentesco") != VISITOR)
    rooms = dwellings.select(*DWELLING, "total_cuartosdor", "total_personas")
    worker = members.join(jobs, ["data_date", *PERSON], "left")
    housed = members.join(rooms, DWELLING, "left").join(summary.select(*HOME, "remesas"), HOME, "left")
    equipped = dwellings.drop("data_date").join(homes, DWELLING, "left")

    def per_home(df, chunks, skip=()):
        steps = {n: Step(INCOME[n]) for n in chunks}
        out, held = run_steps(settle_step(needed(df, steps, HOME)), steps)
        found = _picked(out, held, {n: [v for v in _names(INCOME, n) if v not in skip] for n in chunks}, HOME)
        return settle_step(collapse_max(found, HOME, found.columns[len(HOME):]))

    housing = run_chunk(dwellings, INCOME["condiciones_vivienda"], None, DWELLING).drop("no_sanitario", "sanitario_cagua", "total_cuartosdor")
    dwelled = natural_left(housing, dwellings.select(*DWELLING, F.col("ubica_geo").alias("cve_loc")))
    told = natural_left(run_chunk(homes, INCOME["seguridad_alimentaria"], None, HOME), summary.select(*HOME, "ing_cor"))
    out = per_home(housed, ["educacion", "condiciones_demograficas1", "condiciones_demograficas2"], ("habla_lenguaind",))
    known = F.col(HOME[0]).isNotNull() & F.col(HOME[1]).isNotNull() & F.col(HOME[2]).isNotNull()  # households that can be met by key
    first = {*HOME, *_names(INCOME, "educacion")}
    out = out.withColumns({c: F.when(known, F.col(c)) for c in out.columns if c not in first})
    out = out.join(per_home(worker, ["seguridad_social", "condicion_laboral"]), HOME, "left").join(per_home(equipped, ["enseres_hogar"]), HOME, "left")
    return out.join(told, HOME, "left").join(dwelled, DWELLING, "left")


# Indicators reported per state.
STATE_INDICATORS = [
    "pobreza", "pobreza_e", "pobreza_m", "vul_car", "vul_ing", "no_pobv", "ic_rezedu", "ic_asalud", "ic_segsoc",
    "ic_cv", "ic_sbv", "ic_ali", "carencias", "carencias3", "plb", "plb_m",
]


def poverty_by_state(people: DataFrame, variables: Sequence[str] = STATE_INDICATORS) -> DataFrame:
    """Weighted share (``_porcentaje``) and total (``_num``) of each indicator per state and period."""
    wide = people.groupBy("cve_ent", "data_date").agg(
        F.sum("factor").cast("double").alias("__pop"),
        *[F.sum(F.col("factor") * F.col(v)).cast("double").alias(v) for v in variables],
    )
    return wide.select(
        "cve_ent", F.col("data_date").alias("fecha"),
        *[F.try_divide(F.col(v), F.col("__pop")).alias(f"{v}_porcentaje") for v in variables],
        *[F.col(v).alias(f"{v}_num") for v in variables],
    )


def poverty_long(people: DataFrame, variables: Sequence[str] = STATE_INDICATORS) -> DataFrame:
    """The same indicators long: (cve_ent, data_date, variable, tipo, valor, pob_tot)."""
    long = weighted_indicator(people, ["cve_ent", "data_date"], "factor", variables)
    return long.unpivot(["cve_ent", "data_date", "variable", "pob_tot"], ["nominal", "porcentaje"], "tipo", "valor")


# Flag -> reported name.
TABLE_FLAGS = {
    "pobreza": "pobreza", "pobreza_m": "pobreza_m", "pobreza_e": "pobreza_e", "vul_car": "vul_car", "vul_ing": "vul_ing",
    "no_pobv": "no_pobv", "carencias": "carencias", "carencias3": "carencias3", "ic_rezedu": "ic_rezedu",
    "ic_asalud": "ic_asalud", "ic_segsoc": "ic_segsoc", "ic_cv": "ic_cev", "ic_sbv": "ic_sbv", "ic_ali": "ic_ali",
    "plb_m": "plbm", "plb": "plb",
}


def poverty_table(people: DataFrame, by: Sequence[str] = ("ent",)) -> DataFrame:
    """Measure multidimensional poverty, then counts (``_n``) and percentages (``_p``) per state."""
    measured = run_chunk(people, poverty_rules(), return_all=True)
    named = measured.select(*by, "factor", *[F.col(c).alias(n) for c, n in TABLE_FLAGS.items()])
    return weighted_table(named, list(by), "factor", list(TABLE_FLAGS.values()), "pobreza")


# Income sources that are wages.
WAGES = ["P001", "P011", "P018"]
DISABILITIES = {"disc_int": [6], "disc_fis": [1, 5], "disc_sens": [2, 3, 4], "disc_men": [7]}


def household_vulnerability(people: DataFrame, summary: DataFrame, jobs: DataFrame, income: DataFrame) -> DataFrame:
    """Disability shares, childcare access and the wage gap per state.

    Tables of one survey year with folioviv, foliohog (and numren for persons). Childcare counts workers
    with the benefit, weighted by the household.
    """
    def state(df):
        return df.withColumn("cve_ent", F.substring(pad_left(F.col("folioviv").cast("string"), 10), 1, 2))

    home = ["cve_ent", "folioviv", "foliohog"]
    weights = state(summary).select(*home, F.col("factor_hog").cast("double").alias("w"))
    columns = [f"disc{i}" for i in range(1, 8)]
    flags = {n: F.max(any_in(columns, codes).cast("int")) for n, codes in DISABILITIES.items()}
    persons = state(people).groupBy(*home, "numren").agg(F.max("sexo").alias("sexo"), *[f.alias(n) for n, f in flags.items()])
    per_home = persons.groupBy(*home).agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in flags])
    carers = state(jobs).groupBy(*home).agg(F.sum(F.when(F.col("pres_6") == 6, 1).otherwise(0)).alias("g"))
    weighted = per_home.join(weights, home, "left").join(carers, home, "left")
    totals = weighted.groupBy("cve_ent").agg(
        F.sum(F.col("n") * F.col("w")).alias("personas"),
        F.sum(F.col("g") * F.col("w")).alias("guar"),
        *[F.sum(F.col(n) * F.col("w")).alias(n) for n in flags],
    )
    shares = totals.select(
        "cve_ent",
        *[(100 * F.try_divide(F.col(n), F.col("personas"))).alias(n) for n in flags],
        F.try_divide("guar", "personas").alias("proporcion_guar"),
    )
    earned = state(income).where(F.col("clave").isin(WAGES)).select(*home, "numren", "ing_1")
    wages = earned.join(persons.select(*home, "numren", "sexo"), [*home, "numren"])
    gap = gap_ratio(wages, ["cve_ent"], "sexo", 2, 1, "ing_1", name="brecha_salario_mensual").select(
        "cve_ent",
        "brecha_salario_mensual",
        F.col("brecha_salario_mensual_num").alias("media_salario_m"),
        F.col("brecha_salario_mensual_den").alias("media_salario_h"),
    )
    return shares.join(gap, "cve_ent", "left")
