"""Rates and indicators per place: crime, census, deaths, prices, services."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..functions.dates import data_date_to_date, first_of_month, month_number, parse_es_month
from ..functions.numbers import row_sum
from ..operators.aggregates import density, event_rate, pyramid_sums, rate_per_100k
from ..operators.joins import assemble
from ..operators.projections import at_period
from ..operators.spatial import idw
from ..operators.windows import relative_change

# Crime type -> column name.
CRIMES = {
    "Homicidio doloso": "homicidio_doloso",
    "Homicidio culposo": "homicidio_culposo",
    "Secuestro": "secuestro",
    "Feminicidio": "feminicidio",
    "Violencia familiar": "violencia_familiar",
    "Robo de vehículo automotor": "robo_vehiculos",
    "Daño a la propiedad": "danio_prop",
}


def crime_rates(
    crimes: DataFrame,
    population: DataFrame,
    data_date: str | None = None,
    place: str = "cve_muni",
    kinds: Mapping[str, str] = CRIMES,
    per: float = 100_000,
) -> DataFrame:
    """Incidence and rate per place and month, one column per crime type, up to the period of the load."""
    wide = rate_per_100k(
        crimes, population, ["anio", "mes", place], [place], "subtipodedelito", "incidencia_delictiva", kinds, per=per
    )
    dated = wide.withColumn("fecha", first_of_month("anio", month_number("mes")))
    if data_date is None:
        return dated
    return dated.withColumn("data_date", F.lit(data_date)).where(F.col("fecha") <= data_date_to_date(F.lit(data_date)))


GROUPS = [
    "mayores65", "menores5", "adultos", "menores", "indigenas", "lengua_indigena", "afrodescendientes", "mujeres", "hombres",
]
# Activity codes that count as employed.
EMPLOYED = [10, 11, 12, 13, 14, 15, 16]


def census_indicators(profiles: DataFrame, key: str = "cve_muni") -> DataFrame:
    """Population shares, floating population, migration, gaps and pyramid per municipality.

    ``profiles`` is the cleaned census table. Commuters are told by comparing municipality keys, so ``key`` must be one
    (states: sum the result's numbers up). Everything, the pyramid too, comes from one aggregate over it.
    """
    if key != "cve_muni":
        raise ValueError("census indicators are by municipality")
    unpaid = row_sum([f"acti_sin_pago{i}" for i in range(1, 9)], skip_null=False)
    school = F.concat(pad_left("ent_pais_asi", 2), pad_left("mun_asi", 3))
    work = F.concat(pad_left("ent_pais_trab", 2), pad_left("mun_trab", 3))

    def away(other):
        return F.coalesce(F.sum(F.when(other == F.col(key), 0).when(other != F.col(key), 1)), F.lit(0))

    def employed(sex):
        here = F.col("sexo") == sex
        busy = F.sum(F.when(here & F.col("conact").isin(EMPLOYED), F.col("factor")).otherwise(0))
        able = F.sum(F.when(here & (F.col("edad") > 13), F.col("factor")).otherwise(0))
        return F.try_divide(busy.cast("double"), able)

    pyramid = pyramid_sums("sexo", "edad", "poblacion_mun", {1: "h", 3: "m"})
    base = profiles.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ["poblacion_mun", *GROUPS]],
        F.avg(F.try_divide(F.col("migrantes_internos_recientes").cast("double"), F.col("poblacion_mun"))).alias("migracion_interna_reciente"),
        F.avg(F.try_divide(F.col("migrantes").cast("double"), F.col("poblacion_mun"))).alias("migracion_externa_reciente"),
        away(school).alias("pob_flot_esc"),
        away(work).alias("pob_flot_trab"),
        F.avg(F.when(F.col("sexo") == 1, unpaid)).alias("total_horas_h"),
        F.avg(F.when(F.col("sexo") == 3, unpaid)).alias("total_horas_m"),
        employed(1).alias("proporcion_hombres_ocupados"),
        employed(3).alias("proporcion_mujeres_ocupadas"),
        *[F.when(F.col(key).isNotNull(), c).alias(n) for n, c in pyramid.items()],  # no pyramid without a municipality
    )

    def gap(women, men):
        return F.when(F.col(men) == 0, F.col(women)).otherwise(F.try_divide(women, men))

    total = F.col("poblacion_mun")
    return base.withColumns(
        {
            **{f"prop_{g}": F.try_divide(F.col(g).cast("double"), total) for g in GROUPS},
            "tasa_flot_esc": F.try_divide(F.col("pob_flot_esc").cast("double"), total),
            "tasa_flot_trab": F.try_divide(F.col("pob_flot_trab").cast("double"), total),
            "brecha_horas_cuidados": gap("total_horas_m", "total_horas_h"),
            "brecha_tasa_ocupados": gap("proporcion_mujeres_ocupadas", "proporcion_hombres_ocupados"),
        }
    )


def dwelling_indicators(dwellings: DataFrame) -> DataFrame:
    """Shares of one-person dwellings and of dwellings headed by a woman."""
    total = F.col("viviendas_mun")
    return dwellings.select(
        "cve_muni",
        F.try_divide(F.col("jefatura_fem").cast("double"), total).alias("proporcion_jefatura"),
        F.try_divide(F.col("unipersonales").cast("double"), total).alias("proporcion_unipersonales"),
    )


def mortality_rates(deaths: DataFrame, census: DataFrame, place: str = "cve_muni") -> DataFrame:
    """Maternal (cause starting with O) and infant (coded age under 4000) deaths per inhabitant."""
    pop = census.groupBy(place).agg(F.sum("factor").cast("double").alias("poblacion"))
    preds = {"mortalidad_materna": F.col("causa_def").startswith("O"), "mortalidad_infantil": F.col("edad").try_cast("int") < 4000}
    return event_rate(deaths, pop, [place], preds).select(place, *preds)


def hospital_density(hospitals: DataFrame, place: str = "cve_muni") -> DataFrame:
    """Physicians, hospitals and beds per thousand, averaged over establishments."""
    groups = {"densidad_medicos": ["e1819", "e20"], "densidad_hospitales": ["unidades", "e13"], "densidad_camas": ["e14", "e15"]}
    return density(hospitals, [place], groups)


def price_changes(prices: DataFrame, denominator: str = "current") -> DataFrame:
    """Monthly relative change per city and series; the capital's metropolitan series are left out."""
    known = prices.where(F.col("nom_cd").isNotNull() & ~F.col("nom_cd").contains("México"))
    dated = known.withColumn("fecha_mes", parse_es_month("fecha"))
    return relative_change(dated, ["nom_cd", "variable"], ["fecha_mes"], "value", "value_dif", denominator)


def municipal_inflation(prices: DataFrame, cities: DataFrame, municipalities: DataFrame, denominator: str = "current") -> DataFrame:
    """Latest monthly change of the cities carried to municipalities by inverse distance.

    ``cities``: nom_cd, lat, lon. ``municipalities``: cve_muni, lat, lon. Several series of a city are averaged.
    """
    latest = at_period(price_changes(prices, denominator), "fecha_mes", "latest")
    per_city = latest.groupBy("nom_cd", "fecha_mes").agg(F.avg("value_dif").alias("ipc_dif")).join(cities, "nom_cd")
    spread = idw(municipalities, per_city, "ipc_dif", "cve_muni", "nom_cd")
    when = per_city.agg(F.max("fecha_mes")).scalar()
    return spread.select("cve_muni", "ipc_dif", F.year(when).alias("year"), pad_left(F.month(when).cast("string"), 2).alias("month"))


def assemble_matrix(threats: Sequence[DataFrame], vulnerabilities: Sequence[DataFrame], capacities: Sequence[DataFrame], key: str = "cve_muni") -> DataFrame:
    """Threat, vulnerability and capacity inputs side by side, one row per place of the first threat table."""
    base, *rest = [*threats, *vulnerabilities, *capacities]
    return assemble(base, rest, key)
