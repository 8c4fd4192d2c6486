"""Composite indices: food risk, hazards, vulnerability, complexity, infrastructure, prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geography import parent_key
from ..functions.numbers import geo_mean, row_argmax, row_mean, weighted_row_sum
from ..functions.text import recode_values
from ..operators.aggregates import group_summary, median_of_sums, weighted_rollup
from ..operators.joins import add_group_value, donor_fill, outer_assemble
from ..operators.projections import fill_mean
from ..operators.reshape import spread
from ..operators.scale import settle
from ..operators.windows import average_rank, average_ranks, fill_down, minmax, rank_by

# Sub-index -> the components whose geometric mean it is.
FOOD_SUBINDICES = {
    "disponibilidad_local_i": ["complejidad_i", "productividad_i"],
    "disponibilidad_comercial_i": ["carreteras_i", "inpc_i"],
    "disponibilidad_i": ["disponibilidad_local_i", "disponibilidad_comercial_i"],
    "acceso_economico_i": ["linea_bienestar_i", "gini_i"],
    "acceso_autoconsumo_i": ["alimentacion_i"],
    "acceso_i": ["acceso_economico_i", "acceso_autoconsumo_i"],
    "utilizacion_educativo_i": ["educacion_i"],
    "utilizacion_salud_i": ["fetal_i", "medicos_i", "hospitales_i"],
    "utilizacion_vivienda_i": ["agua_i", "drenaje_i", "refri_i"],
    "utilizacion_i": ["utilizacion_vivienda_i", "utilizacion_salud_i", "utilizacion_educativo_i"],
}
FOOD_COMPONENTS = sorted({c for cs in FOOD_SUBINDICES.values() for c in cs if c not in FOOD_SUBINDICES}) + [
    "violencia_i", "temperaturas_i", "inundaciones_i", "sequia_i",
]
DIMENSIONS = {
    "Disponibilidad": ["disponibilidad_local_i", "disponibilidad_comercial_i"],
    "Acceso": ["acceso_economico_i", "acceso_autoconsumo_i"],
    "Utilización": ["utilizacion_educativo_i", "utilizacion_salud_i", "utilizacion_vivienda_i"],
}


def food_risk(components: DataFrame, key: str = "cve_muni") -> DataFrame:
    """Food-risk index per municipality with ranks, its leading dimension and sub-dimension.

    Missing components take the mean. Stability is 0.4 violence plus 0.6 of the mean natural hazard.
    """
    df = fill_mean(components, FOOD_COMPONENTS)
    for name, parts in FOOD_SUBINDICES.items():
        df = df.withColumn(name, geo_mean(parts))
    df = df.withColumn("estabilidad_natural_i", row_mean(["temperaturas_i", "inundaciones_i", "sequia_i"]))
    df = df.withColumn("estabilidad_i", weighted_row_sum({"violencia_i": 0.4, "estabilidad_natural_i": 0.6}))
    df = df.withColumn("riesgo_alimentario_i", geo_mean(["disponibilidad_i", "acceso_i", "utilizacion_i", "estabilidad_i"]))
    df = settle(df)
    parts = ["disponibilidad", "acceso", "utilizacion", "estabilidad"]
    ranks = [f"{p}_r" for p in parts]
    scores = {**{f"{p}_r": f"{p}_i" for p in parts}, "riesgo_alimentario_rn": "riesgo_alimentario_i"}
    df = settle(average_ranks(df, key, scores, descending=True))
    df = minmax(df, [*ranks, "riesgo_alimentario_rn"], clamp=True, invert=True).withColumnRenamed("riesgo_alimentario_rn_i", "riesgo_alimentario_r_i")
    labels = {"disponibilidad_r_i": "Disponibilidad", "acceso_r_i": "Acceso", "utilizacion_r_i": "Utilización"}
    df = df.withColumn("max_dim", recode_values(row_argmax(list(labels)), labels))
    sub = F.lit(None).cast("string")
    for dim, parts in DIMENSIONS.items():
        sub = F.when(F.col("max_dim") == dim, row_argmax(parts)).otherwise(sub)
    df = df.withColumn("max_sdim", sub).withColumn("cve_ent", parent_key(key))
    df = average_rank(df, "riesgo_alimentario_rn", ["cve_ent"], "riesgo_alimentario_re")
    return add_group_value(df, ["cve_ent"], num_muns=F.count(F.lit(1)))


# Hazard level -> points.
HAZARD_POINTS = {"Muy alto": 10, "Alto": 8, "Medio": 4, "Bajo": 2, "Muy bajo": 1, "Sin peligro": 0, "Nd": 0}


def natural_hazards(levels: DataFrame, hazards: Sequence[str], key: str = "cve_muni") -> DataFrame:
    """Hazard levels to points, scaled to 0-1, and their mean per municipality.

    Standardising first would not change a 0-1 scale, so it is left out.
    """
    points = levels.withColumns({h: recode_values(h, HAZARD_POINTS, keep_other=False).cast("double") for h in hazards})
    names = {f"{h}_i": f"a_n_{h}_i" for h in hazards}
    out = minmax(points, hazards).withColumnsRenamed(names)
    return out.withColumn("amenazas_naturales_i", row_mean(list(names.values())))


def natural_hazards_by_state(municipal: DataFrame, hazards: Sequence[str], weight: str, key: str = "cve_muni") -> DataFrame:
    """Population-weighted hazard sums per state, scaled again over the states."""
    return weighted_rollup(municipal.withColumn("cve_ent", parent_key(key)), ["cve_ent"], weight, [f"a_n_{h}_i" for h in hazards])


# States without prices -> the neighbour whose value they take.
PRICE_DONORS = {"04": "27", "06": "14", "12": "20", "17": "15", "23": "31", "29": "21"}


def price_volatility(prices: DataFrame, state: str = "estado", year: str = "anio", value: str = "ipa_n") -> DataFrame:
    """Median of the yearly sums per state, scaled; states without data take a neighbour's value."""
    spark = prices.sparkSession
    yearly = median_of_sums(prices, [state], [year], value, "a_h_volatilidad_i").withColumnRenamed(state, "cve_ent")
    scaled = minmax(yearly, ["a_h_volatilidad_i"], suffix="")
    return donor_fill(scaled, "cve_ent", "a_h_volatilidad_i", spark.createDataFrame(list(PRICE_DONORS.items()), "cve_ent string, donor string"))


def human_hazards(violence: DataFrame, volatility: DataFrame, inflation: DataFrame) -> DataFrame:
    """Geometric mean of violence, price volatility and inflation; the last two are state values."""
    joined = violence.join(volatility, "cve_ent", "left").join(inflation, "cve_ent", "left")
    return joined.withColumn("amenazas_humana_i", geo_mean(["amenazas_humana_violencia_i", "a_h_volatilidad_i", "a_h_e_inpc_i"]))


# Indicators that are carried down and scaled.
VULNERABILITY_INPUTS = ["irez_soc15", "gini_10", "unprooted", "ic_asalud", "precio_maiz_2015"]


def vulnerability_index(sources: Sequence[DataFrame], key: str = "cve_muni") -> DataFrame:
    """Full join of the sources, gaps filled from the place above in key order, scaled to 0-1, averaged in two levels."""
    full = fill_down(outer_assemble(sources, key), [key], VULNERABILITY_INPUTS)
    scaled = minmax(full, VULNERABILITY_INPUTS, suffix="")
    return (
        scaled.withColumn("socioeconomica", row_mean(["irez_soc15", "gini_10"]))
        .withColumn("o_vulnerable", row_mean(["ic_asalud", "precio_maiz_2015"]))
        .withColumn("vulnerable_groups", row_mean(["unprooted", "o_vulnerable"]))
        .withColumn("vulnerable", row_mean(["socioeconomica", "vulnerable_groups"]))
    )


def index_by_state(index: DataFrame, score: str, cols: Sequence[str], key: str = "cve_muni") -> DataFrame:
    """State means of an index and its parts, ranked by score."""
    means = group_summary(index.select(parent_key(key).alias("cve_ent"), *cols), ["cve_ent"], "mean", cols)
    return rank_by(means, score, ["cve_ent"], "ranking")


def complexity(products: DataFrame, years: Sequence[int], key: str = "cve_muni", year: str = "year", value: str = "pci") -> DataFrame:
    """Mean complexity per place and year, one scaled column per year."""
    means = products.groupBy(key, year).agg(F.avg(value).alias("media"))
    wide = spread(means, year, "media", [key], [str(y) for y in years]).withColumnsRenamed({str(y): f"complejidad_{y}" for y in years})
    return minmax(wide, [f"complejidad_{y}" for y in years], suffix="").withColumn("cve_ent", parent_key(key))


def infrastructure(sources: Sequence[DataFrame], key: str = "cve_locc") -> tuple[DataFrame, DataFrame]:
    """Facilities per locality from all sources, and their sums per municipality."""
    local = outer_assemble(sources, key).withColumn("cve_muni", parent_key(key, 5))
    measures = [c for c in local.columns if c not in (key, "cve_muni")]
    return local, group_summary(local.select("cve_muni", *measures), ["cve_muni"], "sum", measures)


def price_index_by_state(cities: DataFrame, city_states: DataFrame, city: str, value: str, period: str) -> DataFrame:
    """City price series averaged per state and period, scaled inside each period."""
    means = cities.join(city_states, city).groupBy("cve_ent", period).agg(F.avg(value).alias("inpc"))
    return minmax(means, ["inpc"], by=[period], suffix="_norm")


def physicians_rate(physicians: DataFrame, population: DataFrame, count: str, pop: str, key: str = "cve_muni", name: str = "personal_medico_100_h") -> DataFrame:
    """Physicians per 100 000 people, unknown as 0, and scaled."""
    rate = F.coalesce(F.try_divide(F.col(count) * 100_000.0, F.col(pop)), F.lit(0.0))
    return minmax(physicians.join(population, key, "left").withColumn(name, rate), [name], suffix="_norm")
