"""Beneficiary registry: cleaning the raw file and the aggregate tables built from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_at, age_category, period_month, valid_month
from ..functions.geography import valid_locality, valid_municipality, valid_state
from ..functions.numbers import to_int
from ..functions.text import ORIGIN_CODES, SEX_CODES, first_match_code, strip_chars
from ..operators.aggregates import dedupe_max
from ..operators.cube import BENEFICIARY_AXES, multi_level, pair_dimension_cube
from ..operators.projections import filter_valid_codes, legal_ranges, redact_minors
from ..sources.readers import split_lines
from .registry import cleaner

# Fields of a raw line in order.
RAW_FIELDS = [
    "cd_dependencia", "nb_origen", "id_admin", "cd_programa", "cd_padron", "anio", "periodo", "nb_primer_ap",
    "nb_segundo_ap", "nb_nombre", "fh_nacimiento", "cd_sexo", "nu_mes_pago", "new_id", "nu_imp_monetario",
    "cve_ent", "cve_mun", "cve_loc", "in_titular", "cd_beneficio",
]


def clean_beneficiaries(lines: DataFrame, year: int | None = None, value: str = "value") -> DataFrame:
    """Raw lines to 23 typed fields in one projection.

    ``year`` is the year of the file; without it the year stated in the line is used.
    """
    raw = split_lines(lines, "|", {n: i for i, n in enumerate(RAW_FIELDS)}, value)
    anio = F.lit(year).cast("int") if year is not None else to_int(strip_chars("anio", "\"'"), "null").cast("int")
    aged = raw.withColumn("__mes", period_month("periodo")).withColumn("__anio", anio)
    aged = aged.withColumn("edad", age_at("fh_nacimiento", "__anio", "__mes"))
    out = aged.select(
        "cd_dependencia",
        first_match_code("nb_origen", ORIGIN_CODES).alias("origin"),
        "id_admin",
        "cd_programa",
        "cd_padron",
        F.col("__anio").alias("anio"),
        "periodo",
        "nb_primer_ap",
        "nb_segundo_ap",
        "nb_nombre",
        "fh_nacimiento",
        "edad",
        age_category("edad").alias("categoria_edad"),
        first_match_code("cd_sexo", SEX_CODES).alias("cd_sexo"),
        valid_month("nu_mes_pago").alias("nu_mes_pago"),
        F.col("__mes").alias("nu_mes_correspondencia"),
        "new_id",
        to_int(strip_chars("nu_imp_monetario", "\"'"), "null").alias("nu_imp_monetario"),
        valid_municipality("cve_ent", "cve_mun").alias("cve_muni"),
        valid_state("cve_ent").alias("cve_ent"),
        valid_locality("cve_loc").alias("cve_loc"),
        "in_titular",
        "cd_beneficio",
    )
    return redact_minors(out, "edad", ["nb_primer_ap", "nb_segundo_ap", "nb_nombre"])


def beneficiary_cube(clean: DataFrame, axes: Mapping[str, Mapping[str, Sequence[str]]] = BENEFICIARY_AXES) -> DataFrame:
    """All 81 groupings of the clean file in one scan, in the published column order."""
    return pair_dimension_cube(clean, axes, "new_id", "nu_imp_monetario")


@cleaner("pub_agrupaciones")
def clean_cube(cube: DataFrame) -> DataFrame:
    """Cube rows with legal municipality codes, one row per key combination with the largest amount."""
    legal = filter_valid_codes(cube, legal_ranges(cube.sparkSession))
    return dedupe_max(legal, [c for c in cube.columns if c != "suma_importe"], "suma_importe")


def aggregated_register(clean: DataFrame) -> DataFrame:
    """National, state and municipal beneficiaries and amounts per year and programme, missing amounts as 0."""
    named = clean.withColumn("nomagregado", F.concat(F.col("origin"), F.lit("-"), F.col("cd_dependencia"), F.lit("-"), F.col("cd_programa")))
    levels = {"n": (None, ["cd_padron"]), "e": ("cve_ent", []), "m": ("cve_muni", [])}
    out = multi_level(named, levels, ["anio", "nomagregado"], "new_id", "nu_imp_monetario")
    return out.withColumnRenamed("anio", "nomperiodo").withColumn("monto", F.coalesce("monto", F.lit(0)))
