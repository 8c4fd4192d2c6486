"""Published tables: tidy long indicators, semantic tables and place profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geography import program_key
from ..functions.text import clean_text, split_variable
from ..operators.documents import (
    explode_plot_vars,
    map_document,
    metadata_label,
    nested_totals,
    profile_document,
    profile_table,
    series_document,
)
from ..operators.matching import keyword_match, matches_to_array
from ..operators.reshape import gather, union_aligned


def tidy_municipal(wide: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Wide municipal indicators to (ids, variable, tipo, valor), type taken from the name."""
    long = gather(wide, "__name", "valor", ids)
    return long.withColumn("__s", split_variable("__name")).select(*ids, F.col("__s.variable"), F.col("__s.tipo"), "valor")


def poverty_semantic(states: DataFrame, municipalities: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Both levels in one table with year, source note and dictionary entry; municipal percentages as shares."""
    def source(df, key, nivel, valor):
        return (df, {
            "clave": key, "variable": "variable", "tipo": "tipo", "nivel": F.lit(nivel), "valor": valor,
            "pob_tot": "pob_tot", "data_date": "data_date", "anio": F.substring("data_date", 1, 4).try_cast("int"),
        })

    share = F.when(F.col("tipo") == "porcentaje", F.col("valor") / 100).otherwise(F.col("valor"))
    both = union_aligned([source(states, "cve_ent", "estatal", F.col("valor")), source(municipalities, "cve_muni", "municipal", share)])
    names = dictionary.select("id", "nombre", "fuente").distinct()
    return both.withColumn("metadata", metadata_label()).join(names, F.col("variable") == F.col("id"), "left")


def budget_semantic(annual: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Both budget sources without repeated lines, as one document per year, programme and spending type."""
    same = ["ciclo", "id_ramo", "desc_ramo", "id_modalidad", "desc_modalidad", "desc_tipogasto", "monto_modificado"]
    lines = union_aligned([
        (annual, {**{c: c for c in same}, "desc_concepto": "desc_objeto_del_gasto", "cve_programa": program_key("id_modalidad", "id_pp")}),
        (quarterly, {**{c: c for c in same}, "desc_concepto": "desc_concepto", "cve_programa": "cve_programa"}),
    ])
    return nested_totals(lines, ["ciclo", "cve_programa"], "desc_tipogasto", "desc_concepto", "monto_modificado")


def plot_info(plots: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(plot, info): what a chart needs to know, once per plot, with its variables in name order."""
    rows = explode_plot_vars(plots, dictionary)
    return rows.groupBy("plot").agg(
        F.struct(
            F.max("plot_type").alias("plot_type"),
            F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("vars"),
            F.max("title").alias("title"),
            F.max("palette").alias("palette"),
            F.max("subtext").alias("subtext"),
        ).alias("info")
    )


def place_profiles(
    current: DataFrame,
    series: DataFrame,
    maps: DataFrame,
    dictionary: DataFrame,
    plots: DataFrame,
) -> DataFrame:
    """Current, time-series and map documents of every place in one table (tipo, nivel, nivel_clave, values)."""
    info = plot_info(plots, dictionary)
    return profile_table(
        perfil_ubicaciones=profile_document(current, dictionary, info),
        temporal_ubicaciones=series_document(series, dictionary, info),
        maps_ubicaciones=map_document(maps, info),
    )


def recommend_programs(programs: DataFrame, keywords: DataFrame, program: str, name: str, goal: str, keyword_id: str = "id", words: str = "palabras_clave") -> DataFrame:
    """Programme ids per keyword id, from name and goal of each programme."""
    text = clean_text(F.concat_ws(". ", F.col(name), F.col(goal)))
    cleaned = programs.select(F.col(program), text.alias("__text"))
    long = keywords.select(F.col(keyword_id), F.explode(words).alias("palabra"))
    return matches_to_array(keyword_match(cleaned, long, "__text", program, keyword_id), keyword_id, program, "programas")
