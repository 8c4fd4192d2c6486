"""JSON documents built as maps and structs, never by pasting text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geography import wkt_to_geojson
from .scale import deal_out, pack_blocks, sorted_parts


def pack_json(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Move columns into one JSON text column."""
    packed = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.withColumn(name, packed).drop(*[c for c in cols if c != name])


def _sorted_map(key: Column | str, value: Column) -> Column:
    """Aggregate (key, value) entries into a map in key order."""
    k = F.col(key) if isinstance(key, str) else key
    entries = F.collect_list(F.struct(k.alias("k"), value.alias("v")))
    # maps inside the value cannot be compared, so order by the key alone
    by_key = F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    return F.map_from_entries(by_key)


def nested_totals(df: DataFrame, keys: Sequence[str], parent: str, child: str, value: str, name: str = "documento") -> DataFrame:
    """{tipo, value, hijos:[{tipo, value}]} per key and parent, children in name order."""
    children = df.groupBy(*keys, parent, child).agg(F.sum(value).alias("__v"))
    docs = children.groupBy(*keys, parent).agg(
        F.sum("__v").alias("__total"),
        F.array_sort(F.collect_list(F.struct(F.col(child).alias("tipo"), F.col("__v").alias("value")))).alias("__kids"),
    )
    doc = F.struct(F.col(parent).alias("tipo"), F.col("__total").alias("value"), F.col("__kids").alias("hijos"))
    return docs.select(*keys, F.to_json(doc).alias(name))


def _leaf(source: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Attach (name, source) of each variable; the dictionary has columns id, nombre, fuente."""
    dic = dictionary.select(F.col("id").alias("variable"), "nombre", "fuente").dropDuplicates(["variable"])
    return source.join(dic, "variable", "left")


def _one_document(per_plot: DataFrame, info: DataFrame, place: Sequence[str]) -> DataFrame:
    """Combine {plot: {values, info}} of a place into one JSON text."""
    plot = F.struct(F.col("__values").alias("values"), F.col("info"))
    return (
        per_plot.join(info, "plot", "left")
        .groupBy(*place)
        .agg(F.to_json(_sorted_map("plot", plot)).alias("values"))
    )


def profile_document(
    long: DataFrame, dictionary: DataFrame, plots: DataFrame, place: Sequence[str] = ("nivel", "nivel_clave")
) -> DataFrame:
    """{plot: {values: {var: {values, name, source}}, info}} per place.

    ``long`` has place, plot, variable, valor; ``plots`` has plot, info. Rows without value, or whose
    variable is not in the dictionary, are left out.
    """
    rows = _leaf(long, dictionary).where(F.col("valor").isNotNull() & F.col("nombre").isNotNull() & F.col("fuente").isNotNull())
    one = rows.groupBy(*place, "plot", "variable").agg(F.max(F.struct(F.col("valor").cast("string").alias("values"), F.col("nombre").alias("name"), F.col("fuente").alias("source"))).alias("__leaf"))
    per_plot = one.groupBy(*place, "plot").agg(_sorted_map("variable", F.col("__leaf")).alias("__values"))
    return _one_document(per_plot, plots.select("plot", "info"), place)


def series_document(
    long: DataFrame,
    dictionary: DataFrame,
    plots: DataFrame,
    place: Sequence[str] = ("nivel", "nivel_clave"),
    date: str = "fecha",
) -> DataFrame:
    """{plot: {values: {date: {values: {var: {values, name, source}}}}, info}} per place."""
    rows = _leaf(long, dictionary).where(F.col("valor").isNotNull() & F.col("nombre").isNotNull() & F.col("fuente").isNotNull())
    one = rows.groupBy(*place, "plot", date, "variable").agg(F.max(F.struct(F.col("valor").cast("string").alias("values"), F.col("nombre").alias("name"), F.col("fuente").alias("source"))).alias("__leaf"))
    per_date = one.groupBy(*place, "plot", date).agg(_sorted_map("variable", F.col("__leaf")).alias("__vars"))
    per_plot = per_date.groupBy(*place, "plot").agg(
        _sorted_map(F.col(date).cast("string"), F.struct(F.col("__vars").alias("values"))).alias("__values")
    )
    return _one_document(per_plot, plots.select("plot", "info"), place)


def map_document(
    long: DataFrame,
    plots: DataFrame,
    place: Sequence[str] = ("nivel", "nivel_clave"),
    element: str = "element_id",
    shared_by: str | None = None,
    members: DataFrame | None = None,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """{plot: {values: {element: {var: {valor}}}, info}} per place.

    With ``shared_by`` (say the state) the values are collected once per state and plot and then given to
    every place in ``members`` (place columns plus ``shared_by``). ``read`` turns documents into rows of the owner's columns
    and others: a shared document is read once, and its rows are given to the places in its stead. Places are dealt out by
    number, as few states can have many places and each place gets all rows of its state.
    """
    owner = [shared_by] if shared_by else list(place)
    one = long.where(F.col("valor").isNotNull()).groupBy(*owner, "plot", element, "variable").agg(
        F.max(F.col("valor").cast("string")).alias("__v")
    )
    per_element = one.groupBy(*owner, "plot", element).agg(
        _sorted_map("variable", F.struct(F.col("__v").alias("valor"))).alias("__vars")
    )
    per_plot = per_element.groupBy(*owner, "plot").agg(
        _sorted_map(F.col(element).cast("string"), F.col("__vars")).alias("__values")
    )
    docs = _one_document(per_plot, plots.select("plot", "info"), owner)
    docs = read(docs) if read else docs
    if shared_by:
        kept = [c for c in docs.columns if c != shared_by]
        packed = pack_blocks(docs, [shared_by], F.struct(*kept), [F.to_json(F.struct(*kept))])
        met = deal_out(members.select(*place, shared_by).distinct(), packed, [shared_by])
        docs = met.select(*place, F.explode("items").alias("__item")).select(*place, "__item.*")
    return docs


def program_document(df: DataFrame, place: Sequence[str], program: str, period: str, count: str, amount: str) -> DataFrame:
    """{program: {period: {beneficiarios, monto}}} per place."""
    one = df.groupBy(*place, program, period).agg(
        F.max(F.struct(F.col(count).alias("beneficiarios"), F.col(amount).alias("monto"))).alias("__leaf")
    )
    per_program = one.groupBy(*place, program).agg(
        _sorted_map(F.col(period).cast("string"), F.col("__leaf")).alias("__periods")
    )
    return per_program.groupBy(*place).agg(F.to_json(_sorted_map(program, F.col("__periods"))).alias("values"))


def profile_table(**documents: DataFrame) -> DataFrame:
    """Union of document tables as (tipo, nivel, nivel_clave, values); the argument name is the type."""
    out = None
    for tipo, d in documents.items():
        part = d.select(F.lit(tipo).alias("tipo"), "nivel", "nivel_clave", "values")
        out = part if out is None else out.unionByName(part)
    return out


def features(df: DataFrame, wkt: str, props: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON Feature text per row: the form to write as a line-delimited file of any size."""
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":'),
        F.coalesce(wkt_to_geojson(wkt), F.lit("null")),
        F.lit(',"properties":'),
        F.to_json(F.struct(*props), {"ignoreNullFields": "false"}),
        F.lit("}"),
    )
    return df.select(*keep, feature.alias("feature"))


def feature_collection(
    df: DataFrame, wkt: str, props: Sequence[str], by: Sequence[str] = (), size: int = 20_000
) -> DataFrame:
    """GeoJSON FeatureCollections per group in sorted order: (by, part, collection) with at most ``size`` features a part."""
    parts = sorted_parts(features(df, wkt, props, by), by, ["feature"], size)
    body = F.array_join(F.array_sort(F.collect_list("feature")), ",")
    collection = F.concat(
        F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:4326"}},"features":['), body, F.lit("]}")
    )
    return parts.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n_features"), collection.alias("collection"))


# Fields of the plot metadata JSON.
PLOT_METADATA = (
    "struct<vars:array<string>,schema:string,table_name:string,title:string,palette:string,subtext:string,section:string>"
)


def explode_plot_vars(plots: DataFrame, dictionary: DataFrame, metadata: str = "metadata") -> DataFrame:
    """One row per plot variable with its dictionary entry; a variable not in the dictionary keeps nulls."""
    parsed = plots.withColumn("__m", F.from_json(metadata, PLOT_METADATA))
    rows = parsed.select(
        *[c for c in plots.columns if c != metadata],
        F.explode("__m.vars").alias("variable"),
        "__m.schema", "__m.table_name", "__m.title", "__m.palette", "__m.subtext", "__m.section",
    )
    return _leaf(rows, dictionary)


def metadata_label(nivel: str = "nivel", anio: str = "anio") -> Column:
    """Source note by level, with the year for states."""
    return F.when(
        F.col(nivel) == "estatal",
        F.concat(F.lit("Estimaciones del CONEVAL con base en ENIGH "), F.col(anio).cast("string")),
    ).otherwise("Censo de Población y Vivienda 2010, INEGI")


def plot_table(df: DataFrame, level: str, plot: str, key: str, cols: Sequence[str], element: Sequence[str]) -> DataFrame:
    """Long plot rows: the variable name as axis x and its value as axis y, one pair per place and column.

    ``element_id`` joins the ``element`` columns and the variable, so it is stable between runs.
    """
    texts = df.select(
        F.col(key).cast("string").alias("nivel_clave"),
        F.concat_ws("-", *[F.col(e).cast("string") for e in element]).alias("__e"),
        *[F.col(c).cast("string").alias(c) for c in cols],
    )
    long = texts.unpivot(["nivel_clave", "__e"], list(cols), "variable", "valor")
    pair = F.explode(
        F.array(
            F.struct(F.lit("x").alias("vartype"), F.lit("variable").alias("varname"), F.col("variable").alias("value")),
            F.struct(F.lit("y").alias("vartype"), F.lit("valor").alias("varname"), F.col("valor").alias("value")),
        )
    )
    return long.select(
        F.lit(level).alias("nivel"),
        "nivel_clave",
        F.lit(plot).alias("plot"),
        F.concat_ws("-", "__e", "variable").alias("element_id"),
        pair.alias("p"),
    ).select("nivel", "nivel_clave", "plot", "element_id", "p.*")
