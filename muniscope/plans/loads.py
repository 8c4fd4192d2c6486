"""Raw loads: text file to period-stamped table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geography import geo_key
from ..functions.text import digits_or_null, pad_left
from ..operators.documents import pack_json
from ..operators.quality import drop_blank_rows, drop_exact_duplicates, nullify_sentinels, stamp
from ..operators.reshape import gather, months_long, rename_regex, weeks_long
from ..operators.windows import fill_down
from .registry import preparer


def raw_load(df: DataFrame, data_date: str, suffix: str, ts, distinct: bool = False) -> DataFrame:
    """Missing-value texts to null, blank rows dropped, load time and period added."""
    out = drop_blank_rows(nullify_sentinels(df))
    if distinct:
        out = drop_exact_duplicates(out)
    return stamp(out, ts, data_date, suffix)


@preparer("delitos_comun")
def delitos_comun(df: DataFrame) -> DataFrame:
    """Months in columns to rows, keys padded."""
    ids = [c for c in df.columns if c not in set(_months(df))]
    long = months_long(df, ids, "incidencia_delictiva").drop("mes_num")
    return long.withColumns({"Clave_Ent": geo_key("Clave_Ent"), "Cve. Municipio": pad_left(F.col("`Cve. Municipio`").cast("string"), 5)})


@preparer("cfe")
def cfe(df: DataFrame) -> DataFrame:
    ids = [c for c in df.columns if c not in set(_months(df))]
    return months_long(df, ids, "usuarios").drop("mes_num")


def _months(df: DataFrame) -> list[str]:
    from ..operators.reshape import MONTH_COLUMNS

    return [c for c in df.columns if c in MONTH_COLUMNS]


def grain_prices(df: DataFrame, order: str) -> DataFrame:
    """Product named only on its first row, weeks in columns, ``--`` for no price. ``order`` is the row order."""
    filled = fill_down(df, [order], ["producto"])
    weeks = [c for c in df.columns if c.startswith("sem_")]
    ids = [c for c in df.columns if c not in {*weeks, "prom_mes"}]
    return weeks_long(filled, ids)


@preparer("precios_granos")
def precios_granos(df: DataFrame) -> DataFrame:
    """``grain_prices`` in the order of the file's rows."""
    return grain_prices(df.withColumn("__row", F.monotonically_increasing_id()), "__row").drop("__row")


@preparer("asm")
def asm(df: DataFrame) -> DataFrame:
    """Column names trimmed and lower-cased."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


@preparer("evaluaciones")
def evaluaciones(df: DataFrame) -> DataFrame:
    """Activities in columns to rows; report columns shortened and packed into one JSON column."""
    activities = [c for c in df.columns if c.startswith("ACTIVIDAD_")]
    long = gather(df, "ACTIVIDAD", "EDO_ACTIVIDAD", [c for c in df.columns if c not in activities], activities)
    long = long.withColumn("ACTIVIDAD", F.regexp_replace("ACTIVIDAD", "ACTIVIDAD_", ""))
    short = rename_regex(long, [(r"^INFORME (.*)$", r"\1__i"), (r" EN TIEMPO(?=.*__i)", "T"), (r" PRESENTADO(?=.*__i)", "P")])
    reports = [c for c in short.columns if c.endswith("__i")]
    plain = short.withColumnsRenamed({c: c.removesuffix("__i") for c in reports})
    return pack_json(plain, [c.removesuffix("__i") for c in reports], "INFORMES")


@preparer("cuis_39_9")
def cuis_39_9(df: DataFrame) -> DataFrame:
    return nullify_sentinels(df).withColumn("TIE_CURP", digits_or_null("TIE_CURP"))


@preparer("coneval_municipios")
def coneval_municipios(df: DataFrame) -> DataFrame:
    out = nullify_sentinels(df)
    return out.withColumns(
        {"Clave de entidad": pad_left(F.trim("Clave de entidad"), 2), "Clave de municipio": pad_left(F.trim("Clave de municipio"), 5)}
    )
