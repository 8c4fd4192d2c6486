"""Table-driven recoding and renaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .projections import cast_columns

RECODE_COLUMNS = ["variable_inicial", "variable_final", "valor_inicial", "valor_final"]


def recode(df: DataFrame, table: str, recode_df: DataFrame) -> DataFrame:
    """Recode and rename the variables listed for ``table``.

    ``recode_df``: tabla, variable_inicial, variable_final, valor_inicial, valor_final. A listed value gets
    its new value (the smallest one stated, should there be several), an unlisted one becomes null; a variable
    without initial values is only renamed. Each variable is joined to its own list, of any length. Only the
    names of variables that ``df`` has come to the driver: one row for each column that is made.
    """
    mine = recode_df.where((F.col("tabla") == table) & F.col("variable_final").isNotNull()).select(*RECODE_COLUMNS)
    mine = mine.where(F.col("variable_inicial").isin(df.columns))
    made = mine.groupBy("variable_inicial", "variable_final").agg(F.count("valor_inicial").alias("n")).collect()
    made = sorted(made, key=lambda r: (r["variable_inicial"], r["variable_final"]))
    out, new = df, []
    for i, r in enumerate(made):
        old, name = r["variable_inicial"], r["variable_final"]
        if not r["n"]:
            new.append(F.col(f"`{old}`").alias(name))
            continue
        listed = (F.col("variable_inicial") == old) & (F.col("variable_final") == name) & F.col("valor_inicial").isNotNull()
        values = mine.where(listed).groupBy(F.col("valor_inicial").alias(f"__from{i}")).agg(F.min("valor_final").alias(f"__to{i}"))
        out = out.join(values, F.col(f"`{old}`").cast("string") == F.col(f"__from{i}"), "left")
        new.append(F.col(f"__to{i}").alias(name))
    gone = {r["variable_inicial"] for r in made} | {r["variable_final"] for r in made}
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone], *new)


def cast_recoded(df: DataFrame, table: str, recode_df: DataFrame) -> DataFrame:
    """Cast the recoded variables of ``table`` to int."""
    names = recode_df.where((F.col("tabla") == table) & F.col("variable_final").isin(df.columns)).select("variable_final").distinct()
    return cast_columns(df, ints=sorted(r[0] for r in names.collect()))
