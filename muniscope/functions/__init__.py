"""Column expressions. Every function takes columns or names and returns a Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: "Column | str") -> Column:
    return c if isinstance(c, Column) else F.col(c)
