"""Registry of checked queries: each reads the given tables and, where SQL can say it, has a SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """Lazy access to the tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def shape(self, name: str) -> DataFrame:
        """A survey-like table derived from a given table (see ``shapes``)."""
        from .shapes import SHAPES

        table, columns = SHAPES[name]
        return getattr(self, table).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])

    def workspace(self, label: str) -> str:
        """A fresh folder that driver and executors share."""
        return f"{shared_folder(self.spark)}/{label}-{uuid4().hex}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function of ``Tables`` with its optional SQL twin."""
    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def shape_sql(name: str) -> str:
    from .shapes import SHAPES

    table, columns = SHAPES[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {table}"
