"""Reshaping and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape as R
from .core import query


@query("gather", """
SELECT l_orderkey, l_linenumber, variable, valor FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT INCLUDE NULLS (valor FOR variable IN (l_quantity, l_discount, l_tax))""")
def _(t):
    return R.gather(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), "variable", "valor", ["l_orderkey", "l_linenumber"])


def _month_sum(i):
    return F.sum(F.when(F.month("o_orderdate") == i, F.col("o_totalprice")))


@query("months_long", "".join([
    "WITH m AS (SELECT o_orderstatus, CAST(month(o_orderdate) AS INT) AS mes_num, round(sum(o_totalprice), 2) AS monto FROM orders GROUP BY 1, 2) ",
    "SELECT o_orderstatus, list_extract(['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'], mes_num) AS mes, mes_num, monto FROM m",
]))
def _(t):
    wide = t.orders.groupBy("o_orderstatus").agg(*[F.round(_month_sum(i), 2).alias(m) for i, m in enumerate(R.MONTH_COLUMNS, 1)])
    return R.months_long(wide, ["o_orderstatus"], "monto")


@query("weeks_long", """
SELECT o_orderkey, CAST(s AS INT) AS semana, CASE WHEN (o_orderkey + s) % 4 = 0 THEN NULL ELSE o_totalprice + s END AS precio FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)""")
def _(t):
    weeks = [
        F.when((F.col("o_orderkey") + i) % 4 == 0, " --").otherwise((F.col("o_totalprice") + i).cast("string")).alias(f"sem_{i}") for i in range(1, 6)
    ]
    return R.weeks_long(t.orders.select("o_orderkey", *weeks, F.lit("9").alias("prom_mes")), ["o_orderkey"])


@query("spread", """
SELECT o_custkey, any_value(v) FILTER (o_orderstatus = 'F') AS F, any_value(v) FILTER (o_orderstatus = 'O') AS O, any_value(v) FILTER (o_orderstatus = 'P') AS P
FROM (SELECT o_custkey, o_orderstatus, max(o_totalprice) AS v FROM orders GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    long = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.max("o_totalprice").alias("v"))
    return R.spread(long, "o_orderstatus", "v", ["o_custkey"], ["F", "O", "P"])


@query("spread_of_gather", "SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_tax) AS l_tax FROM lineitem GROUP BY 1, 2")
def _(t):
    base = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_tax").alias("l_tax"))
    ids = ["l_orderkey", "l_linenumber"]
    return R.spread(R.gather(base, "k", "v", ids), "k", "v", ids, ["l_quantity", "l_tax"])


@query("colpivot", """
SELECT o_custkey, round(sum(o_totalprice) FILTER (o_orderstatus = 'F' AND anio = 1996), 2) AS "F_1996", round(sum(o_totalprice) FILTER (o_orderstatus = 'O' AND anio = 1997), 2) AS "O_1997"
FROM (SELECT *, year(o_orderdate) AS anio FROM orders) GROUP BY 1""")
def _(t):
    df = t.orders.withColumn("anio", F.year("o_orderdate"))
    return R.colpivot(df, ["o_custkey"], ["o_orderstatus", "anio"], F.round(F.sum("o_totalprice"), 2), [("F", 1996), ("O", 1997)])


@query("transpose_block", """
WITH b AS (SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS clientes, min(o_orderkey) AS primero FROM orders GROUP BY 1)
SELECT v AS variable, any_value(x) FILTER (o_orderstatus = 'F') AS F, any_value(x) FILTER (o_orderstatus = 'O') AS O, any_value(x) FILTER (o_orderstatus = 'P') AS P
FROM (SELECT o_orderstatus, unnest(['n', 'clientes', 'primero']) AS v, unnest([CAST(n AS VARCHAR), CAST(clientes AS VARCHAR), CAST(primero AS VARCHAR)]) AS x FROM b) GROUP BY 1""")
def _(t):
    block = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("clientes"), F.min("o_orderkey").alias("primero"))
    return R.transpose_block(block, "o_orderstatus", ["F", "O", "P"])


@query("union_aligned", "SELECT c_nationkey AS pais, c_acctbal < 0 AS debe, 'x' AS origen FROM customer UNION SELECT s_nationkey, s_acctbal < 0, 'x' FROM supplier")
def _(t):
    return R.union_aligned([
        (t.customer, {"pais": "c_nationkey", "debe": F.col("c_acctbal") < 0, "origen": F.lit("x")}),
        (t.supplier, {"origen": F.lit("x"), "pais": "s_nationkey", "debe": F.col("s_acctbal") < 0}),
    ])


@query("union_all", "SELECT c_nationkey AS pais, c_custkey AS c, CAST(NULL AS BIGINT) AS s FROM customer UNION ALL SELECT s_nationkey, NULL, s_suppkey FROM supplier")
def _(t):
    return R.union_all([
        t.customer.select(F.col("c_nationkey").alias("pais"), F.col("c_custkey").alias("c")),
        t.supplier.select(F.col("s_nationkey").alias("pais"), F.col("s_suppkey").alias("s")),
    ])


@query("new_rows", "SELECT l_partkey, l_suppkey FROM lineitem EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber > 2")
def _(t):
    cols = ["l_partkey", "l_suppkey"]
    return R.new_rows(t.lineitem.select(*cols), t.lineitem.where("l_linenumber > 2").select(*cols))


@query("new_rows_by_key", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def _(t):
    old = t.lineitem.where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.new_rows(t.orders.select("o_orderkey", "o_orderstatus"), old, ["o_orderkey"])


@query("common_ids", """
WITH a AS (SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber AS id FROM lineitem), n AS (SELECT l_suppkey, count(DISTINCT l_returnflag) AS n FROM a GROUP BY 1),
h AS (SELECT l_suppkey, id, count(*) AS h FROM a GROUP BY 1, 2)
SELECT l_suppkey, CAST(0 AS INT) AS part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM h JOIN n USING (l_suppkey) WHERE h = n GROUP BY 1""")
def _(t):
    rows = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.collect_set("l_linenumber").alias("arr"))
    out = R.common_ids(rows, ["l_suppkey"], "l_returnflag", "arr")
    return out.withColumn("ids", F.array_join("ids", ","))


@query("reindex", "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS falta, o_orderstatus FROM orders")
def _(t):
    return R.reindex(t.orders, ["o_orderkey", "falta", "o_orderstatus"])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query("rename_regex", "SELECT p_partkey AS clave, p_brand AS marca, p_size AS tam FROM part")
def _(t):
    return R.rename_regex(t.part.select("p_partkey", "p_brand", "p_size"), [("^p_", ""), ("partkey", "clave"), ("brand", "marca"), ("size", "tam")])


@query("select_period_columns", "SELECT o_custkey, round(sum(o_totalprice) FILTER (year(o_orderdate) = 1996), 2) AS monto, count(*) FILTER (year(o_orderdate) = 1996) AS n FROM orders GROUP BY 1")
def _(t):
    year = F.year("o_orderdate")
    wide = t.orders.groupBy("o_custkey").agg(
        *[F.round(F.sum(F.when(year == y, F.col("o_totalprice"))), 2).alias(f"monto_{y}") for y in (1995, 1996)],
        *[F.count_if(year == y).alias(f"n_{y}") for y in (1995, 1996)],
    )
    return R.select_period_columns(wide, ["o_custkey"], "1996")
