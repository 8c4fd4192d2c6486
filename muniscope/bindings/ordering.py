"""Windows, ranks and ordered selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from .core import query

_CHANGE = "SELECT event_id, user_id, {f} AS value_dif FROM (SELECT event_id, user_id, value AS v, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)"


@query("relative_change", _CHANGE.format(f="round((v - p) / nullif(v, 0), 8)"))
def _(t):
    out = W.relative_change(t.events, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", "user_id", F.round("value_dif", 8).alias("value_dif"))


@query("relative_change_previous", _CHANGE.format(f="round((v - p) / nullif(p, 0), 8)"))
def _(t):
    out = W.relative_change(t.events, ["user_id"], ["ts", "event_id"], "value", denominator="previous", buckets=6)
    return out.select("event_id", "user_id", F.round("value_dif", 8).alias("value_dif"))


@query("rank_by", "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS ranking FROM customer")
def _(t):
    return W.rank_by(t.customer, "c_acctbal", ["c_custkey"]).select("c_custkey", "ranking")


@query("rank_by_ranges", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ranking FROM lineitem")
def _(t):
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return W.rank_by(t.lineitem.select(*ties, "l_quantity"), "l_quantity", ties, buckets=7).select(*ties, "ranking")


@query("average_rank", """
SELECT p_partkey, p_brand, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS rango,
  rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS rango_marca FROM part""")
def _(t):
    df = W.average_rank(t.part.select("p_partkey", "p_brand", "p_size"), "p_size", name="rango", buckets=5)
    return W.average_rank(df, "p_size", ["p_brand"], "rango_marca", descending=True).drop("p_size")


@query("minmax", """
WITH e AS (SELECT c_custkey, c_nationkey, (c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) AS u,
  (c_acctbal - min(c_acctbal) OVER w) / nullif(max(c_acctbal) OVER w - min(c_acctbal) OVER w, 0) AS g FROM customer WINDOW w AS (PARTITION BY c_nationkey))
SELECT c_custkey, u AS c_acctbal_i, 1 - greatest(least(u, 0.9999e0), 0.0001e0) AS invertido, g AS c_acctbal_g FROM e""")
def _(t):
    df = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    df = W.minmax(df, ["c_acctbal"])
    df = W.minmax(df, ["c_acctbal"], clamp=True, invert=True, suffix="_v").withColumnRenamed("c_acctbal_v", "invertido")
    return W.minmax(df, ["c_acctbal"], by=["c_nationkey"], suffix="_g").drop("c_nationkey", "c_acctbal")


@query("zscore", """
SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 8) AS z, round((c_acctbal - avg(c_acctbal) OVER w) / nullif(stddev_samp(c_acctbal) OVER w, 0), 8) AS zg
FROM customer WINDOW w AS (PARTITION BY c_mktsegment)""")
def _(t):
    df = W.zscore(t.customer, ["c_acctbal"]).withColumnRenamed("c_acctbal_z", "z")
    df = W.zscore(df, ["c_acctbal"], by=["c_mktsegment"], suffix="_zg")
    return df.select("c_custkey", F.round("z", 8).alias("z"), F.round("c_acctbal_zg", 8).alias("zg"))


_LABEL = "CASE WHEN event_id % 5 = 0 THEN event_type WHEN event_id % 5 = 1 THEN ' ' END"
_FILL = "SELECT event_id, user_id, last_value(CASE WHEN trim(l) <> '' THEN l END IGNORE NULLS) OVER ({w} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS etiqueta FROM (SELECT event_id, user_id, " + _LABEL + " AS l FROM events)"


@query("fill_down", _FILL.format(w=""))
def _(t):
    df = t.events.selectExpr("event_id", "user_id", f"{_LABEL} AS etiqueta")
    return W.fill_down(df, ["event_id"], ["etiqueta"], buckets=8)


@query("fill_down_by", _FILL.format(w="PARTITION BY user_id"))
def _(t):
    df = t.events.selectExpr("event_id", "user_id", f"{_LABEL} AS etiqueta")
    return W.fill_down(df, ["event_id"], ["etiqueta"], ["user_id"])


@query("group_size", "SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey) AS n_grupo FROM customer")
def _(t):
    return W.group_size(t.customer.select("c_custkey", "c_nationkey"), ["c_nationkey"]).drop("c_nationkey")


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return W.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("top1", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return W.top1(t.orders, ["o_custkey"], "o_totalprice", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("sort_output", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def _(t):
    return W.sort_output(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), "s_acctbal", "s_suppkey")


@query("select_until_target", """
SELECT c_custkey, c_nationkey FROM (SELECT c_custkey, c_nationkey, coalesce(sum(w) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS antes, sum(w) OVER (PARTITION BY c_nationkey) AS total
  FROM (SELECT *, 1 + c_custkey % 9 AS w FROM customer)) WHERE antes < total * 0.25e0""")
def _(t):
    df = t.customer.withColumn("w", 1 + F.col("c_custkey") % 9)
    return W.select_until_target(df, ["c_acctbal", "c_custkey"], "w", 0.25, ["c_nationkey"]).select("c_custkey", "c_nationkey")


@query("select_until_target_overall", """
SELECT o_orderkey FROM (SELECT o_orderkey, coalesce(sum(w) OVER (ORDER BY o_totalprice, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS antes, sum(w) OVER () AS total
  FROM (SELECT *, 1 + o_custkey % 9 AS w FROM orders)) WHERE antes < total * 0.4e0""")
def _(t):
    df = t.orders.withColumn("w", 1 + F.col("o_custkey") % 9)
    return W.select_until_target(df, ["o_totalprice", "o_orderkey"], "w", 0.4, buckets=9).select("o_orderkey")
