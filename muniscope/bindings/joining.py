"""Joins and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import joins as J
from ..operators import matching as M
from ..plans.semantic import recommend_programs
from .core import query, shape_sql

_D = "2 * 6371.0088e0 * asin(least(1.0e0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2))))"


@query("assemble", """
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
f AS (SELECT o_custkey AS c_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f_total FROM orders GROUP BY 1)
SELECT c_custkey, c_nationkey, n_orders, round(f_total, 2) AS f_total FROM customer LEFT JOIN o USING (c_custkey) LEFT JOIN f USING (c_custkey)""")
def _(t):
    key = F.col("o_custkey").alias("c_custkey")
    counts = t.orders.groupBy(key).agg(F.count(F.lit(1)).alias("n_orders"))
    final = t.orders.groupBy(key).agg(F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2).alias("f_total"))
    return J.assemble(t.customer.select("c_custkey", "c_nationkey"), [counts, final], "c_custkey")


@query("natural_left", """
SELECT n_nationkey, n_regionkey, n_name, r_name FROM nation LEFT JOIN (SELECT r_regionkey + 2 AS n_regionkey, r_name FROM region) USING (n_regionkey)""")
def _(t):
    region = t.region.select((F.col("r_regionkey") + 2).alias("n_regionkey"), "r_name")
    return J.natural_left(t.nation, region)


@query("household_join", """
WITH e AS (SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS ingreso FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l_quantity, round(ingreso, 2) AS ingreso FROM lineitem l LEFT JOIN e ON l.l_orderkey = e.l_orderkey AND l.l_linenumber = e.l_linenumber""")
def _(t):
    keys = ["l_orderkey", "l_linenumber"]
    income = t.lineitem.groupBy(*keys).agg(F.round(F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice"))), 2).alias("ingreso"))
    return t.lineitem.select(*keys, "l_quantity").join(income, keys, "left")


@query("join_codes", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def _(t):
    codes = t.nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return J.join_codes(t.customer.select("c_custkey", "c_nationkey"), codes, "c_nationkey").drop("c_nationkey")


@query("outer_assemble", """
WITH a AS (SELECT c_nationkey + 3 AS k, count(*) AS nc FROM customer GROUP BY 1),
b AS (SELECT s_nationkey - 2 AS k, count(*) AS ns FROM supplier GROUP BY 1),
c AS (SELECT n_nationkey AS k, n_name FROM nation)
SELECT k, nc, ns, n_name FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)""")
def _(t):
    a = t.customer.groupBy((F.col("c_nationkey") + 3).alias("k")).agg(F.count(F.lit(1)).alias("nc"))
    b = t.supplier.groupBy((F.col("s_nationkey") - 2).alias("k")).agg(F.count(F.lit(1)).alias("ns"))
    c = t.nation.select(F.col("n_nationkey").alias("k"), "n_name")
    return J.outer_assemble([a, b, c], "k")


@query("left_join_between", """
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey AS cliente__c_custkey, c_name AS cliente__c_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice BETWEEN 1000 AND 200000""")
def _(t):
    left, right = t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer.select("c_custkey", "c_name")
    return J.left_join_between(left, right, "o_custkey", "c_custkey", ("o_totalprice", 1000, 200000), "cliente")


@query("left_join_discard", """
SELECT o_orderkey, k, v, c_name FROM (SELECT o_orderkey, o_custkey AS k, o_totalprice AS v FROM orders) LEFT JOIN (SELECT c_custkey AS k2, c_name FROM customer) ON k = k2""")
def _(t):
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    right = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), "c_name")
    return J.left_join_between(left, right, "k", "k", append_names=False)


@query("downscale", """
WITH r AS (SELECT n_regionkey, n_nationkey FROM nation), s AS (SELECT n_regionkey, round(avg(s_acctbal), 4) AS saldo FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT n_nationkey, n_regionkey, saldo FROM r LEFT JOIN s USING (n_regionkey)""")
def _(t):
    nations = t.nation.select("n_regionkey", "n_nationkey")
    parents = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.round(F.avg("s_acctbal"), 4).alias("saldo"))
    return J.downscale(nations, parents, "n_regionkey")


@query("name_to_key", """
SELECT p_partkey, p_name, clave FROM part LEFT JOIN (SELECT lower(CASE WHEN p_size < 20 THEN p_name ELSE p_name || ' bis' END) AS n, min(p_partkey) AS clave FROM part GROUP BY 1) ON lower(p_name) = n""")
def _(t):
    names = t.part.groupBy(F.when(F.col("p_size") < 20, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" bis"))).alias("p_name")).agg(F.min("p_partkey").alias("clave"))
    shouted = t.part.select("p_partkey", F.upper("p_name").alias("p_name"))
    return J.name_to_key(shouted, names, "p_name", "clave", X.clean_name).withColumn("p_name", F.lower("p_name"))


@query("add_group_value", """
SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS total, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return J.add_group_value(df, ["o_custkey"], total=F.round(F.sum("o_totalprice"), 2), n=F.count(F.lit(1))).drop("o_totalprice")


@query("with_total", """
WITH a AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), b AS (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1)
SELECT c_nationkey, c_mktsegment, n, total, n / total AS parte FROM a LEFT JOIN b USING (c_nationkey)""")
def _(t):
    parts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    totals = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"))
    return J.with_total(parts, totals, "c_nationkey", "n", "total", "parte")


@query("missing_keys", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def _(t):
    done = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.missing_keys(t.customer.select("c_custkey", "c_name"), done, "c_custkey")


@query("restrict_to", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def _(t):
    done = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.restrict_to(t.customer.select("c_custkey", "c_name"), done, "c_custkey")


@query("donor_fill", """
WITH v AS (SELECT s_nationkey * 2 AS k, round(max(s_acctbal), 2) AS v FROM supplier GROUP BY 1),
g AS (SELECT n_nationkey + 1 AS k, v.v AS dv FROM nation JOIN v ON v.k = n_nationkey)
SELECT k, coalesce(v.v, dv) AS v FROM v FULL JOIN g USING (k)""")
def _(t):
    values = t.supplier.groupBy((F.col("s_nationkey") * 2).alias("k")).agg(F.round(F.max("s_acctbal"), 2).alias("v"))
    donors = t.nation.select((F.col("n_nationkey") + 1).alias("k"), F.col("n_nationkey").alias("donor"))
    return J.donor_fill(values, "k", "v", donors)


@query("pair_distances", f"""
WITH a AS ({shape_sql("customer_place")}), b AS ({shape_sql("supplier_place")})
SELECT c_custkey, count(*) AS n, round(min(d), 6) AS cercano, round(avg(d), 6) AS medio, round(max(d), 6) AS lejano FROM (SELECT a.c_custkey, {_D} AS d FROM a CROSS JOIN b) GROUP BY 1""")
def _(t):
    rows = J.pair_distances(t.shape("customer_place"), t.shape("supplier_place"), "c_custkey", "s_suppkey")
    rows = rows.select("c_custkey", F.col("distances.km").alias("km"))
    per_block = rows.select("c_custkey", F.size("km").alias("n"), F.array_min("km").alias("lo"), F.array_max("km").alias("hi"), F.aggregate("km", F.lit(0.0), lambda a, b: a + b).alias("s"))
    return per_block.groupBy("c_custkey").agg(
        F.sum("n").alias("n"), F.round(F.min("lo"), 6).alias("cercano"), F.round(F.sum("s") / F.sum("n"), 6).alias("medio"), F.round(F.max("hi"), 6).alias("lejano")
    )


# the keyword list is derived from the texts' own languages and sources
_PLAIN = "regexp_replace(lower(text), '[^a-z]+', ' ', 'g')"


def _keywords(t):
    stem = F.when(F.col("lang") == "en", "tion").when(F.col("lang") == "fr", "eaux?").when(F.col("lang") == "es", "ci.n").otherwise("un")
    return t.documents.select("lang").distinct().select(F.col("lang").alias("id"), F.array(stem, F.concat(stem, F.lit(" "))).alias("palabras"))


_KEYWORDS = """SELECT id, unnest([w, w || ' ']) AS palabra FROM (SELECT DISTINCT lang AS id, CASE lang WHEN 'en' THEN 'tion' WHEN 'fr' THEN 'eaux?' WHEN 'es' THEN 'ci.n' ELSE 'un' END AS w FROM documents)"""


@query("keyword_match", f"""
WITH k AS ({_KEYWORDS}) SELECT DISTINCT doc_id, id FROM (SELECT doc_id, {_PLAIN} AS txt FROM documents) JOIN k ON regexp_matches(txt, palabra)""")
def _(t):
    texts = t.documents.select("doc_id", F.regexp_replace(F.lower("text"), "[^a-z]+", " ").alias("txt"))
    words = _keywords(t).select("id", F.explode("palabras").alias("palabra"))
    return M.keyword_match(texts, words, "txt", "doc_id", "id")


@query("matches_to_array", """
SELECT o_custkey, CAST(0 AS INT) AS part, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS ids FROM orders GROUP BY 1""")
def _(t):
    out = M.matches_to_array(t.orders, "o_custkey", "o_orderpriority")
    return out.withColumn("ids", F.array_join("ids", ","))


@query("recommend_programs", f"""
WITH k AS ({_KEYWORDS}), p AS (SELECT doc_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(translate(source || '. ' || text, '{X.ACCENTED}', '{X.PLAIN}'), '\\p{{Mn}}', '', 'g'), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '[^a-zA-Z]+', ' ', 'g'))) AS txt FROM documents)
SELECT id, CAST(0 AS INT) AS part, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS programas FROM p JOIN k ON regexp_matches(txt, palabra) GROUP BY 1""")
def _(t):
    out = recommend_programs(t.documents, _keywords(t), "doc_id", "source", "text", words="palabras")
    return out.withColumn("programas", F.array_join("programas", ","))


@query("fuzzy_lookup", """
WITH dim AS (SELECT p_brand, CASE WHEN p_size <= 25 THEN p_name ELSE reverse(p_name) END AS p_name, min(p_partkey) AS clave FROM part GROUP BY 1, 2),
asked AS (SELECT DISTINCT p_brand, replace(p_name, 'e', 'ee') AS n FROM part),
s AS (SELECT asked.p_brand, n, dim.p_name AS dn, clave, 1.0e0 - levenshtein(n, dim.p_name) / greatest(length(n), length(dim.p_name)) AS sim FROM asked JOIN dim USING (p_brand)),
best AS (SELECT *, row_number() OVER (PARTITION BY p_brand, n ORDER BY sim DESC, dn, clave) AS rn FROM s)
SELECT p.p_partkey, p.p_brand, replace(p.p_name, 'e', 'ee') AS p_name, CASE WHEN sim > 0.75 THEN clave END AS clave, CASE WHEN sim > 0.75 THEN sim END AS similitud
FROM part p LEFT JOIN best ON best.p_brand = p.p_brand AND best.n = replace(p.p_name, 'e', 'ee') AND rn = 1""")
def _(t):
    dim = t.part.groupBy("p_brand", F.when(F.col("p_size") <= 25, F.col("p_name")).otherwise(F.reverse("p_name")).alias("p_name")).agg(F.min("p_partkey").alias("clave"))
    typos = t.part.select("p_partkey", "p_brand", F.replace("p_name", F.lit("e"), F.lit("ee")).alias("p_name"))
    return M.fuzzy_lookup(typos, dim, "p_name", "p_brand", "clave")


@query("recommend", """
WITH v AS (SELECT o_custkey AS clave, o_orderpriority AS tipo, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2
  UNION ALL SELECT o_custkey, o_orderpriority || '/' || o_orderstatus, avg(o_totalprice) FROM orders GROUP BY 1, 2),
rel AS (SELECT DISTINCT o_orderpriority AS dim, o_orderpriority || '/' || o_orderstatus AS sub, 'sdg-' || o_orderpriority || o_orderstatus AS ids FROM orders),
d AS (SELECT clave, tipo AS dim FROM (SELECT *, row_number() OVER (PARTITION BY clave ORDER BY v DESC, tipo) rn FROM v WHERE tipo IN (SELECT dim FROM rel)) WHERE rn = 1),
s AS (SELECT clave, dim, tipo AS sub FROM (SELECT v.clave, d.dim, v.tipo, row_number() OVER (PARTITION BY v.clave ORDER BY v.v DESC, v.tipo) rn FROM v JOIN d USING (clave) JOIN rel ON rel.dim = d.dim AND rel.sub = v.tipo) WHERE rn = 1)
SELECT d.clave, d.dim, s.sub, rel.ids FROM d LEFT JOIN s USING (clave) LEFT JOIN rel ON rel.sub = s.sub""")
def _(t):
    sub = F.concat_ws("/", "o_orderpriority", "o_orderstatus")
    risks = t.orders.select(F.col("o_custkey").alias("clave"), F.col("o_orderpriority").alias("tipo"), F.col("o_totalprice").alias("valor"))
    risks = risks.unionByName(t.orders.select(F.col("o_custkey").alias("clave"), sub.alias("tipo"), F.col("o_totalprice").alias("valor")))
    rel = t.orders.select(F.col("o_orderpriority").alias("dim"), sub.alias("sub"), F.array(F.concat(F.lit("sdg-"), "o_orderpriority", "o_orderstatus")).alias("ids")).distinct()
    return M.recommend(risks, rel, ["dim", "sub"], "ids").withColumn("ids", F.array_join("ids", ","))
