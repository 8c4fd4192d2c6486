"""Quality checks, metadata, periods, sources and loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import periods as T
from ..operators import quality as Q
from ..plans import loads, registry
from ..plans.registry import cleaner
from ..sources import layers, readers
from ..streaming.incremental import ingest_incremental
from .core import query

_SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


@query("header_drift", """
WITH f AS (SELECT o_custkey AS file, string_agg(o_orderstatus, '|' ORDER BY o_orderkey) AS v FROM orders GROUP BY 1),
p AS (SELECT file, CAST(i AS INT) AS pos, list_extract(['F', 'O', 'P'], i) AS expected, list_extract(string_split(v, '|'), i) AS found FROM f, LATERAL (SELECT unnest(range(1, greatest(len(string_split(v, '|')), 3) + 1)) AS i))
SELECT file, pos, expected, found, CASE WHEN found IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra' ELSE 'changed' END AS status FROM p WHERE expected IS DISTINCT FROM found""")
def _(t):
    lines = t.orders.groupBy(F.col("o_custkey").alias("file")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))), lambda x: x["o_orderstatus"]), "|").alias("value")
    )
    return Q.header_drift(lines, ["F", "O", "P"])


@query("safe_names", "SELECT s_suppkey AS clave_del_proveedor, s_name AS ano, s_acctbal AS p_2015_saldo FROM supplier")
def _(t):
    df = t.supplier.select(F.col("s_suppkey").alias(" Clave del Proveedor"), F.col("s_name").alias("Año"), F.col("s_acctbal").alias("2015 (saldo)"))
    return Q.safe_names(df)


@query("propose_schema", """
SELECT unnest(['s_suppkey', 's_name', 's_acctbal', 'fecha', 'debe']) AS "column", unnest(['INT', 'TEXT', 'FLOAT', 'TIMESTAMP', 'INT']) AS proposed FROM (SELECT count(*) FROM supplier)""")
def _(t):
    df = t.supplier.select(
        F.col("s_suppkey").cast("string"), "s_name", F.col("s_acctbal").cast("string"),
        F.concat(F.lit("2018-01-0"), (1 + F.col("s_suppkey") % 9).cast("string")).alias("fecha"), (F.col("s_acctbal") < 0).cast("string").alias("debe"),
    )
    return Q.propose_schema(df)


@query("dictionary_gaps", """
SELECT 'orders' AS table_name, c AS "column" FROM (SELECT DISTINCT o_orderpriority AS c FROM orders) WHERE c NOT IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority < '3')""")
def _(t):
    columns = t.orders.select(F.lit("orders").alias("table_name"), F.col("o_orderpriority").alias("column")).distinct()
    dic = t.orders.select(F.col("o_orderpriority").alias("id"), F.when(F.col("o_orderpriority") < "3", "nombre").otherwise(" ").alias("nombre")).distinct()
    return Q.dictionary_gaps(columns, dic)


_SENT = "CASE c_custkey % 7 WHEN 0 THEN 'N/E' WHEN 1 THEN ' - ' WHEN 2 THEN 'na' WHEN 3 THEN '' ELSE c_mktsegment END"


@query("nullify_sentinels", "SELECT c_custkey, CASE WHEN c_custkey % 7 > 3 THEN c_mktsegment END AS v FROM customer")
def _(t):
    return Q.nullify_sentinels(t.customer.selectExpr("c_custkey", f"{_SENT} AS v"))


@query("drop_blank_rows", "SELECT CASE WHEN c_custkey % 7 > 3 THEN c_mktsegment END AS v, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS w FROM customer WHERE c_custkey % 7 > 3 OR c_custkey % 3 = 0")
def _(t):
    df = t.customer.selectExpr(f"{_SENT} AS v", "CASE WHEN c_custkey % 3 = 0 THEN c_name END AS w")
    return Q.drop_blank_rows(Q.nullify_sentinels(df))


@query("drop_exact_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return Q.drop_exact_duplicates(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"))


@query("assert_table", """
SELECT unnest(['exists', 'exists', 'not_all_null', 'min_rows', 'type', 'first']) AS rule, unnest(['s_name', 'falta', 's_acctbal', NULL, 's_nationkey', 's_acctbal']) AS "column",
 unnest([TRUE, FALSE, TRUE, n >= 10, TRUE, v > -1000]) AS passed, unnest(['true', 'false', CAST(n AS VARCHAR), CAST(n AS VARCHAR), 'int', CAST(v AS VARCHAR)]) AS observed
FROM (SELECT count(*) AS n, arg_min(s_acctbal, s_suppkey) AS v FROM supplier)""")
def _(t):
    return Q.assert_table(t.supplier, [
        ("exists", "s_name"), ("exists", "falta"), ("not_all_null", "s_acctbal"), ("min_rows", 10), ("type", "s_nationkey", "int"), ("first", "s_acctbal", "s_acctbal > -1000", "s_suppkey"),
    ])


@query("drop_constant_columns", "SELECT l_orderkey, l_returnflag FROM lineitem")
def _(t):
    return Q.drop_constant_columns(t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", F.lit(1).alias("uno")))


def _profile_sql(table, columns):
    parts = []
    for c, kind in columns.items():
        x = f"CAST({c} AS VARCHAR)"
        mode = f"(SELECT v FROM (SELECT {x} AS v, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1))"
        mode = f"any_value({mode})"
        base = [("num_records", "CAST(count(*) AS VARCHAR)"), ("num_distinct_values", f"CAST(count(DISTINCT {c}) AS VARCHAR)"), ("count_nulls", f"CAST(count(*) - count({c}) AS VARCHAR)"), ("mode", mode)]
        if kind != "string":
            base += [("min", f"CAST(min({c}) AS VARCHAR)"), ("max", f"CAST(max({c}) AS VARCHAR)")]
        parts += [f"SELECT '{c}' AS \"column\", '{kind}' AS type, '{m}' AS measure, {e} AS value FROM {table}" for m, e in base]
    return " UNION ALL ".join(parts)


@query("profile_columns", _profile_sql("customer", {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}))
def _(t):
    return Q.profile_table(t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))


@query("complete_for_period", """
SELECT c_custkey, c_nationkey, 'completo' AS caso FROM customer UNION ALL
SELECT c_custkey, c_nationkey, 'incompleto' FROM customer WHERE (SELECT count(*) FROM nation WHERE n_nationkey <> 5 AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey <> 5)) > 0""")
def _(t):
    expected = t.nation.select(F.col("n_nationkey").alias("c_nationkey"))
    full = Q.complete_for_period(t.customer, "c_nationkey", "c_acctbal", expected).select("c_custkey", "c_nationkey", F.lit("completo").alias("caso"))
    holed = t.customer.withColumn("c_acctbal", F.when(F.col("c_nationkey") != 5, F.col("c_acctbal")))
    part = Q.complete_for_period(holed, "c_nationkey", "c_acctbal", expected).select("c_custkey", "c_nationkey", F.lit("incompleto").alias("caso"))
    return full.unionByName(part)


@query("domain_violations", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority < '4') GROUP BY 1")
def _(t):
    return Q.domain_violations(t.orders, "o_orderpriority", t.orders.where("o_orderpriority < '4'").select("o_orderpriority").distinct())


@query("lineage_edges", """
WITH d AS (SELECT DISTINCT p_brand AS id, CASE WHEN p_brand < 'Brand#2' THEN p_type ELSE '' END AS tipo FROM part)
SELECT 'Column' AS source_kind, id AS source, 'from_table' AS edge, 'Table' AS target_kind, 'part' AS target FROM d UNION
SELECT 'Column', id, 'with_tag', 'Tag', tipo || '/s' FROM d WHERE tipo <> '' UNION SELECT 'Fraction', '2018-9-m', 'for_fraction', 'Year', '2018' FROM d UNION SELECT 'Table', 'part', 'for_year', 'Fraction', '2018-9-m' FROM d""")
def _(t):
    dic = t.part.select(F.col("p_brand").alias("id"), F.when(F.col("p_brand") < "Brand#2", F.col("p_type")).otherwise("").alias("tipo"), F.lit("s").alias("subtipo")).distinct()
    return Q.lineage_edges(dic, "part", "2018-9", "m")


@query("dictionary_catalog", """
WITH e AS (SELECT 'a_dic' AS table_name, c_name AS id, 'cliente' AS nombre, c_mktsegment AS fuente FROM customer UNION ALL SELECT 'b_dic', replace(s_name, 'Supplier', 'Customer'), 'prov', 'x' FROM supplier)
SELECT id, table_name, nombre, fuente FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY table_name, nombre, fuente) AS rn FROM e) WHERE rn = 1""")
def _(t):
    a = t.customer.select(F.col("c_name").alias("id"), F.lit("cliente").alias("nombre"), F.col("c_mktsegment").alias("fuente"))
    b = t.supplier.select(F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("id"), F.lit("prov").alias("nombre"), F.lit("x").alias("fuente"))
    return Q.dictionary_catalog({"b_dic": b, "a_dic": a})


@query("stamp", "SELECT r_regionkey, '2018-12-01 10:00:00' AS loaded_at, '2018-9-m' AS data_date FROM region")
def _(t):
    return Q.stamp(t.region.select("r_regionkey"), "2018-12-01 10:00:00", "2018-9", "m").withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


# --- periods ------------------------------------------------------------------------------------------
_MONTHS = "SELECT date_trunc('month', d)::DATE AS d FROM (SELECT unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS d FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))"


@query("period_calendar", f"""
SELECT CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-m' AS data_date, 'm' AS freq FROM ({_MONTHS})
UNION ALL SELECT DISTINCT CAST(year(d) AS VARCHAR) || '-' || CAST(quarter(d) AS VARCHAR) || '-q', 'q' FROM ({_MONTHS}) UNION ALL SELECT DISTINCT CAST(year(d) AS VARCHAR) || '-a', 'a' FROM ({_MONTHS})
UNION ALL SELECT DISTINCT CAST(year(d) AS VARCHAR) || '-' || CASE WHEN month(d) <= 6 THEN '1' ELSE '2' END || '-b', 'b' FROM ({_MONTHS})
UNION ALL SELECT CAST(isoyear(d) AS VARCHAR) || '-' || CAST(weekofyear(d) AS VARCHAR) || '-w', 'w' FROM (SELECT unnest(generate_series(date_trunc('week', lo)::TIMESTAMP, hi, INTERVAL 7 DAY)) AS d FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))
UNION ALL SELECT CAST(year(d) AS VARCHAR) || '-' || CAST(dayofyear(d) AS VARCHAR) || '-d', 'd' FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))""")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    out = None
    for freq in ["a", "b", "q", "m", "w", "d"]:
        part = T.expand_calendar(bounds, freq).select("data_date", F.lit(freq).alias("freq"))
        out = part if out is None else out.unionByName(part)
    return out


@query("half_month_calendar", f"""
SELECT CAST(year(d) AS VARCHAR) || '-' || CAST((month(d) - 1) * 2 + h AS VARCHAR) || '-bm' AS data_date FROM ({_MONTHS}), (SELECT unnest([1, 2]) AS h), (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
WHERE d + CAST((h - 1) * 15 AS INT) <= hi AND (CASE WHEN h = 1 THEN d + 14 ELSE last_day(d) END) >= lo""")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return T.expand_calendar(bounds, "bm").select("data_date")


@query("pending_periods", f"""
WITH c AS (SELECT CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-m' AS data_date FROM ({_MONTHS}))
SELECT data_date FROM c WHERE data_date <> '1996-5-m' AND data_date NOT IN (SELECT CAST(year(o_orderdate + INTERVAL 30 MONTH) AS VARCHAR) || '-' || CAST(month(o_orderdate + INTERVAL 30 MONTH) AS VARCHAR) || '-m' FROM orders)""")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    label = T.period_label("o_orderdate", "m").alias("data_date")
    skip = t.orders.select(label).where("data_date = '1996-5-m'")
    return T.pending_periods(T.expand_calendar(bounds, "m"), skip, t.orders.select(T.period_label(F.add_months("o_orderdate", 30), "m").alias("data_date"))).select("data_date")


@query("period_of", """
SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS INT) AS b, CAST(quarter(o_orderdate) AS INT) AS q, CAST((month(o_orderdate) - 1) * 2 + CASE WHEN day(o_orderdate) <= 15 THEN 1 ELSE 2 END AS INT) AS bm, CAST(weekofyear(o_orderdate) AS INT) AS w, CAST(dayofyear(o_orderdate) AS INT) AS d FROM orders""")
def _(t):
    from ..functions.dates import period_of

    return t.orders.select("o_orderkey", *[period_of("o_orderdate", f).alias(f) for f in ["b", "q", "bm", "w", "d"]])


# --- text files written from the tables and read back ----------------------------------------------------
@query("read_delimited", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def _(t):
    path = t.workspace("delimited")
    layers.write_delimited(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), path, header=True)
    return readers.read_delimited(t.spark, path)


@query("read_typed", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _(t):
    path = t.workspace("typed")
    layers.write_delimited(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path, sep=";")
    return readers.read_delimited(t.spark, path, ";", False, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string")


@query("read_encoded", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, 'Ñandú ' || s_name AS s_name FROM supplier")
def _(t):
    path = t.workspace("latin")
    t.supplier.select("s_suppkey", F.concat(F.lit("Ñandú "), "s_name").alias("s_name")).write.csv(path, sep="|", header=True, encoding="ISO-8859-1")
    return readers.read_delimited(t.spark, path, encoding="ISO-8859-1")


@query("read_lines_split", "SELECT CAST(o_orderkey AS VARCHAR) AS a, o_orderpriority AS c, CAST(NULL AS VARCHAR) AS falta FROM orders")
def _(t):
    path = t.workspace("lines")
    layers.write_delimited(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    return readers.read_lines_split(t.spark, path, "|", {"a": 0, "c": 2, "falta": 7})


@query("read_json_filter", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 1000")
def _(t):
    path = t.workspace("json")
    layers.write_table(t.supplier.select("s_suppkey", "s_acctbal"), path, "json")
    return readers.read_json(t.spark, path, "s_acctbal > 1000", "s_suppkey bigint, s_acctbal double")


@query("read_folder", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def _(t):
    path = t.workspace("folder")
    rows = t.supplier.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
    repeated = t.region.select(F.lit("s_suppkey").alias("s_suppkey"), F.lit("s_name").alias("s_name"))
    layers.write_delimited(rows.unionByName(repeated).repartition(3, "s_suppkey"), path, header=True)
    return readers.read_folder(t.spark, path).drop("source_file")


@query("field_count_filter", """
SELECT o_orderkey % 4 = 0 AS malo, count(*) AS n FROM orders GROUP BY 1""")
def _(t):
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority", F.when(F.col("o_orderkey") % 4 == 0, "extra"))
    good, bad = readers.field_count_filter(t.orders.select(line.alias("value")), "|", 2)
    return good.select(F.lit(False).alias("malo")).unionByName(bad.select(F.lit(True).alias("malo"))).groupBy("malo").agg(F.count(F.lit(1)).alias("n"))


@query("stack_sections", """
SELECT file, value, CASE WHEN k < 10 THEN 'Usuarios' ELSE 'Ventas' END AS tipo FROM (SELECT o_custkey % 5 AS file, CAST(o_orderkey AS VARCHAR) AS value, o_orderkey % 20 AS k FROM orders)""")
def _(t):
    # one file per customer group: rows sorted by a place code, a single marker line between the sections
    place = F.col("o_orderkey") % 20
    lines = t.orders.select(
        (F.col("o_custkey") % 5).alias("file"), F.struct(place.cast("int").alias("k"), F.col("o_orderkey").alias("o")).alias("line_key"), F.col("o_orderkey").cast("string").alias("value")
    )
    marker = t.orders.select((F.col("o_custkey") % 5).alias("file")).distinct().select(
        "file", F.struct(F.lit(10).alias("k"), F.lit(0).cast("long").alias("o")).alias("line_key"), F.lit("-- Ventas --").alias("value")
    )
    return readers.stack_sections(lines.unionByName(marker), "Ventas", ["Usuarios", "Ventas"]).drop("line_key")


@query("append_period", """
SELECT s_suppkey, s_acctbal, '2018-' || CAST(p AS VARCHAR) || '-m' AS data_date FROM supplier, (SELECT unnest([8, 9]) AS p)""")
def _(t):
    path = t.workspace("period")
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    for month in ["8", "9", "8"]:  # the second load of a period replaces the first
        layers.append_period(rows, path, f"2018-{month}", "m", "2018-12-01 00:00:00")
    return t.spark.read.parquet(path).select("s_suppkey", "s_acctbal", F.col("data_date").cast("string").alias("data_date"))


@query("raw_load", """
SELECT CASE WHEN c_custkey % 7 > 3 THEN c_mktsegment END AS v, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS w, '2018-9-m' AS data_date FROM customer WHERE c_custkey % 7 > 3 OR c_custkey % 3 = 0""")
def _(t):
    df = t.customer.selectExpr(f"{_SENT} AS v", "CASE WHEN c_custkey % 3 = 0 THEN c_name END AS w")
    return loads.raw_load(df, "2018-9", "m", "2018-12-01 00:00:00").drop("loaded_at")


@cleaner("demo_orders")
def _demo_orders(df):
    return df.withColumn("o_totalprice", F.round("o_totalprice", 1))


@query("clean_layer", """
SELECT o_orderkey, round(o_totalprice, 1) AS o_totalprice, CASE WHEN substring(o_orderpriority, 1, 1) < '4' THEN substring(o_orderpriority, 1, 1) END AS prioridad, o_orderstatus AS estado FROM orders""")
def _(t):
    from .ruling import _recode_table

    root = t.workspace("root")
    layers.write_layer(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"), root, "raw", "demo_orders")
    registry.clean_layer(t.spark, root, "demo_orders", _recode_table(t).withColumn("tabla", F.lit("demo_orders")))
    return layers.scan_layer(t.spark, root, "clean", "demo_orders")


@query("copy_and_publish", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    root = t.workspace("pub")
    layers.write_layer(t.nation.select("n_nationkey", "n_name"), root, "tidy", "Nation")
    copied = layers.copy_layer(t.spark, root, "tidy", "semantic", "Nation")
    layers.publish(t.spark.read.parquet(copied), [f"{root}/stage", f"{root}/prod"])
    return t.spark.read.parquet(f"{root}/prod").intersect(t.spark.read.parquet(f"{root}/stage"))


@query("ingest_incremental", "SELECT s_suppkey, s_name, '2018-9-m' AS data_date FROM supplier UNION ALL SELECT s_suppkey, s_name, '2018-10-m' FROM supplier")
def _(t):
    root = t.workspace("stream")
    schema = "s_suppkey bigint, s_name string"
    rows = t.supplier.select("s_suppkey", "s_name")

    def drop(df, period):
        # a folder per period inside the watched pattern; the period is part of the folder and file path
        df.write.csv(f"{root}/in/datos_{period}", sep="|", header=True)

    def step():
        ingest_incremental(
            t.spark, f"{root}/in/*", f"{root}/out", schema, f"{root}/chk", period_pattern=r"(\d{4}-\d+-[a-z]+)", path_period=True,
        )

    drop(rows, "2018-9-m")
    step()
    step()  # nothing new: nothing is loaded twice
    drop(rows, "2018-10-m")
    step()
    return t.spark.read.parquet(f"{root}/out").select("s_suppkey", "s_name", F.col("data_date").cast("string").alias("data_date"))
