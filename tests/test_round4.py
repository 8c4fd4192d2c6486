"""Findings of round 4: nothing that grows with the input is copied to the driver or put into one task."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from muniscope.bindings import load_all
from muniscope.bindings.core import ORACLE, QUERIES

from muniscope.llm import spelling
from muniscope.llm.common import settle
from muniscope.operators import documents as D
from muniscope.operators import scale


def test_tables_of_words_are_never_broadcast(spark, monkeypatch):
    plans = []

    def told(df, label, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, label, *more)

    counts = {"abcdefgh": 100, "abcdefg": 3, "abcdxfgh": 5, "hgfedcba": 2}
    words = settle(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    monkeypatch.setattr(spelling, "settle", told)
    found = spelling.group_variants(words)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("SortMergeJoin") for p in plans) > 10 and not any("Broadcast" in p for p in plans)
    assert {r["word"]: (r["form"], r["n_near"]) for r in found.collect()} == {
        "abcdefgh": (None, 2), "abcdefg": ("abcdefgh", 1), "abcdxfgh": ("abcdefgh", 1), "hgfedcba": (None, 0)
    }


def test_places_of_few_states_are_dealt_out(spark):
    long = spark.range(30).select((F.col("id") % 2).alias("ent"), F.lit("p").alias("plot"), F.concat(F.lit("e"), "id").alias("element_id"), F.lit("v").alias("variable"), F.col("id").alias("valor"))
    members = spark.range(200).select(F.lit("m").alias("nivel"), F.col("id").cast("string").alias("nivel_clave"), F.when(F.col("id") < 199, F.col("id") % 3).alias("ent"))
    plots = spark.createDataFrame([("p", "i")], "plot string, info string")

    def leaves(docs):  # with a null, a map and a row that comes twice
        rows = docs.select("ent", F.explode(F.from_json("values", "map<string,struct<values:map<string,map<string,struct<valor:string>>>>>")).alias("plot", "p")).select("ent", F.explode("p.values").alias("e", "leaf"))
        return rows.select("ent", "e", "leaf", F.lit(None).cast("int").alias("none"), F.explode(F.array(F.lit(1), F.lit(1))).alias("one"))

    told = D.map_document(long, plots, shared_by="ent", members=members, read=leaves)
    assert told.columns == ["nivel", "nivel_clave", "e", "leaf", "none", "one"]
    assert told.select(F.spark_partition_id()).distinct().count() > 1
    got = sorted((int(r.nivel_clave), r.e, r.leaf["v"].valor, r.none, r.one) for r in told.collect())
    assert got == sorted((k, f"e{i}", str(i), None, 1) for k in range(199) if k % 3 < 2 for i in range(k % 3, 30, 2) for _ in range(2))
    whole = D.map_document(long, plots, shared_by="ent", members=members)
    assert whole.select(F.spark_partition_id()).distinct().count() > 1 and whole.count() == sum(k % 3 < 2 for k in range(199))


def test_copies_are_never_broadcast(spark):
    small = spark.range(3).select("id", F.lit("x").alias("x"))
    met = scale.deal_out(spark.range(50).select((F.col("id") % 3).alias("id"), F.col("id").alias("n")), small, ["id"])
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n for r in met.collect()) == list(range(50))


@pytest.fixture(scope="module")
def survey_tables(spark, tmp_path_factory):
    """Persons of 40 households, some of them twice; a household without persons and persons without a household."""
    d = str(tmp_path_factory.mktemp("survey"))
    lines = [(o, 7 * o + 3 * n + 5 * k, o + 11 * n + k, n, float(1 + (o + n) % 50), 20000.0 + 997 * o + n) for o in range(42) for n in range(1, 4) for k in range(1 + (o % 5 == 0))]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double")
    orders = [(o, 13 * o % 29, 90000.0 + 1111 * o) for o in range(1, 45) if o != 40]
    orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double")
    lines.coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    orders.coalesce(1).write.parquet(f"{d}/orders.parquet")
    return d


def _files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_") and n.endswith(".data")}


def test_a_settled_step_lets_its_shuffle_files_go(spark):
    def step():
        return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))

    before = _files(spark)
    plain = scale.settle(step())
    assert _files(spark) - before  # they would stay
    kept = scale.settle_step(step())
    until = time.time() + 20
    while _files(spark) - before and time.time() < until:
        spark._jvm.System.gc()
        time.sleep(0.5)
    assert not _files(spark) - before
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("name, joins", [("registry_deprivation", 1), ("survey_deprivation", 1), ("income_predictors", 6)])
def test_survey_steps_are_settled_one_by_one(spark, survey_tables, name, joins):
    load_all()
    out = QUERIES[name](spark, survey_tables)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == joins
    if name == "registry_deprivation":  # the join by person has more rows than its inputs and comes last
        assert "person_id" in next(x for x in plan.splitlines() if "Join " in x)
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{survey_tables}/{t}.parquet/*.parquet'")
    told = con.execute(ORACLE[name])
    columns = [c[0] for c in told.description]
    assert sorted(columns) == sorted(out.columns)

    def plain(rows, names):
        at = [names.index(c) for c in sorted(names)]
        return sorted(tuple("" if r[i] is None else f"{float(r[i]):.6g}" if isinstance(r[i], (int, float)) or hasattr(r[i], "as_tuple") else str(r[i]) for i in at) for r in rows)

    assert plain(out.collect(), out.columns) == plain(told.fetchall(), columns)
