"""Small hand-made frames with the expected rows: edge cases the given tables do not hold."""

from datetime import date

from pyspark.sql import functions as F

from muniscope.functions import dates as D
from muniscope.functions import geography as G
from muniscope.functions import numbers as N
from muniscope.functions import text as X
from muniscope.operators import aggregates as A
from muniscope.operators import cube as C
from muniscope.operators import matching as M
from muniscope.operators import projections as P
from muniscope.operators import quality as Q
from muniscope.operators import reshape as R
from muniscope.operators import scale
from muniscope.operators import spatial as S
from muniscope.operators import windows as W
from muniscope.operators.recode import recode
from muniscope.operators.rules import Rule, run_chunk
from muniscope.plans.beneficiaries import clean_beneficiaries
from muniscope.plans.packs import PACKS
from muniscope.sources import readers


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_keys_and_codes(spark):
    assert one(spark, G.valid_municipality(F.lit("33"), F.lit("1"))) is None
    assert one(spark, G.valid_municipality(F.lit("9"), F.lit("999"))) is None
    assert one(spark, G.valid_municipality(F.lit(' "9"'), F.lit("15"))) == "09015"
    assert one(spark, X.first_match_code(F.lit("MH"), X.SEX_CODES)) == "H"
    assert one(spark, X.clean_text(F.lit("Agua, Niños  y 3 Ñandúes!"))) == "agua ninos y nandues"


def test_dates(spark):
    assert one(spark, D.age_at(F.lit("19900231"), F.lit(2015), F.lit(6))) is None
    assert one(spark, D.age_at(F.lit("20000602"), F.lit(2018), F.lit(6))) == 17
    assert one(spark, D.age_at(F.lit("20000601"), F.lit(2018), F.lit(6))) == 18
    assert [one(spark, D.period_month(F.lit(p))) for p in ("13a", "13C", "139", "13x")] == [10, 12, 9, None]
    assert one(spark, D.parse_es_month(F.lit("Abr 2018"))) == date(2018, 4, 1)
    assert one(spark, D.data_date_to_date(F.lit("2018-9-m"))) == date(2018, 9, 1)
    assert one(spark, D.excel_serial_date(F.lit("43100"))) == date(2017, 12, 31)
    assert one(spark, D.age_band(F.lit(75))) == "75+" and one(spark, D.age_band(F.lit(74))) == "70-74"


def test_numbers(spark):
    assert one(spark, N.to_int(F.lit("1,234"))) == 1234 and one(spark, N.to_int(F.lit("x"), "null")) is None
    assert one(spark, N.round_int(F.lit("2.5"))) == 2 and one(spark, N.round_int(F.lit("12.0"))) == 12


def test_centroid_of_multipolygon_with_hole(spark):
    shape = "MULTIPOLYGON(((0 0, 4 0, 4 4, 0 4, 0 0),(1 1, 3 1, 3 3, 1 3, 1 1)),((10 0, 12 0, 12 2, 10 2, 10 0)))"
    c = one(spark, G.wkt_centroid(F.lit(shape)))
    assert abs(c["x"] - (12 * 2 + 4 * 11) / 16) < 1e-9 and abs(c["y"] - (12 * 2 + 4 * 1) / 16) < 1e-9


def test_legal_ranges(spark):
    df = spark.createDataFrame([("03", "03004"), ("03", "03008"), ("09", "09001"), ("20", "20570"), ("20", "20571"), ("01", None)], "cve_ent string, cve_muni string")
    kept = rows(P.filter_valid_codes(df, P.legal_ranges(spark)).fillna("-"), "cve_muni")
    assert kept == [("-",), ("03008",), ("20570",)]


def test_rule_forms_keep_nulls_and_fill_groups(spark):
    df = spark.createDataFrame([("h", "a", 10), ("h", "b", 40), ("h", "b", 40), (None, "c", 70), ("k", "d", None)], "hogar string, p string, edad int")
    chunk = [
        Rule.dummy("adulto", "edad >= 18"),
        Rule.grouped("n", "count_distinct", "p", ("hogar",), "edad >= 18"),
        Rule.grouped("mayor", "max", "edad", ("hogar",)),
        Rule.cases("g", ("n = 1", 1), ("n = 0", 2)),
    ]
    out = {tuple(r) for r in run_chunk(df, chunk, None, ["hogar", "p"]).collect()}
    assert out == {("h", "a", 0, 1, 40, 1), ("h", "b", 1, 1, 40, 1), (None, "c", 1, 0, 0, 2), ("k", "d", None, 0, 0, 2)}


def test_crowding_limit(spark):
    df = spark.createDataFrame([(5, 2), (6, 2), (3, 0)], "total_personas int, total_cuartosdor int").withColumns({c: F.lit(9) for c in ["material_pisos", "material_muros", "material_techos"]})
    out = run_chunk(df, PACKS["carencia_vivienda"], ["indice_hacinamiento", "ic_hacinamiento"], ["total_personas"])
    assert rows(out, "total_personas", "ic_hacinamiento") == [(3, None), (5, 0), (6, 1)]


def test_poverty_needs_every_deprivation(spark):
    flags = ["ic_rezedu", "ic_asalud", "ic_segsoc", "ic_cv", "ic_sbv", "ic_ali"]
    data = [(1, 1, 1, 1, 0, 0, 0, 1), (2, 0, 0, 0, 0, 0, 0, 1), (3, None, 1, 0, 0, 0, 0, 1)]
    df = spark.createDataFrame(data, "id int, " + ", ".join(f"{f} int" for f in flags) + ", plb int").withColumns({"plb_m": F.lit(1), "rururb": F.lit(0), "ictpc": F.lit(100.0)})
    out = run_chunk(df, PACKS["pobreza_multidimensional"], None, ["id"])
    assert rows(out, "id", "i_privacion", "pobreza_e", "cuadrantes") == [(1, 3, 1, 1), (2, 0, 0, 3), (3, None, None, None)]


def test_bucketed_windows_equal_plain_ones(spark):
    df = spark.range(400).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 == 0, F.col("id").cast("string")).alias("l"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    for n in (2, 5):
        assert rows(W.fill_down(df, ["id"], ["l"], ["g"], n), "id", "l") == rows(W.fill_down(df, ["id"], ["l"], ["g"], 1), "id", "l")
        assert rows(W.rank_by(df, "v", ["id"], buckets=n), "id", "ranking") == rows(W.rank_by(df, "v", ["id"], buckets=1), "id", "ranking")
        assert rows(W.relative_change(df, ["g"], ["id"], "v", buckets=n), "id", "value_dif") == rows(W.relative_change(df, ["g"], ["id"], "v", buckets=1), "id", "value_dif")
        assert rows(W.select_until_target(df, ["v", "id"], "v", 0.3, buckets=n), "id") == rows(W.select_until_target(df, ["v", "id"], "v", 0.3, buckets=1), "id")


def test_cube_drops_nulls_per_grouping(spark):
    df = spark.createDataFrame([("01", "x", 1, 10), ("01", "x", 1, 5), ("01", None, 2, 7), (None, "x", 3, 1)], "e string, s string, who int, m int")
    axes = {"nivel": {"nacional": [], "estatal": ["e"]}, "tipo": {"total": [], "sexo": ["s"]}}
    out = C.dimension_cube(df, axes, "who", "m")
    assert set(map(tuple, out.collect())) == {
        ("nacional", "total", None, None, 3, 23), ("estatal", "total", "01", None, 2, 22),
        ("nacional", "sexo", None, "x", 2, 16), ("estatal", "sexo", "01", "x", 1, 15),
    }


def test_hot_groups_are_split_and_whole(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id")
    parts = M.matches_to_array(df, "k", "id", size=100, buckets=5)
    assert parts.where("k = 'hot'").count() > 1
    assert parts.select(F.explode("ids").alias("i")).distinct().count() == 1000
    hot = sorted((r["part"], list(r["ids"])) for r in parts.where("k = 'hot'").collect())
    assert [i for _, ids in hot for i in ids] == list(range(900)) and all(len(ids) == 100 for _, ids in hot)
    packed = scale.pack_blocks(df, [], F.col("id"), ["id"], 64)
    assert packed.select(F.sum(F.size("items"))).first()[0] == 1000 and packed.count() > 1


def test_many_keywords_take_the_same_path(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "agua potable"), (2, "escuela"), (3, "nada")], "id int, t string")
    words = spark.createDataFrame([("a", "agua"), ("a", "potable"), ("b", "escuela|primaria")], "kid string, palabra string")
    monkeypatch.setattr(M, "SLICE", 1)
    assert rows(M.keyword_match(texts, words, "t", "id", "kid"), "id", "kid") == [(1, "a"), (2, "b")]
    assert M.keyword_match(texts, words.limit(0), "t", "id", "kid").count() == 0


def test_dictionary_of_any_size_is_a_table(spark):
    import random
    import re

    rng = random.Random(8)
    letters = "abcd é"
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for i in range(80)] + [(None, "abcabc"), (500, None), (7, "zzz abcd")]
    patterns = ["abc", "ab.cd", "a+bca?d", "^abc", "cd$", "x", "", "a|zzz", "(ab){2}", "[zé]a", "\\bab", "bcd*a", "zz+z", "dé?é", "never there"]
    patterns += ["".join(rng.choice("abcdé") for _ in range(5)) for _ in range(300)]
    words = [(f"k{i}", p) for i, p in enumerate(patterns)] + [("none", None), ("k0", "abc")]
    df = spark.createDataFrame(texts, "id int, t string")
    dictionary = spark.createDataFrame(words, "kid string, palabra string")
    want = {(i, k) for i, t in texts if t is not None for k, p in words if p is not None and re.search(p, t)}
    for constants in (10, 10_000):
        got = M.keyword_match(df, dictionary, "t", "id", "kid", constants=constants).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_bucketed_layers_join_without_a_shuffle(spark, tmp_path):
    from muniscope.operators.joins import assemble
    from muniscope.sources.layers import open_bucketed, scan_layer, write_bucketed

    root = str(tmp_path)
    for k, name in enumerate(["a", "B", "c"]):
        write_bucketed(spark.range(200).selectExpr("id AS cve", f"id * {k + 1} AS v{k}"), root, "features", name, ["cve"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        stored = [spark.table(f"features__{n}") for n in ("a", "b", "c")]
        for again in (False, True):
            if again:  # a session that does not know the tables yet
                for n in ("a", "b", "c"):
                    spark.sql(f"DROP TABLE features__{n}")
                stored = [open_bucketed(spark, root, "features", n, ["cve"], 4) for n in ("a", "b", "c")]
            out = assemble(stored[0], stored[1:], "cve")
            assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in out.groupBy("cve").agg(F.sum("v1"))._jdf.queryExecution().executedPlan().toString()
            assert rows(out, "cve", "v0", "v1", "v2") == [(i, i, 2 * i, 3 * i) for i in range(200)]
        plain = [scan_layer(spark, root, "features", n) for n in ("a", "b", "c")]
        assert "Exchange" in assemble(plain[0], plain[1:], "cve")._jdf.queryExecution().executedPlan().toString()
        write_bucketed(spark.range(3).selectExpr("id AS cve", "id AS v0"), root, "features", "a", ["cve"], 4)
        assert spark.table("features__a").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_results_merge_from_parts_of_periods(spark, tmp_path):
    from muniscope.streaming.partials import merged, part_path, write_part

    path, by = str(tmp_path / "parts"), ["k"]
    measures = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "2 * v")}
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 2), ("b", None)], "k string, v int")
    write_part(df.where("v = 1"), path, "2024-2-m", by, measures)
    write_part(df, path, "2024-1-m", by, measures)
    write_part(df.where("k = 'a'"), path, "2024-2-m", by, measures)  # the period again, with a late file
    out = {r["k"]: tuple(r)[1:] for r in merged(spark, path, by, measures).collect()}
    assert out == {"a": (12, 4, 1, 10), None: (2, 1, 2, 4), "b": (None, 0, None, None)}
    write_part(df.limit(0), path, "2024-1-m", by, measures)
    assert {r["k"]: r["s"] for r in merged(spark, path, by, measures).collect()} == {"a": 6}
    assert merged(spark, path, by, measures, F.col("data_date") < "2024-2").count() == 0 and part_path(path, "a/b").endswith("=a%2Fb")


def test_approximate_persons_stay_within_their_error(spark):
    df = spark.range(60_000).selectExpr("CASE WHEN id < 30 THEN 'few' WHEN id < 3000 THEN 'some' ELSE 'many' END AS g", "id DIV 3 AS who", "1 AS m")
    exact = {r["g"]: (r["n_beneficiarios"], r["suma_importe"]) for r in A.beneficiaries(df, ["g"], "who", "m").collect()}
    assert exact == {"few": (10, 30), "some": (990, 2970), "many": (19_000, 57_000)}
    for rsd in (0.05, 0.01):
        for r in A.beneficiaries(df, ["g"], "who", "m", approximate=True, rsd=rsd).collect():
            n, total = exact[r["g"]]
            assert abs(r["n_beneficiarios"] - n) <= 4 * rsd * n and r["suma_importe"] == total


def test_preparers_by_source_name(spark):
    from muniscope.plans import beneficiaries, cleaners, loads  # noqa: F401  (they register themselves)
    from muniscope.plans.registry import CLEANERS, PREPARERS, prepare

    assert "pub_agrupaciones" in CLEANERS and {"asm", "cfe", "cuis_39_9", "coneval_municipios", "precios_granos", "evaluaciones", "delitos_comun"} <= set(PREPARERS)
    assert prepare("asm", spark.createDataFrame([(1, 2)], "` Uno ` int, DOS int")).columns == ["uno", "dos"]
    cfe = prepare("cfe", spark.createDataFrame([("01", 3, 4)], "cve string, Enero int, Febrero int"))
    assert "usuarios" in cfe.columns and sorted(r["usuarios"] for r in cfe.collect()) == [3, 4]
    cuis = prepare("cuis_39_9", spark.createDataFrame([("12a", "N/A"), ("34", "x")], "TIE_CURP string, otro string"))
    assert sorted((str(r["TIE_CURP"]), str(r["otro"])) for r in cuis.collect()) == [("34", "x"), ("None", "None")]
    towns = prepare("coneval_municipios", spark.createDataFrame([(" 1", "1001 ", "na")], "`Clave de entidad` string, `Clave de municipio` string, otro string")).first()
    assert tuple(towns) == ("01", "01001", None)
    grain = prepare("precios_granos", spark.createDataFrame([("maiz", "a", "1", "--"), ("", "b", "2", "3"), ("trigo", "c", "4", "5")], "producto string, lugar string, sem_1 string, sem_2 string"))
    found = {(r["producto"], r["lugar"]) for r in grain.collect()}
    assert found == {("maiz", "a"), ("maiz", "b"), ("trigo", "c")}
    assert prepare("unknown", grain) is grain


def test_median_of_large_groups(spark):
    import random
    import statistics

    rng = random.Random(3)
    groups = {
        "even": [rng.gauss(0, 5) for _ in range(5000)], "odd": [rng.expovariate(1e-6) for _ in range(4001)], "ties": [7.0] * 3000 + [1.0, 9.0], "two": [1.0] * 1500 + [2.0] * 1500,
        "far": [-1e300, 1e300, *[1e-9 * i for i in range(1000)]], "small": [3.0, 1.0], None: [float(i) for i in range(900)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("small", None)], "g string, v double")
    for small in (100, 100_000):
        got = {r["g"]: r["m"] for r in A.exact_median(df, ["g"], "v", "m", small).collect()}
        assert got == {**{g: statistics.median(vs) for g, vs in groups.items()}, "none": None}


def test_long_codes_are_not_cut(spark):
    from muniscope.functions.text import pad_left

    df = spark.createDataFrame([("7",), ("123456",), (None,)], "c string")
    assert [r[0] for r in df.select(pad_left("c", 5)).collect()] == ["00007", "123456", None]


def test_idw_on_a_source_takes_its_value(spark):
    src = spark.createDataFrame([(1, 10.0, 10.0, 5.0), (2, 11.0, 10.0, 9.0)], "s int, lat double, lon double, v double")
    tgt = spark.createDataFrame([(1, 10.0, 10.0), (2, 10.5, 10.0)], "t int, lat double, lon double")
    got = dict(rows(S.idw(tgt, src, "v", "t", "s"), "t", "v"))
    assert got[1] == 5.0 and abs(got[2] - 7.0) < 1e-6


def test_variogram_counts_coincident_points(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, 0.0, 3.0), (0.5, 0.0, 2.0)], "lat double, lon double, v double")
    assert rows(S.variogram_bins(df, "v", 30, 90), "bin", "pairs", "gamma") == [(0, 1.0, 2.0), (1, 2.0, 0.5)]


def test_variogram_crosses_date_line_and_pole(spark):
    df = spark.createDataFrame([(10.0, 179.9, 1.0), (10.0, -179.9, 3.0), (89.9, 0.0, 5.0), (89.9, 180.0, 9.0)], "lat double, lon double, v double")
    assert rows(S.variogram_bins(df, "v", 30, 60, block=1), "bin", "pairs", "gamma") == [(0, 2.0, 5.0)]


def test_recode_unlisted_becomes_null(spark):
    df = spark.createDataFrame([(1, "a", "z"), (2, "q", "y")], "id int, x string, w string")
    table = spark.createDataFrame([("t", "x", "nuevo", "a", "10"), ("t", "w", "otro", None, None)], "tabla string, variable_inicial string, variable_final string, valor_inicial string, valor_final string")
    assert rows(recode(df, "t", table), "id", "nuevo", "otro") == [(1, "10", "z"), (2, None, "y")]
    twice = table.unionByName(spark.createDataFrame([("t", "x", "nuevo", "a", "09"), ("t", "x", "nuevo", "q", None), ("t", "no", "nada", "a", "1")], table.schema))
    assert rows(recode(df, "t", twice), "id", "nuevo", "otro") == [(1, "09", "z"), (2, None, "y")]


def test_common_ids_and_unpivot_identity(spark):
    df = spark.createDataFrame([("g", 1, [1, 2, 3]), ("g", 2, [2, 3]), ("g", 3, []), ("h", 4, [7])], "g string, r int, a array<int>")
    assert rows(R.common_ids(df, ["g"], "r", "a"), "g", "part", "ids") == [("g", 0, [2, 3]), ("h", 0, [7])]
    assert rows(R.common_ids(df, ["g"], "r", "a", size=1), "g", "part", "ids") == [("g", 0, [2]), ("g", 1, [3]), ("h", 0, [7])]
    wide = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "id int, x double, y double")
    back = R.spread(R.gather(wide, "k", "v", ["id"]), "k", "v", ["id"], ["x", "y"])
    assert {tuple(r) for r in back.collect()} == {(1, 2.0, None), (2, 3.0, 4.0)}


def test_zero_denominator_keeps_numerator(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 6.0)], "g string, s int, v double")
    assert A.gap_ratio(df, ["g"], "s", 2, 1, "v").first()["brecha"] == 6.0


def test_header_drift_and_sentinels(spark):
    lines = spark.createDataFrame([("f1", "a|b"), ("f2", "a|x|c")], "file string, value string")
    assert rows(Q.header_drift(lines, ["a", "b"]), "file", "pos", "status") == [("f2", 2, "changed"), ("f2", 3, "extra")]
    df = spark.createDataFrame([("N/E", " "), ("ok", "-")], "a string, b string")
    assert Q.drop_blank_rows(Q.nullify_sentinels(df)).count() == 1


def test_clean_line_with_quotes_minor_and_missing_field(spark):
    full = '"d"|FED|1|S1|P1|2013|13a|Perez|Lopez|Ana|20050101|"M"|9|N1|0|9|15|1|1|1'
    short = "d|X|1"
    out = {r["new_id"]: r for r in clean_beneficiaries(spark.createDataFrame([(full,), (short,)], "value string"), 2013).collect()}
    r = out["N1"]
    assert (r["edad"], r["nb_nombre"], r["cd_sexo"], r["nu_imp_monetario"], r["cve_muni"], r["nu_mes_correspondencia"]) == (8, "", "M", 0, "09015", 10)
    assert out[None]["edad"] is None and out[None]["origin"] is None


def test_sections_and_folder(spark, tmp_path):
    (tmp_path / "one.txt").write_text("u1\nu2\n-- Ventas --\nv1\n")
    lines = readers.read_lines(spark, str(tmp_path / "one.txt"))
    assert rows(readers.stack_sections(lines, "Ventas", ["Usuarios", "Ventas"]), "value", "tipo") == [("u1", "Usuarios"), ("u2", "Usuarios"), ("v1", "Ventas")]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x|y\n1|2\nx|y\n3|4\n")
    assert rows(readers.read_folder(spark, str(folder)), "x", "y", "source_file") == [("1", "2", "a.csv"), ("3", "4", "a.csv")]


def test_cube_spreads_rows_without_a_person(spark):
    df = spark.range(4000).selectExpr("CAST(id % 7 AS INT) AS a", "CAST(id % 11 AS INT) AS b", "CASE WHEN id % 3 > 0 THEN id % 50 END AS who", "1 AS m")
    axes = {"x": {"one": ["a"], "none": []}, "y": {"two": ["b"], "none": []}}
    out = {(r["x"], r["y"], r["a"], r["b"]): (r["n_beneficiarios"], r["suma_importe"]) for r in C.dimension_cube(df, axes, "who", "m").collect()}
    assert out["none", "none", None, None] == (50, 4000) and len(out) == 77 + 7 + 11 + 1
    assert sum(n for (x, y, _, _), (_, n) in out.items() if (x, y) == ("one", "two")) == 4000


def test_rules_of_several_steps(spark):
    from muniscope.operators.rules import Step, run_steps

    df = spark.createDataFrame([(1, 1, 5, "a b"), (1, 2, 7, "x"), (2, 3, None, "a b"), (None, 4, 9, "x")], "h int, p int, v int, t string")
    first = [Rule("v", "v + 1"), Rule.grouped("top", "max", "v", ["h"]), Rule.dummy("is_top", "v = top")]
    second = [Rule("v", "v * 10", where="t = 'a b'"), Rule.grouped("top", "max", "v", ["h"]), Rule.grouped("n", "count_distinct", "p", ["h"])]
    third = [Rule("w", "v + top"), Rule("v", "w + is_top")]
    out, held = run_steps(df, {"one": Step(first), "two": Step(second), "three": Step(third, after="one"), "part": Step(first, ["v"])})
    got = {r["p"]: {s: {k: r[c] for k, c in names.items()} for s, names in held.items()} for r in out.collect()}
    assert got[1] == {"one": {"v": 6, "top": 8, "is_top": 0}, "two": {"v": 50, "top": 50, "n": 2}, "three": {"v": 14, "top": 8, "is_top": 0, "w": 14}, "part": {"v": 6}}
    assert got[2]["one"] == {"v": 8, "top": 8, "is_top": 1} and got[2]["two"] == {"v": None, "top": 50, "n": 2} and got[2]["three"]["v"] == 17
    assert got[3]["one"] == {"v": None, "top": 0, "is_top": None} and got[3]["two"]["top"] == 0 and got[4]["one"]["top"] == 0
    assert out.select("h", "p", "v", "t").collect() and out.count() == 4


def test_nearest_equals_all_pairs(spark):
    import math
    import random

    rng = random.Random(4)
    places = [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -179.99), (10.0, 10.0), (10.0, 10.0)] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    sources = [(i, 20 + rng.gauss(0, 0.2), -100 + rng.gauss(0, 0.2)) for i in range(300)] + [(300 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    sources += [(400, 0.0, 180.0), (401, 0.0, 180.0), (402, 89.9, 120.0)]

    def arc(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * S.EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(h)))

    df = spark.createDataFrame(sources, "id int, lat double, lon double").withColumn("v", F.col("id").cast("double"))
    where = spark.createDataFrame(sorted(set(places)), "__lat double, __lon double")
    for k in (1, 5):
        got = {(r["__lat"], r["__lon"]): [p["d"] for p in r["near"]] for r in S.nearest(where, df, k, block=16).collect()}
        for lat, lon in set(places):
            want = sorted(arc(lat, lon, a, b) for _, a, b in sources)[:k]
            assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6) for x, y in zip(got[lat, lon], want, strict=True))
    few = S.idw(spark.createDataFrame([(1, 5.0, 5.0), (2, None, 1.0)], "t int, lat double, lon double"), df.where("id > 400"), "v", "t", "id", k=5).collect()
    assert {r["t"]: r["v"] is None for r in few} == {1: False, 2: True}
    none = S.idw(spark.createDataFrame([(1, 5.0, 5.0)], "t int, lat double, lon double"), df.limit(0), "v", "t", "id", k=2).collect()
    assert [r["v"] for r in none] == [None]
