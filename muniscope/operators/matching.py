"""Keyword, fuzzy-name and hierarchical matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import pack_blocks, probe_blocks, settle, sorted_parts
from .windows import first_per_key

SLICE = 500
CONSTANTS = 2_000  # patterns that may become constants of the plan
GRAM = 3  # letters that stand for a pattern in the index


def keyword_match(
    texts: DataFrame, keywords: DataFrame, text: str, text_id: str, keyword_id: str, keyword: str = "palabra", constants: int = CONSTANTS
) -> DataFrame:
    """Distinct (text_id, keyword_id) where the keyword pattern occurs in the text.

    A dictionary of up to ``constants`` patterns (its size is counted first) is evaluated beside the text in one projection:
    texts are neither copied nor shuffled, and only hits leave the scan. A larger one stays a table: see ``match_by_index``.
    """
    words = settle(keywords.select(F.col(keyword_id).alias("__kid"), F.col(keyword).alias("__kw")).where(F.col("__kw").isNotNull()).distinct())
    if words.count() > constants:
        return match_by_index(texts, words, text, text_id).select(text_id, F.col("__kid").alias(keyword_id))
    kind = words.schema["__kid"].dataType
    rows = sorted(words.collect(), key=str)
    slices = [
        F.array_compact(F.array(*[F.when(F.col(text).rlike(r["__kw"]), F.lit(r["__kid"])) for r in rows[i : i + SLICE]]))
        for i in range(0, len(rows), SLICE)
    ]
    hits = F.concat(*slices) if slices else F.array().cast(f"array<{kind.simpleString()}>")
    return texts.select(text_id, F.explode(F.array_distinct(hits)).alias(keyword_id)).distinct()


def _grams(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substr(text, i, F.lit(GRAM)))


def required_grams(pattern: Column) -> Column:
    """Grams that every match of a pattern holds; none for patterns with alternatives, groups, classes or escapes."""
    certain = F.regexp_replace(pattern, r"(?s).[?*]", ".")  # a letter that may be missing
    pieces = F.filter(F.split(certain, r"[.^$+]+"), lambda p: F.length(p) >= GRAM)
    found = F.array_distinct(F.flatten(F.transform(pieces, _grams)))
    return F.when(pattern.rlike(r"[|(){}\\\[\]]"), F.array().cast("array<string>")).otherwise(found)


def match_by_index(texts: DataFrame, words: DataFrame, text: str, text_id: str) -> DataFrame:
    """Distinct (text_id, __kid) for a dictionary (__kid, __kw) of any size.

    Each pattern waits under its rarest required gram (counted over the texts) and meets only texts that hold it, by an
    equi-join that can be split; the pattern itself is then tried on the text. Patterns without a gram travel in blocks that
    every text meets.
    """
    told = texts.select(F.col(text_id).alias("__id"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    asked = words.withColumn("__grams", required_grams(F.col("__kw")))
    listed = asked.where(F.size("__grams") > 0).select("__kid", "__kw", F.explode("__grams").alias("__gram"))
    long = told.where(F.length("__text") >= GRAM).select("__id", F.explode(F.array_distinct(_grams(F.col("__text")))).alias("__gram"))
    held = settle(long.join(listed.select("__gram").distinct(), "__gram", "left_semi"))
    often = held.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = listed.join(often, "__gram", "left").groupBy("__kid", "__kw").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram").alias("gram"))).alias("__r"))
    waiting = rarest.where("__r.n > 0").select("__kid", "__kw", F.col("__r.gram").alias("__gram"))
    pairs = waiting.join(held, "__gram").select("__kid", "__kw", F.col("__id").alias("__of"))
    tried = pairs.join(told, F.col("__of").eqNullSafe(F.col("__id"))).where(F.rlike(F.col("__text"), F.col("__kw")))
    packed = pack_blocks(asked.where(F.size("__grams") == 0), [], F.struct("__kid", "__kw"), ["__kid", "__kw"], 64)
    met = probe_blocks(told, packed, [])
    fitting = F.filter("items", lambda p: F.rlike(F.col("__text"), p["__kw"]))
    rest = met.select("__id", F.explode(F.transform(fitting, lambda p: p["__kid"])).alias("__kid"))
    return tried.select("__id", "__kid").unionByName(rest).distinct().select(F.col("__id").alias(text_id), "__kid")


def matches_to_array(matches: DataFrame, key: str, member: str, name: str = "ids", size: int = 100_000, buckets: int | None = None) -> DataFrame:
    """Members per key in sorted order, as arrays of at most ``size``: (key, part, ids), part 0 first."""
    parts = sorted_parts(matches.select(key, member).distinct(), [key], [member], size, buckets)
    return parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(member)).alias(name))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longer)


def fuzzy_lookup(
    df: DataFrame,
    dim: DataFrame,
    name: str,
    block: str,
    key: str,
    threshold: float = 0.75,
    clean=lambda c: c,
    size: int = 1024,
) -> DataFrame:
    """Key of the most similar dimension name within the same block, null unless similarity exceeds ``threshold``.

    An equal name wins outright. Only distinct (block, name) pairs are compared; the candidates of a block
    travel as packed arrays and just the best one per array comes back. Ties go to the smaller name.
    """
    known = dim.select(F.col(block).alias("__b"), clean(F.col(name)).alias("__dn"), F.col(key).alias("__key")).dropDuplicates(["__b", "__dn"])
    asked = df.select(F.col(block).alias("__b"), clean(F.col(name)).alias("__n")).where(F.col("__n").isNotNull() & F.col("__b").isNotNull()).distinct()
    packed = pack_blocks(known, ["__b"], F.struct(F.col("__dn").alias("n"), F.col("__key").alias("k")), ["__dn"], size)
    met = probe_blocks(asked, packed, ["__b"])

    def scored(c):
        longer = F.greatest(F.length("__n"), F.length(c["n"]))
        slack = F.abs(F.length("__n") - F.length(c["n"]))
        # the edit distance is at least the length difference: skip hopeless candidates
        sim = F.when(slack <= longer * (1.0 - threshold), similarity(F.col("__n"), c["n"])).otherwise(0.0)
        return F.struct((-sim).alias("s"), c["n"].alias("n"), c["k"].alias("k"))

    best = F.array_min(F.transform("items", scored))
    winners = met.select("__b", "__n", best.alias("w")).groupBy("__b", "__n").agg(F.min("w").alias("w"))
    good = -F.col("w.s") > threshold
    winners = winners.select(
        "__b", "__n", F.when(good, F.col("w.k")).alias(key), F.when(good, -F.col("w.s")).alias("similitud")
    )
    return df.join(winners, (df[block] == F.col("__b")) & (clean(df[name]) == F.col("__n")), "left").drop("__b", "__n")


def recommend(
    risks: DataFrame, relations: DataFrame, levels: Sequence[str], ids: str, clave: str = "clave", tipo: str = "tipo", valor: str = "valor"
) -> DataFrame:
    """Best dimension, then best sub-dimension inside it, and so on; then the ids of the deepest one reached.

    ``risks`` is long (clave, tipo, valor); ``relations`` has one column per level and the id array. The
    largest mean value wins a level, the first name on a tie. A place without any child value keeps the ids
    of its last level.
    """
    scores = risks.groupBy(clave, F.col(tipo).alias("__t")).agg(F.avg(valor).alias("__v")).where(F.col("__v").isNotNull())
    chosen = None
    for depth, level in enumerate(levels):
        parents = list(levels[:depth])
        names = relations.select(*parents[-1:], F.col(level).alias("__t")).where(F.col("__t").isNotNull()).distinct()
        cand = scores.join(names, "__t")
        if chosen is not None:
            cand = cand.join(chosen, [clave, *parents[-1:]])
        best = F.min_by(F.struct(F.col("__t").alias(level), *parents), F.struct(-F.col("__v"), F.col("__t")))
        picked = cand.groupBy(clave).agg(best.alias("__p")).select(clave, f"__p.{level}")
        chosen = picked if chosen is None else chosen.join(picked, clave, "left")
    out = chosen
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        first = first_per_key(relations.where(F.col(level).isNotNull()).select(level, *levels[depth + 1 :], ids), [level], list(levels[depth + 1 :]) or [ids])
        out = out.join(first.select(level, F.col(ids).alias(f"__ids_{depth}")), level, "left")
    picks = [F.col(f"__ids_{d}") for d in range(len(levels) - 1, -1, -1)]
    return out.select(clave, *levels, F.coalesce(*picks).alias(ids))
