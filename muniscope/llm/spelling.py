"""Spelling variants: words one edit apart, grouped under the far more frequent form.

The words stand in two tries, one read from the front and one from the back, held as one edge table: an edge leads from a
node to the next one where words branch or end, and bears the letters between. Words walk the tries as rows (word, position,
node, edits). A walk without edits is the word's own path, known from building the trie. At a node of the second half of
that path a row makes its one edit: it skips the word's letter there, or takes another letter's edge. Then all rows go on
level by level, each level one join with the edge table on (node, next letter), until none is left; rows that end with
their word at a node where a word ends are neighbours. Edits in a word's first half are found from the back, where tries
are sparse too, so the tries hold the second halves alone. Insertions are the skips of the other word, and the smaller letter finds a replacement, so every pair is
found once at least and then turned round.

Nothing is bounded by a cap: a node has at most as many edges as there are letters, so a level's rows grow with the words.
Nodes are 64-bit hashes of (side, letters so far); pairs are confirmed by their edit distance.

A word's form is its neighbour of largest count, if that is at least ``factor`` times its own; forms lead to a root in less
than 20 steps, as counts grow by ``factor`` each (for 10).

Defined cases: null text has no words; a null id counts as empty where ids are asked for; repeated rows count again; other
columns are ignored; an empty table has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST, FACTOR = 7, 2, 10
DOUBLINGS = 5  # 2 ** 5 steps: more than the digits of a count


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """doc_id and run of each maximal run of at least ``shortest`` letters, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def count_words(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word and n of the words that are long and frequent enough. Counted in each task before the shuffle. Settled."""
    counted = words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return settle(counted.where(F.col("n") >= least), "words")


def _letters(text: Column, at: Column, n: Column) -> Column:
    """``n`` letters from position ``at`` (from 0)."""
    return text.substr(at + 1, n)


def _node(side: Column, letters: Column) -> Column:
    return F.xxhash64(side, letters)


def _read(word: Column, side: Column) -> Column:
    """The word as its side reads it."""
    return F.when(side == 0, word).otherwise(F.reverse(word))


def _meet(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the words, always dealt out by key.

    Spark takes the size of a compressed file for that of its rows, also after an explode, and would copy a side of
    gigabytes to the driver and to all tasks.
    """
    return left.join(right.hint("merge"), on, how)


def build_tries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (word, side, path: the nodes the word meets) and edges (parent, letter, label, child) of both tries.

    A word enters its nodes from just before its middle on: no walk of a word of about this length starts earlier, and what
    longer words do there does not matter to it. Rows are kept narrow, as there is one for each letter.
    """
    m, side, at = F.char_length("word"), F.col("side"), F.col("at")
    text = _read(F.col("word"), side)
    first = F.floor((m - 1) / 2).cast("int")
    read = words.select("word", F.explode(F.array(F.lit(0).cast("byte"), F.lit(1).cast("byte"))).alias("side"))
    places = read.select("word", "side", F.explode(F.sequence(first, m)).alias("at"))
    nodes = places.select(_node(side, _letters(text, F.lit(0), at)).alias("node"), _letters(text, at, F.lit(1)).alias("letter"))
    seen = nodes.groupBy("node").agg(F.min("letter").alias("least"), F.max("letter").alias("most"))
    open_nodes = seen.where((F.col("least") != F.col("most")) | (F.col("most") == "")).select("node")  # words branch or end here
    met = _meet(places.select("word", "side", "at", _node(side, _letters(text, F.lit(0), at)).alias("node")), open_nodes, "node")
    paths = settle(met.groupBy("word", "side").agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("path")), "paths")  # no longer than the word
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.get("path", i - 1).alias("a"), F.get("path", i).alias("b")))
    walked = paths.where(F.size("path") > 1).select(text.alias("text"), F.explode(steps).alias("s"))
    label = _letters(F.col("text"), F.col("s.a.at"), F.col("s.b.at") - F.col("s.a.at"))
    edges = walked.select(F.col("s.a.node").alias("parent"), label.alias("label"), F.col("s.b.node").alias("child")).distinct()
    return paths, settle(edges.withColumn("letter", F.substring("label", 1, 1)), "edges")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: all ordered pairs of words that differ by one inserted, deleted or replaced code point. Settled."""
    paths, edges = build_tries(words)
    at, m, side, label = F.col("at"), F.char_length("word"), F.col("side"), F.col("label")
    text = _read(F.col("word"), side)
    half = F.when(side == 0, F.floor(m / 2)).otherwise(m - F.floor(m / 2))
    own = paths.select("word", "side", F.explode("path").alias("x")).select("word", "side", "x.at", "x.node", F.lit(0).alias("edits"))
    start = own.where((at >= half) & (at < m))
    letter = _letters(text, at, F.lit(1))
    state = ["word", "side", "at", "node", "edits"]
    # of equal letters in a row, the last is the one to skip
    skipped = start.where((at + 1 == m) | (_letters(text, at + 1, F.lit(1)) != letter)).withColumn("at", at + 1)
    behind = F.char_length(label)
    replaced = (
        _meet(start, edges, F.col("node") == F.col("parent"))
        .where((F.col("letter") > letter) & (_letters(label, F.lit(1), behind - 1) == _letters(text, at + 1, behind - 1)))
        .withColumns({"at": at + behind, "node": F.col("child")})
    )
    states = settle(skipped.select(state).unionByName(replaced.select(state)).withColumn("edits", F.lit(1)), "frontier")
    ended = states.where(at == m)
    while not (active := states.where(at < m)).isEmpty():
        met = _meet(active, edges, (F.col("node") == F.col("parent")) & (F.col("letter") == letter)).where(label == _letters(text, at, behind))
        states = settle(met.withColumns({"at": at + behind, "node": F.col("child")}).select(state), "frontier")
        ended = ended.unionByName(states.where(at == m))
    ends = words.select(F.col("word").alias("near"), F.explode(F.array(_node(F.lit(0).cast("byte"), F.col("word")), _node(F.lit(1).cast("byte"), F.reverse("word")))).alias("node"))
    pairs = _meet(ended.select("word", "node"), ends, "node").where(F.levenshtein("word", "near", 1) == 1).select("word", "near")
    return settle(pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct(), "neighbours")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word. ``words``: word, n, settled."""
    near = _meet(neighbours(words), words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    fits = -F.col("best.minus") >= factor * F.col("n")
    told = settle(
        _meet(words, best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")
        ),
        "forms",
    )
    ahead = told.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ahead = settle(_meet(ahead, further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return _meet(told, ahead, "word", "left").withColumn("root", F.coalesce("root", "word"))
