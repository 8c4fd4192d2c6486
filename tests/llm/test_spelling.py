"""op12 against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

from conftest import SMALL
from pyspark.sql import functions as F

from muniscope.llm import spelling
from muniscope.llm.common import settle
from muniscope.llm.queries import QUERIES


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, factor=10):
    out, like = {}, defaultdict(set)
    for w in counts:  # near words agree once a letter is left out, or are that rest
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            like[rest].add(w)
    for w, n in counts.items():
        own = [v for v in set().union(*(like[w[:i] + w[i + 1 :]] for i in range(len(w))), like[w]) if v != w and near(w, v)]
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= factor * n else None
        out[w] = [form, w, n, len(own), counts[form] if form else None]
    for w, r in out.items():
        while out[r[1]][0]:
            r[1] = out[r[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def told(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_random_words(spark):
    rng = random.Random(2)
    counts = {}
    for _ in range(500):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 10)))
        counts[w] = rng.choice([2, 3, 25, 300, 4000])
    base = "thousand" * 40
    counts |= {base: 5000, base[:-1]: 400, base[:100] + "x" + base[101:]: 30, base + "s": 2, "a" * 30: 9, "a" * 31: 100, "aaaaaaab": 2, "ÿabcdefg": 3, "abcdefg": 40}
    words = settle(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    assert told(spelling.group_variants(words)) == plain(counts)


def test_chain_of_forms(spark):
    counts = {"abcdefg" + "h" * k: 10**k for k in range(9)}
    words = settle(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    got = told(spelling.group_variants(words))
    assert got == plain(counts) and {r[1] for r in got.values()} == {"abcdefghhhhhhhh"}


def test_messy(spark, messy):
    found = spelling.runs(messy.withColumn("text", F.concat_ws(" ", "text", F.lit("Straßen-Ähnlich x1abcdefgh2 ×÷×÷×÷×"))))
    words = spelling.count_words(found.select(F.col("run").alias("word")), least=1)
    assert {r["word"]: r["n"] for r in words.collect()} == {"straßen": 10, "Ähnlich": 10, "abcdefgh": 10, "×÷×÷×÷×": 10, "ü" * 130: 1}
    none = spelling.count_words(spelling.runs(messy.limit(0)).select(F.col("run").alias("word")))
    assert spelling.group_variants(none).count() == 0


def test_query(spark, corpus):
    counts = Counter()
    for i, text in corpus[1]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    assert told(QUERIES["op12_spelling"](spark, SMALL)) == plain(counts)
