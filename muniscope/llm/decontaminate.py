"""Benchmark decontamination with one Aho-Corasick automaton over the normalised benchmark items.

Words are runs of bytes that are a digit, an ASCII letter (lower-cased) or not ASCII. A window is ``size`` consecutive
words of an item; an item with fewer words, but not none, is one window. The automaton holds each distinct window as
`` w1 w2 ... `` and reads each normalised text once; word numbers lead back to byte offsets of the original text.

The patterns travel to the tasks in slices of about ``slice_chars`` characters (4 million make an automaton of some 180 MB in
a worker), so what is broadcast and held is bounded whatever the benchmark's size: a benchmark of up to about that size is
one automaton and one pass, a larger one takes a pass a slice.

Defined cases: null or word-free text has no words, hits or items; an item without words (or null) never occurs; items
with equal text or windows are all reported; items without an id are left out; repeated document rows are each judged;
other columns of ``docs`` are returned unchanged unless they have the name of a result column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, text_bytes, worker_memory

SIZE = 13
SLICE_CHARS = 4_000_000
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
HITS = "n_words long, spans array<struct<word:long,n_words:long,start:long,end:long,items:array<string>>>"


def words(raw: bytes) -> list[bytes]:
    return raw.translate(TABLE).split()


def windows(text: str | None, size: int = SIZE) -> list[str]:
    """Distinct windows of an item, as latin-1 strings of UTF-8 bytes with a space on either side."""
    w = words((text or "").encode())
    spans = [w] if 0 < len(w) < size else [w[i : i + size] for i in range(len(w) - size + 1)]
    return list(dict.fromkeys((b" " + b" ".join(s) + b" ").decode("latin-1") for s in spans))


def pattern_slices(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = SIZE, slice_chars: int = SLICE_CHARS) -> Iterator[dict[str, list[str]]]:
    """Windows and the items they belong to, in slices bounded by characters."""
    out: dict[str, list[str]] = {}
    held = 0
    rows = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("string"), F.col(text)).distinct()
    for name, content in rows.toLocalIterator():
        for w in windows(content, size):
            if w not in out:
                held += len(w)
            out.setdefault(w, []).append(name)
        if held > slice_chars:
            yield out
            out, held = {}, 0
    if out:
        yield out


def automaton(patterns: dict[str, list[str]]) -> ahocorasick.Automaton:
    tree = ahocorasick.Automaton()
    for w, items in patterns.items():
        tree.add_word(w, (len(w), w.count(" ") - 1, tuple(items)))
    if patterns:
        tree.make_automaton()
    return tree


def scan(raw: bytes, tree: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int, int, int, tuple[str, ...]]]]:
    """Word count and the occurring windows: first word, words, byte range in ``raw``, items."""
    w = words(raw)
    if not w or tree is None or not len(tree):
        return len(w), []
    normal = (b" " + b" ".join(w) + b" ").decode("latin-1")
    found = list(tree.iter(normal))
    if not found:
        return len(w), []
    plain = np.frombuffer(raw.translate(TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], plain.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
    out = []
    for at, (length, n, items) in found:
        first = int(np.searchsorted(spaces, at - length + 1))
        out.append((first, n, int(begins[first]), int(ends[first + n - 1]), items))
    return len(w), out


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Add ``n_words`` and ``spans`` (first word, words, byte range in the original text, items) to each document.

    Map-only: no shuffle, one read of the text for each slice of patterns.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "spans")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", " + HITS
    sc = docs.sparkSession.sparkContext
    first = True
    out = docs.select(*keep)
    for patterns in pattern_slices(benchmark, item, item_text, size, slice_chars):
        out, first = _pass(out, sc.broadcast(patterns), text, schema, first), False
    return _pass(out, sc.broadcast({}), text, schema, True) if first else out


def _pass(docs: DataFrame, patterns, text: str, schema: str, first: bool) -> DataFrame:
    spans_type = pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("items", pa.list_(pa.string()))]))

    def run(batches):
        key = patterns._path if hasattr(patterns, "_path") else id(patterns)
        kept = worker_memory("patterns")
        if key not in kept:
            kept.clear()
            kept[key] = automaton(patterns.value)
        tree = kept[key]
        for batch in sliced(batches, text, 8 << 20):
            raw, ends = text_bytes(batch.column(text))
            whole = raw.tobytes()
            counts, spans = [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                n, found = scan(whole[a:b], tree)
                counts.append(n)
                spans.append([{"word": f, "n_words": k, "start": s, "end": e, "items": list(items)} for f, k, s, e, items in found])
            names = [x for x in batch.schema.names if x not in ("n_words", "spans")]
            cols = [batch.column(x) for x in names]
            new = pa.array(spans, spans_type)
            if not first:
                old = batch.column("spans").to_pylist()
                new = pa.array([a + b for a, b in zip(old, spans, strict=True)], spans_type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), new], names=[*names, "n_words", "spans"])

    return docs.mapInArrow(run, schema)


def contamination(spans: Column, n_words: Column) -> dict[str, Column]:
    """Columns n_hit, item_ids and contaminated out of the spans.

    Spans are ordered by first word; a word counts once however many windows cover it.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["word"].alias("a"), (s["word"] + s["n_words"]).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    n_hit = F.aggregate(
        ordered, start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(acc["upto"], s["a"]))).alias("n"),
            F.greatest(acc["upto"], s["b"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: s["items"]))))
    return {"n_hit": n_hit, "item_ids": items}


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20, **kw) -> DataFrame:
    """Spans, counts and the verdict: contaminated if n_hit > 0 and share * n_hit >= n_words."""
    found = find_windows(docs, benchmark, **kw)
    cols = contamination(F.col("spans"), F.col("n_words"))
    out = found.withColumns(cols)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))

