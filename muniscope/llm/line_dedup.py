"""Repeated runs of lines, by content-defined chunks of lines.

Rolling hashes over line hashes cut each text into chunks, in several cuts at once. The coarse cut puts a boundary behind a
line where the rolling hash over the last ``WINDOW`` lines is a multiple of ``USUAL``: long chunks, whose first lines still
depend on what stands before them. Each of the ``CUTS`` fine cuts rolls over one line: a salted hash makes every line high or
low, and there is a boundary everywhere but between a high line and a low one behind it. Whether two lines are a chunk of a
fine cut depends on these two lines alone, so shifted text and foreign neighbours never move its borders. Two further fine
cuts pair off a line that is repeated behind itself, from the start and from the end of its repetitions.

Every chunk of ``LEAST`` lines or more, of any cut, that also occurs earlier in the corpus (by its digest; smallest doc_id,
then first line) is compared byte by byte with that first occurrence; where they are equal, all of its lines are removed. A
repeated run goes as the union of its chunks. Two unlike neighbours are a chunk of some fine cut with a chance of
1 - 0.75 ** CUTS (0.9999). A single line that repeats between other neighbours stays, by method. A chunk that overlaps its
own first occurrence is not a later one.

Texts meet their marks in one shuffle and are settled; a chunk's occurrences meet the first one in a join that can be
split, so a chunk that a third of all documents share is no one task's work.

Defined cases: lines end at ``\n``; null text stays null, empty text stays empty; rows that repeat a doc_id are one document
(chunks of equal start are not later ones); a null doc_id comes first; other columns pass through, and
``n_lines``/``n_removed_lines`` replace columns of that name. A document that loses all of its lines has empty text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, mix, powers, run_ends, settle, sliced, span_hashes, strings, text_bytes, worker_memory

WINDOW, USUAL, LEAST = 3, 4, 2
CUTS = 32
FACTORS = powers(int(M1), WINDOW + 1)[1:]
SALTS = mix(np.arange(1, CUTS + 1, dtype=np.uint64)) | np.uint64(1)
MISSING = -(2**63)


def coarse_ends(lines: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Index behind the last line of each coarse chunk. ``lines``: hashes of the lines of texts that lie one behind the other;
    ``place``: number of each line in its text."""
    rolled = np.zeros(len(lines), np.uint64)
    for age in range(min(WINDOW, len(lines))):
        rolled[age:] += np.where(place[age:] >= age, lines[: len(lines) - age], np.uint64(0)) * FACTORS[age]
    last = np.append(place[1:] == 0, True)
    return np.flatnonzero(((mix(rolled) % np.uint64(USUAL) == 0) & (place >= WINDOW - 1)) | last) + 1


def fine_starts(lines: np.ndarray, place: np.ndarray) -> np.ndarray:
    """First lines of the two-line chunks of all fine cuts."""
    joined = np.zeros(max(len(lines) - 1, 0), bool)
    for salt in SALTS:
        high = mix(lines * salt) >> np.uint64(63) == 1
        joined |= high[:-1] & ~high[1:]
    joined &= place[1:] > 0
    new = np.append(True, (lines[1:] != lines[:-1]) | (place[1:] == 0))
    first = np.flatnonzero(new)  # a line that follows itself: pairs from the start and from the end of such a run
    many = np.diff(np.append(first, len(lines)))
    nth = np.arange(len(lines)) - np.repeat(first, many)
    left = np.repeat(many, many) - nth
    return np.flatnonzero(joined | ((left > 1) & ((nth % 2 == 0) | (left % 2 == 0)))[:-1])


def chunks(lines: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of each chunk of ``LEAST`` lines or more, over all cuts; each once."""
    place = np.arange(len(lines)) if place is None else place
    ends = coarse_ends(lines, place)
    begins = np.append(0, ends[:-1])
    fine = fine_starts(lines, place)
    long = (ends - begins > LEAST) | ((ends - begins == LEAST) & ~np.isin(begins, fine))
    starts, sizes = np.append(fine, begins[long]), np.append(np.full(len(fine), LEAST), (ends - begins)[long])
    return starts.astype(np.int64), sizes.astype(np.int64)


def line_places(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line of texts that lie one behind the other, and lines before each text."""
    breaks = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([borders[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, borders[1:]]), kind="stable")
    before = np.concatenate([[0], np.cumsum(1 + np.searchsorted(breaks, borders[1:]) - np.searchsorted(breaks, borders[:-1]))])
    return starts, ends, before


def found_chunks(docs: DataFrame) -> DataFrame:
    """doc, tie, at (first line), n (lines), digest of each chunk. Map-only."""

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "text"):
            raw, borders = text_bytes(batch.column("text"))
            starts, ends, before = line_places(raw, borders)
            whole = raw.tobytes()
            text_of = np.repeat(np.arange(batch.num_rows), np.diff(before))
            place = np.arange(len(starts)) - before[text_of]
            top, many = chunks(span_hashes(raw, starts, ends, seed=3), place)
            first = place[top]
            digest = [hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(starts[top].tolist(), ends[top + many - 1].tolist(), strict=True)]
            rows = pa.array(text_of[top])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(rows), batch.column("tie").take(rows), pa.array(first.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(digest, pa.binary())],
                names=["doc", "tie", "at", "n", "digest"],
            )

    return docs.select("doc", "tie", "text").mapInArrow(run, "doc long, tie int, at int, n int, digest binary")


def _to_compare(marks: list[dict]) -> list[dict]:
    inside = {k for m in marks if m["n"] > LEAST and not m["is_first"] for k in range(m["at"], m["at"] + m["n"] - 1)}
    return [m for m in marks if m["n"] > LEAST or m["is_first"] or m["at"] not in inside]


def _texts(marked: DataFrame) -> DataFrame:
    """digest, doc, tie, at, n, is_first, chunk (its bytes) of each mark, but for pairs of lines inside a repeated coarse chunk,
    which stands for them."""

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "text"):
            out = []
            for doc, tie, text, marks in zip(*[batch.column(c).to_pylist() for c in ("doc", "tie", "text", "marks")], strict=True):
                lines = (text or "").split("\n")
                out += [(m["digest"], doc, tie, m["at"], m["n"], m["is_first"], "\n".join(lines[m["at"] : m["at"] + m["n"]])) for m in _to_compare(marks)]
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["digest", "doc", "tie", "at", "n", "is_first", "chunk"])

    return marked.select("doc", "tie", "text", "marks").mapInArrow(run, "digest binary, doc long, tie int, at int, n int, is_first boolean, chunk string")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated runs of lines taken out of ``text``, and n_lines, n_removed_lines."""
    rest = [c for c in docs.columns if c not in (text, "n_lines", "n_removed_lines")]
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(MISSING)).alias("doc"), F.hash(body).alias("tie"), F.col(text).alias("text"), F.struct(*rest).alias("rest"))
    found = settle(found_chunks(keyed), "chunks")
    firsts = found.groupBy("digest").agg(F.min(F.struct("doc", "at", "tie")).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    repeated = settle(firsts.select("digest", *[F.col("first")[c].alias(f"first_{c}") for c in ("doc", "at", "tie")]), "repeated")
    overlaps = (F.col("tie") == F.col("first_tie")) & (F.col("at") < F.col("first_at") + F.col("n"))
    is_first = (F.col("doc") == F.col("first_doc")) & ((F.col("at") == F.col("first_at")) | overlaps)
    marks = found.join(repeated, "digest").groupBy("doc", "tie").agg(F.collect_set(F.struct("at", "n", "digest", is_first.alias("is_first"))).alias("marks"))
    held = settle(keyed.join(marks, ["doc", "tie"], "left"), "marked")
    texts = settle(_texts(held.where(F.col("marks").isNotNull())), "chunk-texts")
    first_texts = texts.where("is_first").groupBy("digest").agg(F.min("chunk").alias("first_chunk"))
    differing = texts.where("NOT is_first").join(settle(first_texts, "first-texts"), "digest").where(F.col("chunk") != F.col("first_chunk"))
    spared = settle(differing.groupBy("doc", "tie").agg(F.collect_set(F.struct("at", "n")).alias("spared")), "spared")  # as good as always empty
    return _without(held.join(spared, ["doc", "tie"], "left"), text, docs)


def _without(held: DataFrame, text: str, docs: DataFrame) -> DataFrame:
    kind = held.schema["rest"].dataType.simpleString()

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "text"):
            out, lines_of, removed_of = [], [], []
            plain = strings(batch.column("text"))
            for body, marks, spared in zip(plain, batch.column("marks").to_pylist(), batch.column("spared").to_pylist(), strict=True):
                lines = body.split("\n")
                gone = [m for m in marks or () if not m["is_first"] and not any(s["at"] <= m["at"] and m["at"] + m["n"] <= s["at"] + s["n"] for s in spared or ())]
                keep = np.ones(len(lines), bool)
                for m in gone:
                    keep[m["at"] : m["at"] + m["n"]] = False
                lines_of.append(len(lines))
                removed_of.append(len(lines) - int(keep.sum()))
                if gone:
                    body = "\n".join(lines[i] for i in np.flatnonzero(keep))
                out.append(body)
            new = pa.array(out, pa.string())
            if batch.column("text").null_count:
                new = pa.array([None if null else x for x, null in zip(out, batch.column("text").is_null().to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), new, pa.array(lines_of, pa.int64()), pa.array(removed_of, pa.int64())], names=["rest", "text", "n_lines", "n_removed_lines"])

    done = held.select("rest", "text", "marks", "spared").mapInArrow(run, f"rest {kind}, text string, n_lines long, n_removed_lines long")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    return done.select(*[F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in names], "n_lines", "n_removed_lines")
