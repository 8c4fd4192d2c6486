"""Document fingerprints by content-defined chunking with normalised gear-hash boundaries.

A gear hash over the last 16 bytes decides where a chunk may end. Boundaries are normalised: before the usual size more
bits must be zero, beyond it fewer, so chunk sizes gather around ``USUAL`` bytes (``LEAST`` to ``MOST``). A boundary
depends only on the bytes just before it, so an insertion moves the chunks next to it and no others. A fingerprint is the
set of chunk digests, each with its chunk's length; containment is the weight of shared digests over a set's own weight.

As a string a fingerprint is the base64 of its entries (48 bits of digest, 16 of length), sorted by digest.

Defined cases: null text is empty; the empty text has the empty fingerprint, which is contained in everything and
contains only itself; equal texts have equal fingerprints; documents are followed by the next lower id (ids that repeat:
by a hash of the text; null ids last), the last by the first; repeated rows each count; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_table, partitions, sliced, span_hashes, strings, worker_memory

LEAST, USUAL, MOST = 16, 40, 160
STRICT, LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)  # 6 and 4 of the bits that see the whole window
GEAR = (byte_table(99) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """Gear hash behind each byte: the sum of GEAR[byte] << age over the last 16 bytes, by doubling the window."""
    h = GEAR[raw]
    for width in (1, 2, 4, 8):
        if len(h) > width:
            h[width:] += h[:-width] << np.uint32(width)  # the right side is evaluated before any store
    return h


def cut_points(raw: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Ends of all chunks of texts that lie one behind the other (``borders``: their ends, from 0). Texts are hashed
    apart: the first bytes of a text see the bytes before it only where no boundary may be yet (``LEAST``)."""
    h = gear_hashes(raw)
    strict = np.flatnonzero((h & STRICT) == 0) + 1
    loose = np.flatnonzero((h & LOOSE) == 0) + 1
    strict_list, loose_list = strict.tolist(), loose.tolist()
    strict_at = np.searchsorted(strict, borders[:-1]).tolist()
    loose_at = np.searchsorted(loose, borders[:-1]).tolist()
    ends: list[int] = []
    n_strict, n_loose = len(strict_list), len(loose_list)
    for i, (at, stop) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
        s, l = strict_at[i], loose_at[i]  # noqa: E741
        while stop - at > LEAST:
            early, middle, late = at + LEAST, at + USUAL, min(at + MOST, stop)
            while s < n_strict and strict_list[s] < early:
                s += 1
            if s < n_strict and strict_list[s] <= min(middle, late):
                at = strict_list[s]
            else:
                while l < n_loose and loose_list[l] <= middle:
                    l += 1  # noqa: E741
                at = min(loose_list[l], late) if l < n_loose else late
            ends.append(at)
        if at < stop:
            ends.append(stop)
    return np.array(ends, np.int64)


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted entries of each text: digest in the upper 48 bits, chunk length in the lower 16."""
    borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return [np.zeros(0, np.uint64) for _ in texts]
    ends = cut_points(raw, borders)
    starts = np.concatenate([[0], ends[:-1]])
    entry = (span_hashes(raw, starts, ends) & np.uint64(0xFFFFFFFFFFFF0000)) | (ends - starts).astype(np.uint64)
    at = np.searchsorted(ends, borders, "right")
    at[0] = 0
    return [np.unique(entry[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def to_text(entries: np.ndarray) -> str:
    return base64.b64encode(entries.astype(">u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's weight whose digests b has."""
    total = int((a & np.uint64(0xFFFF)).sum())
    if not total:
        return 1.0 if not len(b) else 0.0
    held = a[np.isin(a, b, assume_unique=True)]
    return int((held & np.uint64(0xFFFF)).sum()) / total


def fingerprint_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint``. Map-only."""
    keep = [c for c in docs.columns if c != "fingerprint"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", fingerprint string"

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, text, 2 << 20):
            prints = [to_text(x) for x in fingerprints([t.encode() for t in strings(batch.column(text))])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(prints, pa.string())], names=[*keep, "fingerprint"])

    return docs.select(*keep).mapInArrow(run, schema)


def range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are smaller than ``key``, by binary search in one array literal."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded into one literal by the optimizer
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    fits = lambda at, step: (at + step <= len(cuts)) & (F.get(held, at + step - 1) < key)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in runs of descending id such that each run's rows stand one behind the other, then the row that follows the run.

    Ids are cut into ranges at quantiles. The first row of each range is known from the ids alone; it travels to its own
    range and, marked as not ``own``, to the one before it, so texts are shuffled once. Columns: run, own, doc_id, text.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("key"))
    n = partitions(docs.sparkSession)
    m = 4 * n  # several ranges a task even out what hashing deals unevenly
    cuts = sorted(set(rows.agg(F.percentile_approx("key", F.array(*[F.lit(i / m) for i in range(1, m)]), 100 * m)).first()[0] or []))
    # ranges are numbered upwards; run r holds keys in (cuts[r-1], cuts[r]]
    place = range_of(F.col("key"), cuts)
    heads = rows.select("key", place.alias("run")).groupBy("run").agg(F.max("key").alias("key")).orderBy(F.desc("run")).collect()  # a row a range
    follows = [(heads[i]["key"], heads[i - 1]["run"]) for i in range(len(heads))]  # heads[-1] is the lowest range: its follower is the first of all
    also = docs.sparkSession.createDataFrame(follows or [(0, -1)], "key long, before int")
    marked = rows.withColumn("run", place).join(F.broadcast(also), "key", "left")
    sent = marked.withColumn("to", F.explode(F.expr("array(struct(true AS own, run), struct(false AS own, before AS run))"))).where(F.col("to.run").isNotNull())
    return (
        sent.select("to.run", "to.own", "doc_id", "text", "key", F.xxhash64("text").alias("tie"))
        .repartition(n, "run")
        .sortWithinPartitions("run", F.desc("own"), F.desc("key"), "tie")
        .select("run", "own", "doc_id", "text")
    )


def edited(text: str, follower: str) -> str:
    """The last floor(n/2) code points replaced by the follower's first as many, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and how much of the text's own fingerprint the edited one and the
    next document's contain."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def rows(batches) -> Iterator[tuple]:
        """(run, own, id, text, entries) of all rows in order, fingerprinted by the batch."""
        for batch in sliced(batches, "text", 2 << 20):
            texts = strings(batch.column("text"))
            yield from zip(batch.column("run").to_pylist(), batch.column("own").to_pylist(), batch.column("doc_id").to_pylist(), texts, fingerprints([t.encode() for t in texts]), strict=True)

    def run(batches):
        worker_memory("")
        out: list[tuple] = []
        last = None
        held = 0
        for row in rows(batches):
            if last is not None and last[1] and last[0] == row[0]:
                out.append((last, edited(last[3], row[3]), row[4]))
                held += len(last[3])
            if row[1] or last is None or last[1] or last[0] != row[0]:  # of several rows that follow a run, the first counts
                last = row
            if held > 1 << 20:
                yield _compared(out)
                out, held = [], 0
        if out:
            yield _compared(out)

    def _compared(out: list[tuple]) -> pa.RecordBatch:
        changed = fingerprints([e.encode() for _, e, _ in out])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[2] for r, _, _ in out], pa.int64()), pa.array([len(r[3]) for r, _, _ in out], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for _, e, _ in out]), pa.array([to_text(r[4]) for r, _, _ in out]),
                pa.array([to_text(c) for c in changed]), pa.array([containment(r[4], c) for (r, _, _), c in zip(out, changed, strict=True)]),
                pa.array([containment(r[4], n) for r, _, n in out]),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return with_next(docs, doc_id, text).mapInArrow(run, schema)
