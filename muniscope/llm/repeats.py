"""Repeated byte windows by a depth-limited radix sort of suffixes.

Every string of ``depth`` bytes that also starts earlier (smaller doc_id, or same document and smaller start) is found, and
each byte it covers is removed. Suffixes are ordered only as far as that takes, in most-significant-digit passes whose
digits are compared by hash; groups of one member drop out after each pass, and groups left at full depth are exactly
the repeated windows:

1. Digit of 24 bytes. Each window stands for its *anchor*, its 24-byte string of smallest hash, so equal windows have
   equal anchors at equal places and about one suffix in 39 needs sorting. Tasks deal the anchors by digit.
2. Digit of the whole run: the bytes of all windows that share the anchor. Of equal runs all but the first repeat whole.
3. Digit of ``depth`` bytes: first members of groups that hold several runs are compared window by window.

Anchors travel as packed arrays, one row a bucket and batch. A batch sends each run once (later equal ones are known to
repeat), so a passage that a third of all documents share is at most one entry a batch. A digit with more than ``hot``
different runs is not gathered in pass 3: its windows are dealt by their own hash, each again once a batch.

Defined cases: null text is empty; texts shorter than ``depth`` lose nothing; a null doc_id comes first; rows that repeat
a doc_id are one document, in which windows of equal start do not see each other (fully repeated rows get equal
results); an empty table gives no rows; other columns are ignored. A text may have any length
that a task's memory holds; arrays of several 8-byte numbers for each of its bytes are kept while it is scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, ranges, run_ends, settle, sliced, text_bytes, worker_memory
from .suffixes import Rolling, anchors

DEPTH, DIGIT = 100, 24
HOT = 16384
FLUSH = 16 << 20
MASK = np.uint64(0xFFFFFFFFFFFF)
MARK = np.dtype([("code", "<u8"), ("run", "<u8"), ("doc", "<i8"), ("tie", "<i4"), ("at", "<i4"), ("span", "<u1")])
RANGE = np.dtype([("doc", "<i8"), ("tie", "<i4"), ("at", "<i4"), ("upto", "<i4"), ("kind", "<u1"), ("code", "<u8")])
WINDOW = np.dtype([("code", "<u8"), ("doc", "<i8"), ("tie", "<i4"), ("at", "<i4")])
WIDTHS = {"code": 6, "run": 6}  # bytes kept; the bucket of a code holds further bits
REPEATED, COMPARE, COMPARE_HOT = 0, 1, 2


def packed(rows: np.ndarray) -> bytes:
    """Byte planes of each field one behind the other, which the shuffle's compression shortens well."""
    return b"".join(np.ascontiguousarray(rows[f]).view(np.uint8).reshape(len(rows), -1)[:, : WIDTHS.get(f, 8)].T.tobytes() for f in rows.dtype.names)


def unpacked(blob: bytes, n: int, kind: np.dtype) -> np.ndarray:
    out, at = np.zeros(n, kind), 0
    for f in kind.names:
        size = kind[f].itemsize
        width = min(WIDTHS.get(f, 8), size)
        planes = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
        full = np.zeros((n, size), np.uint8)
        full[:, :width] = planes.T
        out[f] = full.reshape(-1).view(kind[f])
        at += n * width
    return out


def deal(rows: np.ndarray, to: np.ndarray, kind: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(bucket, kind, n, blob) for each bucket that gets rows."""
    order = np.argsort(to, kind="stable")
    rows, to = rows[order], to[order]
    first, count = run_ends(to)
    for a, n in zip(first.tolist(), count.tolist(), strict=True):
        yield int(to[a]), kind, n, packed(rows[a : a + n])


def table_of(rows: Iterable[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "kind", "n", "blob"])


BLOBS = "bucket int, kind int, n int, blob binary"


def doc_bucket(doc: np.ndarray, tie: np.ndarray, n: int) -> np.ndarray:
    return ((tie.astype(np.int64) ^ doc) % n).astype(np.int32)


def sent_marks(batches, depth: int, digit: int, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Pass 1, sending: anchors by the bucket of their digit, and ranges already known to repeat by the bucket of their document."""
    worker_memory("")
    held, size = [], 0

    def flush():
        marks = np.concatenate(held)
        order = np.lexsort((marks["tie"], marks["at"], marks["doc"], marks["run"], marks["code"]))
        marks = marks[order]
        again = np.zeros(len(marks), bool)
        again[1:] = (marks["code"][1:] == marks["code"][:-1]) & (marks["run"][1:] == marks["run"][:-1])
        again[1:] &= (marks["doc"][1:] != marks["doc"][:-1]) | (marks["at"][1:] != marks["at"][:-1])
        yield from deal(as_ranges(marks[again], REPEATED, depth), doc_bucket(marks["doc"][again], marks["tie"][again], buckets), 1)
        marks = marks[~again]
        first, count = run_ends(marks["code"])
        nth = np.arange(len(marks)) - np.repeat(first, count)
        over = nth > hot  # such a digit is hot whatever other batches hold: no need to ask
        yield from deal(as_ranges(marks[over], COMPARE_HOT, depth), doc_bucket(marks["doc"][over], marks["tie"][over], buckets), 1)
        marks = marks[~over]
        yield from deal(marks, ((marks["code"] >> np.uint64(48)) % np.uint64(buckets)).astype(np.int32), 0)

    for batch in sliced(batches, "text"):
        raw, borders = text_bytes(batch.column("text"))
        rolling = Rolling(raw)
        at, lo, hi, code = anchors(raw, borders, depth, digit, rolling)
        which = np.searchsorted(borders, lo, "right") - 1
        marks = np.zeros(len(at), MARK)
        marks["code"], marks["run"] = code, rolling.spans(lo, hi + depth) & MASK
        marks["doc"], marks["tie"] = batch.column("doc").to_numpy()[which], batch.column("tie").to_numpy()[which]
        marks["at"], marks["span"] = lo - borders[which], hi - lo
        held.append(marks)
        size += len(raw)
        if size > FLUSH:
            yield table_of(flush())
            held, size = [], 0
    if held:
        yield table_of(flush())


def as_ranges(marks: np.ndarray, kind: int, depth: int) -> np.ndarray:
    """The bytes of all windows of each anchor."""
    out = np.zeros(len(marks), RANGE)
    for f in ("doc", "tie", "at", "code"):
        out[f] = marks[f]
    out["upto"], out["kind"] = marks["at"] + marks["span"] + depth, kind
    return out


def by_bucket(batches) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Rows (kind, n, blob) of each bucket of a partition sorted by bucket."""
    bucket, rows = None, []
    for batch in batches:
        for b, kind, n, blob in zip(*[batch.column(c).to_pylist() for c in ("bucket", "kind", "n", "blob")], strict=True):
            if b != bucket:
                if rows:
                    yield bucket, rows
                bucket, rows = b, []
            rows.append((kind, n, blob))
    if rows:
        yield bucket, rows


def sorted_marks(batches, depth: int, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Passes 1 and 2, receiving: verdicts by the bucket of their document. Known ranges pass through."""
    for bucket, rows in by_bucket(batches):
        out = [(bucket, 1, n, blob) for kind, n, blob in rows if kind == 1]
        marks = [unpacked(blob, n, MARK) for kind, n, blob in rows if kind == 0]
        if marks:
            m = np.concatenate(marks)
            m = m[np.argsort(m["code"], kind="stable")]
            _, count = run_ends(m["code"])
            m = m[np.repeat(count > 1, count)]
            m = m[np.lexsort((m["tie"], m["at"], m["doc"], m["run"], m["code"]))]
            if len(m):
                new = np.concatenate([[True], m["code"][1:] != m["code"][:-1]])
                head = new.copy()
                head[1:] |= m["run"][1:] != m["run"][:-1]
                same = np.zeros(len(m), bool)  # equal start in one document: not earlier
                same[1:] = ~head[1:] & (m["doc"][1:] == m["doc"][:-1]) & (m["at"][1:] == m["at"][:-1])
                lead = head.copy()
                for i in np.flatnonzero(same):
                    lead[i] = lead[i - 1]
                group = np.cumsum(new) - 1
                runs = np.bincount(group, head)[group]
                found = [as_ranges(m[~lead], REPEATED, depth), as_ranges(m[lead & (runs > 1) & (runs <= hot)], COMPARE, depth), as_ranges(m[lead & (runs > hot)], COMPARE_HOT, depth)]
                both = np.concatenate(found)
                out += deal(both, doc_bucket(both["doc"], both["tie"], buckets), 1)
        yield table_of(out)


def ranges_by_doc(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Ranges of each (doc, tie)."""
    parts = [unpacked(blob, n, RANGE) for n, blob in zip(table.column("n").to_pylist(), table.column("blob").to_pylist(), strict=True)]
    if not parts:
        return {}
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows["at"], rows["tie"], rows["doc"]))]
    edge = np.concatenate([[True], (rows["doc"][1:] != rows["doc"][:-1]) | (rows["tie"][1:] != rows["tie"][:-1])])
    first = np.append(np.flatnonzero(edge), len(rows))
    return {(int(rows["doc"][a]), int(rows["tie"][a])): rows[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)}


def merged(at: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Disjoint, not touching ranges (rows of start and end) that cover the same bytes."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(at, kind="stable")
    at, upto = at[order].astype(np.int64), np.maximum.accumulate(upto[order].astype(np.int64))
    new = np.concatenate([[True], at[1:] > upto[:-1]])
    return np.stack([at[new], np.append(upto[:-1][new[1:]], upto[-1])], 1)


def digest(text: bytes, cut: np.ndarray) -> tuple[int, int, int, str]:
    """Bytes, removed bytes, spans, sha256 of the rest."""
    h, at = hashlib.sha256(), 0
    for a, b in cut.tolist():
        h.update(text[at:a])
        at = b
    h.update(text[at:])
    return len(text), int((cut[:, 1] - cut[:, 0]).sum()), len(cut), h.hexdigest()


RESULT = "doc long, tie int, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
MIDDLE = f"{BLOBS}, to int, text binary, cut array<long>, {RESULT}"


def _row(kind: int, bucket: int, doc: int, tie: int, text: bytes, cut: np.ndarray, done: bool) -> dict:
    out = {"bucket": bucket, "kind": kind, "doc": doc, "tie": tie}
    if not done:
        return out | {"text": text, "cut": cut.ravel().tolist()}
    n, removed, spans, sha = digest(text, cut)
    return out | {"n_bytes": n, "n_removed": removed, "n_spans": spans, "kept_sha256": sha, "spans": cut.ravel().tolist()}


def _arrow(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def compared(docs: pa.Table, verdicts: pa.Table, depth: int, buckets: int) -> pa.Table:
    """Between passes 2 and 3, one bucket of documents: finished rows (kind 0), rows that wait (kind 1), and what pass 3
    needs, by the bucket it goes ``to``: bytes of runs to compare (kind 2), single windows of hot digits (kind 3), and ranges
    found to repeat within this bucket (kind 4). All rows bear the documents' bucket, so each task writes one file."""
    known = ranges_by_doc(verdicts)
    rows: list[dict] = []
    runs: list[tuple[int, np.ndarray, bytes]] = []
    hot: list[np.ndarray] = []
    bucket = docs.column("bucket")[0].as_py() if docs.num_rows else -1
    for doc, tie, text in zip(*[docs.column(c).to_pylist() for c in ("doc", "tie", "text")], strict=True):
        raw = (text or "").encode()
        own = known.get((doc, tie), np.zeros(0, RANGE))
        full = own[own["kind"] == REPEATED]
        cut = merged(full["at"], full["upto"])
        left = own[own["kind"] != REPEATED]
        if len(left):  # windows that lie in removed bytes still count as earlier ones
            for r in left:
                if r["kind"] == COMPARE:
                    runs.append((int(r["code"]), r, raw[r["at"] : r["upto"]]))
            for r in left[left["kind"] == COMPARE_HOT]:
                piece = np.frombuffer(raw[r["at"] : r["upto"]], np.uint8)
                w = np.zeros(len(piece) - depth + 1, WINDOW)
                w["code"] = Rolling(piece).all_of(depth)
                w["doc"], w["tie"], w["at"] = doc, tie, r["at"] + np.arange(len(w))
                hot.append(w)
        rows.append(_row(1 if len(left) else 0, bucket, doc, tie, raw, cut, not len(left)))
    if runs:
        runs.sort(key=lambda x: x[0])
        to = np.array([(c >> 20) % buckets for c, _, _ in runs])
        for b in np.unique(to).tolist():
            own = [runs[i] for i in np.flatnonzero(to == b).tolist()]
            ends = np.array([r for _, r, _ in own], RANGE)
            head = packed(ends)
            rows.append({"bucket": bucket, "to": b, "kind": 2, "n": len(own), "blob": head + b"".join(x for _, _, x in own)})
    if hot:
        w = np.concatenate(hot)
        w = w[np.lexsort((w["tie"], w["at"], w["doc"], w["code"]))]
        again = np.zeros(len(w), bool)
        again[1:] = (w["code"][1:] == w["code"][:-1]) & ((w["doc"][1:] != w["doc"][:-1]) | (w["at"][1:] != w["at"][:-1]))
        back = window_ranges(w[again], depth)
        rows += [{"bucket": bucket, "to": b, "kind": 4, "n": n, "blob": blob} for b, _, n, blob in deal(back, doc_bucket(back["doc"], back["tie"], buckets), 4)]
        w = w[~again]
        rows += [{"bucket": bucket, "to": b, "kind": 3, "n": len(x), "blob": w[x].tobytes()} for b, x in _by(w["code"] % np.uint64(buckets))]
    return _arrow(rows, MIDDLE)


def _by(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(to, kind="stable")
    first, count = run_ends(to[order])
    for a, n in zip(first.tolist(), count.tolist(), strict=True):
        yield int(to[order[a]]), order[a : a + n]


def window_ranges(w: np.ndarray, depth: int) -> np.ndarray:
    """Windows that repeat, joined to ranges where they follow one another."""
    w = w[np.lexsort((w["at"], w["tie"], w["doc"]))]
    out = np.zeros(len(w), RANGE)
    for f in ("doc", "tie", "at"):
        out[f] = w[f]
    out["upto"] = w["at"] + depth
    if len(w) < 2:
        return out
    new = np.concatenate([[True], (w["doc"][1:] != w["doc"][:-1]) | (w["tie"][1:] != w["tie"][:-1]) | (w["at"][1:] > w["at"][:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(w)) - 1
    short = out[first]
    short["upto"] = out["upto"][last]
    return short


def repeated_windows(batches, depth: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Pass 3, receiving: windows that also start earlier, by the bucket of their document."""
    for bucket, rows in by_bucket(batches):
        out: list[tuple[int, int, int, bytes]] = [(bucket, 1, n, blob) for kind, n, blob in rows if kind == 4]
        found = []
        for kind, n, blob in rows:
            if kind == 3:
                found.append(np.frombuffer(blob, WINDOW))
            elif kind == 2:
                head = sum(min(WIDTHS.get(f, 8), RANGE[f].itemsize) for f in RANGE.names) * n
                runs = unpacked(blob, n, RANGE)
                length = (runs["upto"] - runs["at"]).astype(np.int64)
                raw = np.frombuffer(blob, np.uint8, offset=head)
                code = Rolling(raw).all_of(depth)
                many = length - depth + 1
                w = np.zeros(int(many.sum()), WINDOW)
                w["code"] = code[ranges(np.cumsum(length) - length, many)]
                w["doc"], w["tie"] = np.repeat(runs["doc"], many), np.repeat(runs["tie"], many)
                w["at"] = ranges(runs["at"].astype(np.int64), many)
                found.append(w)
        if found:
            w = np.concatenate(found)
            w = w[np.argsort(w["code"], kind="stable")]
            _, count = run_ends(w["code"])
            w = w[np.repeat(count > 1, count)]
            w = w[np.lexsort((w["tie"], w["at"], w["doc"], w["code"]))]
            first, count = run_ends(w["code"])
            lead = np.repeat(first, count)
            later = (w["doc"] != w["doc"][lead]) | (w["at"] != w["at"][lead]) if len(w) else np.zeros(0, bool)
            back = window_ranges(w[later], depth)
            out += deal(back, doc_bucket(back["doc"], back["tie"], buckets), 1)
        yield table_of(out)


def finished(docs: pa.Table, more: pa.Table) -> pa.Table:
    """One bucket of waiting documents with the ranges of pass 3."""
    known = ranges_by_doc(more)
    rows = []
    for doc, tie, bucket, text, cut in zip(*[docs.column(c).to_pylist() for c in ("doc", "tie", "bucket", "text", "cut")], strict=True):
        own = known.get((doc, tie), np.zeros(0, RANGE))
        old = np.array(cut, np.int64).reshape(-1, 2)
        rows.append(_row(0, bucket, doc, tie, text, merged(np.concatenate([old[:, 0], own["at"]]), np.concatenate([old[:, 1], own["upto"]])), True))
    return _arrow(rows, RESULT)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, digit: int = DIGIT, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end of each removed run of bytes, flat)."""
    spark = docs.sparkSession
    n = partitions(spark)
    buckets = 4 * n
    missing = -(2**63)
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(missing)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.hash("text"))
    marks = keyed.mapInArrow(lambda b: sent_marks(b, depth, digit, buckets, hot), BLOBS)
    verdicts = marks.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: sorted_marks(b, depth, buckets, hot), BLOBS)
    place = F.pmod(F.col("tie").cast("long").bitwiseXOR(F.col("doc")), F.lit(buckets)).cast("int")
    met = keyed.withColumn("bucket", place).groupBy("bucket").cogroup(verdicts.groupBy("bucket")).applyInArrow(lambda a, b: compared(a, b, depth, buckets), MIDDLE)
    name = f"repeats_{uuid4().hex}"
    met.write.option("compression", "zstd").bucketBy(n, "bucket").saveAsTable(name)  # waiting documents stay where they are
    middle = spark.table(name)
    later = middle.where(F.col("kind") >= 2).select(F.col("to").alias("bucket"), "kind", "n", "blob").repartition(n, "bucket").sortWithinPartitions("bucket")
    found = settle(later.mapInArrow(lambda b: repeated_windows(b, depth, buckets), BLOBS), "windows")
    waiting = middle.where(F.col("kind") == 1).select("bucket", "doc", "tie", "text", "cut")
    rest = waiting.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(finished, RESULT)
    done = middle.where(F.col("kind") == 0).select("doc", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans").unionByName(rest)
    return done.select(F.when(F.col("doc") != missing, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
