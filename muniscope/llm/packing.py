"""Shortest-pack-first packing over the histogram of lengths.

Documents are encoded, ended and cut into pieces of at most ``size`` ids. Only the histogram (at most ``size`` counts) goes
to the driver. Lengths are placed longest first, all pieces of a length together: they join the shortest packs (those with
most room) while these fit, splitting a packing pattern's count where only some of its packs are used, and open new packs
otherwise. The patterns are joined back to the pieces by rank: the r-th piece of a length takes the r-th place that the
patterns have for it. A rank is the piece's number among the pieces of its length that its own task made, plus those of the
tasks before, so a length that a third of all pieces share is ranked by many tasks. ``sequences`` then brings the ids of a
sequence together; ids travel as little-endian unsigned integers of ``width`` bytes in one binary value
(``numpy.frombuffer(x, "<u4")``): four, or two where the vocabulary is small enough, which halves what is moved and stored.

Defined cases: null text is empty and is the end id alone; repeated rows are packed each; null ids are kept; an empty
table packs nothing; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import offsets, run_ends, settle, sliced, text_bytes
from .tokens import encoder, with_end

SIZE = 2048
SENT = 1 << 20  # rows of 16 bytes that may be sent to all tasks
PIECES = "doc_id long, start long, length int, doc_tokens long, task int, nth long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, end: int, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """Pieces of at most ``size`` ids: doc_id, start, length, doc_tokens, ids, and task and nth (its place among the pieces of
    its length that one task made)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in sliced(batches, "text", 4 << 20):
            ids, counts = with_end(*encoder(tokenizer).encode(batch.column("text")), end)
            pieces = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
            length = np.minimum(size, counts[doc] - start)
            by_length = np.argsort(length, kind="stable")
            first, many = run_ends(length[by_length])
            nth = np.empty(len(doc), np.int64)
            nth[by_length] = np.arange(len(doc)) - np.repeat(first, many)
            nth += seen[length]
            seen += np.bincount(length, minlength=size + 1)
            if len(ids) and int(ids.max()) >> (8 * width):
                raise ValueError(f"an id does not fit into {width} bytes")
            borders = pa.array((width * np.concatenate([[0], np.cumsum(length)])).astype(np.int32))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, borders.buffers()[1], pa.py_buffer(ids.astype(f"<u{width}"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(counts[doc]), pa.array(np.full(len(doc), task, np.int32)), pa.array(nth), packed],
                names=["doc_id", "start", "length", "doc_tokens", "task", "nth", "ids"],
            )

    return rows.mapInArrow(run, PIECES)


def pack_histogram(histogram: Mapping[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in the order they were placed) and how many packs follow each."""
    by_room: dict[int, list[list]] = {}  # room left -> [pattern, count]
    for length in sorted(histogram, reverse=True):
        todo, grown = histogram[length], []
        while todo:
            room = max((r for r, packs in by_room.items() if packs), default=0)
            if room < length:
                grown.append([size - length, [(length,), todo]])
                todo = 0
                continue
            pattern, count = by_room[room].pop()
            used = min(count, todo)
            if used < count:
                by_room[room].append([pattern, count - used])
            todo -= used
            left = room - length
            if left >= length and todo:  # such a pack may still be among the shortest for this length
                by_room.setdefault(left, []).append([(*pattern, length), used])
            else:
                grown.append([left, [(*pattern, length), used]])
        for left, pack in grown:
            by_room.setdefault(left, []).append(pack)
    packed: dict[tuple[int, ...], int] = {}
    for packs in by_room.values():
        for pattern, count in packs:
            packed[pattern] = packed.get(pattern, 0) + count
    return sorted(packed.items(), reverse=True)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Runs of places: length, first rank, rank behind the run, sequence of the first rank, offset in the sequence."""
    taken: dict[int, int] = {}
    base, out = 0, []
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            out.append((length, first, first + count, base, offset))
            taken[length] = first + count
            offset += length
        base += count
    return out


def with_rank(pieces: DataFrame) -> DataFrame:
    """Add ``rank``: 0, 1, ... within each length, in place of task and nth."""
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = settle(counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    if base.count() <= SENT:  # a row for each task and length; where these are more, the pieces are dealt by both
        base = F.broadcast(base)
    return pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth")).drop("task", "nth", "base")


def pack(spark: SparkSession, pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add sequence_id and offset to the pieces. Give a settled table: it is read twice."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(places(pack_histogram(histogram, size)), "length int, first long, behind long, base_sequence long, offset long")
    ranked = with_rank(pieces)
    met = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("behind"))).drop(runs["length"])
    return met.withColumn("sequence_id", F.col("base_sequence") + F.col("rank") - F.col("first")).drop("rank", "first", "behind", "base_sequence")


def sequences(packed: DataFrame, size: int = SIZE, pad: int = 0, width: int = 4) -> DataFrame:
    """Whole sequences of ``size`` ids: sequence_id, ids (padded with ``pad``), n_used, and their pieces in order: doc_id,
    start, length, doc_tokens, offset. At most ``size`` pieces meet in one."""
    piece = F.struct("offset", "doc_id", "start", "length", "doc_tokens")
    joined = packed.groupBy("sequence_id").agg(
        F.expr("listagg(ids) WITHIN GROUP (ORDER BY offset)").alias("used"), F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("length").cast("int").alias("n_used")
    )
    padding = F.unhex(F.repeat(F.lit(pad.to_bytes(width, "little").hex()), size - F.col("n_used")))
    return joined.select("sequence_id", F.concat("used", padding).alias("ids"), "n_used", "pieces")


def write_sequences(packed: DataFrame, path: str, size: int = SIZE, pad: int = 0, width: int = 4) -> DataFrame:
    """Write the sequences as Parquet and read them back."""
    whole = sequences(packed, size, pad, width)
    whole.write.option("compression", "zstd").parquet(path)
    return packed.sparkSession.read.schema(whole.schema).parquet(path)


def placements(stored: DataFrame, width: int = 4) -> DataFrame:
    """The pieces that written sequences hold: doc_id, start, length, ids_crc32 (of the ids found there, as little-endian
    unsigned 32-bit integers), doc_tokens, sequence_id, offset. Map-only."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces = batch.column("pieces")
            many = np.diff(offsets(pieces))
            each = pieces.flatten()
            place, length = (each.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("offset", "length"))
            raw, borders = text_bytes(batch.column("ids"))
            wide = memoryview(raw.view(f"<u{width}").astype("<u4")).cast("B")
            start = np.repeat(borders[:-1] // width, many) + place
            sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(start.tolist(), (start + length).tolist(), strict=True)]
            of = pa.array(np.repeat(np.arange(batch.num_rows), many))
            yield pa.RecordBatch.from_arrays(
                [each.field("doc_id"), each.field("start"), pa.array(length), pa.array(sums, pa.int64()), each.field("doc_tokens"), batch.column("sequence_id").take(of), pa.array(place)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return stored.select("sequence_id", "ids", "pieces").mapInArrow(run, kind)
