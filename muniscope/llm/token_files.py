"""Token ids in ORC files: run-length coded integers, row indexes, and Bloom filters on document ids.

Files follow ascending doc_id (nulls first): documents are dealt by range, sorted, encoded and written by the task that
holds the range, so the order costs one shuffle of the texts and no id is moved again. Each row also has ``part`` (number
of its file) and ``part_start`` (ids before it in that file), from which ``with_start`` makes corpus-wide offsets by a sum
over files only. Stripes are read in parallel by the usual splits; a search by doc_id skips files and row groups by
min/max and Bloom filters (``find_documents``).

Defined cases: null text is empty and has the end id alone; documents with equal or null ids keep one fixed order (by a
hash of the text); repeated rows are all written; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import list_array, partitions, sliced
from .tokens import encoder, with_end

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
    "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "orc.encoding.strategy": "SPEED",
}


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text", files: int | None = None) -> None:
    """Encode every whole text, append ``end``, write in ascending id order."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = ["doc_id", "tie"]
    dealt = rows.repartitionByRange(files or partitions(docs.sparkSession), *order).sortWithinPartitions(*order).drop("tie")

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, "text", 4 << 20):
            ids, counts = with_end(*encoder(tokenizer).encode(batch.column("text")), end)
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(starts), pa.array(counts), list_array(pa.array(ids), counts)],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )

    dealt.mapInArrow(run, SCHEMA).write.options(**OPTIONS).orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def find_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """Rows of a few documents; files and row groups without them are skipped by the metadata."""
    return read_token_ids(spark, path).where(F.col("doc_id").isin(*doc_ids))


def with_start(tokens: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before this one. The sums by file (of the ``stored`` rows) are as many rows as files."""
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return tokens.join(F.broadcast(base), "part").withColumn("start", F.col("__base") + F.col("part_start")).drop("__base")


def with_checksum(tokens: DataFrame, keep: Sequence[str], name: str = "ids_crc32") -> DataFrame:
    """Columns ``keep`` and the crc32 of each row's ids as little-endian unsigned 32-bit integers. Map-only."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*keep).schema) + f", {name} long"

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            borders = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1].tolist()
            raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sums, pa.int64())], names=[*keep, name])

    return tokens.select(*keep, "ids").mapInArrow(run, schema)
