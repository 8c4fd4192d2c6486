"""Parts the corpus operators share: shared-folder tables, Arrow batches cut by bytes, byte-level hashing."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder

_OWN: dict[str, str] = {}
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``. Only a local session may do without it."""
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


def settle(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back, so that a lost executor never costs more than one step."""
    path = workspace(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[str, dict] = {}


def worker_memory(name: str) -> dict:
    """What a Python worker keeps between tasks under ``name``. Whatever another operator kept in it is let go first, so
    one worker's memory never adds up over the operators of a pipeline."""
    for other in [k for k in _HELD if k != name]:
        del _HELD[other]
    return _HELD.setdefault(name, {})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes a piece; a longer single row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def offsets(col: pa.Array) -> np.ndarray:
    """Row borders of a string or binary array, one more than rows, in bytes of its data buffer."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the row borders in them, starting at 0. Null counts as empty."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    ends = offsets(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def strings(col: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return ["" if x is None else x for x in col.to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= M1
    x ^= x >> np.uint64(33)
    x *= M2
    x ^= x >> np.uint64(33)
    return x


def byte_table(seed: int) -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n] if n else out[:0]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each raw[start:end], by the same prefix sums for all spans: equal bytes give equal values anywhere."""
    base = 0x9E3779B97F4A7C15 | 1
    back = pow(base, -1, 1 << 64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(byte_table(seed)[raw] * powers(base, len(raw)), out=total[1:])
    shift = powers(back, len(raw) + 1)
    return mix((total[ends] - total[starts]) * shift[starts] + (ends - starts).astype(np.uint64) * M1)


def run_ends(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal values in a sorted array."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return first, np.diff(np.append(first, len(key)))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start..start+length-1 for each pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.repeat(starts - at, lengths) + np.arange(total)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """One list a row out of concatenated values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors (once a session), for clusters whose Python does not have it installed."""
    sc = spark.sparkContext
    if _OWN.get("shipped") != sc.applicationId:
        top = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for p in top.rglob("*.py"):
                z.write(p, p.relative_to(top.parent))
        sc.addPyFile(str(target))
        _OWN["shipped"] = sc.applicationId
    return spark
