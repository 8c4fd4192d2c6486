"""Shared building blocks that keep hot keys and global orderings distributed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import shared_folder

def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame, **options: str) -> DataFrame:
    """Compute once where several later steps read the result: written to the shared folder and read back.

    Nothing stays in executor memory, and a lost executor costs no more than this step.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_step(df: DataFrame) -> DataFrame:
    """``settle`` for a long job of wide steps, whose shuffle files are let go with each step.

    Spark removes them once the driver has collected what refers to them, which by itself may not happen before the job
    ends. So the disk holds the shuffles of one step beside the settled tables, not those of all steps. The end of a step may
    still be on its way to the listeners when it returns: what such an event held goes before the next step begins.
    """
    collect = df.sparkSession.sparkContext._jvm.System.gc
    collect()
    out = settle(df, compression="zstd")
    collect()
    return out


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition that treats null keys as equal."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def sorted_parts(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], size: int, buckets: int | None = None) -> DataFrame:
    """Add ``part``: rows of a group in ``order``, cut every ``size`` rows (0 for the first ``size``). Holds for groups of any size."""
    out = running(
        df,
        by,
        sort_key(*order),
        local={"__rn": lambda w: F.row_number().over(w)},
        block={"__n": lambda k: F.count(F.lit(1))},
        carry={"__before": lambda w: F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1))},
        buckets=buckets,
    )
    place = F.col("__rn") + F.coalesce(F.col("__before"), F.lit(0)) - 1
    return out.withColumn("part", F.floor(place / size).cast("int")).drop("__rn", "__before")


def pack_blocks(df: DataFrame, keys: Sequence[str], payload: Column, spread: Sequence[str], size: int = 2048) -> DataFrame:
    """Collect rows into arrays of about ``size``: one output row per (keys, block) with ``items`` and ``blocks``.

    ``blocks`` is how many blocks the key has, so a probe row can be sent to each of them by an equi-join.
    """
    base = df.select(*keys, payload.alias("__item"), F.xxhash64(*spread).alias("__h"))
    if keys:
        counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        base = base.join(counts, list(keys))
    else:
        base = base.withColumn("__n", base.agg(F.count(F.lit(1))).scalar())
    blocks = F.ceil(F.col("__n") / size).cast("int")
    return (
        base.withColumn("blocks", blocks)
        .withColumn("block", F.pmod("__h", F.col("blocks")).cast("int"))
        .groupBy(*keys, "block", "blocks")
        .agg(F.collect_list("__item").alias("items"))
    )


def probe_blocks(probe: DataFrame, packed: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Meet every probe row with every block of its key. Rows are copied once per block, never per item.

    The packed side is the small one; a hot key, or no key at all, is met by all tasks (``deal_out``).
    """
    if keys:
        counts = packed.groupBy(*keys).agg(F.max("blocks").alias("__nblocks"))
        left = probe.join(counts, list(keys), how)
    else:
        left = probe.withColumn("__nblocks", packed.agg(F.max("blocks")).scalar())
    left = left.withColumn("block", F.explode_outer(F.sequence(F.lit(0), F.col("__nblocks") - 1))).drop("__nblocks")
    return deal_out(left, packed.drop("blocks"), [*keys, "block"], how)


def deal_out(probe: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join whose work is dealt out over all tasks, however few keys there are.

    The small side is copied to as many salts as there are shuffle partitions and probes are salted. Both sides are dealt
    out by number, because few bytes here can be much work, and by their size they would be put together into one task. The
    copies are never broadcast: Spark takes their size for that of one copy.
    """
    salts = partitions(probe)
    left = probe.withColumn("__salt", F.pmod(F.xxhash64(*probe.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    at = [*on, "__salt"]
    return left.repartition(salts, *at).join(copies.repartition(salts, *at).hint("merge"), at, how).drop("__salt")


def sort_key(*cols: Column | str) -> Column:
    """One ascending struct out of several sort columns (nulls first)."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(cols)])


def descending_key(score: Column | str, *ties: Column | str) -> Column:
    """Ascending struct equivalent to ``score desc nulls last, ties asc``."""
    s = F.col(score) if isinstance(score, str) else score
    return sort_key(s.isNull(), -s, *ties)


def ordered_buckets(df: DataFrame, key: Column, name: str = "__bucket", buckets: int | None = None) -> DataFrame:
    """Rows in contiguous ranges of ``key``, numbered: every key in range i sorts before every key in range i+1.

    A range exchange cuts as many ranges as the session has shuffle partitions, and ``buckets`` at least. The numbered
    rows are settled, so all later steps see the same ranges.
    """
    return settle(df.repartitionByRange(max(buckets or 1, partitions(df)), key).withColumn(name, F.spark_partition_id()))


def running(
    df: DataFrame,
    by: Sequence[str],
    key: Column,
    local: dict[str, Callable[[WindowSpec], Column]],
    block: dict[str, Callable[[Column], Column]],
    carry: dict[str, Callable[[WindowSpec], Column]],
    buckets: int | None = None,
) -> DataFrame:
    """Prefix computation along ``key`` inside ``by`` in two levels, so one group may span many tasks.

    local   columns over an ordered window of (by, bucket)
    block   one aggregate per (by, bucket); each gets the sort key column
    carry   columns over the ordered block table of a ``by``
    """
    keyed = df.withColumn("__key", sort_key(*by, key) if by else sort_key(key))
    placed = ordered_buckets(keyed, F.col("__key"), buckets=buckets)
    w = Window.partitionBy(*by, "__bucket").orderBy("__key")
    out = placed.select("*", *[f(w).alias(name) for name, f in local.items()])
    blocks = placed.groupBy(*by, "__bucket").agg(*[f(F.col("__key")).alias(name) for name, f in block.items()])
    wb = Window.partitionBy(*by).orderBy("__bucket")
    carried = blocks.select(
        *[F.col(b).alias(f"__r_{b}") for b in by],
        F.col("__bucket").alias("__rb"),
        *[f(wb).alias(name) for name, f in carry.items()],
    )
    cond = out["__bucket"] == carried["__rb"]
    for b in by:
        cond = cond & out[b].eqNullSafe(carried[f"__r_{b}"])
    return out.join(carried, cond, "left").drop("__key", "__bucket", "__rb", *[f"__r_{b}" for b in by])
