"""Resharding by minimum-cost flow: new capacities are filled so that the fewest bytes leave their shard.

Documents of an old shard fall into ``blocks`` hash blocks; their sizes are all the driver sees (old shards x blocks rows,
whatever the data's size). A flow network old shard -> new shard (cost 0 where a shard keeps its own bytes, else 1 a byte,
or a given cost matrix) gives the bytes of each transfer. Blocks then realise the transfers: kept ones first, the largest
first, each where most room is left. Only shards that lose or gain a block are written again, straight from the tasks that
read them: texts are never shuffled.

Defined cases: null text has no bytes (size 1); a null old shard counts as a retired shard of its own; repeated rows fall into
the same block; an empty table has an empty plan; other columns travel along, ``shard`` and ``block`` replace columns of that name.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = 1024
Plan = dict[tuple[int, int], int]


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def with_block(df: DataFrame, old: Column, doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """Add ``old_shard`` (null: -1) and ``block``."""
    return df.withColumns({"old_shard": F.coalesce(old.cast("int"), F.lit(-1)), "block": F.pmod(F.xxhash64(doc_id, text), F.lit(blocks)).cast("int")})


def block_sizes(df: DataFrame, size: Column) -> dict[tuple[int, int], tuple[int, int]]:
    """Bytes and rows of each (old shard, block)."""
    rows = df.groupBy("old_shard", "block").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    return {(r["old_shard"], r["block"]): (r["bytes"], r["n"]) for r in rows}


def min_cost_flow(supply: Mapping[int, int], capacity: Mapping[int, int], cost: Mapping[tuple[int, int], int] | None = None) -> dict[tuple[int, int], int]:
    """Cheapest shipment of all supplies into the capacities, by successive shortest paths with potentials.

    Default cost: 0 for a shard's own bytes, 1 otherwise. Capacities must hold the supplies.
    """
    if sum(supply.values()) > sum(capacity.values()):
        raise ValueError("capacities are too small")
    price = (lambda i, j: cost[i, j]) if cost else (lambda i, j: int(i != j))
    source, sink = ("s",), ("t",)
    edges: dict[tuple, dict[tuple, list[int]]] = defaultdict(dict)  # node -> node -> [room, cost]

    def link(a, b, room, c):
        edges[a][b] = [room, c]
        edges[b].setdefault(a, [0, -c])

    for i, n in supply.items():
        link(source, ("old", i), n, 0)
        for j in capacity:
            link(("old", i), ("new", j), n, price(i, j))
    for j, n in capacity.items():
        link(("new", j), sink, n, 0)
    height = defaultdict(int)
    while True:
        dist, back, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for b, (room, c) in edges[a].items():
                reach = d + c + height[a] - height[b]
                if room > 0 and reach < dist.get(b, reach + 1):
                    dist[b], back[b] = reach, a
                    heapq.heappush(heap, (reach, b))
        if sink not in dist:
            break
        far = max(dist.values())
        for node in edges:
            height[node] += dist.get(node, far)
        path, b = [], sink
        while b != source:
            path.append((back[b], b))
            b = back[b]
        push = min(edges[a][b][0] for a, b in path)
        for a, b in path:
            edges[a][b][0] -= push
            edges[b][a][0] += push
    return {(i, j): n for i in supply for j in capacity if (n := edges["new", j][("old", i)][0])}


def place_blocks(sizes: Mapping[tuple[int, int], tuple[int, int]], capacity: Mapping[int, int], cost=None) -> Plan:
    """New shard of each (old shard, block), realising the flow in whole blocks."""
    supply: dict[int, int] = defaultdict(int)
    for (old, _), (n, _) in sizes.items():
        supply[old] += n
    flow = min_cost_flow(supply, capacity, cost)
    room = dict(capacity)
    plan: Plan = {}
    order = sorted(sizes, key=lambda b: (-sizes[b][0], b))
    stay = {old: flow.get((old, old), 0) for old in supply}
    for b in order:  # what stays: as much as fits, the largest first
        n = sizes[b][0]
        if n <= stay[b[0]] and n <= room.get(b[0], 0):
            plan[b] = b[0]
            stay[b[0]] -= n
            room[b[0]] -= n
    left = {(i, j): n for (i, j), n in flow.items() if i != j}
    for b in order:
        if b in plan:
            continue
        n = sizes[b][0]
        wanted = [j for j in capacity if left.get((b[0], j), 0) >= n and room[j] >= n]
        to = max(wanted or capacity, key=lambda j: (room[j], left.get((b[0], j), 0), -j))
        plan[b] = to
        room[to] -= n
        if (b[0], to) in left:
            left[b[0], to] -= n
    return plan


def even_capacity(total: int, shards: int) -> dict[int, int]:
    """Capacities that hold ``total`` and differ by at most one."""
    return {j: total // shards + (j < total % shards) for j in range(shards)}


def plan_frame(spark: SparkSession, plan: Plan, sizes: Mapping[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """The plan as a table of at most old shards x blocks rows: old_shard, block, shard, and the slot its first row takes."""
    start: dict[int, int] = defaultdict(int)
    rows = []
    for (old, block), shard in sorted(plan.items()):
        rows.append((old, block, shard, start[shard]))
        start[shard] += sizes[old, block][1]
    return spark.createDataFrame(rows, "old_shard int, block int, shard int, first_slot long")


def affected(plan: Plan) -> set[int]:
    """Shards that lose or gain a block: only their files change."""
    moved = {(old, new) for (old, _), new in plan.items() if old != new}
    return {x for pair in moved for x in pair}


def rewrite(df: DataFrame, plan: DataFrame, path: str, only: Sequence[int] | None = None) -> None:
    """Write the new shards' rows under ``path``/shard=N. ``only``: the shards that change (see ``affected``); the files of
    others stay where they are. The plan is small by construction, so it is broadcast."""
    placed = df.drop("shard").join(F.broadcast(plan.select("old_shard", "block", "shard")), ["old_shard", "block"])
    if only is not None:
        placed = placed.where(F.col("shard").isin(*only))
    placed.write.partitionBy("shard").parquet(path)


def reshard_files(spark: SparkSession, root: str, shards: Sequence[int], capacity: Mapping[int, int], out: str, doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> dict[int, str]:
    """Move a sharded data set (``root``/shard=N) to new capacities. Returns the folder of each new shard: the old one
    for shards that keep every row and gain none, a new one below ``out`` for the rest."""
    stored = spark.read.parquet(root)
    df = with_block(stored, F.col("shard"), doc_id, text, blocks)
    sizes = block_sizes(df, size_of(F.col(text)))
    plan = place_blocks(sizes, capacity)
    changed = affected(plan)
    if changed:
        rewrite(df.where(F.col("old_shard").isin(*changed)), plan_frame(spark, plan, sizes), out, sorted(changed))
    return {j: f"{out if j in changed else root}/shard={j}" for j in capacity if j in changed or j in shards}
