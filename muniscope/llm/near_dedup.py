"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct ``shingle``-word shingles (words split at ASCII white space, A-Z lower-cased; fewer
words: the whole sequence as one). Each of ``REGISTERS`` buckets has its own hash function and keeps its smallest value
compressed to the count of leading zeros and ``MANTISSA`` bits behind them. ``ROWS`` registers make a band; documents that
agree in a band are candidates. Two documents' similarity is estimated from agreeing registers less those expected to
agree by chance of compression, and candidates not far below the threshold are verified on their full sets.

Work is bounded without dropping anything: equal texts are first reduced to one document. In a band's bucket every member
is verified against one of them only (a star, never all pairs): the one that meets most others over all of its buckets,
which in a group of copies is the one they were made from. Buckets whose members then still lie in different
components are finished in blocks: members outside the first one's component meet all members by their registers, block
by block; only pairs of different components that the estimate lets pass are verified. So every candidate pair is either
linked, or known to lie in one component, or rejected by estimate or by full sets.

At similarity 0.8, a pair shares no band with a chance of 5e-8; the estimate rejects it with one of about 1e-6.

Words of more than ``LONG_WORD`` bytes are hashed by blake2b: sums of powers modulo 2**64 give equal values for long words
of a certain form.

Defined cases: null, empty and word-free texts have an empty set and are linked with nothing; a row without id takes no
part and is kept, with a null component; rows that share an id are documents of their own, each linked by its text, and a
component's id is the smallest id in it; equal texts are linked if they have words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, M2, mix, partitions, settle, sliced, span_hashes, text_bytes, worker_memory
from .links import components

REGISTERS, ROWS, MANTISSA = 128, 4, 8
SLACK = 5.0  # standard deviations below the threshold that still get verified
MEMBERS, STRAYS, GROUP = 512, 256, 100
LONG_WORD = 64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
FACTOR = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
SHIFT = mix(np.arange(1001, 1001 + REGISTERS, dtype=np.uint64)).astype(np.uint32)


def shingles(raw: np.ndarray, borders: np.ndarray, shingle: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle hashes of texts that lie one behind the other, sorted and distinct within each text, and their counts."""
    low = LOWER[raw]
    solid = ~SPACE[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    inner = borders[(borders > 0) & (borders < len(raw))]  # a word never crosses into the next text
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    word = span_hashes(low, starts, ends, seed=5)
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        word[i] = int.from_bytes(hashlib.blake2b(low[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    first = np.searchsorted(starts, borders)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    size = np.minimum(shingle, n_words)
    n_out = np.where(n_words > 0, n_words - size + 1, 0)
    place = np.arange(len(word)) - first[:-1][doc]
    code = np.zeros(len(word), np.uint64)
    for k in range(shingle):
        ok = k < size[doc]
        ahead = np.minimum(np.arange(len(word)) + k, max(len(word) - 1, 0))
        code = np.where(ok, (code ^ word[ahead]) * M1 + M2 * np.array([k + 1], np.uint64), code)
    code = mix(code ^ size[doc].astype(np.uint64)) if len(code) else code
    keep = place < n_out[doc]
    code, doc = code[keep], doc[keep]
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    if len(code):
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])])
        code, doc = code[new], doc[new]
    return code, np.bincount(doc, minlength=len(n_words))


def registers(code: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Compressed registers of each set that is not empty: leading zeros in the upper bits, mantissa in the lower."""
    x = (code >> np.uint64(32)).astype(np.uint32)
    at = (np.cumsum(counts) - counts)[counts > 0]
    low = np.empty((len(at), REGISTERS), np.uint32)
    for j in range(REGISTERS):
        low[:, j] = np.minimum.reduceat(x * FACTOR[j] + SHIFT[j], at) if len(at) else 0
    return compress(low)


def compress(low: np.ndarray) -> np.ndarray:
    """32-bit minima to (leading zeros, mantissa) as 16-bit values."""
    _, exponent = np.frexp(low.astype(np.float64))  # low = m * 2**exponent, 0.5 <= m < 1
    zeros = np.where(low > 0, 32 - exponent, 32)
    behind = np.where(zeros < 31, (low.astype(np.uint64) << np.minimum(zeros + 1, 63).astype(np.uint64)) & np.uint64(0xFFFFFFFF), 0)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | (behind >> np.uint64(32 - MANTISSA))).astype(np.uint16)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of these sizes agrees after compression."""
    table = _chances()
    step = lambda n: np.clip(np.rint(2 * np.log2(np.maximum(n, 1))), 0, len(table) - 1).astype(int)
    return table[step(n_a), step(n_b)]


_CHANCES: list[np.ndarray] = []


def _chances(sizes: int = 60) -> np.ndarray:
    """For set sizes 2**0, 2**0.5, 2**1, ...: the sum over register values of both sets' chances to hold that value."""
    if not _CHANCES:
        zeros = np.arange(32)[:, None]
        low = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA)[None, :] / (1 << MANTISSA))
        wide = np.broadcast_to(2.0 ** -(zeros + 1) / (1 << MANTISSA), low.shape)
        n = 2.0 ** (np.arange(sizes) / 2)[:, None]
        held = np.exp(n * np.log1p(-np.minimum(low.ravel(), 1 - 1e-12))) - np.exp(n * np.log1p(-np.minimum((low + wide).ravel(), 1 - 1e-12)))
        _CHANCES.append(held @ held.T)
    return _CHANCES[0]


def estimate(agree: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the number of agreeing registers, corrected for chance agreements."""
    c = chance(n_a, n_b)
    return (agree / REGISTERS - c) / (1 - c)


def with_digest(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text (null as empty), digest of the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("digest"))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 2) -> DataFrame:
    """One narrow row a document: doc_id, n_shingles, digest (of the text), registers, bands. Map-only."""

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "text"):
            raw, borders = text_bytes(batch.column("text"))
            code, counts = shingles(raw, borders, shingle)
            regs = registers(code, counts)
            full = counts > 0
            words = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), -1) if len(regs) else np.zeros((0, REGISTERS // 4), np.uint64)
            bands = mix(mix(words) + np.arange(words.shape[1], dtype=np.uint64) * M1).view(np.int64) if len(regs) else np.zeros((0, REGISTERS // ROWS), np.int64)
            where = np.cumsum(full) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), batch.column("digest"),
                    pa.array([regs[where[i]].tobytes() if full[i] else b"" for i in range(len(counts))], pa.binary()),
                    pa.array([bands[where[i]] if full[i] else [] for i in range(len(counts))], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "registers", "bands"],
            )

    return with_digest(docs, doc_id, text).select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, registers binary, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    Every pair belongs to the group of its ``a``. A text goes once to each group it is in; a group of many pairs is dealt
    over several parts by ``b``, each with its own copy of the centre.
    """
    parts = settle(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts")), "parts")
    members = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("node"), F.lit(1).alias("role"))
    centres = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"), F.lit(0).alias("role"))
    seats = centres.unionByName(members)
    n = partitions(pairs.sparkSession)
    sent = seats.join(texts, "node").repartition(n, "a", "part").sortWithinPartitions("a", "part", "role").select("a", "part", "role", "node", "text")

    def run(batches):
        worker_memory("")
        group, centre = None, []
        for batch in sliced(batches, "text"):
            raw, borders = text_bytes(batch.column("text"))
            code, counts = shingles(raw, borders, shingle)
            ends = np.cumsum(counts)
            found_a, found_b = [], []
            for i, (a, part, role, b) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("a", "part", "role", "node")], strict=True)):
                own = code[ends[i] - counts[i] : ends[i]]
                if (a, part) != group:
                    group, centre = (a, part), []
                if role == 0:
                    centre.append(own.copy())
                    continue
                if any(alike(c, own, percent) for c in centre):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return sent.mapInArrow(run, "a long, b long").distinct()


def promising(pairs: DataFrame, regs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is not far below the threshold."""
    side = lambda c: regs.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    floor = lowest_estimate(percent)

    def run(batches):
        worker_memory("")
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
                r_a, r_b = (_registers_of(batch.column(c)) for c in ("r_a", "r_b"))
                keep = pa.array(estimate((r_a == r_b).sum(1), n_a, n_b) >= floor)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def lowest_estimate(percent: int) -> float:
    jaccard = percent / 100
    return jaccard - SLACK * (jaccard * (1 - jaccard) / REGISTERS) ** 0.5


def _registers_of(col: pa.Array) -> np.ndarray:
    raw, _ = text_bytes(col)
    return raw.view(np.uint16).reshape(-1, REGISTERS)


def block_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between different components in unfinished buckets.

    ``members``: bucket, band, doc_id, component, first (the bucket's centre), head (its component), n (members),
    strays (members of other components), n_shingles, registers.
    Strays are the members outside ``head``. Blocks of strays meet blocks of members, so a task holds two blocks at most,
    with their texts. A pair of different components that the estimate lets pass is verified on the full sets right there,
    in the first band where it agrees; a link joins its components for the rest of the block. So pairs never leave the
    task: what does is a forest of links, at most one for each row that came in.
    """
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    counted = members.withColumns({"m_blocks": blocks(F.col("n"), MEMBERS), "s_blocks": blocks(F.col("strays"), STRAYS)}).join(texts, "node")
    placed = counted.withColumns({"m": F.pmod(F.xxhash64("node", F.lit(1)), "m_blocks").cast("int"), "s": F.pmod(F.xxhash64("node", F.lit(2)), "s_blocks").cast("int")})
    keep = ["bucket", "band", "node", "component", "n_shingles", "registers", "text"]
    stray = placed.where((F.col("component") != F.col("head"))).select(*keep, "s", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)).alias("m"), F.lit(0).alias("role"))
    all_of = placed.where(F.col("node") != F.col("first")).select(*keep, F.explode(F.sequence(F.lit(0), F.col("s_blocks") - 1)).alias("s"), "m", F.lit(1).alias("role"))
    n = partitions(members.sparkSession)
    order = ["bucket", "s", "m", "role"]
    sent = stray.unionByName(all_of).repartition(n, *order[:3]).sortWithinPartitions(*order).select(*order, "band", "node", "component", "n_shingles", "registers", "text")
    floor = lowest_estimate(percent)

    def run(batches):
        worker_memory("")
        group, strays, joined = None, [], {}
        for batch in sliced(batches, "text"):
            raw, borders = text_bytes(batch.column("text"))
            code, counts = shingles(raw, borders, shingle)
            ends = np.cumsum(counts)
            sets = [code[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            keys = list(zip(*[batch.column(c).to_pylist() for c in order[:3]], strict=True))
            role, band = batch.column("role").to_numpy(), batch.column("band").to_numpy()
            ids, comps, sizes = (batch.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
            regs = _registers_of(batch.column("registers"))
            found: list[tuple[int, int]] = []
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if keys[a] != group:
                    group, strays, joined = keys[a], [], {}
                split = a + int((role[a:b] == 0).sum())
                strays += [(int(ids[i]), int(comps[i]), int(sizes[i]), regs[i].copy(), sets[i].copy()) for i in range(a, split)]
                if b > split:
                    found += _links(strays, ids[split:b], comps[split:b], sizes[split:b], regs[split:b], sets[split:b], int(band[split]), joined, floor, percent)
            yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()), pa.array([max(p) for p in found], pa.int64())], names=["a", "b"])

    return sent.mapInArrow(run, "a long, b long").distinct()


def _links(strays, ids, comps, sizes, regs, sets, band: int, joined: dict[int, int], floor: float, percent: int) -> Iterator[tuple[int, int]]:
    """A forest of links between strays and rows. ``joined``: components joined so far in this block."""

    def root(c: int) -> int:
        while c in joined:
            c = joined[c]
        return c

    for doc, comp, size, own, codes in strays:
        at = np.flatnonzero(comps != comp)
        if not len(at):
            continue
        same = regs[at] == own
        rough = estimate(same.sum(1), sizes[at], np.full(len(at), size))
        first = same.reshape(len(at), -1, ROWS).all(2).argmax(1) == band
        for j in at[(rough >= floor) & first].tolist():
            a, b = root(comp), root(int(comps[j]))
            if a != b and alike(codes, sets[j], percent):
                joined[a] = b
                yield doc, int(ids[j])


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    least, most = min(len(a), len(b)), max(len(a), len(b))
    if not least or 100 * least < percent * most:
        return False
    at = np.searchsorted(a, b)
    shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * shared >= percent * (least + most - shared)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All rows (node, doc_id, digest, n_shingles; node is a row number), and the nodes that are linked with their component:
    node, component (its smallest node)."""
    signs = settle(signatures(docs, doc_id, text, shingle).withColumn("node", F.monotonically_increasing_id()), "signatures")
    full = signs.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = settle(full.groupBy("digest").agg(F.min("node").alias("rep")), "classes")
    copies = full.select("digest", "node").join(classes, "digest").where(F.col("node") != F.col("rep")).select(F.col("rep").alias("a"), F.col("node").alias("b"))
    reps = full.join(classes.select(F.col("rep").alias("node")), "node", "left_semi")
    banded = reps.select("node", F.posexplode("bands").alias("band", "key")).select("node", "band", F.xxhash64("band", "key").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    members = settle(banded.join(settle(sizes, "sizes"), "bucket"), "members")
    met = settle(members.groupBy("node").agg(F.sum("size").alias("met")), "met")
    firsts = members.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("node")).alias("minus"))).alias("x")).select("bucket", (-F.col("x.minus")).alias("first"))
    crowded = settle(members.drop("size").join(settle(firsts, "firsts"), "bucket"), "buckets")
    stars = settle(crowded.where(F.col("node") != F.col("first")).select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    involved = crowded.select("node").distinct()
    regs = settle(reps.join(involved, "node", "left_semi").select("node", "doc_id", "digest", "n_shingles", "registers"), "registers")
    bodies = with_digest(docs, doc_id, text).join(regs.select("node", "doc_id", "digest"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    texts = settle(bodies.select("node", "text"), "texts")
    regs = regs.select("node", "n_shingles", "registers")
    linked = settle(verify(settle(promising(stars, regs, percent), "promising"), texts, shingle, percent), "linked")
    by_star = components(linked)
    known = settle(crowded.join(by_star, "node", "left").withColumn("component", F.coalesce("component", "node")), "known")
    unfinished = (
        known.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("node") == F.col("first")).alias("own"))
        .groupBy("bucket").agg(
            F.sum("n").alias("n"), F.sum(F.when(~F.col("own"), F.col("n"))).alias("strays"),
            F.max(F.when(F.col("own"), F.col("component"))).alias("head"), F.count(F.lit(1)).alias("components"),
        )
        .where((F.col("components") > 1) & (F.col("n") > 2)).drop("components")
    )
    left = known.join(settle(unfinished, "unfinished"), "bucket")
    again = settle(block_links(left.join(regs, "node"), texts, shingle, percent), "linked")
    return signs.select("node", "doc_id", "digest", "n_shingles"), components(linked.union(again).union(copies))


def _with_first(rows: DataFrame, found: DataFrame) -> DataFrame:
    """All rows with the smallest doc_id of their component, and the first row of it: (doc_id, node)."""
    members = settle(found.join(rows.select("node", "doc_id"), "node"), "grouped")
    least = settle(members.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("first")), "first-of-group")
    return rows.join(members.join(least, "component").select("node", "first"), "node", "left")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = _with_first(*groups(docs, doc_id, text, shingle, percent))
    return rows.select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents with one row of each component left (smallest id). Rows without id and rows without words all stay."""
    rows = settle(_with_first(*groups(docs, doc_id, text, **kw)), "first-rows")
    gone = rows.where(F.col("first").isNotNull() & (F.col("first.node") != F.col("node"))).join(
        rows.where(F.col("first.node") == F.col("node")).select("doc_id", "digest"), ["doc_id", "digest"], "left_anti"
    ).select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__digest_gone")).distinct()
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.withColumns({"__digest": F.substring(F.unhex(F.sha2(body, 256)), 1, 16), "__key": F.col(doc_id).cast("long")})
    left = named.join(gone, (F.col("__key") == F.col("__gone")) & (F.col("__digest") == F.col("__digest_gone")), "left_anti")
    several = F.col("__key").isNull() | ~body.rlike(r"[^\x20\x09-\x0D]")  # these are linked with nothing, repeated or not
    return left.withColumn("__row", F.when(several, F.monotonically_increasing_id())).dropDuplicates(["__key", "__digest", "__row"]).select(*docs.columns)
