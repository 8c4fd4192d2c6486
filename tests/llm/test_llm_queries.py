"""Each query against a plain version on the smallest tables."""

import hashlib
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SMALL  # noqa: E402

from muniscope.llm import fingerprint, language_id, line_dedup  # noqa: E402
from muniscope.llm.queries import QUERIES  # noqa: E402


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def token_ids(rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: np.array(e.ids, "<u4") for (i, _), e in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True)}


def test_reshard(spark, corpus):
    rows = QUERIES["op1_reshard"](spark, SMALL).collect()
    texts = dict(corpus[1])
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards = defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(8))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(sizes) - min(sizes) < 0.01 * max(sizes)
    total, old = sum(sizes), defaultdict(int)
    for r in rows:
        old[r["old_shard"]] += r["size"]
    moved = sum(r["size"] for r in rows if r["shard"] != r["old_shard"])
    least = sum(max(0, n - total // 8) for n in old.values())
    assert least <= moved <= least + 0.01 * total


def test_token_files(spark, corpus):
    got, at = by_id(QUERIES["op2_token_files"](spark, SMALL)), 0
    for i, ids in token_ids(corpus[1]).items():
        whole = np.append(ids, np.uint32(2)).astype("<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(whole), zlib.crc32(whole.tobytes()))
        at += len(whole)


def test_line_dedup(spark, corpus):
    got = by_id(QUERIES["op3_line_dedup"](spark, SMALL))
    for i, (n, gone, text) in brute.lines(corpus[1]).items():
        assert (got[i]["n_lines"], got[i]["n_removed_lines"], got[i]["kept_sha256"]) == (n, gone, hashlib.sha256(text.encode()).hexdigest())


def test_language_id(spark, corpus):
    got = by_id(QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01"))
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert got.keys() == lang.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [r["lang_pred"] == lang[i] for i, r in got.items() if r["held_out"]]
    assert np.mean(held) > 0.95


def test_fingerprints(spark, corpus):
    got = by_id(QUERIES["op7_fingerprints"](spark, SMALL))
    rows = corpus[1][::-1]
    printed = {}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert abs(r["near_edited"] - brute.containment(t.encode(), changed.encode())) < 1e-12
        assert abs(r["near_next"] - brute.containment(t.encode(), after.encode())) < 1e-12
        lengths = sorted(int(e) & 0xFFFF for e in fingerprint.from_text(r["fingerprint"]))
        assert lengths == sorted(len(c) for c in set(brute.chunks(t.encode())))
        for text, key in ((t, "fingerprint"), (changed, "edited_fingerprint")):
            assert printed.setdefault(text, r[key]) == r[key]


def test_ranges_by_binary_search(spark):
    cuts = [-5, 0, 3, 3 + 2**40, 2**62]
    keys = [-(2**63), -5, -4, 0, 1, 3, 4, 2**40, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for some in (cuts, cuts[:1], cuts[:4], []):
        got = df.select("k", fingerprint.range_of(F.col("k"), some).alias("r")).collect()
        assert all(r["r"] == sum(c < r["k"] for c in some) for r in got)


def check_packing(rows, ids, end=1, size=2048):
    pieces, held = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = np.append(ids[r["doc_id"]], np.uint32(end)).astype("<u4")
        assert r["doc_tokens"] == len(whole)
        assert r["ids_crc32"] == zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for own, total in [(v, len(ids[i]) + 1) for i, v in pieces.items()] + [(v, None) for v in held.values()]:
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == total if total is not None else at <= size
    assert sorted(held) == list(range(len(held)))
    return sum(r["length"] for r in rows) / (size * len(held))


def test_packing(spark, corpus):
    rows = QUERIES["op8_packing"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in corpus[1]}
    assert check_packing(rows, token_ids(corpus[1])) > 0.97


def test_near_dedup(spark, corpus):
    got = by_id(QUERIES["op9_near_dedup"](spark, SMALL))
    want = brute.components(corpus[1], 2)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_repeats(spark, corpus):
    got = by_id(QUERIES["op10_repeats"](spark, SMALL))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute.repeats(corpus[1])


def test_pipeline(spark, corpus):
    docs, rows = corpus
    model = language_id.fit(docs.where("crc32(CAST(doc_id AS STRING)) % 3 <> 1"))
    named = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    rows = [(i, t) for i, t in rows if named[i]["lang_pred"] != "und"]
    rows = [(i, t) for i, (n, gone, t) in brute.lines(rows).items() if not (gone and gone == n)]
    groups = brute.components(rows, 5)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = brute.windows(items)
    rows = [(i, t) for i, t in rows if not (lambda n, hit: hit > 0 and 20 * hit >= n)(*brute.hit_words(t, windows))]
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in rows}
    assert check_packing(got, token_ids(rows)) > 0.95


def test_line_boundaries_resist_shifts():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 2**63, 400).astype(np.uint64)
    moved = np.concatenate([rng.integers(0, 2**63, 7).astype(np.uint64), code])
    own, other = set(line_dedup.coarse_ends(code, np.arange(400)).tolist()), {e - 7 for e in line_dedup.coarse_ends(moved, np.arange(407)).tolist()}
    assert {e for e in own if e > 2} == {e for e in other if e > 2} and len(own) > 60
    alone, behind = (list(zip(*[x.tolist() for x in line_dedup.chunks(c)], strict=True)) for c in (code, moved))
    pairs = [(a, n) for a, n in alone if n == 2]
    assert set(pairs) <= {(a - 7, n) for a, n in behind} and len(pairs) >= 398
    both = line_dedup.chunks(np.concatenate([code, moved]), np.concatenate([np.arange(400), np.arange(407)]))
    assert sorted(zip(*[x.tolist() for x in both], strict=True)) == sorted(alone + [(400 + a, n) for a, n in behind])
    assert len(line_dedup.chunks(code[:1])[0]) == 0
