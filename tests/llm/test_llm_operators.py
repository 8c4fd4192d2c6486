"""Edge cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from muniscope.llm import chat_format, decontaminate, fingerprint, language_id, line_dedup, links, near_dedup, packing, repeats, reshard, token_files, tokens
from muniscope.llm.common import settle, workspace

WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "the cat sat on the mat and then it ran. " * 400


def some(spark, rows, extra="source string"):
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


# 1
def test_flow_moves_least():
    flow = reshard.min_cost_flow({0: 10, 1: 2, 7: 3}, {0: 5, 1: 5, 2: 5})
    assert flow[0, 0] == 5 and flow[1, 1] == 2 and sum(flow.values()) == 15
    assert sum(n for (i, j), n in flow.items() if i != j) == 8
    priced = reshard.min_cost_flow({0: 4, 1: 4}, {2: 4, 3: 4}, {(0, 2): 5, (0, 3): 1, (1, 2): 2, (1, 3): 1})
    assert priced == {(0, 3): 4, (1, 2): 4}
    with pytest.raises(ValueError):
        reshard.min_cost_flow({0: 3}, {0: 2})


def test_reshard_files_leaves_other_shards_alone(spark, corpus):
    root, out = workspace(spark, "old"), workspace(spark, "new")
    corpus[0].withColumn("shard", (F.col("doc_id") % 4).cast("int")).write.partitionBy("shard").parquet(root)
    sizes = {r["shard"]: r["n"] for r in spark.read.parquet(root).groupBy("shard").agg(F.sum(reshard.size_of(F.col("text"))).alias("n")).collect()}
    wanted = {0: sizes[0] - 50_000, 1: sizes[1] + 50_000, 2: sizes[2], 3: sizes[3]}
    where = reshard.reshard_files(spark, root, [0, 1, 2, 3], wanted, out)
    assert where[2].startswith(root) and where[3].startswith(root) and where[0].startswith(out) and where[1].startswith(out)
    now = [spark.read.parquet(p).drop("old_shard", "block", "shard") for p in where.values()]
    assert sum(d.count() for d in now) == corpus[0].count()
    assert sorted(r[0] for d in now for r in d.select("doc_id").collect()) == [i for i, _ in corpus[1]]


def test_reshard_messy(spark, messy):
    blocked = reshard.with_block(messy, F.col("n"))
    sizes = reshard.block_sizes(blocked, reshard.size_of(F.col("text")))
    plan = reshard.place_blocks(sizes, reshard.even_capacity(sum(n for n, _ in sizes.values()), 3))
    out = workspace(spark, "messy")
    reshard.rewrite(blocked, reshard.plan_frame(spark, plan, sizes), out)
    assert spark.read.parquet(out).count() == 10
    assert reshard.place_blocks({}, {0: 0, 1: 0}) == {}


# 2
def test_token_files(spark, messy):
    path = workspace(spark, "ids")
    token_files.write_token_ids(messy, path, WORDS, 2, files=3)
    stored = token_files.with_start(token_files.read_token_ids(spark, path), token_files.read_token_ids(spark, path))
    rows = sorted(stored.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 2
        at += r["n_tokens"]
    assert rows[2]["ids"] == [2]
    empty = workspace(spark, "none")
    token_files.write_token_ids(messy.limit(0), empty, WORDS, 2)
    assert token_files.read_token_ids(spark, empty).count() == 0


def test_token_files_prune(spark, corpus):
    path = workspace(spark, "pruned")
    token_files.write_token_ids(corpus[0], path, WORDS, 2, files=4)
    found = token_files.find_documents(spark, path, [3, 150])
    assert {r["doc_id"] for r in found.collect()} == {3, 150}
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    import pyarrow.orc as orc

    raw = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".orc")]
    assert len(raw) == 4 and sum(orc.ORCFile(f).nstripes for f in raw) >= 4


def test_encoder_equals_library():
    library, rng = Tokenizer.from_file(WORDS), random.Random(5)
    texts = [
        "a\x0bb", "a\x1cb", "a\x85b c", "it's, we'll. 've, x'., a.. b., 3, é, É. İSTANBUL ΟΔΟΣ Σ.", "é a ́b", "<|startoftext|>Hi<|endoftext|>", "<|STARTOFTEXT|> a", "",
        "  ", "\n.,\n.", "don'T, I'D. A'S", "ÉA, ｆull", "日本語、テスト。", "ẞİ.", "a­, b‍.", "a.", ",a", ".a", "..", "a. b", None,
    ]
    texts += ["".join(rng.choice("abAB.,' \n\té1日<|>") for _ in range(60)) for _ in range(300)]
    ids, counts = tokens.encoder(WORDS).encode(pa.array(texts))
    border = np.concatenate([[0], np.cumsum(counts)])
    for i, t in enumerate(texts):
        assert ids[border[i] : border[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)


# 3
def test_line_dedup(spark, messy):
    got = line_dedup.dedup_lines(messy)
    assert got.columns == [c for c in messy.columns if c != "n_lines"] + ["n_lines", "n_removed_lines"]
    assert got.select("doc_id", "text", "source", "bucket").exceptAll(messy.select("doc_id", "text", "source", "bucket")).count() == 0  # no document has lines twice
    block = "\n".join(f"line {i} of the shared passage" for i in range(40))
    rows = [(i, f"head {i}\n" * (i % 3) + block + f"\nown end {i}", None) for i in range(6)] + [(6, None, None), (7, "", None)]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(some(spark, rows)).collect()}
    assert out[0]["n_removed_lines"] == 0 and all(out[i]["n_removed_lines"] >= 25 for i in range(1, 6))
    assert all(f"own end {i}" in out[i]["text"] for i in range(6)) and out[6]["text"] is None and out[7]["text"] == ""
    assert line_dedup.dedup_lines(some(spark, [])).count() == 0


# 4
def test_language_id(spark, messy, corpus):
    none = language_id.identify(messy, language_id.fit(messy.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    model = language_id.fit(corpus[0])
    got = language_id.identify(messy, model)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.columns == [c for c in messy.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (2, 3, 4)) and rows[7]["lang_pred"] != "und"
    assert language_id.identify(messy.limit(0), model).count() == 0
    x = np.random.default_rng(0).integers(0, 256, (40, language_id.WINDOW)).astype(np.uint8)
    p, pooled = model.weights, []
    for w in language_id.WIDTHS:
        z = sum(p["embed"][x][:, k : language_id.WINDOW - w + 1 + k] @ p[f"conv{w}"][k] for k in range(w)) + p[f"shift{w}"]
        pooled.append(np.maximum(z.max(1), 0))
    logits = np.concatenate(pooled, 1) @ p["out"] + p["bias"]
    want = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    assert np.abs(model.log_probs(x) - want).max() < 1e-4


def test_language_gradients():
    rng = np.random.default_rng(2)
    net = language_id.ByteConvNet(["a", "b"])
    x, y = rng.integers(0, 256, (5, 20)).astype(np.uint8), np.array([0, 1, 0, 1, 1])

    def loss():
        p, pooled = net.weights, []
        for w in language_id.WIDTHS:
            z = sum(p["embed"][x][:, k : 20 - w + 1 + k] @ p[f"conv{w}"][k] for k in range(w)) + p[f"shift{w}"]
            pooled.append(np.maximum(z.max(1), 0))
        logits = np.concatenate(pooled, 1) @ p["out"] + p["bias"]
        return -(logits - np.log(np.exp(logits).sum(1, keepdims=True)))[np.arange(5), y].mean()

    grads = net._gradients(x, y, np.ones(5))
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.weights[name][at]
        net.weights[name][at] = old + 1e-5
        up = loss()
        net.weights[name][at] = old - 1e-5
        down = loss()
        net.weights[name][at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4, name


# 5
def test_chat_parts(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    rows = [
        (1, 0, "user", [("text", "see [IMG] and \\[\\IMG]: ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("text", " then", None, None, None, None, None)]),
        (1, 1, "assistant", [("text", "yes</s>", None, None, None, None, None), ("audio", None, "b.wav", None, None, 2.0, None)]),
        (1, 2, "tool[:]", [("document", None, None, None, None, None, 3), ("odd", "kept", None, None, None, None, None)]),
        (2, None, None, None), (2, None, None, None), (None, 1, "system", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{part}>")
    got = {r["conv_id"]: r for r in chat_format.format_chats(df).collect()}
    one = got[1]
    assert one["formatted"] == "<s>[INST]see [\\IMG] and \\[\\\\IMG]: [IMG] then[/INST][ANS]yes<\\/s>[AUDIO]</s>[ROLE]tool[\\:][:][DOC]kept[/ROLE]"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [("image", "a.png", 4), ("audio", "b.wav", 25), ("document", None, 768)]
    raw = one["formatted"].encode()
    assert [raw[a["start"] :].startswith(chat_format.PLACEHOLDERS[a["kind"]].encode()) for a in one["attachments"]] == [True] * 3
    assert one["attachment_tokens"] == 797 and [raw[s["start"] : s["start"] + s["length"]] for s in one["loss_spans"]] == [b"yes<\\/s>", b"[AUDIO]"]
    assert got[2]["formatted"] == "<s>[ROLE][:][/ROLE][ROLE][:][/ROLE]" and got[2]["n_turns"] == 2
    assert got[None]["formatted"] == "<s>[SYS][/SYS]"
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_chat_escape_round_trip(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["[", "<", "\\", "/", "INST]", "s>", "IMG]", ":]", "ROLE]", "ANS]", "é", "\n"]) for _ in range(12)) for _ in range(300)] + ["", None]
    df = spark.createDataFrame([(i, 0, "assistant", t) for i, t in enumerate(texts)], "conv_id int, turn int, role string, text string")
    out = chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text"))))
    back = out.select("conv_id", chat_format.parse_turns(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in back:
        want = texts[r["conv_id"]] or ""
        assert len(r["t"]) == 1 and (r["t"][0]["role"], r["t"][0]["text"], r["loss"]) == ("assistant", want, want)


def test_chat_control_strings_over_part_borders(spark):
    words = ["a </s> b", "x [/INST] y", "[\\\\IMG]", "<s>[ANS]ok</s>", "[ROLE]z[:]q[/ROLE]"]
    cut2 = [(w[:i], w[i:]) for w in words for i in range(len(w) + 1)]
    cut3 = [(w[:i], w[i:j], w[j:]) for w in words for i in range(len(w) + 1) for j in range(i, len(w) + 1)]
    rows = [(n, k, role, [("text", t, None) for t in parts]) for n, parts in enumerate(cut2 + cut3) for k, role in enumerate(["user", "assistant", "x"])]
    rows.append((-1, 0, "assistant", [("text", "a </", None), ("image", None, "p.png"), ("text", "s> b [", None), ("text", "/INST]", None)]))
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, parts array<struct<kind:string,text:string,ref:string>>")
    out = chat_format.format_chats(df)
    back = {r["conv_id"]: r for r in out.select("*", chat_format.parse_turns(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for n, parts in enumerate(cut2 + cut3):
        want = "".join(parts)
        assert [(t["role"], t["text"]) for t in back[n]["t"]] == [("user", want), ("assistant", want), ("x", want)] and back[n]["loss"] == want
    assert back[-1]["formatted"] == "<s>[ANS]a </[IMG]s> b [\\/INST]</s>" and len(back[-1]["attachments"]) == 1


# 6
def test_decontaminate(spark, messy):
    items = spark.createDataFrame([(1, "The CAT sat, on the mat"), (2, "x"), (3, None), (4, ""), (None, "one two"), (5, "no id here"), (6, "x")], "item_id long, text string")
    got = decontaminate.decontaminate(messy, items)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[5]["contaminated"] and rows[5]["n_words"] == 4000 and rows[5]["n_hit"] == 2400 and rows[5]["item_ids"] == ["1"]
    assert rows[7]["item_ids"] == ["2", "6"] and rows[7]["n_hit"] == 1 and rows[None]["item_ids"] == ["5"] and not rows[1]["contaminated"]
    assert (rows[2]["n_words"], rows[2]["n_hit"], rows[2]["contaminated"]) == (0, 0, False) and got.count() == 10
    span = rows[None]["spans"][0]
    assert "no id here at all".encode()[span["start"] : span["end"]] == b"no id here"
    cut = decontaminate.decontaminate(messy, items, slice_chars=8)  # several automata give the same
    assert sorted(map(str, cut.select("doc_id", "n_hit", "item_ids").collect())) == sorted(map(str, got.select("doc_id", "n_hit", "item_ids").collect()))
    assert decontaminate.decontaminate(messy, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(messy.limit(0), items).count() == 0


# 7
def test_fingerprints(spark, messy):
    got = fingerprint.compare_with_next(messy)
    rows = got.collect()
    assert len(rows) == 10 and sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "2", "3", "None", "4", "5", "5", "6", "7", "8"])
    by = {r["doc_id"]: r for r in rows}
    assert by[6]["fingerprint"] == by[5]["fingerprint"] and by[6]["near_next"] == 1.0 and by[3]["near_next"] == 1.0 and by[3]["fingerprint"] == ""
    assert fingerprint.compare_with_next(messy.limit(0)).count() == 0
    alone = fingerprint.compare_with_next(some(spark, [(1, "abcdef", None)])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert fingerprint.fingerprint_documents(messy).columns == [c for c in messy.columns if c != "fingerprint"] + ["fingerprint"]


def test_chunks_resist_shifts():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    a, b = fingerprint.fingerprints([text, b"some words before " + text])
    assert fingerprint.containment(a, b) > 0.97 and fingerprint.containment(b, a) > 0.97
    assert np.array_equal(fingerprint.from_text(fingerprint.to_text(a)), a)


# 8
def test_pack_histogram():
    rng = np.random.default_rng(7)
    lengths = np.minimum(rng.geometric(0.004, 20_000), 2048)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    patterns = packing.pack_histogram(histogram)
    used = {}
    for pattern, count in patterns:
        assert sum(pattern) <= 2048 and list(pattern) == sorted(pattern, reverse=True)
        for n in pattern:
            used[n] = used.get(n, 0) + count
    assert used == histogram and sum(lengths) / (2048 * sum(c for _, c in patterns)) > 0.99
    assert packing.pack_histogram({}) == []


def test_packing_messy(spark, messy):
    pieces = settle(packing.token_pieces(messy, WORDS, 1, size=64), "pieces")
    packed = settle(packing.pack(spark, pieces, size=64), "packed")
    assert packed.count() == pieces.count() and {r["doc_id"] for r in packed.collect()} == {None, *range(1, 9)}
    whole = packing.write_sequences(packed, workspace(spark, "sequences"), size=64)
    library, texts = tokens.encoder(WORDS).library, defaultdict(Counter)
    for r in messy.select("doc_id", "text").collect():
        texts[r["doc_id"]][tuple(library.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)] += 1
    found = defaultdict(list)
    for r in whole.collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == 64 and ids[r["n_used"] :] == [0] * (64 - r["n_used"])
        assert [p["offset"] for p in r["pieces"]] == list(np.cumsum([0, *(p["length"] for p in r["pieces"])])[:-1])
        for p in r["pieces"]:
            found[p["doc_id"]].append((p["start"], ids[p["offset"] : p["offset"] + p["length"]], p["doc_tokens"]))
    for doc, held in texts.items():
        whole_ids = sorted(x for t, n in held.items() for k in range(0, len(t), 64) for x in [(k, list(t[k : k + 64]), len(t))] * n)
        assert sorted(found[doc]) == whole_ids
    assert packing.placements(whole).count() == pieces.count()
    none = settle(packing.token_pieces(messy.limit(0), WORDS, 1), "pieces")
    assert packing.sequences(packing.pack(spark, none)).count() == 0


# 9
def test_near_dedup_messy(spark, messy):
    rows = near_dedup.near_duplicates(messy).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    assert by[6]["component_id"] == 5 and by[5]["component_id"] == 5 and by[2]["n_shingles"] == 0 and by[None]["component_id"] is None and by[7]["component_id"] == 7
    kept = near_dedup.keep_one(messy)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "None", "4", "5", "7", "8"]) and kept.columns == messy.columns
    assert near_dedup.near_duplicates(messy.limit(0)).count() == 0


def test_near_dedup_hot_groups(spark):
    """A crowd of documents that are all alike at about 0.7 hides a few true pairs from the star; blocks must find them."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(60), 5):
            words[k] = f"v{i}x{k}"
        rows.append((i, " ".join(words), None))
    for i in range(150, 170):  # near copies of some of them
        words = rows[i - 140][1].split()
        words[rng.randrange(60)] = f"u{i}"
        rows.append((i, " ".join(words), None))
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parent))
    import brute

    want = brute.components([(i, t) for i, t, _ in rows], 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(some(spark, rows), shingle=2).collect()}
    assert got == want


def test_near_dedup_rows_of_one_id(spark):
    a = " ".join(f"word{i}" for i in range(80))
    rows = [(1, a, "x"), (2, "something else entirely, not to be lost at all", "y"), (2, a + " more", "z"), (3, a, "x"), (3, a, "x"), (2, "", None), (2, "", None), (0, "a b c d e f", None), (0, "a b c d e f", None)]
    got = near_dedup.near_duplicates(some(spark, rows)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(0, 0), (0, 0), (1, 1), (2, 1), (2, 2), (2, 2), (2, 2), (3, 1), (3, 1)]
    kept = near_dedup.keep_one(some(spark, rows))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(0, "a b c d e f"), (1, a), (2, ""), (2, ""), (2, "something else entirely, not to be lost at all")])


def test_long_words_of_two_letters(spark):
    order = [bin(i).count("1") % 2 for i in range(1024)]
    rows = [(1, "".join("ab"[k] for k in order), None), (2, "".join("ba"[k] for k in order), None), (3, "".join("ab"[k] for k in order) + " ", None)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(some(spark, rows), shingle=2).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_hyperminhash():
    rng = np.random.default_rng(9)
    low = rng.integers(0, 2**32, 2000).astype(np.uint32)
    got = near_dedup.compress(np.concatenate([low, [0, 1, 2**32 - 1]]).astype(np.uint32))
    for v, c in zip([*low.tolist(), 0, 1, 2**32 - 1], got.tolist(), strict=True):
        zeros = 32 - v.bit_length()
        mantissa = (v << (zeros + 1)) % 2**32 >> 24 if zeros < 31 else 0
        assert c == zeros << 8 | mantissa
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 1800).astype(np.uint64)
    for share in (0.3, 0.8):
        n = int(900 * share)
        regs = near_dedup.registers(np.concatenate([a, np.concatenate([a[:n], b[n:900]])]), np.array([900, 900]))
        rough = near_dedup.estimate(np.array([(regs[0] == regs[1]).sum()]), np.array([900]), np.array([900]))[0]
        assert abs(rough - n / (1800 - n)) < 0.17
    assert 0 < near_dedup.chance(np.array([500]), np.array([500]))[0] < 0.01


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)] + [(5, 5), (7, 9), (9, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}


# 10
@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats(spark, hot):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parent))
    import brute

    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = make(60), make(14)
    rows = [(i, make(40) + passage[rng.randrange(40) :] + make(30) + " " + line + " " + make(20), None) for i in range(25)]
    rows += [(30, passage * 3, None), (31, "x" * 700, None), (32, None, None), (33, "", None), (34, "short", None), (35, rows[0][1], None), (36, "é" * 90 + passage, None)]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(some(spark, rows).repartition(3), hot=hot).collect()}
    want = brute.repeats(sorted((i, t) for i, t, _ in rows))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_repeats_messy(spark, messy):
    rows = repeats.remove_repeats(messy).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 10 and by[2]["n_bytes"] == 0 and by[6]["n_removed"] == by[6]["n_bytes"] == len(LONG) and by[6]["n_spans"] == 1
    assert by[5]["n_removed"] == len(LONG) - 40 and by[8]["n_removed"] == 258
    assert repeats.remove_repeats(messy.limit(0)).count() == 0
