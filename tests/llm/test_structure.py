"""op11 against a plain search over all edits, and its edge cases."""

import hashlib
import random
import re

from muniscope.llm import structure
from muniscope.llm.queries import ORACLE, QUERIES

KEYS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain(rows):
    """rows: (turn, role, text) without nulls in role and text."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0d]", "", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {("", 0): (0, "", ())}  # (initials so far reduced, rows used) -> cheapest, least

    def put(held, key, value):
        if key not in held or value < held[key]:
            held[key] = value

    def add(so_far, initial):
        """Reduced initials: '', 's', 'u' (last was user), 'a'."""
        fits = {"": "su", "s": "u", "u": "a", "a": "u"}[so_far]
        return initial if initial and initial in fits else None

    def inserted(held):
        for _ in range(3):
            for (state, k), (cost, audit, out) in list(held.items()):
                for role in ("user", "assistant"):
                    if (to := add(state, role[0])) is not None:
                        put(held, (to, k), (cost + 3, audit + "I", (*out, role + ":")))
        return held

    for i, ((_, role, text), fault) in enumerate(zip(rows, faults, strict=True)):
        now, extra = {}, 3 if fault == "truncated" else 0
        for (state, _), (cost, audit, out) in inserted(best).items():
            put(now, (state, i + 1), (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                for new, price, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if (to := add(state, new[:1])) is not None:
                        put(now, (to, i + 1), (cost + price + extra, audit + letter, (*out, f"{new}:{text}")))
        best = now
    cost, audit, out = min(v for (state, _), v in inserted(best).items() if state in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def test_random_conversations_in_small_blocks(spark):
    rng = random.Random(5)
    said = {}
    for conv in range(120):
        roles = ["user", "assistant", "system", "tool", "user ", ""] if conv % 3 else ["user", "assistant"]
        said[conv] = [
            (rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(["Yes.", "No", " ", "", "é!", f"t{rng.random()}.", f"cut {rng.random()}"])) for _ in range(rng.randrange(1, 14))
        ]
    said[200] = [(k, "ua"[k % 2] + "x", f"{k}.") for k in range(700)]  # more than one block of the usual size
    df = spark.createDataFrame([(c, *r, "x") for c, rows in said.items() for r in rows], "conv_id long, turn long, role string, text string, conv string")
    faults = structure.find_faults(df)
    for size in (3, structure.BLOCK):
        got = {r["conv"]: r for r in structure.summaries(faults, structure.plan_repairs(faults, size)).collect()}
        assert len(got) == len(said)
        for conv, rows in said.items():
            assert {k: got[f"={conv}"][k] for k in KEYS} == plain(rows), conv


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "cut"), (1, 1, "assistant", "cut"), (1, 2, "assistant", "A."), (None, 1, "user", None), (None, None, None, "Hm."), (2, 1, "user", "Q?")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    faults = structure.find_faults(df)
    plan = structure.plan_repairs(faults)
    out = structure.repaired_rows(faults, plan).orderBy("conv", "at", "nth").collect()
    assert [(r["conv"], r["role"], r["text"], r["edit"]) for r in out] == [
        ("=1", "system", "S.", "K"), ("=1", "user", "cut", "R"), ("=1", "assistant", "A.", "K"), ("=2", "user", "Q?", "K"), ("=2", "assistant", "", "I"),
    ]
    found = {r["conv"]: (r["cost"], r["audit"]) for r in plan.where("block = 0").collect()}
    assert found == {"=1": (10, "KRDK"), "=2": (3, "KI"), "": (8, "DD")}
    empty = structure.find_faults(df.limit(0))
    assert structure.summaries(empty, structure.plan_repairs(empty)).count() == 0


def test_query(spark):
    from conftest import SMALL

    rows = QUERIES["op11_structure"](spark, SMALL).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows) and "op11_structure" in ORACLE
    assert all(re.fullmatch("[DIKR]*", r["audit"]) and (r["audit"] or r["cost"] == 0) for r in rows)
