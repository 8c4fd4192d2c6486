"""Repair of a conversation's structure by the cheapest edits.

A repaired conversation is empty, or an optional system turn and then user and assistant turns by turns, ending with the
assistant. Edits: Keep a row (free), Rerole it to user or assistant (3), Delete it (4; the only edit of a blank row and of a
repetition of an earlier row), Insert an empty user or assistant turn anywhere (3); a truncated row that is not deleted adds 3.

Each edit is an edge of a graph over (row, state of the pattern), and its weight is one integer: the cost in the high
digits, below it one digit for each letter of the audit so far (D, I, K, R in ASCII order; zero where the audit has ended).
The n-th edit's letter stands n digits from the top, so adding the weights of a path gives its cost and its audit in one
number, and the smallest integer is the cheapest audit, the least in ASCII order among equals. Nothing else is compared. Two
audits of equal cost for the same rows and state are never one the beginning of the other (the rest would be insertions,
which cost), so keeping one integer for each state is enough.

A conversation is cut into blocks of ``BLOCK`` rows. A block gives the smallest integer from each state to each state, by
itself; the blocks of a conversation are then chained in order, in one stream a task. So no task ever holds the texts of a
conversation: what it holds of one is a few bytes a row (initials and audit). Rows are numbered over range-dealt parts.

Defined cases: rows stand in the order of (turn, role, text), nulls first; null role or text counts as one space; roles are
judged by their first character, an empty role has none; repeated rows are duplicates; a null conv_id is a conversation of
its own; other columns are ignored; an empty table has no conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import running, sort_key
from .common import partitions, settle, worker_memory

BLOCK = 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS = "DIKR"  # in ASCII order
DIGIT = {letter: i + 1 for i, letter in enumerate(LETTERS)}
BITS = 3  # of a digit
EMPTY, SYSTEM, USER, WHOLE = range(4)  # states: nothing yet, behind system, behind user, behind assistant
STEPS = {("s", EMPTY): SYSTEM, ("u", EMPTY): USER, ("u", SYSTEM): USER, ("u", WHOLE): USER, ("a", USER): WHOLE}
NEXT = {EMPTY: ("u", USER), SYSTEM: ("u", USER), USER: ("a", WHOLE), WHOLE: ("u", USER)}  # what a new or reroled turn must be
ROLES = {"u": "user", "a": "assistant"}
NO_TEXT = r"[\x20\x09-\x0D]"
MOST_INSERTS = 2  # a third one would lead back to an earlier state


def conversation_key(conv: Column) -> Column:
    """A text that is never null and differs between conversations, the null one included."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def numbered_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, conv_id, turn, role, text and ``at``: the row's number in its conversation."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(conversation_key(F.col(conv)).alias("conv"), F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"))
    out = running(
        rows, ["conv"], sort_key("turn", "role", "text"),
        local={"nth": lambda w: F.row_number().over(w)}, block={"n": lambda k: F.count(F.lit(1))},
        carry={"before": lambda w: F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1))},
    )
    return out.select("conv", "conv_id", "turn", "role", "text", (F.col("nth") + F.coalesce("before", F.lit(0)) - 1).alias("at"))


def find_faults(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The numbered rows with ``fault``: blank, duplicate, truncated or null (the first that applies). Settled."""
    rows = numbered_rows(df, conv, turn, role, text).withColumn("digest", F.sha2("text", 256))
    first = rows.groupBy("conv", "role", "digest").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    met = rows.join(first, ["conv", "role", "digest"], "left")
    shown = F.regexp_replace("text", NO_TEXT, "")
    fault = (
        F.when(F.length(shown) == 0, "blank")
        .when(F.col("at") > F.col("first_at"), "duplicate")
        .when(~shown.endswith(".") & ~shown.endswith("!") & ~shown.endswith("?"), "truncated")
    )
    return settle(met.select("conv", "conv_id", "turn", "role", "text", "at", fault.alias("fault")), "faults")


def symbols(fault: Column, role: Column) -> Column:
    """One letter a row for the graph: the role's initial (o: any other), a capital where truncated, x where the row must go."""
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(known)).otherwise(known)


Best = dict[int, tuple[int, int]]  # state: (weight, letters)


def extend(best: Best, state: int, to: int, came: tuple[int, int], cost: int, letter: str, width: int) -> None:
    weight, n = came
    weight += (cost << width) + (DIGIT[letter] << (width - BITS * (n + 1)))
    if to not in best or weight < best[to][0]:
        best[to] = (weight, n + 1)


def insertions(best: Best, width: int) -> Best:
    """The states with up to ``MOST_INSERTS`` turns inserted."""
    out, now = dict(best), best
    for _ in range(MOST_INSERTS):
        new: Best = {}
        for state, came in now.items():
            extend(new, state, NEXT[state][1], came, INSERT, "I", width)
        for state, came in new.items():
            if state not in out or came[0] < out[state][0]:
                out[state] = came
        now = new
    return out


def through(rows: str, start: int) -> tuple[Best, int]:
    """The smallest weights from ``start`` before the rows (their symbols) to each state behind them, and the digits' width."""
    width = BITS * (MOST_INSERTS + 1) * max(len(rows), 1)
    best: Best = {start: (0, 0)}
    for symbol in rows:
        ready, best = insertions(best, width), {}
        extra = TRUNCATED if symbol.isupper() else 0
        for state, came in ready.items():
            extend(best, state, state, came, DELETE, "D", width)
            if symbol == "x":
                continue
            kept = STEPS.get((symbol.lower(), state))
            if kept is not None:
                extend(best, state, kept, came, extra, "K", width)
            must, to = NEXT[state]
            if must != symbol.lower():
                extend(best, state, to, came, REROLE + extra, "R", width)
    return best, width


def chained(best: Best, width: int, block: dict[int, Best], more: int) -> tuple[Best, int]:
    """Weights behind a further block, out of those before it; ``more``: the block's width."""
    total = width + more
    low = (1 << width) - 1
    out: Best = {}
    for state, (weight, n) in best.items():
        for to, (added, m) in block.get(state, {}).items():
            cost = (weight >> width) + (added >> more)
            letters = ((weight & low) << more) + ((added & ((1 << more) - 1)) << (width - BITS * n))
            new = (cost << total) + letters
            if to not in out or new < out[to][0]:
                out[to] = (new, n + m)
    return out, total


def finished(best: Best, width: int) -> tuple[int, str]:
    """Cost and audit of the cheapest way to a whole conversation, turns inserted at its end included."""
    more = BITS * MOST_INSERTS
    best = {state: (((w >> width) << (width + more)) + ((w & ((1 << width) - 1)) << more), n) for state, (w, n) in best.items()}
    best = insertions(best, width + more)
    weight, n = min(best[s] for s in (EMPTY, WHOLE) if s in best)
    width += more
    digits = (weight & ((1 << width) - 1)) >> (width - BITS * n) if n else 0
    return weight >> width, decoded(digits, n)


def decoded(digits: int, n: int) -> str:
    """Letters of ``n`` digits."""
    raw = np.frombuffer(digits.to_bytes((BITS * n + 7) // 8, "big"), np.uint8)
    bits = np.unpackbits(raw)[len(raw) * 8 - BITS * n :].reshape(n, BITS)
    return "".join(np.array(list("-" + LETTERS))[bits @ np.array([4, 2, 1])]) if n else ""


def walk(audit: str, rows: str) -> Iterator[tuple[str, str, str | None]]:
    """For each row, and once more behind the last: turns inserted before it (initials), its edit, its new role."""
    state, before, at = EMPTY, "", 0
    for letter in audit:
        must, to = NEXT[state]
        if letter == "I":
            before, state = before + must, to
            continue
        if letter == "K":
            state = STEPS[rows[at].lower(), state]
        elif letter == "R":
            state = to
        yield before, letter, ROLES[must] if letter == "R" else None
        before, at = "", at + 1
    yield before, "", None


def _weights(blocks: DataFrame) -> DataFrame:
    """Add to each block its smallest integers: ways, a list of (start, end, weight, letters). Map-only."""

    def run(batches):
        worker_memory("")
        known: dict[tuple[str, bool], list] = {}
        for batch in batches:
            out = []
            for rows, block in zip(batch.column("rows").to_pylist(), batch.column("block").to_pylist(), strict=True):
                key = (rows, block == 0)
                if key not in known:
                    if len(known) > 2000:
                        known.clear()
                    known[key] = [
                        {"start": start, "end": end, "weight": w.to_bytes(w.bit_length() // 8 + 1, "big"), "letters": n}
                        for start in ((EMPTY,) if block == 0 else (EMPTY, SYSTEM, USER, WHOLE)) for end, (w, n) in through(rows, start)[0].items()
                    ]
                out.append(known[key])
            ways = pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.binary()), ("letters", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*batch.columns, ways], names=[*batch.schema.names, "ways"])

    return blocks.mapInArrow(run, "conv string, block long, rows string, initials string, ways array<struct<start:int,end:int,weight:binary,letters:int>>")


LEGAL = {"su", "ua", "au"}


def plan_repairs(faults: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv, cost, audit, illegal (adjacent rows whose initials do not follow each other), and ``block``, ``edits``: for each
    row of a block (number, turns inserted before it, edit, new role). cost, audit and illegal stand in block 0 alone. Blocks
    have ``size`` rows."""
    initial = F.when(F.length("role") > 0, F.substring("role", 1, 1)).otherwise("-")
    narrow = faults.select("conv", "at", F.floor(F.col("at") / size).alias("block"), symbols(F.col("fault"), F.col("role")).alias("symbol"), initial.alias("initial"))
    told = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", name))), lambda x: x[name]), "")
    blocks = narrow.groupBy("conv", "block").agg(told("symbol").alias("rows"), told("initial").alias("initials"))
    dealt = _weights(blocks).repartition(partitions(faults.sparkSession), "conv").sortWithinPartitions("conv", "block")

    def run(batches):
        worker_memory("")
        conv, best, width, rows, illegal, last = None, {}, 0, [], 0, ""

        def done():
            if conv is None:
                return
            cost, audit = finished(best, width)
            letters = "".join(rows)
            steps, at = walk(audit, letters), 0
            for k in range(len(letters) // size + 1):
                edits = [{"at": at + i, "before": b, "edit": e, "role": r} for i, (b, e, r) in zip(range(size), steps)]
                at += len(edits)
                first = k == 0
                yield {"conv": conv, "block": k, "cost": cost if first else None, "audit": audit if first else None, "illegal": illegal if first else None, "edits": edits}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv"] != conv:
                    out += done()
                    conv, best, width, rows, illegal, last = r["conv"], {EMPTY: (0, 0)}, 0, [], 0, ""
                block: dict[int, Best] = {}
                for w in r["ways"]:
                    block.setdefault(w["start"], {})[w["end"]] = (int.from_bytes(w["weight"], "big"), w["letters"])
                best, width = chained(best, width, block, BITS * (MOST_INSERTS + 1) * len(r["rows"]))
                rows.append(r["rows"])
                line = last + r["initials"]
                illegal += sum(line[i : i + 2] not in LEGAL for i in range(len(line) - 1))
                last = line[-1]
            yield pa.RecordBatch.from_pylist(out, schema)
        yield pa.RecordBatch.from_pylist(list(done()), schema)

    edit = pa.struct([("at", pa.int64()), ("before", pa.string()), ("edit", pa.string()), ("role", pa.string())])
    schema = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("edits", pa.list_(edit))])
    return settle(dealt.mapInArrow(run, "conv string, block long, cost long, audit string, illegal long, edits array<struct<at:long,before:string,edit:string,role:string>>"), "repairs")


def repaired_rows(faults: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: conv, at and nth (their order), role, text, edit (K, R or I)."""
    edits = plan.select("conv", F.explode("edits").alias("e")).select("conv", "e.at", "e.before", "e.edit", F.col("e.role").alias("new_role"))
    left = faults.join(edits.where(F.col("edit").isin("K", "R")), ["conv", "at"]).select("conv", "at", F.lit(MOST_INSERTS).alias("nth"), F.coalesce("new_role", "role").alias("role"), "text", "edit")
    new = edits.where(F.length("before") > 0).select("conv", "at", F.posexplode(F.split("before", "")).alias("nth", "initial")).where(F.length("initial") > 0)
    role = F.when(F.col("initial") == "u", ROLES["u"]).otherwise(ROLES["a"])
    return left.unionByName(new.select("conv", "at", "nth", role.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit")))


def digests(repaired: DataFrame) -> DataFrame:
    """conv, repaired_sha256 of the rows ``role:text`` joined by newlines. Rows pass one by one: no text is gathered."""
    dealt = repaired.repartition(partitions(repaired.sparkSession), "conv").sortWithinPartitions("conv", "at", "nth").select("conv", F.concat("role", F.lit(":"), "text").alias("line"))

    def run(batches):
        worker_memory("")
        conv, code = None, None
        for batch in batches:
            names, sums = [], []
            for name, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if name != conv:
                    if conv is not None:
                        names.append(conv)
                        sums.append(code.hexdigest())
                    conv, code = name, hashlib.sha256(line.encode())
                else:
                    code.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.string())], names=["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([code.hexdigest()], pa.string())], names=["conv", "repaired_sha256"])

    return dealt.mapInArrow(run, "conv string, repaired_sha256 string")


def summaries(faults: DataFrame, plan: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation with rows."""
    count = lambda name: F.sum(F.when(F.col("fault") == name, 1).otherwise(0)).alias(name)
    turns = faults.where(F.col("turn").isNotNull()).groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counts = faults.groupBy("conv").agg(count("blank"), count("duplicate"), count("truncated"))
    one = plan.where("block = 0").select("conv", "illegal", "cost", "audit")
    return counts.join(one, "conv").join(turns, "conv", "left").join(digests(repaired_rows(faults, plan)), "conv", "left").withColumns(
        {"gaps": F.coalesce("gaps", F.lit(0)).cast("long"), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    )
