"""Declarative feature rules: an ordered list of named expressions run as few Spark steps.

Row rules become ``withColumns`` projections. Grouped rules over the same keys that do not need one
another are computed by one aggregate and joined back once; keys that are null get 0.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGG = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg}


@dataclass(frozen=True)
class Rule:
    """One derived variable.

    value   expression                              ``Rule("x", "a + b")``
    dummy   1/0, null when the condition is null    ``Rule.dummy("x", "a > 1")``
    cases   first true condition gives its value    ``Rule.cases("x", ("a = 1", 2), ("a = 3", 4))``
    where   only rows meeting it; null elsewhere
    by/agg  aggregate per group put beside each row, 0 where the group has none;
            agg is max, min, sum, mean or count_distinct
    """

    name: str
    expr: str
    kind: str = "value"
    branches: tuple[tuple[str, object], ...] = ()
    where: str | None = None
    by: tuple[str, ...] = ()
    agg: str | None = None

    @classmethod
    def dummy(cls, name: str, condition: str, where: str | None = None) -> Rule:
        return cls(name, condition, "dummy", where=where)

    @classmethod
    def cases(cls, name: str, *branches: tuple[str, object]) -> Rule:
        return cls(name, "", "cases", branches=branches)

    @classmethod
    def grouped(cls, name: str, agg: str, expr: str, by: Sequence[str], where: str | None = None) -> Rule:
        return cls(name, expr, where=where, by=tuple(by), agg=agg)

    def value_sql(self) -> str:
        """The row value as SQL."""
        if self.kind == "dummy":
            out = f"CAST(({self.expr}) AS INT)"  # true 1, false 0, null stays null
        elif self.kind == "cases":
            out = "CASE " + " ".join(f"WHEN ({c}) THEN {v}" for c, v in self.branches) + " END"
        else:
            out = self.expr
        if self.where and not self.by:
            out = f"CASE WHEN ({self.where}) THEN {out} END"
        return out

    def reads(self) -> set[str]:
        text = " ".join([self.expr, self.where or "", *(c for c, _ in self.branches), *self.by])
        return set(re.findall(r"[A-Za-z_]\w*", text))


def _renamed(text: str, names: dict[str, str]) -> str:
    """SQL text with other column names; quoted strings stay."""
    parts = re.split(r"('[^']*')", text)
    return "".join(p if p.startswith("'") else re.sub(r"[A-Za-z_]\w*", lambda m: names.get(m[0], m[0]), p) for p in parts)


@dataclass(frozen=True)
class Step:
    """A chunk in a run of several: ``after`` names the step whose variables it starts from (else the table's)."""

    chunk: Sequence[Rule]
    variables: Sequence[str] | None = None
    after: str | None = None


def run_steps(df: DataFrame, steps: Mapping[str, Step]) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """All rules of several chunks over one table, by levels of dependency.

    Each rule's variable becomes a column of its own, also where chunks (or one chunk twice) give the same name to
    different values. A row rule is as deep as what it reads, a grouped rule one deeper. So all grouped rules of a level
    over the same keys, of whatever chunk, are one aggregate and one join. Returns the table with all columns, and for each
    step the column that holds each of its variables.
    """
    taken = {c: 0 for c in df.columns}  # level of each column
    layers: dict[int, list[Rule]] = {}
    groups: dict[int, list[Rule]] = {}
    held: dict[str, dict[str, str]] = {}
    for label, step in steps.items():
        names = dict(held[step.after]) if step.after else {}
        for rule in step.chunk:
            if step.variables is not None and rule.name not in step.variables:
                continue
            own = replace(
                rule, expr=_renamed(rule.expr, names), where=rule.where and _renamed(rule.where, names),
                branches=tuple((_renamed(c, names), v if not isinstance(v, str) else _renamed(v, names)) for c, v in rule.branches),
                by=tuple(names.get(k, k) for k in rule.by),
            )
            level = max([0, *(taken[c] for c in own.reads() if c in taken)]) + bool(own.by)
            name = rule.name if rule.name not in taken else f"{rule.name}__{len(taken)}"
            names[rule.name], taken[name] = name, level
            (groups if own.by else layers).setdefault(level, []).append(replace(own, name=name))
        held[label] = names
    for level in range(max([0, *layers, *groups]) + 1):
        if level in groups:
            tables = []
            for by in dict.fromkeys(r.by for r in groups[level]):
                tables += [(t, by) for t in _group_tables(df, [r for r in groups[level] if r.by == by], by)]
            for table, by in tables:
                df = df.join(table, list(by), "left")
            df = df.withColumns({r.name: F.coalesce(F.col(r.name), F.lit(0)) for r in groups[level]})
        layer: dict[str, Column] = {}
        for rule in layers.get(level, []):
            if set(layer) & rule.reads():
                df, layer = df.withColumns(layer), {}
            layer[rule.name] = F.expr(rule.value_sql())
        df = df.withColumns(layer) if layer else df
    return df, held


def run_chunk(
    df: DataFrame,
    chunk: Sequence[Rule],
    variables: Sequence[str] | None = None,
    ids: Sequence[str] = (),
    return_all: bool = False,
) -> DataFrame:
    """Apply the rules named in ``variables`` (default all) in order; return ids and new variables, or all.

    Runs as the only step of ``run_steps``, so grouped rules over the same keys that do not need one another share an
    aggregate and a join, wherever they stand in the chunk.
    """
    out, held = run_steps(df, {"": Step(chunk, variables)})
    rules = [r for r in chunk if variables is None or r.name in set(variables)]
    names = list(dict.fromkeys(r.name for r in rules))
    kept = df.columns if return_all else ids
    return out.select(*[F.col(held[""].get(c, c)).alias(c) for c in dict.fromkeys([*kept, *names])])


def needed(df: DataFrame, steps: Mapping[str, Step], ids: Sequence[str]) -> DataFrame:
    """The id columns and those that a rule of the steps reads: what a table must hold before they run."""
    rules = [r for s in steps.values() for r in s.chunk if s.variables is None or r.name in s.variables]
    read = set(ids).union(*[r.reads() for r in rules])
    return df.select(*[c for c in df.columns if c in read])


def _group_tables(df: DataFrame, rules: Sequence[Rule], by: tuple[str, ...]) -> list[DataFrame]:
    """Rows of keys and values of the rules over them; distinct counts go through a per-member step."""
    present = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in by))

    def guarded(r):
        return F.expr(f"CASE WHEN ({r.where}) THEN {r.value_sql()} END" if r.where else r.value_sql())

    plain = [r for r in rules if r.agg != "count_distinct"]
    counted: dict[str, list[Rule]] = {}
    for r in rules:
        if r.agg == "count_distinct":
            counted.setdefault(r.expr, []).append(r)

    tables = []
    if counted:
        # a member may occur in several rows: mark it once per rule, then add the marks up
        for member, group in counted.items():
            marks = [F.max(F.when(F.expr(r.where or "true"), 1)).alias(f"__m_{r.name}") for r in group]
            riders = [r for r in plain if member == next(iter(counted))]
            partial = [_AGG["sum" if r.agg == "mean" else r.agg](guarded(r)).alias(f"__p_{r.name}") for r in riders]
            partial += [F.count(guarded(r)).alias(f"__c_{r.name}") for r in riders if r.agg == "mean"]
            members = present.groupBy(*by, F.expr(member).alias("__member")).agg(*marks, *partial)
            final = [F.sum(F.when(F.col("__member").isNotNull(), F.col(f"__m_{r.name}"))).alias(r.name) for r in group]
            for r in riders:
                total = F.sum(f"__p_{r.name}") if r.agg in ("sum", "mean") else _AGG[r.agg](f"__p_{r.name}")
                final.append((total / F.sum(f"__c_{r.name}") if r.agg == "mean" else total).alias(r.name))
            tables.append(members.groupBy(*by).agg(*final))
    else:
        tables.append(present.groupBy(*by).agg(*[_AGG[r.agg](guarded(r)).alias(r.name) for r in plain]))

    return tables
