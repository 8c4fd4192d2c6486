"""SQL twin of a rule chunk: one SELECT per rule, grouped rules as window aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.rules import Rule

_WINDOW = {"max": "max", "min": "min", "sum": "sum", "mean": "avg"}


def chunk_sql(source: str, columns: Sequence[str], chunk: Sequence[Rule], out: Sequence[str], casts: dict[str, str] | None = None) -> str:
    """``out`` columns of ``source`` after the rules; ``columns`` are the source's columns."""
    casts = casts or {}
    have, sql = set(columns), f"SELECT * FROM ({source})"
    for r in chunk:
        if r.by:
            inner = f"CASE WHEN ({r.where}) THEN {r.value_sql()} END" if r.where else r.value_sql()
            part = f"OVER (PARTITION BY {', '.join(r.by)})"
            agg = f"count(DISTINCT {inner}) {part}" if r.agg == "count_distinct" else f"{_WINDOW[r.agg]}({inner}) {part}"
            unknown = " OR ".join(f"{k} IS NULL" for k in r.by)
            value = f"CASE WHEN {unknown} THEN 0 ELSE coalesce({agg}, 0) END"
        else:
            value = r.value_sql()
        if r.by and r.name in casts:
            value = f"CAST({value} AS {casts[r.name]})"
        kept = f"* EXCLUDE ({r.name})" if r.name in have else "*"
        sql = f"SELECT {kept}, {value} AS {r.name} FROM ({sql})"
        have.add(r.name)
    return f"SELECT {', '.join(out)} FROM ({sql})"
