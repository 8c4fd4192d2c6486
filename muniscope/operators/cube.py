"""Dimension-product aggregation: all combinations of configured groupings in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scale import partitions

SMALL_PERSON = 128  # rows of a person that are compared with one another
TABLE_KEYS = 12  # keys up to which all sets of them fit into a table
WORD = 62  # groupings marked in one long

# Axis -> option -> key columns. Fixed values of the beneficiary cube; any configuration of this shape works.
BENEFICIARY_AXES: dict[str, dict[str, list[str]]] = {
    "nivel": {"nacional": [], "estatal": ["cve_ent"], "municipal": ["cve_ent", "cve_muni"]},
    "grupo": {"programa": ["cd_programa"], "padron": ["cd_programa", "cd_padron"], "todo": []},
    "tipos": {"cd_sexo": ["cd_sexo"], "categoria_edad": ["categoria_edad"], "total": []},
    "temporalidad": {
        "mes_pago": ["anio", "nu_mes_pago"],
        "mes_correspondencia": ["anio", "nu_mes_correspondencia"],
        "anual": ["anio"],
    },
}


def dimension_cube(
    df: DataFrame,
    axes: Mapping[str, Mapping[str, Sequence[str]]],
    who: str,
    amount: str,
    count_name: str = "n_beneficiarios",
    sum_name: str = "suma_importe",
) -> DataFrame:
    """Distinct ``who`` and total ``amount`` for every combination of one option per axis.

    Output: one label column per axis, every key column (null where unused), count and sum. A row with a
    null in a used key is left out of that grouping.

    One scan: rows are reduced to (all keys, who) and each copied to its groupings with a mark (see ``_marked_copies``), so
    the copies are summed straight into the groups and no set of persons per group is ever held.
    """
    keys = list(dict.fromkeys(k for options in axes.values() for cols in options.values() for k in cols))
    combos: dict[frozenset, tuple[str, ...]] = {}
    for names in product(*axes.values()):
        used = frozenset(k for axis, name in zip(axes, names) for k in axes[axis][name])
        if used in combos:
            raise ValueError(f"groupings {combos[used]} and {names} use the same keys")
        combos[used] = names

    bit = {k: 1 << i for i, k in enumerate(keys)}
    masks = {sum(bit[k] for k in used): names for used, names in combos.items()}
    copies = _marked_copies(df, keys, who, amount, list(masks), known=True)
    totals = copies.groupBy("__gid", *keys).agg(F.sum("__new").alias(count_name), F.sum("__amount").alias(sum_name))
    labels = F.create_map(*[x for m, names in masks.items() for x in (F.lit(m), F.array(*[F.lit(n) for n in names]))])
    label = F.element_at(labels, F.col("__gid"))
    return totals.select(*[label[i].alias(axis) for i, axis in enumerate(axes)], *keys, count_name, sum_name)


def _marked_copies(
    df: DataFrame, keys: Sequence[str], who: str, amount: str, masks: Sequence[int], known: bool = False, small: int = SMALL_PERSON
) -> DataFrame:
    """Rows reduced to (all keys, who) and copied to the groupings ``masks``: sums of key bits, the first key's bit being 1.

    Output: ``__gid`` (the mask), the keys (null where the grouping does not use them), ``__amount`` and ``__new``, which is 1
    in one of a person's rows in each group. With ``known`` a row with a null in a used key is left out of that grouping.

    A person's rows lie together. A row is new in a grouping unless an earlier row of the person has the same values in all
    of its keys, so it needs no more than the sets of keys it shares with earlier rows. Which groupings lie in a set of
    keys is looked up: a bit each, in words of ``WORD`` bits. Persons of more than ``small`` rows are reduced by group in a
    shuffle of their own instead.
    """
    bit = {k: 1 << i for i, k in enumerate(keys)}
    words = [masks[i : i + WORD] for i in range(0, len(masks), WORD)]
    n = partitions(df)
    # rows travel as they are: before the shuffle hardly two are alike, and a hash table of them would only fill memory
    reduced = df.select(*keys, who, amount).repartition(n, *keys, who).groupBy(*keys, who).agg(F.sum(amount).alias("__amount"))
    place = F.when(F.col(who).isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(who))  # rows without a person count by their keys
    placed = reduced.withColumn("__place", place).repartition(n, "__place")
    person = Window.partitionBy("__place", who).orderBy(keys[0])
    sized = placed.withColumn("__n", F.count(F.lit(1)).over(person.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    earlier = F.collect_list(F.when(F.col("__n") <= small, F.struct(*keys))).over(person.rowsBetween(Window.unboundedPreceding, -1))
    nulls = reduce(add, [F.when(F.col(k).isNull(), b).otherwise(0) for k, b in bit.items()])

    def lying_in(shared, word):
        """Groupings of a word whose keys are all in ``shared``."""
        if len(keys) <= TABLE_KEYS:
            table = (sum(1 << i for i, m in enumerate(word) if m & s == m) for s in range(1 << len(keys)))
            return F.element_at(F.expr(f"array({', '.join(f'{t}L' for t in table)})"), shared + 1)
        return reduce(Column.bitwiseOR, [F.when(shared.bitwiseAND(m) == m, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, m in enumerate(word)])

    def copied(rows, *more):
        if known:
            rows = rows.withColumns({f"__in{w}": lying_in(F.lit((1 << len(keys)) - 1) - nulls, word) for w, word in enumerate(words)})
        out = rows.select("*", F.posexplode(F.expr(f"array({', '.join(map(str, masks))})")).alias("__at", "__gid"))
        if known:
            out = out.where(bit_at("__in") == 1)
        return out.select("__gid", who, "__amount", *more, *[F.when(F.col("__gid").bitwiseAND(b) != 0, F.col(k)).alias(k) for k, b in bit.items()])

    def bit_at(prefix):
        word = F
        for w in range(len(words)):
            word = word.when(F.col("__at") < (w + 1) * WORD, F.col(f"{prefix}{w}"))
        return F.call_function("shiftright", word, F.col("__at") % WORD).bitwiseAND(1)

    def shared(e):
        return reduce(add, [F.when(e[k].eqNullSafe(F.col(k)), b).otherwise(0) for k, b in bit.items()])

    def old(word):
        return F.aggregate("__shared", F.lit(0).cast("long"), lambda acc, e: acc.bitwiseOR(lying_in(e, word)))

    few = sized.withColumn("__earlier", earlier).where(F.col("__n") <= small)
    few = few.withColumn("__shared", F.array_distinct(F.transform("__earlier", shared))).drop("__earlier")
    few = few.withColumns({f"__old{w}": old(word) for w, word in enumerate(words)})
    first = F.when(F.col(who).isNotNull(), 1 - bit_at("__old")).otherwise(0).cast("int").alias("__new")
    many = copied(sized.where(F.col("__n") > small)).groupBy("__gid", who, *keys).agg(F.sum("__amount").alias("__amount"))
    columns = ["__gid", *keys, "__amount", "__new"]
    return copied(few, first).select(*columns).unionByName(many.withColumn("__new", F.col(who).isNotNull().cast("int")).select(*columns))


def multi_level(
    df: DataFrame, levels: Mapping[str, tuple[str | None, Sequence[str]]], shared: Sequence[str], who: str, amount: str
) -> DataFrame:
    """National / state / municipal aggregate in one table (nivel, cvenivel, shared keys, beneficiarios, monto).

    ``levels`` maps the level tag to (place column or None, extra key columns). Duplicate rows are dropped
    as a SQL UNION does.
    """
    place = list(dict.fromkeys(c for c, _ in levels.values() if c))
    extra = list(dict.fromkeys(k for _, ks in levels.values() for k in ks))
    keys = list(dict.fromkeys([*place, *extra, *shared]))
    sets = {tag: [*([c] if c else []), *ks, *shared] for tag, (c, ks) in levels.items()}
    gid = {tag: sum(1 << i for i, k in enumerate(keys) if k in used) for tag, used in sets.items()}

    copies = _marked_copies(df, keys, who, amount, list(dict.fromkeys(gid.values())))
    totals = copies.groupBy("__gid", *keys).agg(F.sum("__new").alias("beneficiarios"), F.sum("__amount").alias("monto"))
    nivel, clave = F.lit(None).cast("string"), F.lit(None).cast("string")
    for tag, (c, _) in levels.items():
        here = F.col("__gid") == gid[tag]
        nivel = F.when(here, tag).otherwise(nivel)
        clave = F.when(here, F.col(c).cast("string") if c else F.lit("nacional")).otherwise(clave)
    return totals.select(nivel.alias("nivel"), clave.alias("cvenivel"), *shared, "beneficiarios", "monto").distinct()


def pair_dimension_cube(df: DataFrame, axes, who: str, amount: str) -> DataFrame:
    """Beneficiary cube in its published shape: one ``tipo`` value column and one month column."""
    cube = dimension_cube(df, axes, who, amount)
    return cube.select(
        F.col("anio").cast("string").alias("anio"),
        "cve_ent",
        "cve_muni",
        F.col("cd_programa").alias("cve_programa"),
        F.col("cd_padron").alias("cve_padron"),
        F.coalesce(F.col("cd_sexo"), F.col("categoria_edad"), F.lit("total")).alias("tipo"),
        "temporalidad",
        F.coalesce(F.col("nu_mes_pago"), F.col("nu_mes_correspondencia")).alias("mes"),
        "nivel",
        "grupo",
        "n_beneficiarios",
        "suma_importe",
    )
