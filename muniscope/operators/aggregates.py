"""Group aggregates: weighted indicators, rates, shares, gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scale import settle, sorted_parts

_FN = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "median": F.median}


def _pred(p: Column | str) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def group_summary(df: DataFrame, by: Sequence[str], fn: str = "sum", cols: Sequence[str] | None = None) -> DataFrame:
    """Same aggregate over every measure, nulls skipped."""
    cols = cols or [c for c in df.columns if c not in set(by)]
    return df.groupBy(*by).agg(*[_FN[fn](c).alias(c) for c in cols])


def weighted_flags(df: DataFrame, by: Sequence[str], weight: str, flags: Mapping[str, Column | str]) -> DataFrame:
    """For each name: sum of the weight over rows where the predicate holds."""
    return df.groupBy(*by).agg(
        *[F.sum(F.when(_pred(p), F.col(weight)).otherwise(F.lit(0))).alias(n) for n, p in flags.items()]
    )


# Limits as in the source survey: the names do not always match the ages.
CENSUS_FLAGS: dict[str, str] = {
    "migrantes_internos_recientes": "nom_mun <> nom_mun_res10",
    "migrantes": "ent_pais_res10 > 33",
    "mayores65": "edad > 64",
    "menores5": "edad < 6",
    "adultos": "edad BETWEEN 19 AND 29",
    "menores": "edad < 18",
    "mayores": "edad > 64",
    "indigenas": "perte_indigena IN (1, 2)",
    "lengua_indigena": "hlengua = 1",
    "afrodescendientes": "afrodes IN (1, 2)",
    "mujeres": "sexo = 3",
    "hombres": "sexo = 1",
}


def weighted_indicator(df: DataFrame, by: Sequence[str], weight: str, variables: Sequence[str]) -> DataFrame:
    """Long table (by, variable, nominal, pob_tot, porcentaje) of weighted totals and shares.

    All variables are summed in one aggregate and turned long afterwards, so the input is not multiplied.
    """
    wide = df.groupBy(*by).agg(
        F.sum(weight).cast("double").alias("pob_tot"),
        *[F.sum(F.col(weight) * F.col(v)).cast("double").alias(v) for v in variables],
    )
    long = wide.unpivot([*by, "pob_tot"], list(variables), "variable", "nominal")
    return long.withColumn("porcentaje", F.try_divide("nominal", "pob_tot"))


def proportions(df: DataFrame, by: Sequence[str], total: str, parts: Sequence[str], prefix: str = "prop_") -> DataFrame:
    """Sums of total and parts with each part's share of the total."""
    sums = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in [total, *parts]])
    return sums.withColumns({f"{prefix}{p}": F.try_divide(F.col(p).cast("double"), F.col(total)) for p in parts})


def event_rate(
    events: DataFrame, pop: DataFrame, by: Sequence[str], preds: Mapping[str, Column | str], population: str = "poblacion"
) -> DataFrame:
    """Counts of rows meeting each predicate, divided by the population of the group."""
    counts = events.groupBy(*by).agg(*[F.count_if(_pred(p)).alias(f"n_{n}") for n, p in preds.items()])
    joined = counts.join(pop, list(by), "left")
    return joined.withColumns({n: F.try_divide(F.col(f"n_{n}").cast("double"), F.col(population)) for n in preds})


def rate_per_100k(
    events: DataFrame,
    pop: DataFrame,
    by: Sequence[str],
    place: Sequence[str],
    kind: str,
    value: str,
    kinds: Mapping[str, str],
    population: str = "poblacion",
    per: float = 100_000,
) -> DataFrame:
    """Incidence total and rate per kind as columns ``<name>_total`` and ``<name>_tasa``.

    ``kinds`` maps the wanted kinds to column names. Totals are pivoted in one conditional aggregate; the
    population joins afterwards at group grain.
    """
    totals = (
        events.where(F.col(kind).isin(list(kinds)))
        .groupBy(*by)
        .agg(*[F.sum(F.when(F.col(kind) == k, F.col(value))).cast("double").alias(f"{n}_total") for k, n in kinds.items()])
    )
    joined = totals.join(pop.select(*place, population), list(place), "left")
    rates = {f"{n}_tasa": F.try_divide(F.col(f"{n}_total") * per, F.col(population)) for n in kinds.values()}
    return joined.withColumns(rates).drop(population)


def density(df: DataFrame, by: Sequence[str], cols: Mapping[str, Sequence[str]], per: float = 1000) -> DataFrame:
    """Average of the sum of the listed columns, per thousand."""
    def total(parts):
        out = F.col(parts[0]).cast("double")
        for p in parts[1:]:
            out = out + F.col(p)
        return out

    return df.groupBy(*by).agg(*[F.avg(total(p) / per).alias(n) for n, p in cols.items()])


def beneficiaries(df: DataFrame, by: Sequence[str], who: str, amount: str, approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct persons and total amount per group.

    The exact form aggregates per (group, person) first: both steps combine map-side and a huge group is
    spread by person before it is counted. The approximate form is one partial aggregate with a standard error of ``rsd``.
    """
    if approximate:
        return df.groupBy(*by).agg(
            F.approx_count_distinct(who, rsd).alias("n_beneficiarios"), F.sum(amount).alias("suma_importe")
        )
    persons = df.groupBy(*by, who).agg(F.sum(amount).alias("__amount"))
    return persons.groupBy(*by).agg(F.count(who).alias("n_beneficiarios"), F.sum("__amount").alias("suma_importe"))


def with_grand_total(df: DataFrame, by: str, label: str, cols: Sequence[str], fn: str = "mean", total_fn: str = "sum") -> DataFrame:
    """Group rows plus one overall row under ``label``. By default groups hold means and the total row sums."""
    groups = group_summary(df, [by], fn, cols)
    total = df.agg(*[_FN[total_fn](c).alias(c) for c in cols]).select(F.lit(label).alias(by), *cols)
    return groups.unionByName(total)


def dedupe_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key combination (nulls count as a value) with the largest value."""
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def distinct_flag_score(df: DataFrame, by: str, code: str, codes: Sequence[int], credit: float) -> DataFrame:
    """Distinct (group, code) pairs, ``credit`` for each listed code, summed per group."""
    pairs = df.select(by, code).distinct()
    return pairs.groupBy(by).agg(F.sum(F.when(F.col(code).isin(list(codes)), F.lit(credit)).otherwise(F.lit(0.0))).alias(code))


def gap_ratio(
    df: DataFrame,
    by: Sequence[str],
    split: str,
    numerator: object,
    denominator: object,
    value: Column | str,
    fn: str = "mean",
    name: str = "brecha",
    weight: Column | str | None = None,
) -> DataFrame:
    """Ratio of an aggregate between two subgroups in one pass; a zero denominator leaves the numerator.

    With ``weight`` each side is sum(value*weight) / sum(weight).
    """
    v = _pred(value)

    def side(which):
        here = F.col(split) == F.lit(which)
        if weight is not None:
            wt = _pred(weight)
            return F.try_divide(F.sum(F.when(here, v * wt)), F.sum(F.when(here, wt)))
        return _FN[fn](F.when(here, v))

    sides = df.groupBy(*by).agg(side(numerator).alias(f"{name}_num"), side(denominator).alias(f"{name}_den"))
    ratio = F.when(F.col(f"{name}_den") == 0, F.col(f"{name}_num")).otherwise(
        F.try_divide(F.col(f"{name}_num"), F.col(f"{name}_den"))
    )
    return sides.withColumn(name, ratio)


def floating_population(df: DataFrame, home: str, other: str, pop: DataFrame, population: str, name: str) -> DataFrame:
    """Rows whose other place differs from home, and their rate per home population. Unknown places do not count."""
    moved = F.sum(F.when(F.col(home) == F.col(other), 0).when(F.col(home) != F.col(other), 1))
    counts = df.groupBy(home).agg(F.coalesce(moved, F.lit(0)).alias(f"pob_flot_{name}"))
    return counts.join(pop, home, "left").select(
        home,
        f"pob_flot_{name}",
        F.try_divide(F.col(f"pob_flot_{name}").cast("double"), F.col(population)).alias(f"tasa_flot_{name}"),
    )


def two_stage(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], weights: DataFrame, weight: str, counts: Mapping[str, Column | str]
) -> DataFrame:
    """Count per inner unit (household), weight it, sum per outer unit (region)."""
    units = df.groupBy(*inner).agg(*[F.sum(F.when(_pred(p), 1).otherwise(0)).alias(n) for n, p in counts.items()])
    joined = units.join(weights, list(inner), "left")
    return joined.groupBy(*outer).agg(*[F.sum(F.col(n) * F.col(weight)).alias(n) for n in counts])


def collapse_max(df: DataFrame, ids: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Person rows to one row per id with the largest value of each variable."""
    return df.groupBy(*ids).agg(*[F.max(v).alias(v) for v in variables])


SMALL_GROUP = 100_000  # different values of a group that one task may hold
RANGES = 64


def median_of_sums(df: DataFrame, by: Sequence[str], inner: Sequence[str], value: str, name: str, small: int = SMALL_GROUP) -> DataFrame:
    """Median over ``inner`` of the sums of ``value``."""
    sums = df.groupBy(*by, *inner).agg(F.sum(value).alias("__s"))
    return exact_median(sums, by, "__s", name, small)


def exact_median(df: DataFrame, by: Sequence[str], value: str, name: str, small: int = SMALL_GROUP) -> DataFrame:
    """Exact median of ``value`` per group (null values skipped, null where a group has no other).

    Equal values are counted first, in each task. Where a group has more than ``small`` different ones, they are cut at
    quantiles of a sketch into ``RANGES`` ranges, the rows of each range are counted, and only the ranges that hold the
    middle are kept; these are cut again until they are small. The sketch only chooses the cuts, the counts are exact. So no
    task holds a large group, whatever its distribution, and each round reads one narrow table.
    """
    values = settle(df.groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__c")))
    known = F.when(F.col("__v").isNotNull(), F.col("__c"))
    total = F.coalesce(F.sum(known), F.lit(0))
    # __k and __k2: ranks of the middle values (from 0) among the rows between __lo and __hi; __d: different values there
    middle = settle(
        values.groupBy(*by).agg(total.alias("__n"), F.count("__v").alias("__d"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        .select(*by, F.floor((F.col("__n") - 1) / 2).alias("__k"), F.floor(F.col("__n") / 2).alias("__k2"), "__d", "__lo", "__hi")
    )

    def inside(table):
        """The values between __lo and __hi of their group's row."""
        named = table.withColumnsRenamed({k: f"__r_{k}" for k in by})
        cond = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))
        for k in by:
            cond = cond & values[k].eqNullSafe(named[f"__r_{k}"])
        return values.join(named, cond).drop(*[f"__r_{k}" for k in by])

    parts = [middle.where("__d = 0").select(*by, F.lit(None).cast("double").alias(name))]
    while True:
        upto = F.sum("__c").over(Window.partitionBy(*by).orderBy("__v"))  # of at most ``small`` rows
        counted = inside(middle.where((F.col("__d") > 0) & (F.col("__d") <= small))).withColumn("__upto", upto)
        hit = lambda k: F.when((F.col("__upto") > F.col(k)) & (F.col("__upto") - F.col("__c") <= F.col(k)), F.col("__v"))
        parts.append(counted.groupBy(*by).agg((F.max(hit("__k")) / 2 + F.max(hit("__k2")) / 2).alias(name)))
        large = settle(middle.where(F.col("__d") > small))
        if large.isEmpty():
            return reduce(DataFrame.unionByName, parts)
        grid = F.percentile_approx("__v", [i / RANGES for i in range(1, RANGES)], 100 * RANGES)
        bounds = settle(inside(large).groupBy(*by).agg(grid.alias("__grid")))
        with_grid = large.join(bounds.withColumnsRenamed({k: f"__g_{k}" for k in by}), reduce(and_, [large[k].eqNullSafe(F.col(f"__g_{k}")) for k in by], F.lit(True)))
        place = F.size(F.filter("__grid", lambda g: g < F.col("__v")))
        ranges = inside(with_grid.drop(*[f"__g_{k}" for k in by])).withColumn("__b", place).groupBy(*by, "__k", "__k2", "__b").agg(
            F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__d"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
        before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__b")) - F.col("__n")  # of at most RANGES rows
        around = ranges.withColumn("__before", before).where((F.col("__before") <= F.col("__k2")) & (F.col("__before") + F.col("__n") > F.col("__k")))
        middle = settle(
            around.groupBy(*by, "__k", "__k2")
            .agg(F.min("__before").alias("__skip"), F.sum("__d").alias("__d"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
            .select(*by, (F.col("__k") - F.col("__skip")).alias("__k"), (F.col("__k2") - F.col("__skip")).alias("__k2"), "__d", "__lo", "__hi")
        )


def weighted_rollup(df: DataFrame, by: Sequence[str], weight: str, cols: Sequence[str]) -> DataFrame:
    """Sum of column times weight per region, each then scaled to 0-1 over the regions."""
    sums = df.groupBy(*by).agg(*[F.sum(F.col(c) * F.col(weight)).alias(c) for c in cols])
    ends = sums.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).alias("e")).scalar()
    return sums.withColumns(
        {
            c: F.try_divide(F.col(c) - ends.getField(c).getField("lo"), ends.getField(c).getField("hi") - ends.getField(c).getField("lo"))
            for c in cols
        }
    )


def count_pivot(df: DataFrame, by: Sequence[str], kind: str, kinds: Sequence[str]) -> DataFrame:
    """Rows per group and kind, one column per kind (lower case, blanks as underscores); none is null."""
    counts = df.groupBy(*by).pivot(kind, list(kinds)).count()
    return counts.withColumnsRenamed({k: k.lower().replace(" ", "_") for k in kinds})


def pyramid_sums(sex: str, age: str, weight: str, sexes: Mapping[object, str]) -> dict[str, Column]:
    """Aggregates of the population pyramid, so that it can be one of several results of one pass."""
    old = F.col(age).cast("int")
    out = {}
    for code, name in sexes.items():
        for low in range(0, 80, 5):
            here = old.between(low, low + 4) if low < 75 else old >= low
            out[f"{name}{low}_{low + 4}" if low < 75 else f"{name}{low}"] = F.sum(F.when((F.col(sex) == code) & here, F.col(weight)))
    return out


def population_pyramid(df: DataFrame, by: Sequence[str], sex: str, age: str, weight: str, sexes: Mapping[object, str]) -> DataFrame:
    """Weight per sex and five-year band, one column each (``h0_4`` ... ``m75``)."""
    from ..functions.dates import age_band

    bands = [f"{a}-{a + 4}" for a in range(0, 75, 5)] + ["75+"]
    group = F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in sexes.items() for x in kv]), F.col(sex)), age_band(age))
    values = [f"{s}{b}" for s in sexes.values() for b in bands]
    wide = df.where(F.col(sex).isin(list(sexes))).withColumn("__g", group).groupBy(*by).pivot("__g", values).agg(F.sum(weight))
    return wide.withColumnsRenamed({v: v.replace("-", "_").replace("+", "") for v in values})


def sum_over_splits(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum measures over the finer splits of a key."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def concat_values(df: DataFrame, by: Sequence[str], value: str, sep: str = ", ", size: int = 100_000, buckets: int | None = None) -> DataFrame:
    """Values of a group joined in sorted order, duplicates once: (by, part, value) with at most ``size`` values a part."""
    distinct = df.select(*by, F.col(value).cast("string").alias(value)).where(F.col(value).isNotNull()).distinct()
    parts = sorted_parts(distinct, by, [value], size, buckets)
    joined = F.array_join(F.array_sort(F.collect_list(value)), sep)
    return parts.groupBy(*by, "part").agg(joined.alias(value))


def weighted_table(df: DataFrame, by: Sequence[str], weight: str, flags: Sequence[str], known: str) -> DataFrame:
    """Weighted totals (``_n``) and weighted percentages (``_p``) of 0/1 flags; rows with ``known`` null are left out."""
    aggs = []
    for f in flags:
        aggs.append((100 * F.try_divide(F.sum(F.col(f) * F.col(weight)), F.sum(F.when(F.col(f).isNotNull(), F.col(weight))))).alias(f"{f}_p"))
        aggs.append(F.coalesce(F.sum(F.when(F.col(f) == 1, F.col(weight))), F.lit(0)).alias(f"{f}_n"))
    return df.where(F.col(known).isNotNull()).groupBy(*by).agg(*aggs)
