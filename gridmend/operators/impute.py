"""Filling missing values from similar records (problem 6)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import number, ref


@dataclass(frozen=True)
class Target:
    """A column to fill. valid: the numbers allowed for a code; else any number but NaN is present.

    determinants: attribute sets to verify; None searches all sets of up to `Limits.max_size` attributes.
    """

    name: str
    determinants: tuple[tuple[str, ...], ...] | None = None
    groups: tuple[tuple[str, ...], ...] = ()
    valid: tuple[int, ...] | None = None

    def value(self) -> Column:
        c = ref(self.name)
        return F.when(c.isin(*self.valid), c) if self.valid is not None else number(c)

    @property
    def is_code(self) -> bool:
        return self.valid is not None


@dataclass(frozen=True)
class Dependency:
    """determinant -> target, as verified: the share of records that agree with their determinant's commonest value.

    kind: ``fd``; ``entries`` where only some determinant values are sound, whose share of the records is cover; ``sum`` for a sum or difference of two columns; ``table`` for a reference table.
    """

    determinant: tuple[str, ...]
    records: int
    confidence: float
    accepted: bool
    kind: str = "fd"
    cover: float = 1.0
    after: tuple[Dependency, ...] = ()  # those whose sound entries' records were set aside before


@dataclass(frozen=True)
class Limits:
    min_confidence: float = 0.97  # of a dependency over all records whose determinant occurs more than once
    min_records: int = 100
    min_entry: float = 0.97  # of a dictionary entry over its own records
    min_cover: float = 0.5  # share of the records in sound entries, where the dependency as a whole does not hold
    min_repeat: float = 0.5  # a set whose values are this far from a key (1 - distinct values a record) or less can tell next to nothing
    max_size: int = 2  # attributes of a determinant
    rsd: float = 0.01  # of the distinct counts that prune the search
    tolerance: float = 1e-6  # of sums


def _has(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _dictionary(complete: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, __n, __most, __entry): per determinant the number of records, those with the commonest value, and that value (the least on ties)."""
    counts = complete.where(_has(keys)).groupBy(*keys, "__y").agg(F.count("*").alias("__c"))
    best = F.max(F.struct(F.col("__c").alias("c"), (-F.col("__y")).alias("neg"), F.col("__y").alias("y")))
    return counts.groupBy(*keys).agg(F.sum("__c").alias("__n"), best.alias("__b")).select(*keys, "__n", F.col("__b.c").alias("__most"), F.col("__b.y").alias("__entry"))


def _each(rows: DataFrame, sets: list[tuple[str, ...]], *more: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, i, x): for each record and set whose columns all have a value, the set's number and its values, with the columns more, as 64 bits."""
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.when(_has(k), F.xxhash64(*k, *more)).alias("x")) for i, k in enumerate(sets)])
    return rows.select(*keep, F.explode(each).alias("e")).select(*keep, "e.i", "e.x").where("x is not null")


def _verify(complete: DataFrame, sets: list[tuple[str, ...]], limits: Limits, codes: bool) -> list[Dependency]:
    """Each set over all complete records, all in one aggregation; one row a set comes to the driver."""
    if not sets:
        return []
    counts = _each(complete, sets, keep=("__y",)).groupBy("i", "x", "__y").agg(F.count("*").alias("c"))
    d = counts.groupBy("i", "x").agg(F.sum("c").alias("n"), F.max("c").alias("most"))
    many, sound = F.col("n") > 1, (F.col("n") >= limits.min_records) & (F.col("most") >= limits.min_entry * F.col("n"))
    total = d.groupBy("i").agg(F.sum(F.when(many, F.col("n"))).alias("n"), F.sum(F.when(many, F.col("most"))).alias("agree"), F.sum("n").alias("all"), F.sum(F.when(sound, F.col("n"))).alias("sound"))
    rows = {x["i"]: x for x in total.collect()}
    out = []
    for i, keys in enumerate(sets):
        x = rows.get(i)
        n, share, cover = (x["n"] or 0, (x["agree"] or 0) / x["n"] if x["n"] else 0.0, (x["sound"] or 0) / x["all"]) if x else (0, 0.0, 0.0)
        holds = n >= limits.min_records and share >= limits.min_confidence
        part = codes and not holds and n >= limits.min_records and cover >= limits.min_cover
        out.append(Dependency(keys, n, share, holds or part, "entries" if part else "fd", cover if part else 1.0))
    return out


def _distinct(c: Column) -> Column:
    """Its distinct values by a sketch of 16,384 registers, within one per cent or so (`Limits.rsd`)."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(c, 14))


def search(complete: DataFrame, attributes: tuple[str, ...], limits: Limits, codes: bool) -> list[Dependency]:
    """Dependencies attribute set -> __y over all complete records, found by levels of the lattice of attribute sets.

    One aggregation a level estimates the distinct values of every set, alone and with __y. A set is dropped, with all that hold it, where its values hardly repeat; it
    is not extended by what it determines, nor counted or verified where __y has or makes so many values that it can't hold. Only what is left is verified exactly; a set that holds ends its branch.
    For codes (few values) sets that are sound for some of their values count too; larger sets then explain the records that the widest of these leaves.
    """
    found: list[Dependency] = []
    level, counts, values, records = [(a,) for a in attributes], {}, 0.0, 0
    single: list[str] = []
    slack, aside = 1 - limits.min_confidence, ()

    def sketched(rows: DataFrame, sets: list[tuple[str, ...]], *more: str) -> list[tuple[int, float]]:
        """(records, distinct values) of each set, with the columns more."""
        if not sets:
            return []
        r = _each(rows, sets, *more).groupBy("i").agg(F.count("*").alias("n"), _distinct(F.col("x")).alias("d"))
        got = {x["i"]: (x["n"], x["d"]) for x in r.collect()}
        return [got.get(i, (0, 0)) for i in range(len(sets))]

    for size in range(1, limits.max_size + 1):
        # a set has no more values than the product of its parts': where the target has more, too many records disagree
        level = [k for k in level if size == 1 or codes or prod(counts[x,] for x in k) * (1 + 3 * limits.rsd) >= values - slack * records]
        if not level:
            break
        seen = sketched(complete, [*level, ("__y",)])
        records, values = seen.pop()
        alive = []
        for keys, (n, d) in zip(level, seen):
            counts[keys] = d
            same = d <= 1 if size == 1 else any(d <= counts.get(sub, 0) * (1 + 3 * limits.rsd) for sub in combinations(keys, size - 1))
            if n >= limits.min_records and n - d >= limits.min_repeat * n and not same:
                alive.append((keys, n, d))
        maybe = [x for x in alive if codes or x[2] * (1 + 3 * limits.rsd) >= values - slack * records]
        verify = [keys for (keys, n, d), (_, dy) in zip(maybe, sketched(complete, [x[0] for x in maybe], "__y")) if dy - d <= slack * n + 3 * limits.rsd * (d + dy) or (codes and d * limits.min_records <= n)]
        new = [replace(x, after=aside) for x in _verify(complete, verify, limits, codes) if x.accepted]
        new = sorted(new, key=lambda x: (x.kind != "fd", -x.cover, -x.confidence, x.determinant))
        found += new
        holds = [set(x.determinant) for x in found if x.kind == "fd"]
        single = [k[0] for k, *_ in alive] if size == 1 else single
        ok = {frozenset(k) for k, *_ in alive if not any(h <= set(k) for h in holds)}
        level = [k for k in combinations(single, size + 1) if all(frozenset(x) in ok for x in combinations(k, size))]
        if level and new and new[0].kind == "entries":
            # what a sound entry tells needs no larger set: these explain the records that are left
            complete, aside = _left_by(complete, new[0], limits), (*aside, new[0])
    return found


def _left_by(complete: DataFrame, dep: Dependency, limits: Limits) -> DataFrame:
    """The records that no sound entry of the dependency tells."""
    return complete.join(_sound(complete, dep, limits).select(*dep.determinant), list(dep.determinant), "left_anti")


def _sound(complete: DataFrame, dep: Dependency, limits: Limits) -> DataFrame:
    """The dictionary of a dependency: (determinant, __n, __most, __entry) of the determinant values that agree well enough."""
    d = _dictionary(complete, dep.determinant).where(F.col("__most") >= limits.min_entry * F.col("__n"))
    return d.where(F.col("__n") >= limits.min_records) if dep.kind == "entries" else d


def sums(complete: DataFrame, numerics: tuple[str, ...], limits: Limits) -> list[Dependency]:
    """Which sums and differences of two other numeric columns the target is, by one aggregation over all complete records: no shuffle but of one row a task."""
    pairs = [(a, sign, b) for a, b in combinations(numerics, 2) for sign in "+-"] + [(b, "-", a) for a, b in combinations(numerics, 2)]
    if not pairs:
        return []
    cols = []
    for i, (a, sign, b) in enumerate(pairs):
        made, has = _sum_of((a, sign, b)), _has((a, b))
        close = F.abs(made - F.col("__y")) <= limits.tolerance * F.greatest(F.abs(F.col(a)), F.abs(F.col(b)), F.abs(F.col("__y")))
        # a sum with nothing on one side is no evidence
        has = has & (F.col(a) != 0) & (F.col(b) != 0)
        cols += [F.count(F.when(has, F.lit(1))).alias(f"n{i}"), F.count(F.when(has & close, F.lit(1))).alias(f"k{i}")]
    r = complete.agg(*cols).first()
    out = [Dependency(p, r[f"n{i}"], r[f"k{i}"] / r[f"n{i}"] if r[f"n{i}"] else 0.0, False, "sum") for i, p in enumerate(pairs)]
    return [replace(x, accepted=x.records >= limits.min_records and x.confidence >= limits.min_confidence) for x in out]


def _sum_of(x: tuple[str, ...]) -> Column:
    return F.col(x[0]) + F.col(x[2]) if x[1] == "+" else F.col(x[0]) - F.col(x[2])


def mine(complete: DataFrame, target: Target, limits: Limits, attributes: tuple[str, ...] = (), numerics: tuple[str, ...] = (), reference: DataFrame | None = None, reference_keys: tuple[str, ...] = ()) -> list[Dependency]:
    """The dependencies of the target over all complete records, in the order in which they fill: sums, sets of attributes, a reference table.

    complete holds the attributes and the value as __y. A reference table (its value as entry) is verified by the records that share its key.
    """
    out = sums(complete, numerics, limits) if not target.is_code else []
    out += search(complete, attributes, limits, target.is_code) if target.determinants is None else _verify(complete, list(target.determinants), limits, target.is_code)
    if reference is not None:
        both = complete.where(_has(reference_keys)).select(*reference_keys, "__y").join(reference.withColumnRenamed("entry", "__entry"), list(reference_keys))
        r = both.agg(F.count("*").alias("n"), F.count(F.when(F.col("__y") == F.col("__entry"), F.lit(1))).alias("agree")).first()
        share = r["agree"] / r["n"] if r["n"] else 0.0
        out.append(Dependency(reference_keys, r["n"], share, r["n"] >= limits.min_records and share >= limits.min_confidence, "table"))
    return out


def _useful(missing: DataFrame, accepted: list[Dependency]) -> list[Dependency]:
    """The dependencies that have a key for some missing cell for which none before them, that holds for all its values, has one: the others would be joined for nothing."""
    if len(accepted) < 2:
        return accepted
    parts, before = [], F.lit(False)
    for i, d in enumerate(accepted):
        has = _has((d.determinant[0], d.determinant[2]) if d.kind == "sum" else d.determinant)
        parts.append(F.count(F.when(has & ~before, F.lit(1))).alias(f"u{i}"))
        before = before | has if d.kind in ("sum", "fd") else before
    r = missing.agg(*parts).first()
    return [d for i, d in enumerate(accepted) if r[f"u{i}"]]


def fill_cells(df: DataFrame, row_id: str, keys: dict[str, Column], target: Target, limits: Limits = Limits(), numerics: dict[str, Column] | None = None, reference: DataFrame | None = None, reference_keys: tuple[str, ...] = (), reference_name: str = "") -> DataFrame:
    """One row per missing cell of the target: (row_id, value, how).

    keys: the attributes and groups by name, as expressions over df, numerics: the columns of which the target may be a sum; names must not begin with two underscores. The value comes from the first of these that has one; `how` names it:
    a verified dependency (``fd:sum:a-b``, ``fd:a,b``, or ``fd:table:a,b`` from a reference table with one row per key), then the groups in the given order (``group:a,b``; the median of a
    number, the commonest of a code, least on ties), then all records (``all``). Where no record has a value, value is null and how ``none``.
    Every missing cell gives exactly one row. A null, a NaN, or a code outside `valid` is missing; a null key matches nothing. Infinite numbers
    are present; keys of type double determine nothing (no two measured numbers are equal but by chance). Empty input gives an empty result.

    Plan: only rows with a missing cell are joined; statistics are partial aggregations over all complete rows.
    Dictionaries are joined by shuffle unless Spark knows them to be small.
    """
    numerics = numerics or {}
    base = df.select(ref(row_id).alias("__id"), *[c.alias(k) for k, c in keys.items()], *[number(c).alias(k) for k, c in numerics.items()], target.value().alias("__y"))
    complete, missing = base.where("__y is not null").drop("__id"), base.where("__y is null").drop("__y")
    attributes = tuple(k for k in keys if base.schema[k].dataType.typeName() not in ("double", "float"))
    how: list[tuple[Column, Column]] = []
    for n, dep in enumerate(_useful(missing, [d for d in mine(complete, target, limits, attributes, tuple(numerics), reference, reference_keys) if d.accepted])):
        if dep.kind == "sum":
            how.append((_sum_of(dep.determinant), F.lit(f"fd:sum:{''.join(dep.determinant)}")))
            continue
        if dep.kind == "table":
            side, label = reference.select(*dep.determinant, F.col("entry").alias(f"__e{n}")), f"fd:{reference_name}:{','.join(dep.determinant)}"
        else:
            rows = reduce(lambda rows, x: _left_by(rows, x, limits), dep.after, complete)
            side, label = _sound(rows, dep, limits).select(*dep.determinant, F.col("__entry").alias(f"__e{n}")), f"fd:{','.join(dep.determinant)}"
        missing = missing.join(side, list(dep.determinant), "left")
        how.append((F.col(f"__e{n}"), F.lit(label)))
    for n, group in enumerate(target.groups):
        if target.is_code:
            side = _dictionary(complete, group).select(*group, F.col("__entry").alias(f"__g{n}"))
        else:
            side = complete.where(_has(group)).groupBy(*group).agg(F.percentile_approx("__y", 0.5, 1000).alias(f"__g{n}"))
        missing = missing.join(side, list(group), "left")
        how.append((F.col(f"__g{n}"), F.lit(f"group:{','.join(group)}")))
    if target.is_code:
        top = complete.groupBy("__y").agg(F.count("*").alias("n")).agg(F.max(F.struct("n", (-F.col("__y")).alias("neg"), F.col("__y").alias("y")))["y"].alias("a"))
    else:
        top = complete.agg(F.percentile_approx("__y", 0.5, 1000).alias("a"))
    how.append((F.lit(top.first()["a"]).cast(base.schema["__y"].dataType), F.lit("all")))  # one number
    value = F.coalesce(*[v for v, _ in how])
    label = reduce(lambda c, x: c.when(x[0].isNotNull(), x[1]), how, F.when(F.lit(False), F.lit(""))).otherwise(F.lit("none"))
    return missing.select(F.col("__id").alias(row_id), value.alias("value"), label.alias("how"))


def fill_table(df: DataFrame, row_id: str, cells: dict[str, DataFrame]) -> DataFrame:
    """df with each target's missing cells filled and a column <target>_how that is null where the cell was present.

    cells: by target the result of fill_cells. Rows of df with a null row_id stay unfilled.
    """
    out = df
    for name, c in cells.items():
        side = c.select(ref(row_id).alias("__id"), F.col("value").alias("__value"), F.col("how").alias("__how"))
        out = out.join(side, ref(row_id) == F.col("__id"), "left").withColumn(name, F.when(F.col("__how").isNotNull(), F.col("__value").cast(df.schema[name].dataType)).otherwise(ref(name))).withColumn(f"{name}_how", F.col("__how")).drop("__id", "__value", "__how")
    return out
