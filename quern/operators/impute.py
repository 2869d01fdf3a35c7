"""Missing values filled from records of the same kind, with provenance.

Functional dependencies are searched level by level over the attributes: a set
of columns is tested for the targets that none of its subsets determines. One
pass a level tests all of its sets; what it has gathered is also the dictionary
of those that hold. Rows with holes look their values up there by left joins;
what stays open falls back on the record's group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import HOT_ROWS, salted_join, settle

KEY = ["_k1", "_k2"]


@dataclass(frozen=True)
class Target:
    """A column to fill. ``usable`` is an SQL condition on its value, ``due``
    one on the row; ``how`` is the group fallback: mean (two decimals), mode, or
    whole (a rounded mean)."""

    name: str
    usable: str
    due: str = "true"
    how: str = "mean"


@dataclass(frozen=True)
class Dependency:
    """Columns that determine targets; ``stats`` holds, under the number
    ``det``, what each of their values was seen with."""

    columns: tuple[str, ...]
    targets: tuple[str, ...]
    det: int
    stats: DataFrame
    most_rows: int


def _known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    return known


def _key(columns: Sequence[str]) -> tuple[Column, Column]:
    """128-bit hash of the columns."""
    cols = [F.col(c) for c in columns]
    return F.xxhash64(*cols), F.xxhash64(F.lit("2"), *cols)


def _usable(t: Target) -> Column:
    return F.when(F.expr(t.usable), F.col(t.name))


def mine_dependencies(
    df: DataFrame, targets: Sequence[Target], attributes: Sequence[str], *, width: int = 2, tolerance: float = 0.05, least_groups: int = 3
) -> list[Dependency]:
    """Minimal verified dependencies, narrow ones first, then in the order of
    ``attributes``.

    A set of up to ``width`` attributes determines a target where at least
    ``least_groups`` of its values stand in two or more records with a usable
    target and at most the share ``tolerance`` of those contradict themselves.
    Values with a missing part count for nothing. Each level is one aggregation
    over (set, hash of its values) with map-side combining; one row per set
    comes to the driver.
    """
    held: list[Dependency] = []
    for size in range(1, width + 1):
        sets = []
        for det in combinations(attributes, size):
            left = [t.name for t in targets if not any(t.name in d.targets and set(d.columns) <= set(det) for d in held)]
            if left:
                sets.append((det, left))
        if not sets:
            break
        tested = F.array(*[F.when(_known(det), F.struct(F.lit(i).alias("det"), *[k.alias(n) for k, n in zip(_key(det), KEY)])) for i, (det, _) in enumerate(sets)])
        values = [_usable(t).alias(f"v{j}") for j, t in enumerate(targets)]
        aggs = [F.count(F.lit(1)).alias("n")]
        for j in range(len(targets)):
            aggs += [F.min(f"v{j}").alias(f"lo{j}"), F.max(f"v{j}").alias(f"hi{j}"), F.count(f"v{j}").alias(f"n{j}")]
        each = df.select(F.explode(F.array_compact(tested)).alias("d"), *values).select("d.*", *[f"v{j}" for j in range(len(targets))])
        stats = settle(each.groupBy("det", *KEY).agg(*aggs), "dependencies")
        sums = [F.max("n").alias("most")]
        for j in range(len(targets)):
            many = F.col(f"n{j}") >= 2
            sums += [F.count_if(many).alias(f"g{j}"), F.count_if(many & (F.col(f"lo{j}") != F.col(f"hi{j}"))).alias(f"b{j}")]
        for r in sorted(stats.groupBy("det").agg(*sums).collect(), key=lambda r: r["det"]):
            det, left = sets[r["det"]]
            good = tuple(t.name for j, t in enumerate(targets) if t.name in left and r[f"g{j}"] >= least_groups and r[f"b{j}"] <= tolerance * r[f"g{j}"])
            if good:
                held.append(Dependency(det, good, r["det"], stats, r["most"]))
    return held


def _dictionary(d: Dependency, targets: Sequence[Target], prefix: str) -> DataFrame:
    """(key, <prefix><target>): the values that never contradict themselves."""
    at = {t.name: j for j, t in enumerate(targets)}
    cols = [F.when(F.col(f"lo{at[n]}") == F.col(f"hi{at[n]}"), F.col(f"lo{at[n]}")).cast("double").alias(prefix + n) for n in d.targets]
    found = d.stats.where(F.col("det") == d.det).select(*KEY, *cols)
    return found.where(F.coalesce(*[F.col(prefix + n) for n in d.targets]).isNotNull())


def _group_stats(df: DataFrame, targets: Sequence[Target], by: Sequence[str], prefix: str) -> DataFrame:
    """(key, <prefix>rows, <prefix>n_<target>, <prefix><target>): rows, usable
    values and the fallback of every group. Sums are exact decimals, so the
    order of rows makes no difference; a mode's ties go to the lower value."""
    rows = df.where(_known(by)).select(*[k.alias(n) for k, n in zip(_key(by), KEY)], *[_usable(t).alias(t.name) for t in targets])
    aggs = [F.count(F.lit(1)).alias(f"{prefix}rows")]
    for t in targets:
        aggs.append(F.count(t.name).alias(f"{prefix}n_{t.name}"))
        if t.how != "mode":
            mean = F.sum(F.col(t.name).try_cast("decimal(28,4)")).cast("double") / F.count(t.name)
            aggs.append((F.floor(mean + 0.5).cast("double") if t.how == "whole" else F.floor(mean * 100 + 0.5) / 100).alias(prefix + t.name))
    out = rows.groupBy(*KEY).agg(*aggs)
    for t in targets:
        if t.how == "mode":
            counted = rows.where(F.col(t.name).isNotNull()).groupBy(*KEY, t.name).agg(F.count(F.lit(1)).alias("c"))
            mode = counted.groupBy(*KEY).agg(F.max(F.struct("c", (-F.col(t.name).cast("double")).alias("v"))).alias("b")).select(*KEY, (-F.col("b.v")).alias(prefix + t.name))
            out = out.join(mode, KEY, "left")
    return out


def _joined(rows: DataFrame, small: DataFrame, columns: Sequence[str], row_id: str, hot: bool, ways: int) -> DataFrame:
    """Left join on the columns' hash. Rows with a missing part keep half of
    their key NULL: they are spread and match nothing."""
    k1, k2 = _key(columns)
    known = _known(columns)
    keyed = rows.withColumns({"_k1": F.when(known, k1), "_k2": F.when(known, k2).otherwise(F.xxhash64(row_id))})
    out = salted_join(keyed, small, KEY, "left", row_id, ways) if hot else keyed.join(small, KEY, "left")
    return out.drop(*KEY)


def fill_missing(
    df: DataFrame,
    targets: Sequence[Target],
    attributes: Sequence[str],
    groups: Sequence[Sequence[str]],
    *,
    row_id: str,
    width: int = 2,
    tolerance: float = 0.05,
    least_groups: int = 3,
    ways: int = 16,
) -> DataFrame:
    """``df`` with ``<t>_filled``, ``<t>_source`` and ``<t>_peers`` for every
    target.

    ``<t>_source`` is ``own`` (a usable value stood there), ``not_due``,
    ``fd:<columns>`` or ``group:<columns>``, or ``none`` where neither a
    dependency nor a group could tell. Dependencies go before groups, both in
    their order. All values come from usable ones. ``<t>_peers`` counts the usable values of the last group; it is
    NULL for rows without holes. Groups with a NULL column don't lend values.
    An empty table gives no rows. Columns of ``df`` that have the result's names
    or begin with ``_`` are replaced.
    """
    own_names = {f"{t.name}_{x}" for t in targets for x in ("filled", "source", "peers")}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in own_names and not c.startswith("_")])
    hole = {t.name: ~F.coalesce(F.expr(t.usable), F.lit(False)) & F.coalesce(F.expr(t.due), F.lit(False)) for t in targets}
    some = F.lit(False)
    for h in hole.values():
        some = some | h
    held = mine_dependencies(df, targets, attributes, width=width, tolerance=tolerance, least_groups=least_groups)
    out, values = df.where(some), {t.name: [] for t in targets}
    for i, d in enumerate(held):
        out = _joined(out, _dictionary(d, targets, f"_d{i}_"), d.columns, row_id, d.most_rows >= HOT_ROWS, ways)
        for n in d.targets:
            values[n].append((F.col(f"_d{i}_{n}"), "fd:" + "+".join(d.columns)))
    for i, by in enumerate(groups):
        out = _joined(out, _group_stats(df, targets, by, f"_g{i}_"), by, row_id, True, ways)
        for t in targets:
            values[t.name].append((F.col(f"_g{i}_{t.name}"), "group:" + "+".join(by)))

    def result(t: Target, found: list[tuple[Column, str]]) -> list[Column]:
        kind = df.schema[t.name].dataType
        value, source = F.lit(None).cast(kind), F.lit("none")
        for v, mark in reversed(found):
            x = v.try_cast(kind)
            value, source = F.coalesce(x, value), F.when(x.isNotNull(), F.lit(mark)).otherwise(source)
        own, due = F.coalesce(F.expr(t.usable), F.lit(False)), F.coalesce(F.expr(t.due), F.lit(False))
        return [
            F.when(own, F.col(t.name)).when(due, value).alias(f"{t.name}_filled"),
            F.when(own, F.lit("own")).when(~due, F.lit("not_due")).otherwise(source).alias(f"{t.name}_source"),
        ]

    kept = [F.col(f"`{c}`") for c in df.columns]
    peers = f"_g{len(groups) - 1}_n_"
    filled = out.select(*kept, *[c for t in targets for c in result(t, values[t.name])], *[(F.col(peers + t.name) if groups else F.lit(None).cast("long")).alias(f"{t.name}_peers") for t in targets])
    whole = df.where(~some).select(*kept, *[c for t in targets for c in result(t, [])], *[F.lit(None).cast("long").alias(f"{t.name}_peers") for t in targets])
    return filled.unionByName(whole)
