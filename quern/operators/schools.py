"""Schools and majors that are new, gone, deleted or renamed."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from heapq import heappush, heapreplace

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import notes
from quern.operators.order import first_per_key
from quern.session import settle, spread

#: Names in a block when all names of two sides are compared.
NEW_BLOCK, OLD_BLOCK = 250, 500


def schools(df: DataFrame) -> DataFrame:
    return df.select("school").where("coalesce(school, '') <> ''").distinct()


def major_counts(plan: DataFrame) -> DataFrame:
    return plan.where("coalesce(school, '') <> ''").groupBy("school").agg(F.count(F.lit(1)).alias("major_count"))


def new_majors(rows: DataFrame, past: DataFrame) -> DataFrame:
    """Rows whose school has no past row of exactly their core, in any category."""
    known = past.where("school <> ''").select("school", "core").distinct()
    return rows.join(known, ["school", "core"], "left_anti").select(*rows.columns)


def deleted_majors(plan: DataFrame, past: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """Past rows (copies kept) of schools present this year and not renamed
    (``renamed``: new_school) whose exact major their school no longer has."""
    present = schools(plan)
    if renamed is not None:
        present = present.join(renamed.select(F.col("new_school").alias("school")), "school", "left_anti")
    pool = past.join(present, "school", "left_semi")
    gone = pool.join(plan.select("school", "major").distinct(), ["school", "major"], "left_anti")
    return gone.select("hist_pos", "school", "school_cat", "major", "J", "T", F.lit(notes.DELETED).alias("log"))


def new_schools(plan: DataFrame, past: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """(school, major_count) of schools without a past, renamed ones left out."""
    out = major_counts(plan).join(schools(past), "school", "left_anti")
    return out if renamed is None else out.join(renamed.select(F.col("new_school").alias("school")), "school", "left_anti")


def gone_schools(plan: DataFrame, past: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """(school) of past schools not present this year, old names left out."""
    out = schools(past).join(schools(plan), "school", "left_anti")
    return out if renamed is None else out.join(renamed.select(F.col("old_school").alias("school")), "school", "left_anti")


def apply_renames(past: DataFrame, renamed: DataFrame) -> DataFrame:
    """Past rows under their school's new name. Of several new names for one old
    name the last stands (``renamed``: old_school, new_school, pos)."""
    last = first_per_key(renamed.where("coalesce(old_school, '') <> ''").select("old_school", "new_school", "pos"), ["old_school"], -F.col("pos"))
    joined = past.join(last.select(F.col("old_school").alias("school"), F.col("new_school").alias("_new")), "school", "left")
    return joined.withColumn("school", F.coalesce("_new", "school")).select(*past.columns)


def name_blocks(new: DataFrame, old: DataFrame, new_block: int, old_block: int) -> DataFrame:
    """(news, olds): blocks of names by hash, every block of one side beside
    every block of the other, each pair of blocks once."""
    new, old = settle(new, "new-names"), settle(old, "old-names")
    n, m = (max(1, -(-df.count() // size)) for df, size in ((new, new_block), (old, old_block)))
    news = new.groupBy(spread(F.col("new_school"), n).alias("_i")).agg(F.collect_list("new_school").alias("news"))
    olds = old.groupBy(spread(F.col("old_school"), m).alias("_j")).agg(F.collect_list("old_school").alias("olds"))
    pairs = news.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).join(olds, "_j").select("news", "olds")
    # by number, so that few bytes aren't put into one task
    return pairs.repartition(max(min(n * m, 4 * new.sparkSession.sparkContext.defaultParallelism), n * m // 256))


class _Name(str):
    """A name that sorts in reverse, for a heap with the worst candidate on top."""

    __slots__ = ()

    def __lt__(self, other: str) -> bool:
        return str.__gt__(self, other)


def best_ratios(news: list[str], olds: list[str], topk: int) -> list[tuple[str, str, float]]:
    """Ratcliff-Obershelp ratios of all pairs, or of each new name's ``topk``
    best; a pair is passed over only if its upper bound is below all of them."""
    kept: dict[str, list[tuple[float, _Name]]] = {a: [] for a in news}
    match = SequenceMatcher(None)
    for b in olds:
        match.set_seq2(b)
        for a, heap in kept.items():
            match.set_seq1(a)
            full = 0 < topk <= len(heap)
            if full and (match.real_quick_ratio() < heap[0][0] or match.quick_ratio() < heap[0][0]):
                continue
            one = (match.ratio(), _Name(b))
            if not full:
                heappush(heap, one) if topk > 0 else heap.append(one)
            elif heap[0] < one:
                heapreplace(heap, one)
    return [(a, str(b), x) for a, heap in kept.items() for x, b in heap]


def rename_candidates(plan: DataFrame, past: DataFrame, *, topk: int = 5, measure: str = "ratio", new_block: int = NEW_BLOCK, old_block: int = OLD_BLOCK) -> DataFrame:
    """(new_school, old_school, similarity, place) for schools only this year
    has, against schools only the past has, best first; ties by name.

    ``measure`` is ``ratio`` (Ratcliff-Obershelp), ``edit`` (1 - edit distance /
    longer length) or ``pairs`` (Dice's share of neighbouring characters in
    common). All old names are compared with each new one, in blocks of bounded
    size. ``topk`` of 0 or less keeps all; otherwise names with nothing in common
    (similarity 0) aren't proposed.
    """
    new = new_schools(plan, past).select(F.col("school").alias("new_school"))
    old = gone_schools(plan, past).select(F.col("school").alias("old_school"))
    if measure != "ratio":
        pairs = name_blocks(new, old, new_block, old_block).select(F.explode("news").alias("new_school"), "olds").select("new_school", F.explode("olds").alias("old_school"))
        if measure == "edit":
            sim = 1 - F.levenshtein("new_school", "old_school") / F.greatest(F.length("new_school"), F.length("old_school"))
        else:
            grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(2))))
            sim = 2 * F.size(F.array_intersect(grams("new_school"), grams("old_school"))) / (F.size(grams("new_school")) + F.size(grams("old_school")))
        scored = pairs.withColumn("similarity", F.round(sim, 6))
    else:

        def ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for news, olds in zip(pdf["news"], pdf["olds"]):
                    yield pd.DataFrame(best_ratios(list(news), list(olds), topk), columns=["new_school", "old_school", "similarity"])

        scored = name_blocks(new, old, new_block, old_block).mapInPandas(ratios, "new_school string, old_school string, similarity double")
    place = F.row_number().over(Window.partitionBy("new_school").orderBy(F.desc("similarity"), "old_school"))
    ranked = scored.withColumn("place", place)
    return ranked.where((F.col("place") <= topk) & (F.col("similarity") > 0)) if topk > 0 else ranked


def rename_overlap(pairs: DataFrame, plan: DataFrame, past: DataFrame) -> DataFrame:
    """For (new_school, old_school) pairs the share of the smaller school's
    distinct cores that both have: a check on renames missed or mistaken."""
    cores = lambda df, name: df.where("core <> ''").select(F.col("school").alias(name), "core").distinct()
    size = lambda df, name, n: cores(df, name).groupBy(name).agg(F.count(F.lit(1)).alias(n))
    p = pairs.select("new_school", "old_school").distinct()
    shared = p.join(cores(plan, "new_school"), "new_school").join(cores(past, "old_school"), ["old_school", "core"]).groupBy("new_school", "old_school").agg(F.count(F.lit(1)).alias("shared"))
    out = p.join(shared, ["new_school", "old_school"], "left").join(size(plan, "new_school", "n_new"), "new_school", "left").join(size(past, "old_school", "n_old"), "old_school", "left")
    smaller = F.least(F.coalesce("n_new", F.lit(0)), F.coalesce("n_old", F.lit(0)))
    count = F.coalesce("shared", F.lit(0))
    return out.select("new_school", "old_school", count.cast("long").alias("shared"), smaller.cast("long").alias("smaller"), F.when(smaller > 0, F.round(count / smaller, 6)).alias("overlap"))


def enrich_renames(renamed: DataFrame, plan: DataFrame, research: DataFrame | None = None) -> DataFrame:
    """Rename rows with this year's number of majors and, where there is no
    remark yet, one from research texts (``research``: school, text) filed
    under the new name or else the old one."""
    out = renamed.drop("major_count_2026").join(major_counts(plan).withColumnsRenamed({"school": "new_school", "major_count": "major_count_2026"}), "new_school", "left")
    out = out.withColumn("major_count_2026", F.coalesce("major_count_2026", F.lit(0)))
    pointer = F.concat(F.lit("（见 research/"), F.col("new_school"), F.lit(".md）"))
    summary = F.lit(None).cast("string")
    if research is not None:
        for name, alias in (("old_school", "_old"), ("new_school", "_new")):
            text = notes.research_summary(F.col("text"), F.col("school"))
            r = research.select(F.col("school").alias(name), F.when(~text.startswith("（见"), text).alias(alias))
            out = out.join(r, name, "left")
        summary = F.coalesce("_new", "_old")
    has = F.trim(F.coalesce("remark", F.lit(""))) != ""
    merged = F.when(has, F.col("remark")).when(summary.isNotNull(), notes.merge_remark(summary, F.col("remark"), F.col("manual_reviewed"))).otherwise(F.coalesce("remark", pointer))
    return out.withColumn("remark", merged).drop("_old", "_new")
