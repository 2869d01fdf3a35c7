"""Joins of this year's offers with past records, from strict to judged.

``plan`` rows have src_row_idx, school, school_cat, major, stripped, core,
subject, batch; ``past`` rows have hist_pos, school, school_cat, major,
stripped, core, subject, J, T. Text columns hold '' for missing. The past side
is always reduced to one row per key (first row, count) before it is joined, so
neither side's copies multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import notes
from quern.functions.numeric import same_number
from quern.functions.text import family_keys, fold_category, subject_differs

PLAN = ["src_row_idx", "school", "school_cat", "major", "stripped", "core", "subject", "batch"]
#: How far a nearest J may be.
NEAR = 0.5
MATCH = ["src_row_idx", "school", "school_cat", "major", "matched", "matched_major", "J", "T", "log"]


def first_row(*fields: str) -> Column:
    """Aggregate: the fields of the row with the least hist_pos."""
    return F.min(F.struct(F.col("hist_pos"), *[F.col(f) for f in fields]))


def strict_match(plan: DataFrame, past: DataFrame) -> DataFrame:
    """One MATCH row per plan row: the first past row with the same school,
    category (the default is none) and stripped name, or a miss."""
    key = ["school", "_cat", "stripped"]
    right = past.withColumn("_cat", fold_category(F.col("school_cat"))).groupBy(*key).agg(first_row("J", "T", "major").alias("_h"))
    hit = F.col("_h").isNotNull()
    log = F.when(hit, notes.joined(F.lit(notes.STRICT), notes.single_year(F.col("_h.T")))).otherwise(F.lit(notes.MISS))
    return (
        plan.withColumn("_cat", fold_category(F.col("school_cat")))
        .join(right, key, "left")
        .select("src_row_idx", "school", "school_cat", "major", hit.alias("matched"), F.col("_h.major").alias("matched_major"), F.col("_h.J").alias("J"), F.col("_h.T").alias("T"), log.alias("log"))
    )


def unmatched(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Plan rows without a match among ``results``."""
    return plan.join(results.where("matched").select("src_row_idx"), "src_row_idx", "left_anti")


def coarse_match(plan: DataFrame, past: DataFrame) -> DataFrame:
    """MATCH rows for plan rows with exactly one past candidate.

    In this order: (1) one past row of the same school, category and core;
    (2) one of the same school and category with a compatible core; (3) one of
    the same school with a compatible core in any category. Rows, not distinct
    values, are counted. All three counts come from one join of the distinct
    plan keys with past rows counted per (school, category, core).
    """
    groups = past.withColumn("_hc", fold_category(F.col("school_cat"))).groupBy("school", "_hc", F.col("core").alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), first_row("J", "T", "major", "school_cat", "subject").alias("_h")
    )
    keys = plan.select("school", fold_category(F.col("school_cat")).alias("_pc"), "core").distinct()
    # an empty core is compatible with nothing, but may be equal (step 1)
    tried = keys.withColumn("_k", F.explode(F.array_union(family_keys(F.col("core")), F.array(F.col("core")))))
    pairs = tried.join(groups, ["school", "_k"])
    same, compatible = F.col("_pc") == F.col("_hc"), F.col("core") != ""
    exact = same & (F.col("_k") == F.col("core"))

    def counted(cond: Column, name: str) -> list[Column]:
        return [F.sum(F.when(cond, F.col("_n"))).alias(f"_n{name}"), F.min(F.when(cond, F.col("_h"))).alias(f"_h{name}")]

    decided = pairs.groupBy("school", "_pc", "core").agg(*counted(exact, "1"), *counted(same & compatible, "2"), *counted(compatible, "3"))
    step = F.when(F.col("_n1") == 1, 1).when(F.col("_n2") == 1, 2).when(F.col("_n3") == 1, 3)
    chosen = F.when(F.col("_n1") == 1, F.col("_h1")).when(F.col("_n2") == 1, F.col("_h2")).when(F.col("_n3") == 1, F.col("_h3"))
    decided = decided.select("school", "_pc", "core", step.alias("step"), chosen.alias("_h")).where("step IS NOT NULL")
    rows = plan.withColumn("_pc", fold_category(F.col("school_cat"))).join(decided, ["school", "_pc", "core"])
    base = (
        F.when(F.col("step") == 1, F.lit(notes.COARSE))
        .when(F.col("step") == 2, F.lit(notes.COARSE + notes.FAMILY_NOTE))
        .otherwise(F.concat(F.lit(notes.COARSE), notes.cross_category(F.col("school"), F.col("_h.school_cat"), F.col("_h.J"), F.col("school_cat"), F.col("major"))))
    )
    drift = F.when(subject_differs(F.col("subject"), F.col("_h.subject")), F.lit(notes.SUBJECT_NOTE)).otherwise(F.lit(""))
    log = notes.joined(base, drift, notes.single_year(F.col("_h.T")))
    return rows.select(
        "src_row_idx", "school", "school_cat", "major", F.lit(True).alias("matched"), F.col("_h.major").alias("matched_major"),
        F.col("_h.J").alias("J"), F.col("_h.T").alias("T"), log.alias("log"), "step",
    )


def candidates(plan: DataFrame, past: DataFrame) -> DataFrame:
    """(src_row_idx, hist_pos, major, core, J, T, subject) of every past row of
    the same school and category with a compatible core."""
    left = plan.select("src_row_idx", "school", fold_category(F.col("school_cat")).alias("_c"), F.explode(family_keys(F.col("core"))).alias("_k"))
    right = past.select("school", fold_category(F.col("school_cat")).alias("_c"), F.col("core").alias("_k"), "hist_pos", "major", "core", "J", "T", "subject")
    return left.join(right, ["school", "_c", "_k"]).select("src_row_idx", "hist_pos", "major", "core", "J", "T", "subject")


def candidate_items(plan: DataFrame, past: DataFrame) -> DataFrame:
    """Plan rows that have candidates, with them as an array in past order. The
    arrays are made once for each school, category and core of the plan."""
    key = [F.col("school"), fold_category(F.col("school_cat")).alias("_c"), F.col("core")]
    left = plan.select(*key).distinct().withColumn("_k", F.explode(family_keys(F.col("core"))))
    right = past.select("school", fold_category(F.col("school_cat")).alias("_c"), F.col("core").alias("_k"), "hist_pos", "major", F.col("core").alias("_core"), "J", "T")
    payload = F.sort_array(F.collect_list(F.struct("hist_pos", "major", F.col("_core").alias("core"), "J", "T")))
    found = left.join(right, ["school", "_c", "_k"]).groupBy("school", "_c", "core").agg(payload.alias("_l"))
    listed = F.transform("_l", lambda c: F.struct(c["major"].alias("major"), c["core"].alias("core"), c["J"].alias("J"), c["T"].alias("T")))
    return plan.withColumn("_c", key[1]).join(found, ["school", "_c", "core"]).select(*plan.columns, listed.alias("candidates"))


def locate_echo(picked: DataFrame, plan: DataFrame, past: DataFrame) -> DataFrame:
    """The candidate behind each pick (src_row_idx, match, J, T): the first with
    the picked name whose figures echo the pick's, else the first with it."""
    p = picked.select("src_row_idx", F.col("match").alias("major"), F.col("J").alias("_ej"), F.col("T").alias("_et"))
    pool = candidates(plan.join(p.select("src_row_idx").distinct(), "src_row_idx", "left_semi"), past)
    echo = F.col("_ej").isNotNull() & same_number(F.col("J"), F.col("_ej")) & same_number(F.col("T"), F.col("_et"))
    best = F.min(F.struct((~echo).alias("_o"), "hist_pos", "J", "T", "subject"))
    return pool.join(p, ["src_row_idx", "major"]).groupBy("src_row_idx", "major").agg(best.alias("_b")).select("src_row_idx", F.col("major").alias("match"), "_b.hist_pos", "_b.J", "_b.T", "_b.subject")


def locate_past(matches: DataFrame, plan: DataFrame, past: DataFrame) -> DataFrame:
    """(src_row_idx, level, hist_pos, major, core, J, T) of the past row a match
    came from: (1) same school and matched name; (2) same school and core with
    equal figures; (3) the only row of the same core; (4) the nearest J of the
    same core within 0.5, a missing J counting as 0. No row where none fits."""
    m = matches.select("src_row_idx", "matched_major", F.col("J").alias("_j"), F.col("T").alias("_t")).join(plan.select("src_row_idx", "school", "core"), "src_row_idx")
    h = past.select("school", F.col("major").alias("_hm"), F.col("core").alias("_hc"), "hist_pos", F.col("J").alias("_hj"), F.col("T").alias("_ht"))
    fields = ["hist_pos", "_hm", "_hc", "_hj", "_ht"]
    named = m.where("coalesce(matched_major, '') <> ''").join(
        h.groupBy("school", F.col("_hm").alias("matched_major")).agg(F.min(F.struct(*fields)).alias("_r")), ["school", "matched_major"]
    ).select("src_row_idx", F.lit(1).alias("level"), F.lit(0.0).alias("_d"), "_r")
    # (2) figures that occur, each with its first row: an equi-join, NULL equal to NULL
    kinds = h.groupBy("school", F.col("_hc").alias("core"), "_hj", "_ht").agg(F.min(F.struct(*fields)).alias("_r"))
    echo = m.alias("m").join(
        kinds.alias("k"),
        (F.col("m.school") == F.col("k.school")) & (F.col("m.core") == F.col("k.core")) & F.col("m._j").eqNullSafe(F.col("k._hj")) & F.col("m._t").eqNullSafe(F.col("k._ht")),
    ).select("src_row_idx", F.lit(2).alias("level"), F.lit(0.0).alias("_d"), "_r")
    # (3) cores with one row
    alone = h.groupBy("school", F.col("_hc").alias("core")).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*fields)).alias("_r")).where("_n = 1")
    only = m.join(alone, ["school", "core"]).select("src_row_idx", F.lit(3).alias("level"), F.lit(0.0).alias("_d"), "_r")
    # (4) the nearest J: candidates share a bucket of the tolerance's width, or neighbour it
    near = h.groupBy("school", F.col("_hc").alias("core"), F.coalesce("_hj", F.lit(0.0)).alias("_z")).agg(F.min(F.struct(*fields)).alias("_r")).withColumn("_b", F.floor(F.col("_z") / NEAR))
    asked = m.where("_j IS NOT NULL").withColumn("_b", F.explode(F.array(*[F.floor(F.col("_j") / NEAR) + i for i in (-1, 0, 1)])))
    dist = F.abs(F.col("_z") - F.col("_j"))
    close = asked.join(near, ["school", "core", "_b"]).where(dist <= NEAR).select("src_row_idx", F.lit(4).alias("level"), dist.alias("_d"), "_r")
    ranked = echo.unionByName(only).unionByName(close)
    best = named.unionByName(ranked).groupBy("src_row_idx").agg(F.min(F.struct("level", "_d", "_r")).alias("_b"))
    return best.select("src_row_idx", "_b.level", "_b._r.hist_pos", F.col("_b._r._hm").alias("major"), F.col("_b._r._hc").alias("core"), F.col("_b._r._hj").alias("J"), F.col("_b._r._ht").alias("T"))
