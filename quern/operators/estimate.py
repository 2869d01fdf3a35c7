"""Graded estimates for offers without a past."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import notes
from quern.functions.numeric import round2, short_number
from quern.functions.text import subject_atoms, subject_covers

REFERENCE_VARIANTS = " \\| "
INTENDED_VARIANTS = "\\s*\\|\\s*"


def estimate(rows: DataFrame, past: DataFrame, *, variants: str = REFERENCE_VARIANTS) -> DataFrame:
    """(src_row_idx, value, T, level, n, log) for every row of ``rows``.

    Level 0 averages the past rows of the same school whose subjects cover the
    row's, level 1 all past rows of the school, level 2 has nothing to go by. T
    is averaged at the same level and may be NULL. Past rows are summed per
    (school, subject) first, and distinct subjects meet by their rarest part;
    means are taken over decimals, so they don't depend on
    the order of rows.
    """
    ok = lambda c: F.when(~F.isnan(c), F.col(c).cast("decimal(18,4)"))
    sums = past.where("school <> ''").groupBy("school", F.col("subject").alias("_hs")).agg(
        F.sum(ok("J")).alias("_sj"), F.count(ok("J")).alias("_nj"), F.sum(ok("T")).alias("_st"), F.count(ok("T")).alias("_nt")
    )
    asked = rows.select("school", "subject").distinct()
    figures = ("_sj", "_nj", "_st", "_nt")
    whole = sums.groupBy("school").agg(*[F.sum(c).alias(c + "1") for c in figures])
    # A past subject covers a row's only if one of its variants has the row's
    # rarest part: an equi-join on that part instead of all pairs of a school.
    pattern = F.split(F.coalesce("_hs", F.lit("")), variants)
    parts = sums.select("school", "_hs", F.explode(F.array_distinct(F.flatten(F.transform(pattern, subject_atoms)))).alias("_a"))
    often = parts.groupBy("school", "_a").agg(F.count(F.lit(1)).alias("_f"))
    wanted = asked.where("trim(coalesce(subject, '')) <> ''").select("school", "subject", F.explode_outer(F.array_distinct(subject_atoms(F.col("subject")))).alias("_a"))
    rarest = wanted.join(often, ["school", "_a"], "left").groupBy("school", "subject").agg(F.min(F.struct(F.coalesce("_f", F.lit(0)), F.col("_a"))).alias("_m")).select("school", "subject", F.col("_m._a").alias("_a"))
    covered = rarest.join(parts, ["school", "_a"]).where(subject_covers(F.col("subject"), F.col("_hs"), variants)).select("school", "subject", "_hs")
    fitting = covered.join(sums, ["school", "_hs"]).groupBy("school", "subject").agg(*[F.sum(c).alias(c + "0") for c in figures])
    levels = asked.join(whole, "school").join(fitting, ["school", "subject"], "left")
    free = F.size(subject_atoms(F.coalesce("subject", F.lit("")))) == 0  # nothing asked: every row fits
    levels = levels.withColumns({c + "0": F.when(free, F.col(c + "1")).otherwise(F.col(c + "0")) for c in figures})
    mean = lambda s, n: F.when(F.col(n) > 0, round2(F.col(s) / F.col(n)))
    level = F.when(F.coalesce("_nj0", F.lit(0)) > 0, 0).when(F.coalesce("_nj1", F.lit(0)) > 0, 1).otherwise(2)
    told = levels.select(
        "school", "subject", level.alias("level"),
        F.when(level == 0, mean("_sj0", "_nj0")).when(level == 1, mean("_sj1", "_nj1")).alias("value"),
        F.when(level == 0, mean("_st0", "_nt0")).when(level == 1, mean("_st1", "_nt1")).alias("T"),
        F.when(level == 0, F.col("_nj0")).when(level == 1, F.col("_nj1")).otherwise(F.lit(0)).cast("int").alias("n"),
    )
    v = short_number(F.col("value"))
    log = (
        F.when(F.col("level") == 0, F.concat(F.lit("新增专业：估算=同校同选科("), F.col("n"), F.lit(")均值="), v))
        .when(F.col("level") == 1, F.concat(F.lit("新增专业：退化=同校全专业均值(无同选科)("), F.col("n"), F.lit(")="), v))
        .otherwise(F.lit(notes.NO_HISTORY))
    )
    out = rows.select("src_row_idx", "school", "subject").join(told, ["school", "subject"], "left")
    filled = out.withColumns({"level": F.coalesce("level", F.lit(2)), "n": F.coalesce("n", F.lit(0))})
    return filled.select("src_row_idx", "value", "T", "level", "n", log.alias("log"))
