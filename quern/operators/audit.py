"""Data-quality checks over published tables; one row per check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import notes
from quern.functions.numeric import close_number
from quern.functions.text import blank_row, family_keys
from quern.operators.results import major_row

JUDGED_STAGES = (notes.JUDGED,)
#: Width of a bucket of figures, no less than the tolerance of ``close_number``.
BUCKET = 0.02


def _check(df: DataFrame, name: str, broken, what: str) -> DataFrame:
    bad = F.count_if(broken)
    return df.agg(F.lit(name).alias("name"), (bad == 0).alias("passed"), F.concat(F.lit(what + ": "), bad.cast("string")).alias("detail"))


def judged_coverage(table: DataFrame, verdicts: DataFrame | None) -> DataFrame:
    """Every judged offer has the verdict 确定; ``verdicts`` is None where no
    verdict file exists, which fails."""
    if verdicts is None:
        return table.agg(F.lit("judgmental_coverage").alias("name"), F.lit(False).alias("passed"), F.lit("复核未派发").alias("detail"))
    rows = table.where(major_row() & F.col("匹配方式").isin(*JUDGED_STAGES)).join(verdicts.withColumnRenamed("src_row_idx", "_row_idx"), "_row_idx", "left")
    return _check(rows, "judgmental_coverage", F.coalesce("verdict", F.lit("")) != "确定", "without verdict 确定")


def stages_filled(flat: DataFrame) -> DataFrame:
    """Every offer has a stage; an empty table fails."""
    rows = flat.where(major_row())
    blank = F.count_if(F.trim(F.coalesce("匹配方式", F.lit(""))) == "")
    n = F.count(F.lit(1))
    return rows.agg(F.lit("nonempty_log").alias("name"), ((n > 0) & (blank == 0)).alias("passed"), F.concat(F.lit("blank: "), blank.cast("string")).alias("detail"))


def no_blank_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        cols = [F.col(f"`{c}`") for c in df.columns if c != "_row_idx"]
        one = df.agg(F.count_if(blank_row(*cols)).alias("n"), F.lit(name).alias("t"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.lit("no_empty_rows").alias("name"), (F.sum("n") == 0).alias("passed"), F.concat(F.lit("blank rows: "), F.sum("n").cast("string")).alias("detail"))


def tables_filled(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.limit(1).agg(F.count(F.lit(1)).alias("n"), F.lit(name).alias("t"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.lit("tables_nonempty").alias("name"), (F.min("n") > 0).alias("passed"), F.concat(F.lit("empty tables: "), F.count_if(F.col("n") == 0).cast("string")).alias("detail"))


def figures_consistent(results: DataFrame, past: DataFrame, estimates: DataFrame) -> DataFrame:
    """Matched figures equal those of some past row of the same school and
    matched name, estimated ones their estimate; all rows are checked. Matches
    without a past row of that name are skipped."""
    # figures that occur on either side are compared once, however many rows have them
    h = past.select("school", F.col("major").alias("matched_major"), F.col("J").alias("_hj"), F.col("T").alias("_ht"), F.lit(True).alias("_there")).distinct()
    kinds = results.where("matched").groupBy("school", "matched_major", "J", "T").agg(F.count(F.lit(1)).alias("n"))
    # close figures share a bucket or neighbour it; NULL figures have one of their own
    bucket = lambda c: F.coalesce(F.floor(F.col(c) / BUCKET), F.lit(-(2**62)))
    known = h.select("school", "matched_major").distinct()
    asked = kinds.join(known, ["school", "matched_major"]).withColumn("_b", F.explode(F.array(*[bucket("J") + i for i in (-1, 0, 1)])))
    met = asked.join(h.withColumn("_b", bucket("_hj")), ["school", "matched_major", "_b"], "left")
    any_close = F.bool_or(F.coalesce(close_number(F.col("J"), F.col("_hj")) & close_number(F.col("T"), F.col("_ht")) & F.col("_there"), F.lit(False)))
    m = met.groupBy("school", "matched_major", "J", "T").agg(F.first("n").alias("n"), any_close.alias("ok")).select("n", "ok")
    e = results.where("NOT matched").join(estimates.select("src_row_idx", F.col("value").alias("_ev"), F.col("T").alias("_et")), "src_row_idx")
    e = e.select(F.lit(1).cast("long").alias("n"), (close_number(F.col("J"), F.col("_ev")) & close_number(F.col("T"), F.col("_et"))).alias("ok"))
    bad = F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0))
    return m.unionByName(e).agg(F.lit("jt_consistency").alias("name"), (bad == 0).alias("passed"), F.concat(F.lit("inconsistent: "), bad.cast("string")).alias("detail"))


def renames_sourced(renamed: DataFrame) -> DataFrame:
    """Every rename row holds a link to an official site."""
    return _check(renamed, "rename_official_link", ~notes.has_official_link(*[F.col(f"`{c}`").cast("string") for c in renamed.columns]), "without link")


def uncovered(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a feed whose keys another feed doesn't have; a NULL key is had
    by none."""
    return rows.join(other.select(*keys).distinct(), keys, "left_anti").select(*rows.columns)


def residual_brackets(rows: DataFrame) -> DataFrame:
    """Rows whose core still holds a bracket: one that isn't closed or opened."""
    return rows.where(F.col("core").rlike("[()]"))


def unmatched_families(rest: DataFrame, past: DataFrame) -> DataFrame:
    """(src_row_idx, core, past_core) of offers without a match whose school has
    a past core that differs by the ending 类 alone. Cores are joined once for
    each school, however many rows have them."""
    keys = rest.select("school", "core").distinct().withColumn("past_core", F.explode(family_keys(F.col("core")))).where("core <> past_core")
    met = keys.join(past.select("school", F.col("core").alias("past_core")).distinct(), ["school", "past_core"])
    return rest.select("src_row_idx", "school", "core").join(met, ["school", "core"]).select("src_row_idx", "core", "past_core")


def audit(checks: list[DataFrame]) -> DataFrame:
    """(name, passed, detail) of all checks."""
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    return out


def all_passed(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("ok"))
