"""One result per plan row, and the tables made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import notes
from quern.functions.text import OUT_OF_SCOPE_WORDS, has_any, subject_differs
from quern.operators.match import MATCH, locate_past
from quern.operators.order import first_per_key
from quern.session import spread

# First cells of a header row.
HEADER_CELLS = ("batch", "批次")

_SHORT = [c for c in MATCH if c != "matched_major"]


def judged_matches(checked: DataFrame, plan: DataFrame, past: DataFrame) -> DataFrame:
    """MATCH rows of judged lines that passed their checks."""
    subject = past.select("hist_pos", F.col("subject").alias("_hs"))
    rows = checked.drop("error", "file", "lineno").join(plan.select("src_row_idx", "school", "school_cat", "major", "subject"), "src_row_idx").join(subject, "hist_pos", "left")
    hit = F.col("match").isNotNull()
    drift = F.when(subject_differs(F.col("subject"), F.col("_hs")), F.lit(notes.SUBJECT_NOTE)).otherwise(F.lit(""))
    told = notes.joined(F.concat(F.lit(notes.JUDGED + "："), "reason"), drift, notes.single_year(F.col("T")))
    log = F.when(hit, told).otherwise(F.concat(F.lit(notes.JUDGED_NONE + "："), "reason"))
    return rows.select("src_row_idx", "school", "school_cat", "major", hit.alias("matched"), F.col("match").alias("matched_major"), "J", "T", log.alias("log"))


def main_results(plan: DataFrame, matchers: list[DataFrame], estimates: DataFrame, *, classified: DataFrame | None = None) -> DataFrame:
    """Exactly one row per plan row: the first matcher's match, else the
    estimate, else the fallback. ``classified`` (src_row_idx) limits which rows
    may keep a match."""
    ranked = None
    for rank, m in enumerate(matchers):
        one = m.where("matched").select(*_SHORT).withColumn("_rank", F.lit(rank))
        ranked = one if ranked is None else ranked.unionByName(one)
    if classified is not None:
        ranked = ranked.join(classified.select("src_row_idx").distinct(), "src_row_idx", "left_semi")
    found = first_per_key(ranked.select("src_row_idx", "J", "T", "log", "_rank"), ["src_row_idx"], F.col("_rank")).select("src_row_idx", F.col("J").alias("_mj"), F.col("T").alias("_mt"), F.col("log").alias("_ml"), F.lit(True).alias("_m"))
    est = estimates.select("src_row_idx", F.col("value").alias("_ev"), F.col("T").alias("_et"), F.col("log").alias("_el"))
    rows = plan.select("src_row_idx", "school", "school_cat", "major").join(found, "src_row_idx", "left").join(est, "src_row_idx", "left")
    m = F.col("_m").isNotNull()
    return rows.select(
        "src_row_idx", "school", "school_cat", "major", m.alias("matched"),
        F.when(m, F.col("_mj")).otherwise(F.col("_ev")).alias("J"), F.when(m, F.col("_mt")).otherwise(F.col("_et")).alias("T"),
        F.when(m, F.col("_ml")).otherwise(F.coalesce("_el", F.lit(notes.SPECIAL))).alias("log"),
    )


def demote(results: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results that weren't doubted, and (src_row_idx, reason) of the doubted."""
    doubted = verdicts.where(F.col("verdict") == "存疑").select("src_row_idx", "reason")
    return results.join(doubted.select("src_row_idx"), "src_row_idx", "left_anti").select(*results.columns), doubted


def core_groups(past: DataFrame) -> DataFrame:
    """(school, core, n, names): number of past rows per core and the first
    three majors by position. The three smallest positions are found in salted
    parts of a group first, so no task sorts a whole hot group. Rows with a NULL school or core belong to no group."""
    counted = past.groupBy("school", "core").agg(F.count(F.lit(1)).alias("n"))
    top = past.select("school", "core", "hist_pos", "major", spread(F.col("hist_pos"), 16).alias("_s"))
    for parts in (["school", "core", "_s"], ["school", "core"]):
        top = top.withColumn("_r", F.row_number().over(Window.partitionBy(*parts).orderBy("hist_pos"))).where("_r <= 3")
    names = top.groupBy("school", "core").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "major"))), lambda x: x["major"]), "/").alias("names"))
    return counted.join(names, ["school", "core"])


def special_rows(remaining: DataFrame, past: DataFrame, estimates: DataFrame, *, doubted: DataFrame | None = None, flight_label: str | None = None) -> DataFrame:
    """Rows without a home with the reason why: doubted at the second look,
    flight training, or nothing among the past rows of the same core fits."""
    rows = remaining.join(core_groups(past), ["school", "core"], "left")
    n = F.coalesce("n", F.lit(0))
    listed = F.concat(F.lit("没找到能匹配的往年专业：同校同核心名有 "), n, F.lit(" 个（"), "names", F.when(n > 3, F.lit("…")).otherwise(F.lit("")), F.lit("），今年的方向和这些都对不上"))
    bare = F.concat(F.lit("没找到能匹配的往年专业："), F.when(F.col("core") != "", F.col("core")).otherwise(F.col("major")))
    flight = F.lit(False) if flight_label is None else F.col("batch") == flight_label
    log = F.when(flight, F.lit(notes.FLIGHT)).when(n > 0, listed).otherwise(bare)
    if doubted is not None:
        rows = rows.join(doubted.select("src_row_idx", F.col("reason").alias("_why")), "src_row_idx", "left")
        log = F.when(F.col("_why").isNotNull(), F.concat(F.lit(notes.DEMOTED + "："), "_why")).otherwise(log)
    est = estimates.select("src_row_idx", F.col("value").alias("_v"), F.col("T").alias("_t"), F.col("level").alias("_l"), F.col("n").alias("_n"))
    rows = rows.join(est, "src_row_idx", "left")
    keep = lambda c: F.when(~flight, F.col(c))
    return rows.select(
        "src_row_idx", "school", "school_cat", "major", "core", "subject", "batch", log.alias("log"), flight.alias("is_flight"),
        keep("_v").alias("est_value"), keep("_t").alias("est_t"), keep("_l").alias("est_level"), keep("_n").alias("est_n"),
    )


def second_look_items(matches: DataFrame, plan: DataFrame, past: DataFrame, *, all_judgemental: bool = False) -> DataFrame:
    """One item per judged match: plan row, located past row, number of past
    rows of its core, and the question. ``all_judgemental`` adds coarse ones."""
    begins = [notes.JUDGED + "：", *(["核心名匹配："] if all_judgemental else [])]
    chosen = F.lit(False)
    for b in begins:
        chosen = chosen | F.col("log").startswith(b)
    m = matches.where(F.col("matched") & chosen)
    located = locate_past(m, plan, past).select("src_row_idx", F.struct(F.coalesce("major", F.lit("")).alias("major"), F.coalesce("core", F.lit("")).alias("core"), "J", "T").alias("matched_candidate"))
    counts = past.groupBy("school", "core").agg(F.count(F.lit(1)).alias("past_same_core"))
    rows = m.select("src_row_idx", F.col("log").alias("prior_log")).join(plan, "src_row_idx").join(located, "src_row_idx", "left").join(counts, ["school", "core"], "left")
    n = F.coalesce("past_same_core", F.lit(0))
    return rows.select("src_row_idx", "school", "school_cat", F.col("major").alias("dagluben_major"), F.col("core").alias("dagluben_core"), "subject", "batch", "matched_candidate", "prior_log", n.alias("past_same_core"), notes.requirement(n).alias("requirement"))


def major_row() -> Column:
    """Grid rows that hold an offer: both code and name are there, and it isn't
    the header."""
    return ~F.coalesce("c0", F.lit("")).isin(*HEADER_CELLS) & (F.coalesce("c4", F.lit("")) != "") & (F.coalesce("c5", F.lit("")) != "")


def hierarchical(grid: DataFrame, results: DataFrame) -> DataFrame:
    """Every row of the source grid with seven result columns, filled on offer
    rows; out-of-scope offers get only their stage. Should a row have several
    results, the one with the least note stands; row 0 doesn't count."""
    first = first_per_key(results.where("src_row_idx <> 0").select("src_row_idx", "J", "T", "log"), ["src_row_idx"], F.col("log"))
    joined = grid.join(first.withColumnRenamed("src_row_idx", "_row_idx").withColumn("_there", F.lit(True)), "_row_idx", "left")
    there = F.col("_there").isNotNull() & major_row()
    beyond = major_row() & F.col("_there").isNull() & has_any(F.coalesce("c1", F.lit("")), OUT_OF_SCOPE_WORDS)
    parts = notes.split_log(F.col("log"))
    cols = [F.when(there, F.col("J")).alias("近三年统计线差"), F.when(there, F.col("T")).alias("近三年线差标准差")]
    for h in notes.RESULT_HEADERS:
        out = F.when(there, parts[h])
        cols.append((out.when(beyond, F.lit("专科（超范围）")) if h == "匹配方式" else out).alias(h))
    return joined.select("_row_idx", *[f"c{i}" for i in range(12)], *cols)


def flat(table: DataFrame) -> DataFrame:
    """Only the offers in scope of a hierarchical table."""
    return table.where(major_row() & ~has_any(F.coalesce("c1", F.lit("")), OUT_OF_SCOPE_WORDS))


def coverage(plan: DataFrame, results: DataFrame, new: DataFrame, special: DataFrame, deleted: DataFrame, fresh: DataFrame, gone: DataFrame, renamed: DataFrame) -> DataFrame:
    """One row of eight counters."""
    counts = [("total", plan), ("matched", results.where("matched")), ("new_major", new), ("special", special), ("deleted", deleted), ("new_school", fresh), ("gone_school", gone), ("rename", renamed.select("new_school").distinct())]
    rows = None
    for name, df in counts:
        one = df.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name, _ in counts])


def edge_tables(new: DataFrame, deleted: DataFrame, renamed: DataFrame, fresh: DataFrame, gone: DataFrame, special: DataFrame) -> dict[str, DataFrame]:
    """The boundary tables under their headers."""
    level = F.lit("")
    for k, v in notes.LEVEL_LABELS.items():
        level = F.when(F.col("level") == k, F.lit(v)).otherwise(level)
    named = lambda df, **cols: df.select(*[(c if not isinstance(c, str) else F.col(c)).alias(h) for h, c in cols.items()])
    sp = special.withColumn("level", F.col("est_level"))
    return {
        "今年新增往年没有的专业": named(new, 学校="school", 专业="major", 选科="subject", 统计线差估算="value", 线差标准差估算="T", 估算方式=level, 用了几条往年数据="n", 说明="log"),
        "往年有但今年停招的专业": named(deleted, 学校="school", 招生类别="school_cat", 专业="major", 近三年统计线差="J", 近三年线差标准差="T", 说明="log"),
        "学校改名表": named(renamed, 新校名="new_school", 原校名=F.coalesce("old_school", F.lit("")), 今年本科专业数="major_count_2026", **{"说明（含官方来源）": F.coalesce("remark", F.lit(""))}),
        "今年新招生的学校": named(fresh, 新校名="school", 今年本科专业数="major_count", 说明=F.lit(notes.NEW_SCHOOL)),
        "往年有今年停招的学校": named(gone, 历史旧校名="school", 说明=F.lit(notes.GONE_SCHOOL)),
        "未能匹配的专业": named(sp, src_row_idx="src_row_idx", 学校="school", 招生类别="school_cat", 专业="major", 核心名="core", 选科="subject", 批次="batch", 统计线差估算="est_value", 线差标准差估算="est_t", 估算方式=level, 用了几条往年数据="est_n", 原因说明="log"),
    }


__all__ = ["core_groups", "coverage", "demote", "edge_tables", "flat", "hierarchical", "judged_matches", "main_results", "second_look_items", "special_rows"]
