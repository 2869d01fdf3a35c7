"""The engine's operators as queries over the test tables.

plan_rows and history_rows play this year's offers and the past; texts are
folded by width only (``fold_width``), which plain SQL can do as well.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import notes
from quern.functions import text as tx
from quern.functions.numeric import line_diff, round2
from quern.operators import audit as checks
from quern.operators import contracts, match, order, results, schools
from quern.operators.estimate import estimate
from quern.plans import pipeline
from quern.session import run_folder, salted_join, settle, table
from quern.sources import files, grids
from quern.sources.xlsx import read_xlsx, write_xlsx
from quern.streaming.results import verdict_sink

W = tx.fold_width
#: All years of lineitem, with made-up cut-offs.
YEARS = tuple(range(1992, 1999))
CUTS = {y: 440 + y % 5 for y in YEARS}


def plan_offers(spark: SparkSession, d: str) -> DataFrame:
    """plan_rows as the plan relation."""
    m = F.col("major")  # folded once, then taken apart
    folded = table(spark, d, "plan_rows").select("src_row_idx", *[W(F.col(c)).alias(c) for c in ("school", "school_cat", "major", "subject")], F.coalesce("batch", F.lit("")).alias("batch"))
    return folded.select("src_row_idx", "school", "school_cat", m, tx.strip_asides(m).alias("stripped"), tx.core_name(m).alias("core"), "subject", "batch")


def past_offers(spark: SparkSession, d: str) -> DataFrame:
    """history_rows as the past relation."""
    m, own = F.col("major"), F.col("school_cat")
    figure = lambda c: F.when(~F.isnan(c), F.col(c))
    folded = table(spark, d, "history_rows").select(
        "hist_pos", *[W(F.col(c)).alias(c) for c in ("school", "school_cat", "major", "subject")], figure("j").alias("J"), figure("t").alias("T"), F.coalesce("source_table", F.lit("")).alias("source_table")
    )
    base, cat = tx.split_school(F.col("school"))
    return folded.select(
        "hist_pos", base.alias("school"), F.when(cat != "", cat).when(own != "", own).otherwise(tx.category_in_major(m)).alias("school_cat"), m,
        tx.strip_asides(m).alias("stripped"), tx.core_name(m).alias("core"), "subject", "J", "T", "source_table",
    )


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return plan_offers(spark, d), past_offers(spark, d)


def _rest(plan: DataFrame, past: DataFrame) -> DataFrame:
    left = match.unmatched(plan, match.strict_match(plan, past))
    return match.unmatched(left, match.coarse_match(left, past))


def _grid(rows: DataFrame, row: str, cells: dict[int, object], width: int) -> DataFrame:
    """Rows as a sheet with the given cells."""
    return rows.select(F.col(row).alias("_row_idx"), *[(cells[i] if i in cells else F.lit(None)).cast("string").alias(f"c{i}") for i in range(width)])


def plan_sheet(spark: SparkSession, d: str) -> DataFrame:
    """plan_rows as a sheet of the plan, early batches under one of their names."""
    early = F.when(F.col("batch") == grids.EARLY, grids.PLAN_EARLY[0]).otherwise(F.col("batch"))
    return _grid(table(spark, d, "plan_rows"), "src_row_idx", {0: early, 1: F.col("school_cat"), 3: F.col("school"), 4: F.col("src_row_idx"), 5: F.col("major"), 6: F.col("subject")}, 12)


def past_sheets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """history_rows as a sheet with figures and one with lowest scores of two years."""
    t = table(spark, d, "history_rows")
    early = F.coalesce(F.col("source_table") == grids.EARLY, F.lit(False))
    j, t_ = (F.when(~F.isnan(c), F.col(c)) for c in ("j", "t"))
    regular = _grid(t.where(~early), "hist_pos", {0: F.lit(grids.PAST_KEPT[0]), 2: F.col("school"), 3: F.col("major"), 4: F.col("subject"), 9: j, 19: t_}, 29)
    low = _grid(t.where(early), "hist_pos", {0: F.lit(grids.SUPPLEMENT_KEPT[0]), 1: F.col("school_cat"), 3: F.col("school"), 5: F.col("major"), 6: F.col("subject"), 10: j, 14: t_}, 29)
    return regular, low


def q_plan_projection(spark, d):
    return grids.plan_rows(plan_sheet(spark, d), normalise=W)


def q_history_projection(spark, d):
    regular, low = past_sheets(spark, d)
    return grids.past_rows(grids.past_regular(regular, normalise=W), grids.past_early(low, {2025: 0, 2024: 0, 2023: 0}, normalise=W))


def _lows(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), "l_extendedprice").where(F.col("y").isin(*YEARS))
    return li.groupBy("l_partkey", "y").agg(F.min("l_extendedprice").alias("low"))


def q_line_diff(spark, d):
    """Mean and deviation over the years, by grouping."""
    cut = F.create_map(*[F.lit(x) for kv in CUTS.items() for x in kv])
    diff = F.col("low") - cut[F.col("y")]
    n = F.count(F.lit(1))
    return _lows(spark, d).groupBy("l_partkey").agg(round2(F.avg(diff)).alias("j"), F.when(n >= 2, round2(F.stddev_pop(diff))).alias("t"), n.cast("int").alias("n"))


def q_line_diff_rowwise(spark, d):
    """The same from one column per year, without a second grouping."""
    wide = _lows(spark, d).groupBy("l_partkey").agg(*[F.min(F.when(F.col("y") == y, F.col("low"))).alias(f"y{y}") for y in YEARS])
    j, t = line_diff({y: F.col(f"y{y}") for y in YEARS}, CUTS)
    return wide.select("l_partkey", j.alias("j"), t.alias("t"))


def q_union_history(spark, d):
    h = past_offers(spark, d)
    early = F.col("source_table") == "提前批"
    both = grids.past_rows(h.where(~early).withColumn("feed", F.lit(0)), h.where(early).withColumn("feed", F.lit(1)))
    return both.select("hist_pos", "feed", "school", "major")


def q_split_school(spark, d):
    base, cat = tx.split_school(W(F.col("school")))
    return table(spark, d, "history_rows").select("hist_pos", base.alias("base"), cat.alias("cat"))


def q_strip_brackets(spark, d):
    n = W(F.col("major"))
    return table(spark, d, "plan_rows").select("src_row_idx", tx.strip_asides(n).alias("stripped"))


def q_core_name(spark, d):
    return table(spark, d, "plan_rows").select("src_row_idx", tx.core_name(W(F.col("major"))).alias("core"))


def q_diff_brackets(spark, d):
    b = tx.brackets(W(F.col("major")))
    return table(spark, d, "history_rows").select("hist_pos", F.posexplode(b).alias("place", "b")).select("hist_pos", "place", "b.kind", "b.value")


def q_subject_coverage(spark, d):
    """Offers with the first past row of their name, and whether its subjects
    cover theirs."""
    p, h = _sides(spark, d)
    first = h.groupBy("school", "stripped").agg(match.first_row("subject").alias("_h"))
    covers = tx.subject_covers(F.col("subject"), F.col("_h.subject"))
    return p.join(first, ["school", "stripped"]).select("src_row_idx", "subject", F.col("_h.subject").alias("past_subject"), covers.alias("covers"))


def q_nfkc(spark, d):
    return table(spark, d, "history_rows").select("hist_pos", tx.fold(F.col("major")).alias("major"), tx.fold(F.col("school")).alias("school"))


def q_strict_match(spark, d):
    return match.strict_match(*_sides(spark, d))


def q_strict_unmatched(spark, d):
    p, h = _sides(spark, d)
    return match.unmatched(p, match.strict_match(p, h)).select("src_row_idx", "school", "major")


def q_coarse_match(spark, d):
    p, h = _sides(spark, d)
    return match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h)


def q_candidates(spark, d):
    p, h = _sides(spark, d)
    return match.candidates(_rest(p, h), h).select("src_row_idx", "hist_pos", "major", "J", "T")


def q_batches(spark, d):
    p, h = _sides(spark, d)
    items = match.candidates(_rest(p, h), h).select("src_row_idx").distinct()
    return order.batches(items, ["src_row_idx"], 20)


def q_locate_echo(spark, d):
    """For the first name among each row's candidates, the row whose figures
    are those of the last candidate of that name."""
    p, h = _sides(spark, d)
    rest = settle(_rest(p, h), "rest")
    c = match.candidates(rest, h)
    picks = c.groupBy("src_row_idx").agg(F.min("major").alias("match"))
    last = c.withColumnRenamed("major", "match").join(picks, ["src_row_idx", "match"]).groupBy("src_row_idx", "match").agg(F.max(F.struct("hist_pos", "J", "T")).alias("b"))
    return match.locate_echo(last.select("src_row_idx", "match", "b.J", "b.T"), rest, h).select("src_row_idx", "match", "hist_pos")


def q_locate_fallback(spark, d):
    """Coarse matches traced back; names of those without a deviation are withheld."""
    p, h = _sides(spark, d)
    m = settle(match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h).withColumn("matched_major", F.when(F.col("T").isNotNull(), F.col("matched_major"))), "coarse")
    return match.locate_past(m, p, h).select("src_row_idx", "level", "hist_pos")


def q_new_majors(spark, d):
    p, h = _sides(spark, d)
    return schools.new_majors(_rest(p, h), h).select("src_row_idx", "school", "core")


def q_estimate_graded(spark, d):
    p, h = _sides(spark, d)
    return estimate(schools.new_majors(_rest(p, h), h), h)


def q_deleted(spark, d):
    p, h = _sides(spark, d)
    return schools.deleted_majors(p, h, _renamed(spark, d)).drop("log")


def _renamed(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rename_rows").where("is_rename")
    return r.select("old_school", "new_school", "confidence", "remark", "manual_reviewed", "is_rename", F.xxhash64("old_school", "new_school").alias("pos"))


def q_new_gone_schools(spark, d):
    p, h = _sides(spark, d)
    r = _renamed(spark, d)
    fresh = schools.new_schools(p, h, r).select(F.lit("new").alias("kind"), "school", F.col("major_count").alias("n"))
    return fresh.unionByName(schools.gone_schools(p, h, r).select(F.lit("gone").alias("kind"), "school", F.lit(None).cast("long").alias("n")))


def _renames_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Of several new names the greatest stands: a stated order for the map."""
    r = table(spark, d, "rename_rows").where("is_rename").groupBy("old_school").agg(F.max("new_school").alias("new_school"))
    return r.withColumn("pos", F.lit(1).cast("long"))


def q_rename_apply(spark, d):
    return schools.apply_renames(past_offers(spark, d), _renames_by_name(spark, d)).select("hist_pos", "school")


def q_rename_topk(spark, d):
    return schools.rename_candidates(*_sides(spark, d), topk=5, measure="pairs")


def q_rename_ratio(spark, d):
    return schools.rename_candidates(*_sides(spark, d), topk=5)


def q_rename_overlap(spark, d):
    return schools.rename_overlap(table(spark, d, "rename_rows").where("new_school IS NOT NULL AND old_school IS NOT NULL"), *_sides(spark, d))


KINDS = ("prose", "list", "table", "junk")


def q_contract_check(spark, d):
    """Label rows as result lines: the document must exist and have a text, the
    kind must be known, one line per document and annotator."""
    labels = table(spark, d, "doc_labels")
    docs = table(spark, d, "documents").select("doc_id", (F.length("text") > 0).alias("has_text"))
    rows = labels.join(docs, "doc_id", "left").withColumn("dup", contracts.seen_before(F.col("doc_id"), F.col("has_text").isNotNull(), "annotator", "doc_kind"))
    error = contracts.first_error([
        (F.col("has_text").isNull(), "unknown document"), (F.col("dup"), "repeated"), (~F.coalesce(F.col("doc_kind").isin("prose", "list"), F.lit(False)), "kind not allowed"),
    ])
    return rows.select("doc_id", "annotator", "doc_kind", error.alias("error"))


def q_contract_judged(spark, d):
    """Judged lines made of the candidates, with every kind of mistake."""
    p, h = _sides(spark, d)
    rest = settle(_rest(p, h), "rest")
    allowed = settle(match.candidates(rest, h), "allowed")
    pick = allowed.groupBy("src_row_idx").agg(F.min(F.struct("hist_pos", "major", "J", "T")).alias("b"))
    rows = rest.drop("stripped", "core").join(pick, "src_row_idx")
    s, no = F.col("subject"), F.col("batch") == grids.EARLY
    line = F.to_json(F.struct(
        F.when(F.col("school_cat") == "走读", F.col("src_row_idx") + UNKNOWN).otherwise(F.col("src_row_idx")).alias("src_row_idx"), "school", "major",
        F.when(s == "历史", "x").when(~no, F.col("b.major")).alias("match"), F.when(s == "物理", F.col("b.J") + 1).when(~no, F.col("b.J")).alias("J"),
        F.when(s == "生物", F.col("b.T") + 1).when(~no, F.col("b.T")).alias("T"), F.when(s == "化学", " ").otherwise("同").alias("reason"),
    ), {"ignoreNullFields": "false"})
    again = F.explode(F.when(s == "地理", F.array(F.lit(0), F.lit(UNKNOWN))).otherwise(F.array(F.lit(0))))
    written = rows.select(F.lit("lines.jsonl").alias("file"), line.alias("value"), "src_row_idx", "subject")
    lines = written.select("file", "value", "src_row_idx", again.alias("add")).select("file", (F.col("src_row_idx") + F.col("add")).alias("lineno"), "value")
    return contracts.check_judged(lines, rest.select("src_row_idx"), allowed).drop("file")


#: Added to a number, it is none of the table's.
UNKNOWN = 100_000_000


def q_contract_renames(spark, d):
    """rename_rows as lines, against this year's new schools."""
    columns = ["new_school", "old_school", "confidence", "is_rename", "remark"]
    place = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in columns]))  # a small table
    value = F.to_json(F.struct(*columns[:-1], F.col("remark").alias("note")), {"ignoreNullFields": "false"})
    lines = table(spark, d, "rename_rows").select(F.lit("renames.jsonl").alias("file"), place.alias("lineno"), value.alias("value"))
    return contracts.check_renames(lines, schools.new_schools(*_sides(spark, d))).drop("file")


def _items(spark: SparkSession, d: str) -> DataFrame:
    p, h = _sides(spark, d)
    return match.candidate_items(_rest(p, h), h)


def q_resolve_decisions(spark, d):
    """Picks by position: the first candidate, none, or one that isn't there."""
    items = settle(_items(spark, d), "items")
    cand = F.when(F.col("subject") == "物理", 1_000_000).when(F.col("subject") != "历史", 0)
    picks = items.where("subject <> '化学'").select("src_row_idx", cand.alias("cand"), F.concat(F.lit(" "), "subject", F.lit(" ")).alias("reason"), F.lit(None).cast("string").alias("error"))
    return contracts.resolve_decisions(items, picks)


def q_resolve_verdicts(spark, d):
    items = settle(_items(spark, d), "items")
    verdict = F.when(F.col("subject") == "物理", "错").when(F.col("subject") == "历史", "存疑").otherwise("确定")
    return contracts.resolve_verdicts(items, items.where("subject <> '化学'").select("src_row_idx", verdict.alias("verdict"), F.col("subject").alias("reason")))


def q_edge_tables(spark, d):
    """The boundary tables under their headers, as one."""
    out = pipeline.link(*_sides(spark, d))
    sheets = results.edge_tables(out["new_majors"], out["deleted"], out["renamed"], out["new_schools"], out["gone_schools"], out["special"])
    rows = None
    for name, df in sheets.items():
        get = lambda *hs: F.coalesce(*[F.col(h) for h in hs if h in df.columns], F.lit(None).cast("string"))  # noqa: B023, E731
        one = df.select(F.lit(name).alias("tbl"), get("学校", "新校名", "历史旧校名").alias("school"), get("专业").alias("major"), get("说明", "原因说明", "说明（含官方来源）").alias("note"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _place(spark: SparkSession, name: str) -> str:
    """A local path in the run's shared folder, for sinks that the driver writes."""
    folder = run_folder(spark)
    if "://" in folder and not folder.startswith("file://"):
        raise RuntimeError("the shared folder isn't mounted on the driver")
    return f"{folder.removeprefix('file://')}/{name}-{uuid.uuid4().hex}"


def q_sink_json_lines(spark, d):
    """plan_rows written as JSON lines and read again."""
    columns = ["src_row_idx", "school", "school_cat", "major", "subject", "batch"]
    rows, path = table(spark, d, "plan_rows").select(*columns), f"{run_folder(spark)}/lines-{uuid.uuid4().hex}"
    files.write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


def q_sink_csv(spark, d):
    """supplier written as CSV and read again."""
    rows, path = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("double").alias("s_acctbal")), f"{run_folder(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def q_sink_xlsx(spark, d):
    """nation written as a workbook and read again, header and all."""
    path = _place(spark, "book") + ".xlsx"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    write_xlsx(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey"), path)
    return read_xlsx(spark, path, columns=3)


def q_prompts_back(spark, d):
    """Documents of 20 items written for a judge, and their items read again."""
    folder = _place(spark, "prompts")
    out = {"unresolved": settle(_rest(*_sides(spark, d)), "rest"), "past": past_offers(spark, d)}
    pipeline.prompts(out, folder)
    items = files.prompt_items(spark, "file://" + folder)
    return items.select("src_row_idx", "school", "major", F.size("candidates").alias("n"), F.col("candidates")[0]["major"].alias("first"))


def q_contract_lines(spark, d):
    """JSON lines made of edge_rows, some broken, through the strict checks."""
    e = table(spark, d, "edge_rows")
    good = F.to_json(F.struct(F.col("edge_id").alias("src_row_idx"), F.when(F.col("est_level") == 0, "确定").otherwise("存疑").alias("verdict"), F.coalesce("log", F.lit("")).alias("reason")))
    value = F.when(F.col("est_n") < 0, F.concat(good, F.lit(" junk"))).when(F.col("est_level").isNull(), F.lit("{}")).otherwise(good)
    lines = e.select(F.lit("lines.jsonl").alias("file"), F.col("edge_id").alias("lineno"), value.alias("value"))
    return contracts.check_verdicts(lines, e.select(F.col("edge_id").cast("int").alias("src_row_idx")))


def q_duplicate_keys(spark, d):
    """Offers that repeat an earlier one's school, category and name."""
    p = plan_offers(spark, d)
    key = ["school", "school_cat", "stripped"]
    first = p.groupBy(*key).agg(F.min("src_row_idx").alias("_first"))
    return salted_join(p, first, key, "inner", "src_row_idx").where("src_row_idx > _first").select("src_row_idx", "school", "stripped")


def q_verdict_demote(spark, d):
    """Documents as results; a label table or junk is a doubt."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").withColumnRenamed("doc_id", "src_row_idx")
    v = table(spark, d, "doc_labels").groupBy(F.col("doc_id").alias("src_row_idx")).agg(F.max("doc_kind").alias("k"))
    kept, _ = results.demote(docs, v.select("src_row_idx", F.when(F.col("k").isin("junk", "table"), "存疑").otherwise("确定").alias("verdict"), F.lit("x").alias("reason")))
    return kept


def q_special_reasons(spark, d):
    p, h = _sides(spark, d)
    rest = settle(_rest(p, h), "rest")
    remaining = rest.join(schools.new_majors(rest, h).select("src_row_idx"), "src_row_idx", "left_anti").select(*rest.columns)
    return results.special_rows(remaining, h, estimate(remaining, h)).drop("is_flight")


def q_verify_requirement(spark, d):
    p, h = _sides(spark, d)
    m = match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h)
    items = results.second_look_items(m, p, h, all_judgemental=True)
    return items.select("src_row_idx", F.col("past_same_core").cast("long").alias("past_same_core"), "requirement", F.col("matched_candidate.major").alias("candidate"))


def q_main_results(spark, d):
    return pipeline.link(*_sides(spark, d))["main"]


def q_structured_log(spark, d):
    """Notes of coarse matches and of edge_rows taken apart."""
    p, h = _sides(spark, d)
    a = match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h).select(F.col("src_row_idx").cast("long").alias("id"), "log")
    b = table(spark, d, "edge_rows").select((-F.col("edge_id")).alias("id"), F.concat(F.lit("新增专业："), "log", F.lit("；（仅一年数据，无标准差）")).alias("log"))
    return a.unionByName(b).select("id", notes.split_log(F.col("log")).alias("s")).select("id", *[F.col(f"s.{x}").alias(y) for x, y in zip(notes.RESULT_HEADERS, LOG_COLUMNS)])


LOG_COLUMNS = ("stage", "single_year", "drift", "second_look", "reason")


def q_official_url(spark, d):
    s = table(spark, d, "supplier")
    text = F.concat(F.lit("见 http://www.example.org/a 和 https://jyt."), F.lower(F.replace("s_name", F.lit("#"), F.lit(""))), F.when(F.col("s_acctbal") > 0, ".gov.cn/x）等").otherwise(".edu.cn/y)"))
    return s.select("s_suppkey", notes.official_url(text).alias("url"), notes.has_official_link(text).alias("official"))


def q_notes_pairs(spark, d):
    """The cut-offs of a sheet of notes: the nations of one region tell one
    year, those of another two."""
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    one = F.concat("n_name", F.lit(" - 一段线；2023="), (k + 400).cast("string"))
    note = F.when(r == 1, one).when(r == 2, F.concat(one, F.lit(", 2024 = "), (k + 410).cast("string"))).otherwise(F.col("n_name"))
    found = grids.cutoffs_from_notes(_grid(table(spark, d, "nation"), "n_nationkey", {0: F.col("n_name"), 1: note}, 3))
    return spark.createDataFrame(list((found or {}).items()), "year int, value int")


def plan_grid(spark: SparkSession, d: str) -> DataFrame:
    """plan_rows as the grid they could have come from: early batches play the
    rows out of scope, rows without a subject those without a code."""
    t = table(spark, d, "plan_rows")
    cells = {0: F.col("batch"), 1: F.when(F.col("batch") == "提前批", "专科").otherwise(F.col("school_cat")), 3: F.col("school"), 4: F.when(F.col("subject") != "", F.col("src_row_idx").cast("string")), 5: F.col("major"), 6: F.col("subject")}
    return t.select(F.col("src_row_idx").alias("_row_idx"), *[cells.get(i, F.lit(None).cast("string")).alias(f"c{i}") for i in range(12)])


_GRID_NAMES = {"近三年统计线差": "j", "近三年线差标准差": "t"} | dict(zip(notes.RESULT_HEADERS, LOG_COLUMNS))


def _hierarchical(spark: SparkSession, d: str) -> DataFrame:
    p, h = _sides(spark, d)
    kept = pipeline.link(p, h)["main"].join(p.where("batch = '提前批'").select("src_row_idx"), "src_row_idx", "left_anti")
    return results.hierarchical(plan_grid(spark, d), kept).withColumnsRenamed(_GRID_NAMES).select("_row_idx", "c0", "c1", "c3", "c4", "c5", "j", "t", *LOG_COLUMNS)


def q_hierarchical(spark, d):
    return _hierarchical(spark, d)


def q_flat(spark, d):
    return results.flat(_hierarchical(spark, d))


def q_coverage(spark, d):
    return pipeline.link(*_sides(spark, d))["coverage"]


def q_audit(spark, d):
    """All checks over the main results, with faults put in: figures of two
    categories are moved, matches of a third count as judged, and only some of
    those have a verdict."""
    p, h = _sides(spark, d)
    out = pipeline.link(p, h)
    judged = F.col("matched") & (F.col("school_cat") == "民族班")
    named = settle(out["main"].join(out["matched_names"], "src_row_idx", "left").withColumns({
        "J": F.when(F.col("school_cat").isin("走读", "航海类"), F.col("J") + 0.5).otherwise(F.col("J")), "log": F.when(judged, notes.JUDGED + "：同").otherwise(F.col("log")),
    }), "named")
    verdicts = p.where("school_cat = '民族班' AND subject <> '化学'").select("src_row_idx", F.when(F.col("subject") == "不限", "存疑").otherwise("确定").alias("verdict"))
    table_ = results.hierarchical(plan_grid(spark, d), named)
    sheets = {"plan": plan_grid(spark, d), "past": h}
    return checks.audit([
        checks.judged_coverage(table_, verdicts), checks.stages_filled(results.flat(table_)), checks.no_blank_rows(sheets), checks.tables_filled(sheets),
        checks.figures_consistent(named, h, out["estimates"]), checks.renames_sourced(table(spark, d, "rename_rows")),
    ])


def q_text_helpers(spark, d):
    """Small text functions over offers and the first past row of their name."""
    p, h = _sides(spark, d)
    first = h.groupBy("school", "stripped").agg(match.first_row("major", "subject").alias("_h"))
    a, b = F.col("major"), F.col("_h.major")
    return p.join(first, ["school", "stripped"]).select(
        "src_row_idx", tx.brackets_within(b, a).alias("within"), tx.bracket_brief(a).alias("brief"), notes.rename_query(F.col("school"), b).alias("query"),
        notes.merge_remark(F.col("subject"), F.col("_h.subject"), F.col("batch") == grids.EARLY).alias("remark"), tx.cut_reason(F.concat(F.lit(" "), a, b, F.col("school"))).alias("reason"),
    )


def q_research_summary(spark, d):
    """The concluding line of every document, as of a research text."""
    return table(spark, d, "documents").select("doc_id", notes.research_summary(F.col("text"), F.coalesce("school", F.lit("?"))).alias("summary"))


def q_enrich_renames(spark, d):
    """Renames with this year's majors and remarks from research on old names."""
    research = table(spark, d, "rename_rows").select("old_school").distinct().select(F.col("old_school").alias("school"), F.concat(F.lit("# 查询\n- 前身为"), "old_school", F.lit("，后更名\n见 https://www.moe.gov.cn/a）")).alias("text"))
    return schools.enrich_renames(_renamed(spark, d).drop("pos"), plan_offers(spark, d), research)


def _files_of(rows: DataFrame, folder: str, line) -> None:
    """Files named by the column file, with lines in the order of place (small tables)."""
    open_file, name = None, None
    os.makedirs(folder, exist_ok=True)
    for r in rows.select("file", "place", line.alias("line")).orderBy("file", "place").toLocalIterator():
        if r["file"] != name:
            if open_file:
                open_file.close()
            name, open_file = r["file"], open(os.path.join(folder, r["file"]), "w", encoding="utf-8")
        open_file.write(r["line"] + "\n")
    if open_file:
        open_file.close()


def _label_lines(spark: SparkSession, d: str, ending: str) -> DataFrame:
    """doc_labels as one file for each annotator; every fifth kind is odd."""
    place = F.row_number().over(Window.partitionBy("annotator").orderBy("doc_id", "doc_kind"))
    return table(spark, d, "doc_labels").select(F.concat(F.lit("verify_"), "annotator", F.lit(ending)).alias("file"), place.alias("place"), "doc_id", "doc_kind")


def q_side_tsv(spark, d):
    """Labels as lines of picks in files, read again: the last line of an id stands."""
    folder, kind = _place(spark, "tsv"), F.col("doc_kind")
    cand = F.when(kind == "prose", "0").when(kind == "list", "-").when(kind == "table", "x").otherwise("3")
    _files_of(_label_lines(spark, d, ".tsv"), folder, F.concat_ws("\t", "doc_id", cand, F.concat(kind, F.lit("\tmore "))))
    return files.decisions(files.numbered_lines(spark, "file://" + folder, "verify_*.tsv"))


def q_side_verdicts(spark, d):
    """The same with verdicts."""
    folder, kind = _place(spark, "verdicts"), F.col("doc_kind")
    _files_of(_label_lines(spark, d, ".tsv"), folder, F.when(kind == "junk", F.col("doc_id").cast("string")).otherwise(F.concat_ws("\t", "doc_id", F.when(kind == "prose", "确定").otherwise("存疑"), F.lit(" why "))))
    return files.verdict_decisions(files.numbered_lines(spark, "file://" + folder, "verify_*.tsv"))


def q_verdict_map(spark, d):
    """Labels as JSON lines in files; the last verdict of an id stands."""
    folder = _place(spark, "json")
    _files_of(_label_lines(spark, d, "_result.jsonl"), folder, F.to_json(F.struct(F.col("doc_id").alias("src_row_idx"), F.col("doc_kind").alias("verdict"))))
    return files.verdict_map(files.numbered_lines(spark, "file://" + folder, "verify_*_result.jsonl"))


def q_streamed_verdicts(spark, d):
    """Verdict lines of a file, checked as a stream into a table."""
    folder = _place(spark, "stream")
    e = table(spark, d, "edge_rows")
    line = F.to_json(F.struct(F.col("edge_id").alias("src_row_idx"), F.when(F.col("est_level") == 0, "确定").when(F.col("est_level") == 1, "好").otherwise("存疑").alias("verdict"), F.coalesce("log", F.lit("")).alias("reason")))
    _files_of(e.withColumns({"file": F.lit("verify_1_result.jsonl"), "place": F.col("edge_id")}), folder, line)
    out = f"{run_folder(spark)}/streamed-{uuid.uuid4().hex}"
    verdict_sink(spark, "file://" + folder, e.select(F.col("edge_id").cast("int").alias("src_row_idx")), out, out + "-at").awaitTermination()
    return spark.read.schema("src_row_idx int, verdict string, reason string, error string").parquet(out)


def q_viewer_head(spark, d):
    """The first rows of the plan's sheet."""
    return files.view(plan_sheet(spark, d), head=20)


def q_second_look(spark, d):
    """Items for a second look at every coarse match, with the past row behind it."""
    p, h = _sides(spark, d)
    m = settle(match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h), "coarse")
    return results.second_look_items(m, p, h, all_judgemental=True).select("*", *[F.col(f"matched_candidate.{c}").alias(f"past_{c.lower()}") for c in ("major", "core", "J", "T")]).drop("matched_candidate", "requirement")


def q_second_look_prompts(spark, d):
    """Coarse matches as if judged, written as documents and read again."""
    p, h = _sides(spark, d)
    m = settle(match.coarse_match(match.unmatched(p, match.strict_match(p, h)), h).withColumn("log", F.lit(notes.JUDGED + "：同")), "judged")
    folder = _place(spark, "second")
    pipeline.second_look_prompts({"judged": m, "plan": settle(p, "plan"), "past": settle(h, "past")}, folder)
    docs = spark.read.schema("batch int, items array<struct<src_row_idx int, dagluben_major string, past_same_core long>>").option("multiLine", True).option("pathGlobFilter", "verify_batch_*.json").json("file://" + folder)
    return docs.select(F.explode("items").alias("i")).select("i.*")


def q_special_doubted(spark, d):
    """Rows without a home, those of the early batch as flight training, some
    of them doubted at the second look."""
    p, h = _sides(spark, d)
    rest = settle(_rest(p, h), "rest")
    remaining = rest.join(schools.new_majors(rest, h).select("src_row_idx"), "src_row_idx", "left_anti").select(*rest.columns)
    doubted = remaining.where("subject = '物理'").select("src_row_idx", F.concat(F.lit("疑："), "core").alias("reason"))
    return results.special_rows(remaining, h, estimate(remaining, h), doubted=doubted, flight_label=grids.EARLY)


def q_rename_files(spark, d):
    """Candidates for renames as written for a judge: all gone schools for each new one."""
    p, h = _sides(spark, d)
    folder = _place(spark, "renames")
    pipeline.rename_files({"plan": settle(p, "plan"), "past": settle(h, "past")}, folder)
    lines = spark.read.schema("new_school string, candidate_old_schools array<string>").json(f"file://{folder}/rename_candidates")
    return lines.select("new_school", F.size("candidate_old_schools").cast("long").alias("n"), F.array_join(F.array_sort("candidate_old_schools"), ",").alias("names"))


def q_published(spark, d):
    """Rows of every published table, read from where they were written."""
    out = pipeline.link(*_sides(spark, d))
    folder = _place(spark, "published")
    pipeline.publish(out, "file://" + folder)
    rows = None
    for name in pipeline.tables(out):
        one = spark.read.parquet(f"file://{folder}/{name}.parquet").agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("n"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def q_supplement_coverage(spark, d):
    """Past rows of the early batch whose school and name the regular feed doesn't have."""
    h = past_offers(spark, d)
    early = F.col("source_table") == grids.EARLY
    return checks.uncovered(h.where(early), h.where(~early), ["school", "major"]).select("hist_pos", "school", "major")


def q_residual_brackets(spark, d):
    return checks.residual_brackets(past_offers(spark, d)).select("hist_pos", "core")


def q_unmatched_families(spark, d):
    p, h = _sides(spark, d)
    return checks.unmatched_families(_rest(p, h), h)


def q_audit_passed(spark, d):
    return checks.all_passed(q_audit(spark, d))


def q_sample(spark, d):
    return order.stable_sample(plan_offers(spark, d), "src_row_idx").select("src_row_idx", "school", "major")


def q_viewer_grep(spark, d):
    t = table(spark, d, "rename_rows").select(F.xxhash64("new_school").alias("_row_idx"), "new_school", "old_school", "remark")
    return files.view(t, grep="学院").select("line")


def q_source_hash(spark, d):
    return files.digests(spark, [f"{d}/*.parquet"])


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

# ---------------------------------------------------------------------------
# The same in DuckDB's SQL, built on common table expressions
# ---------------------------------------------------------------------------

_BLANKS = "[ \\t\\n\\r\\x{3000}\\x{00a0}\\x{2002}\\x{2007}\\x{2009}\\x{202f}]"


def _w(x: str) -> str:
    return f"regexp_replace(translate(coalesce({x}, ''), '（）：，；', '():,;'), '{_BLANKS}', '', 'g')"


def _any(words) -> str:
    return "|".join(words)


def _strip(x: str) -> str:
    inner = "substring(p, 2, length(p) - 2)"
    facing = f"regexp_extract({inner}, '{tx.FACING}')"
    kept = f"'(' || CASE WHEN contains({inner}, '男') THEN '男' ELSE '女' END || CASE WHEN {facing} <> '' THEN ',' || {facing} ELSE '' END || ')'"
    one = f"CASE WHEN regexp_matches(p, '^\\([^()]*\\)$') AND regexp_matches({inner}, '{_any(tx.ASIDE_WORDS)}') THEN CASE WHEN regexp_matches({inner}, '{tx.GENDER}') THEN {kept} ELSE '' END ELSE p END"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '\\([^()]*\\)|[^()]+|[()]'), lambda p: {one}), '')"


def _core(x: str) -> str:
    for _ in range(5):
        x = f"regexp_replace({x}, '\\([^()]*\\)', '', 'g')"
    return x


_END = "\\(([^()]*)\\)$"
_SPLIT = f"""
  SELECT *, regexp_matches(n, '{_END}') AS there, regexp_extract(n, '{_END}', 1) AS c FROM (SELECT *, {_w("school")} AS n FROM history_rows)"""
_BASE = f"CASE WHEN there AND (c = '' OR regexp_matches(c, '{_any(tx.CATEGORY_WORDS)}')) THEN regexp_replace(n, '{_END}', '') ELSE n END"
_CAT = f"CASE WHEN there AND regexp_matches(c, '{_any(tx.CATEGORY_WORDS)}') THEN c ELSE '' END"


def _atoms(x: str) -> str:
    return f"list_filter(string_split(trim({x}), '和'), lambda a: a <> '')"


def _covers(new: str, past: str) -> str:
    return f"CASE WHEN len({_atoms(new)}) = 0 THEN true WHEN trim({past}) = '' THEN false ELSE len(list_filter(string_split({past}, ' | '), lambda v: list_has_all({_atoms('v')}, {_atoms(new)}))) > 0 END"


def _r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    markers = "CASE " + " ".join(f"WHEN contains(major, '{m}') THEN '{m}'" for m in tx.CATEGORY_MARKERS) + " ELSE '' END"
    fold = lambda x: f"CASE WHEN {x} = '{tx.DEFAULT_CATEGORY}' THEN '' ELSE {x} END"
    compatible = "u.core <> '' AND h.core <> '' AND (u.core = h.core OR u.core || '类' = h.core OR h.core || '类' = u.core)"
    named = lambda x: f"CASE WHEN coalesce({x}, '') = '' THEN '普通' ELSE {x} END"
    cross = (
        f"'（【跨招生类别·一对多兜底】往年' || school || '该专业只招过 1 条记录、招生类别是「' || {named('hcat')} || '」（线差 J=' || coalesce(CAST(J AS VARCHAR), 'None') || '）；今年这条是「' || {named('school_cat')}"
        " || '」。招生类别不同=不同专业、不同分数线，但往年只此 1 条，按一对多兜底配它、J 仅作参考，不等于今年该类别的真实门槛。）'"
        f" || CASE WHEN contains(school_cat, '综合评价') OR contains(major, '综合评价') THEN {q(notes.COMPOSITE_NOTE)} ELSE '' END"
    )
    single = f"CASE WHEN T IS NULL THEN '；{notes.SINGLE_YEAR}' ELSE '' END"
    drift = f"CASE WHEN trim(subject) <> '' AND trim(hsub) <> '' AND trim(subject) <> trim(hsub) THEN '；{notes.SUBJECT_NOTE}' ELSE '' END"
    pick = lambda c: f"CASE step WHEN 1 THEN h1.{c} WHEN 2 THEN h2.{c} ELSE h3.{c} END"
    row = "struct_pack(hist_pos := h.hist_pos, major := h.major, cat := h.school_cat, sub := h.subject, J := h.J, T := h.T)"
    num = lambda c: f"CAST({c} AS DECIMAL(18,4))"

    def estimates(name: str, rows: str) -> str:
        return f"""
{name}0 AS (SELECT src_row_idx, e.school, h.school IS NOT NULL AS there, h.J, h.T, {_covers('e.subject', 'h.subject')} AS fits FROM {rows} e LEFT JOIN H h ON h.school = e.school AND h.school <> ''),
{name}1 AS (SELECT src_row_idx, count(J) FILTER (there AND fits) AS n0, count(J) FILTER (there) AS n1,
  CAST(sum({num('J')}) FILTER (fits) AS DOUBLE) / nullif(count(J) FILTER (fits), 0) AS j0, CAST(sum({num('J')}) AS DOUBLE) / nullif(count(J), 0) AS j1,
  CAST(sum({num('T')}) FILTER (fits) AS DOUBLE) / nullif(count(T) FILTER (fits), 0) AS t0, CAST(sum({num('T')}) AS DOUBLE) / nullif(count(T), 0) AS t1 FROM {name}0 GROUP BY 1),
{name}2 AS (SELECT src_row_idx, CASE WHEN n0 > 0 THEN 0 WHEN n1 > 0 THEN 1 ELSE 2 END AS level, {_r2("CASE WHEN n0 > 0 THEN j0 WHEN n1 > 0 THEN j1 END")} AS value,
  {_r2("CASE WHEN n0 > 0 THEN t0 WHEN n1 > 0 THEN t1 END")} AS T, CAST(CASE WHEN n0 > 0 THEN n0 WHEN n1 > 0 THEN n1 ELSE 0 END AS INTEGER) AS n FROM {name}1),
{name} AS (SELECT *, CASE level WHEN 0 THEN '新增专业：估算=同校同选科(' || n || ')均值=' || v WHEN 1 THEN '新增专业：退化=同校全专业均值(无同选科)(' || n || ')=' || v ELSE '{notes.NO_HISTORY}' END AS log
  FROM (SELECT *, regexp_replace(printf('%.4f', value), '\\.?0+$', '') AS v FROM {name}2))"""

    return f"""WITH
P0 AS (SELECT src_row_idx, {_w('school')} AS school, {_w('school_cat')} AS school_cat, {_w('major')} AS major, {_w('subject')} AS subject, coalesce(batch, '') AS batch FROM plan_rows),
P AS (SELECT src_row_idx, school, school_cat, major, {_strip('major')} AS stripped, {_core('major')} AS core, subject, batch, {fold('school_cat')} AS fc FROM P0),
H0 AS (SELECT hist_pos, {_BASE} AS school, {_CAT} AS c0, {_w('school_cat')} AS own, {_w('major')} AS major, {_w('subject')} AS subject,
  CASE WHEN isnan(j) THEN NULL ELSE j END AS J, CASE WHEN isnan(t) THEN NULL ELSE t END AS T, coalesce(source_table, '') AS source_table FROM ({_SPLIT})),
H1 AS (SELECT *, CASE WHEN c0 <> '' THEN c0 WHEN own <> '' THEN own ELSE {markers} END AS school_cat FROM H0),
H AS (SELECT hist_pos, school, school_cat, major, {_strip('major')} AS stripped, {_core('major')} AS core, subject, J, T, source_table, {fold('school_cat')} AS fc FROM H1),
F1 AS (SELECT * FROM H QUALIFY row_number() OVER (PARTITION BY school, fc, stripped ORDER BY hist_pos) = 1),
S AS (SELECT P.src_row_idx, P.school, P.school_cat, P.major, f.hist_pos IS NOT NULL AS matched, f.major AS matched_major, f.J, f.T,
  CASE WHEN f.hist_pos IS NULL THEN '{notes.MISS}' ELSE '{notes.STRICT}' || CASE WHEN f.T IS NULL THEN '；{notes.SINGLE_YEAR}' ELSE '' END END AS log
  FROM P LEFT JOIN F1 f ON f.school = P.school AND f.fc = P.fc AND f.stripped = P.stripped),
U AS (SELECT P.* FROM P WHERE src_row_idx NOT IN (SELECT src_row_idx FROM S WHERE matched)),
C0 AS (SELECT u.src_row_idx, count(*) FILTER (u.fc = h.fc AND u.core = h.core) AS n1, arg_min({row}, h.hist_pos) FILTER (u.fc = h.fc AND u.core = h.core) AS h1,
  count(*) FILTER (u.fc = h.fc AND {compatible}) AS n2, arg_min({row}, h.hist_pos) FILTER (u.fc = h.fc AND {compatible}) AS h2,
  count(*) FILTER ({compatible}) AS n3, arg_min({row}, h.hist_pos) FILTER ({compatible}) AS h3
  FROM U u JOIN H h ON h.school = u.school GROUP BY 1),
C1 AS (SELECT *, CASE WHEN n1 = 1 THEN 1 WHEN n2 = 1 THEN 2 WHEN n3 = 1 THEN 3 END AS step FROM C0),
C2 AS (SELECT U.*, step, {pick('major')} AS matched_major, {pick('cat')} AS hcat, {pick('sub')} AS hsub, {pick('J')} AS J, {pick('T')} AS T FROM C1 JOIN U USING (src_row_idx) WHERE step IS NOT NULL),
C AS (SELECT src_row_idx, school, school_cat, major, true AS matched, matched_major, J, T, step,
  {q(notes.COARSE)} || CASE step WHEN 1 THEN '' WHEN 2 THEN {q(notes.FAMILY_NOTE)} ELSE {cross} END || {drift} || {single} AS log FROM C2),
R AS (SELECT U.* FROM U WHERE src_row_idx NOT IN (SELECT src_row_idx FROM C)),
K AS (SELECT u.src_row_idx, h.hist_pos, h.major, h.core, h.J, h.T FROM R u JOIN H h ON h.school = u.school AND h.fc = u.fc WHERE {compatible}),
N AS (SELECT R.* FROM R WHERE NOT EXISTS (SELECT 1 FROM H WHERE H.school <> '' AND H.school = R.school AND H.core = R.core)),
{estimates('E', 'N')},
X AS (SELECT R.* FROM R WHERE src_row_idx NOT IN (SELECT src_row_idx FROM N)),
{estimates('Y', 'X')},
CC AS (SELECT school, core, count(*) AS n, array_to_string(list_slice(list(major ORDER BY hist_pos), 1, 3), '/') AS names FROM H GROUP BY 1, 2),
M AS (SELECT P.src_row_idx, P.school, P.school_cat, P.major, coalesce(s.matched, c.matched, false) AS matched,
  CASE WHEN s.matched THEN s.J WHEN c.matched THEN c.J ELSE e.value END AS J, CASE WHEN s.matched THEN s.T WHEN c.matched THEN c.T ELSE e.T END AS T,
  CASE WHEN s.matched THEN s.log WHEN c.matched THEN c.log ELSE coalesce(e.log, '{notes.SPECIAL}') END AS log
  FROM P LEFT JOIN (SELECT * FROM S WHERE matched) s USING (src_row_idx) LEFT JOIN C c USING (src_row_idx) LEFT JOIN E e USING (src_row_idx)),
RN AS (SELECT old_school, new_school FROM rename_rows WHERE is_rename),
NS AS (SELECT school, count(*) AS n FROM P WHERE school <> '' AND school NOT IN (SELECT school FROM H WHERE school <> '') GROUP BY 1),
GS AS (SELECT DISTINCT school FROM H WHERE school <> '' AND school NOT IN (SELECT school FROM P WHERE school <> ''))
"""


def _log_sql(source: str) -> str:
    stage, note = "''", "txt"
    for begin, label in reversed(notes.KEYWORD_STAGES):
        stage = f"CASE WHEN starts_with(txt, '{begin}') THEN '{label}' ELSE {stage} END"
    for label in reversed(notes.STAGES):
        rest = f"substring(txt, {len(label) + 2})"
        rest = f"regexp_replace({rest}, '(?s)^(.*?)（仅一年数据[^）]*(?:）|$)', '\\1')"
        rest = f"trim(regexp_replace({rest}, '(?s)^(.*?)选科要求跨年不同.*?不影响匹配', '\\1'), '；，、 ')"
        shown, kept = ("'专科（超范围）'", "''") if label == "专科" else (f"'{label}'", rest)
        stage, note = f"CASE WHEN starts_with(txt, '{label}：') THEN {shown} ELSE {stage} END", f"CASE WHEN starts_with(txt, '{label}：') THEN {kept} ELSE {note} END"
    flag = lambda m: f"CASE WHEN contains(txt, '{m}') THEN '是' ELSE '' END"
    return f"SELECT *, CASE WHEN stage = '{notes.JUDGED}' THEN '确定' ELSE '' END AS second_look FROM (SELECT *, {stage} AS stage, {flag('（仅一年数据')} AS single_year, {flag('选科要求跨年不同')} AS drift, {note} AS reason FROM (SELECT *, trim(coalesce(log, '')) AS txt FROM {source}))"


def oracle() -> dict[str, str]:
    base = _sql()
    lows = f"SELECT l_partkey, year(l_shipdate) AS y, min(l_extendedprice) AS low FROM lineitem WHERE year(l_shipdate) IN {YEARS} GROUP BY 1, 2"
    diff = f"SELECT l_partkey, low - CASE y {' '.join(f'WHEN {y} THEN {c}' for y, c in CUTS.items())} END AS v FROM ({lows})"
    line = f"SELECT l_partkey, {_r2('avg(v)')} AS j, CASE WHEN count(*) >= 2 THEN {_r2('stddev_pop(v)')} END AS t"
    grams = lambda s: f"SELECT DISTINCT school, substring(school, i, 2) AS g FROM (SELECT school, unnest(generate_series(1, greatest(length(school) - 1, 1))) AS i FROM {s})"
    major = "coalesce(c4, '') <> '' AND coalesce(c5, '') <> ''"
    scope = f"NOT regexp_matches(coalesce(c1, ''), '{_any(tx.OUT_OF_SCOPE_WORDS)}')"
    grid = "SELECT src_row_idx AS _row_idx, batch AS c0, CASE WHEN batch = '提前批' THEN '专科' ELSE school_cat END AS c1, school AS c3, CASE WHEN subject <> '' THEN CAST(src_row_idx AS VARCHAR) END AS c4, major AS c5 FROM plan_rows"
    logs = _log_sql("(SELECT * FROM M WHERE src_row_idx IN (SELECT src_row_idx FROM P WHERE batch <> '提前批'))")
    on = f"({major}) AND l.src_row_idx IS NOT NULL"
    cells = ", ".join(f"CASE WHEN {on} THEN l.{c} END AS {c}" for c in ("single_year", "drift", "second_look", "reason"))
    beyond = f"({major}) AND l.src_row_idx IS NULL AND NOT ({scope})"
    hier = f"""SELECT g.*, CASE WHEN {on} THEN l.J END AS j, CASE WHEN {on} THEN l.T END AS t, CASE WHEN {on} THEN l.stage WHEN {beyond} THEN '专科（超范围）' END AS stage, {cells}
      FROM ({grid}) g LEFT JOIN ({logs}) l ON l.src_row_idx = g._row_idx"""
    brackets = "SELECT hist_pos, CAST(unnest(generate_series(0, len(b) - 1)) AS INTEGER) AS place, unnest(b) AS c FROM (SELECT hist_pos, regexp_extract_all(major, '\\(([^()]*)\\)', 1) AS b FROM H) WHERE len(b) > 0"
    gender = f"regexp_matches(c, '{tx.GENDER}') AND regexp_matches(c, '[男女]')"
    official = "'见 http://www.example.org/a 和 https://jyt.' || lower(replace(s_name, '#', '')) || CASE WHEN s_acctbal > 0 THEN '.gov.cn/x）等' ELSE '.edu.cn/y)' END"
    deleted = "FROM H WHERE school IN (SELECT school FROM P WHERE school <> '') AND school NOT IN (SELECT new_school FROM RN) AND NOT EXISTS (SELECT 1 FROM P WHERE P.school = H.school AND P.major = H.major)"
    special = """SELECT X.src_row_idx, X.school, X.school_cat, X.major, X.core, X.subject, X.batch, CASE WHEN CC.n > 0 THEN '没找到能匹配的往年专业：同校同核心名有 ' || CC.n || ' 个（' || names || CASE WHEN CC.n > 3 THEN '…' ELSE '' END || '），今年的方向和这些都对不上'
      ELSE '没找到能匹配的往年专业：' || CASE WHEN X.core <> '' THEN X.core ELSE X.major END END AS log, Y.value AS est_value, Y.T AS est_t, Y.level AS est_level, Y.n AS est_n
      FROM X LEFT JOIN CC ON CC.school = X.school AND CC.core = X.core LEFT JOIN Y ON Y.src_row_idx = X.src_row_idx"""
    markers = "CASE " + " ".join(f"WHEN contains(H1.major, '{m}') THEN '{m}'" for m in tx.CATEGORY_MARKERS) + " ELSE '' END"
    labels = "SELECT doc_id, doc_kind FROM (SELECT *, row_number() OVER (PARTITION BY annotator ORDER BY doc_id, doc_kind) AS place FROM doc_labels) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY annotator DESC, place DESC) = 1"
    close = lambda a, b: f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN true WHEN {a} IS NULL OR {b} IS NULL THEN false ELSE abs({a} - {b}) <= 0.011 END"
    out = {
        "q_plan_projection": base + f"""SELECT src_row_idx, P.school, P.school_cat, P.major, P.stripped, P.core, P.subject, r.batch, CASE WHEN r.batch = '{grids.EARLY}' THEN '{grids.PLAN_EARLY[0]}' ELSE r.batch END AS raw_batch,
          CASE WHEN r.batch = '{grids.EARLY}' THEN 1 ELSE 0 END AS feed FROM P JOIN plan_rows r USING (src_row_idx)
          WHERE r.batch IN ('{grids.PLAN_REGULAR}', '{grids.EARLY}') AND coalesce(r.major, '') <> '' AND NOT regexp_matches(coalesce(r.school_cat, ''), '{_any(tx.OUT_OF_SCOPE_WORDS)}')""",
        "q_history_projection": base + f""", Z AS (SELECT H1.*, {markers} AS marked, coalesce(source_table, '') = '{grids.EARLY}' AS early FROM H1),
          Z2 AS (SELECT Z.*, CAST(J IS NOT NULL AS INTEGER) + CAST(T IS NOT NULL AS INTEGER) AS years, (coalesce(T, 0.0) + coalesce(J, 0.0)) / nullif(CAST(J IS NOT NULL AS INTEGER) + CAST(T IS NOT NULL AS INTEGER), 0) AS mean FROM Z)
          SELECT hist_pos + CASE WHEN early THEN {grids.FEED} ELSE 0 END AS hist_pos, Z2.school, CASE WHEN early THEN own WHEN c0 <> '' THEN c0 ELSE marked END AS school_cat, Z2.major, {_strip('Z2.major')} AS stripped, {_core('Z2.major')} AS core, Z2.subject,
          CASE WHEN early THEN {_r2('mean')} ELSE J END AS J, CASE WHEN NOT early THEN T WHEN years = 2 THEN {_r2('sqrt(((T - mean) * (T - mean) + (J - mean) * (J - mean)) / 2)')} END AS T, CASE WHEN early THEN '{grids.EARLY}' ELSE '{grids.PAST_KEPT[0]}' END AS source_table
          FROM Z2 JOIN (SELECT hist_pos, major AS raw FROM history_rows) r USING (hist_pos) WHERE early OR NOT regexp_matches(coalesce(raw, ''), '{_any(tx.OUT_OF_SCOPE_WORDS)}')""",
        "q_contract_judged": base + f""", B AS (SELECT src_row_idx, arg_min(struct_pack(major := major, J := J, T := T), hist_pos) AS b FROM K GROUP BY 1),
          L0 AS (SELECT R.src_row_idx AS lineno, CASE WHEN school_cat = '走读' THEN R.src_row_idx + {UNKNOWN} ELSE R.src_row_idx END AS src_row_idx, CASE WHEN subject = '历史' THEN 'x' WHEN batch <> '{grids.EARLY}' THEN b.major END AS match,
            CASE WHEN subject = '物理' THEN b.J + 1 WHEN batch <> '{grids.EARLY}' THEN b.J END AS lj, CASE WHEN subject = '生物' THEN b.T + 1 WHEN batch <> '{grids.EARLY}' THEN b.T END AS lt, CASE WHEN subject = '化学' THEN '' ELSE '同' END AS reason, subject FROM R JOIN B USING (src_row_idx)),
          L1 AS (SELECT * FROM L0 UNION ALL SELECT lineno + {UNKNOWN}, src_row_idx, match, lj, lt, reason, subject FROM L0 WHERE subject = '地理'),
          L2 AS (SELECT L1.*, s.src_row_idx IS NOT NULL AS sent, row_number() OVER (PARTITION BY L1.src_row_idx ORDER BY lineno) > 1 AS again FROM L1 LEFT JOIN (SELECT src_row_idx FROM R) s ON s.src_row_idx = L1.src_row_idx),
          L3 AS (SELECT L2.*, K.hist_pos, K.J, K.T FROM L2 LEFT JOIN K ON K.src_row_idx = L2.src_row_idx AND K.major = L2.match
            QUALIFY row_number() OVER (PARTITION BY lineno ORDER BY CASE WHEN round(K.J, 2) IS NOT DISTINCT FROM round(lj, 2) AND round(K.T, 2) IS NOT DISTINCT FROM round(lt, 2) THEN 0 ELSE 1 END, K.hist_pos) = 1)
          SELECT lineno, src_row_idx, match, J, T, hist_pos, reason, CASE WHEN NOT sent THEN 'src_row_idx 不在派发的行中' WHEN again THEN 'src_row_idx 重复出现' WHEN reason = '' THEN 'reason 为空或非字符串'
            WHEN match IS NOT NULL AND hist_pos IS NULL THEN 'match 不在候选集内' WHEN match IS NOT NULL AND round(J, 2) IS DISTINCT FROM round(lj, 2) THEN 'J 与候选不一致' WHEN match IS NOT NULL AND round(T, 2) IS DISTINCT FROM round(lt, 2) THEN 'T 与候选不一致' END AS error FROM L3""",
        "q_contract_lines": """SELECT 'lines.jsonl' AS file, lineno, CASE WHEN kind = 0 THEN CAST(lineno AS INTEGER) END AS src_row_idx, CASE WHEN kind = 0 THEN verdict END AS verdict, CASE WHEN kind = 0 THEN substring(trim(reason), 1, 30) END AS reason,
          CASE kind WHEN 1 THEN 'JSON 解析失败' WHEN 2 THEN '缺少必需字段 src_row_idx,verdict,reason' ELSE CASE WHEN trim(reason) = '' THEN 'reason 为空或非字符串' END END AS error
          FROM (SELECT edge_id AS lineno, CASE WHEN est_level = 0 THEN '确定' ELSE '存疑' END AS verdict, coalesce(log, '') AS reason, CASE WHEN est_n < 0 THEN 1 WHEN est_level IS NULL THEN 2 ELSE 0 END AS kind FROM edge_rows)""",
        "q_contract_renames": base + """, L AS (SELECT *, CAST(row_number() OVER (ORDER BY new_school NULLS FIRST, old_school NULLS FIRST, confidence NULLS FIRST, is_rename NULLS FIRST, remark NULLS FIRST) AS INTEGER) AS lineno, new_school IN (SELECT school FROM NS) AS fresh FROM rename_rows),
          L2 AS (SELECT *, is_rename AND fresh AND row_number() OVER (PARTITION BY new_school, old_school, is_rename AND fresh ORDER BY lineno) > 1 AS again FROM L)
          SELECT lineno, trim(new_school) AS new_school, trim(old_school) AS old_school, confidence, is_rename, coalesce(trim(remark), '') AS remark, CASE WHEN is_rename IS NULL THEN 'is_rename 不是布尔' WHEN confidence IS NULL THEN 'confidence 不是数值' WHEN NOT confidence BETWEEN 0 AND 1 THEN 'confidence 不在 [0,1]'
            WHEN coalesce(trim(new_school), '') = '' THEN 'new_school 为空或非字符串' WHEN is_rename AND NOT coalesce(fresh, false) THEN 'new_school 不是今年独有校' WHEN is_rename AND coalesce(trim(old_school), '') = '' THEN 'is_rename=True 但 old_school 为空' WHEN again THEN '(new_school, old_school) 重复出现' END AS error FROM L2""",
        "q_resolve_decisions": base + """, B AS (SELECT src_row_idx, arg_min(struct_pack(major := major, J := J, T := T), hist_pos) AS b FROM K GROUP BY 1)
          SELECT R.src_row_idx, school, R.major, CASE WHEN picked THEN b.major END AS match, CASE WHEN picked THEN b.J END AS J, CASE WHEN picked THEN b.T END AS T, CASE WHEN subject = '化学' THEN '' ELSE trim(subject) END AS reason,
            CASE WHEN subject = '化学' THEN '缺 decision' WHEN subject = '物理' THEN 'cand 越界' END AS error FROM (SELECT *, subject NOT IN ('化学', '物理', '历史') AS picked FROM R) R JOIN B USING (src_row_idx)""",
        "q_resolve_verdicts": base + """SELECT src_row_idx, CASE WHEN subject = '化学' THEN NULL WHEN subject = '物理' THEN '错' WHEN subject = '历史' THEN '存疑' ELSE '确定' END AS verdict, CASE WHEN subject = '化学' THEN '' ELSE trim(subject) END AS reason,
            CASE WHEN subject = '化学' THEN '缺 decision' WHEN subject = '物理' THEN 'verdict 不在允许集' END AS error FROM R WHERE src_row_idx IN (SELECT src_row_idx FROM K)""",
        "q_edge_tables": base + f"""SELECT '今年新增往年没有的专业' AS tbl, school, major, log AS note FROM N JOIN E USING (src_row_idx)
          UNION ALL SELECT '往年有但今年停招的专业', school, major, '{notes.DELETED}' {deleted.replace("AND school NOT IN (SELECT new_school FROM RN) ", "")}
          UNION ALL SELECT '今年新招生的学校', school, NULL, '{notes.NEW_SCHOOL}' FROM NS UNION ALL SELECT '往年有今年停招的学校', school, NULL, '{notes.GONE_SCHOOL}' FROM GS
          UNION ALL SELECT '未能匹配的专业', school, major, log FROM ({special})""",
        "q_sink_json_lines": "SELECT src_row_idx, school, school_cat, major, subject, batch FROM plan_rows",
        "q_sink_csv": "SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier",
        "q_sink_xlsx": "SELECT 1 AS _row_idx, 'n_nationkey' AS c0, 'n_name' AS c1, 'n_regionkey' AS c2 UNION ALL SELECT CAST(row_number() OVER (ORDER BY n_nationkey) + 1 AS INTEGER), CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR) FROM nation",
        "q_prompts_back": base + "SELECT R.src_row_idx, R.school, R.major, n, first FROM R JOIN (SELECT src_row_idx, CAST(count(*) AS INTEGER) AS n, arg_min(major, hist_pos) AS first FROM K GROUP BY 1) USING (src_row_idx)",
        "q_line_diff": f"{line}, CAST(count(*) AS INTEGER) AS n FROM ({diff}) GROUP BY 1",
        "q_line_diff_rowwise": f"{line} FROM ({diff}) GROUP BY 1",
        "q_union_history": base + "SELECT hist_pos, CASE WHEN source_table = '提前批' THEN 1 ELSE 0 END AS feed, school, major FROM H",
        "q_split_school": base + f"SELECT hist_pos, {_BASE} AS base, {_CAT} AS cat FROM ({_SPLIT})",
        "q_strip_brackets": base + "SELECT src_row_idx, stripped FROM P",
        "q_core_name": base + "SELECT src_row_idx, core FROM P",
        "q_diff_brackets": base + f"SELECT hist_pos, place, CASE WHEN {gender} THEN '性别' WHEN contains(c, '合作') THEN '合作' ELSE '其他' END AS kind, CASE WHEN {gender} THEN CASE WHEN contains(c, '男') THEN '男' ELSE '女' END ELSE c END AS value FROM ({brackets})",
        "q_subject_coverage": base + f"SELECT src_row_idx, p.subject, h.subject AS past_subject, {_covers('p.subject', 'h.subject')} AS covers FROM P p JOIN (SELECT * FROM H QUALIFY row_number() OVER (PARTITION BY school, stripped ORDER BY hist_pos) = 1) h USING (school, stripped)",
        "q_strict_match": base + "SELECT * FROM S",
        "q_strict_unmatched": base + "SELECT src_row_idx, school, major FROM U",
        "q_coarse_match": base + "SELECT * FROM C",
        "q_candidates": base + "SELECT src_row_idx, hist_pos, major, J, T FROM K",
        "q_batches": base + "SELECT src_row_idx, CAST(ceil(row_number() OVER (ORDER BY src_row_idx) / 20.0) AS BIGINT) AS batch_no FROM (SELECT DISTINCT src_row_idx FROM K)",
        "q_locate_echo": base + """, B AS (SELECT src_row_idx, min(major) AS major FROM K GROUP BY 1), Q AS (SELECT K.* FROM K JOIN B USING (src_row_idx, major)),
          L AS (SELECT src_row_idx, arg_max(struct_pack(J := J, T := T), hist_pos) AS l FROM Q GROUP BY 1)
          SELECT src_row_idx, major AS match, hist_pos FROM Q JOIN L USING (src_row_idx)
          QUALIFY row_number() OVER (PARTITION BY src_row_idx ORDER BY CASE WHEN l.J IS NOT NULL AND round(J, 2) IS NOT DISTINCT FROM round(l.J, 2) AND round(T, 2) IS NOT DISTINCT FROM round(l.T, 2) THEN 0 ELSE 1 END, hist_pos) = 1""",
        "q_locate_fallback": base + """, A AS (SELECT C.src_row_idx, C.school, P.core, CASE WHEN C.T IS NOT NULL THEN matched_major END AS mm, C.J, C.T FROM C JOIN P USING (src_row_idx)),
          L AS (SELECT A.src_row_idx, 1 AS level, 0.0 AS dist, h.hist_pos FROM A JOIN H h ON h.school = A.school AND h.major = A.mm WHERE coalesce(mm, '') <> ''
            UNION ALL SELECT A.src_row_idx, CASE WHEN h.J IS NOT DISTINCT FROM A.J AND h.T IS NOT DISTINCT FROM A.T THEN 2 WHEN n = 1 THEN 3 WHEN A.J IS NOT NULL AND abs(coalesce(h.J, 0) - A.J) <= 0.5 THEN 4 END,
              CASE WHEN NOT (h.J IS NOT DISTINCT FROM A.J AND h.T IS NOT DISTINCT FROM A.T) AND n > 1 THEN abs(coalesce(h.J, 0) - coalesce(A.J, 0)) ELSE 0.0 END, h.hist_pos FROM A JOIN H h ON h.school = A.school AND h.core = A.core JOIN CC ON CC.school = A.school AND CC.core = A.core)
          SELECT src_row_idx, level, hist_pos FROM L WHERE level IS NOT NULL QUALIFY row_number() OVER (PARTITION BY src_row_idx ORDER BY level, dist, hist_pos) = 1""",
        "q_new_majors": base + "SELECT src_row_idx, school, core FROM N",
        "q_estimate_graded": base + "SELECT src_row_idx, value, T, level, n, log FROM E",
        "q_deleted": base + f"SELECT hist_pos, school, school_cat, major, J, T {deleted}",
        "q_new_gone_schools": base + "SELECT 'new' AS kind, school, n FROM NS WHERE school NOT IN (SELECT new_school FROM RN) UNION ALL SELECT 'gone', school, NULL FROM GS WHERE school NOT IN (SELECT old_school FROM RN)",
        "q_rename_apply": base + "SELECT hist_pos, coalesce(new_school, school) AS school FROM H LEFT JOIN (SELECT old_school, max(new_school) AS new_school FROM RN GROUP BY 1) r ON r.old_school = H.school",
        "q_rename_topk": base + f""", A AS ({grams('NS')}), B AS ({grams('GS')}) SELECT *, CAST(row_number() OVER (PARTITION BY new_school ORDER BY similarity DESC, old_school) AS INTEGER) AS place
          FROM (SELECT a.school AS new_school, b.school AS old_school, round(2 * count(*) / ((SELECT count(*) FROM A x WHERE x.school = a.school) + (SELECT count(*) FROM B y WHERE y.school = b.school)), 6) AS similarity FROM A a JOIN B b USING (g) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY new_school ORDER BY similarity DESC, old_school) <= 5""",
        "q_rename_overlap": base + """, D AS (SELECT DISTINCT new_school, old_school FROM rename_rows WHERE new_school IS NOT NULL AND old_school IS NOT NULL),
          PC AS (SELECT DISTINCT school, core FROM P WHERE core <> ''), HC AS (SELECT DISTINCT school, core FROM H WHERE core <> '')
          SELECT new_school, old_school, shared, smaller, CASE WHEN smaller > 0 THEN round(shared / smaller, 6) END AS overlap FROM (
            SELECT new_school, old_school, (SELECT count(*) FROM PC JOIN HC USING (core) WHERE PC.school = new_school AND HC.school = old_school) AS shared,
            least((SELECT count(*) FROM PC WHERE school = new_school), (SELECT count(*) FROM HC WHERE school = old_school)) AS smaller FROM D)""",
        "q_contract_check": """SELECT doc_id, annotator, doc_kind, CASE WHEN has_text IS NULL THEN 'unknown document' WHEN rn > 1 THEN 'repeated' WHEN NOT coalesce(doc_kind IN ('prose', 'list'), false) THEN 'kind not allowed' END AS error
          FROM (SELECT l.*, length(text) > 0 AS has_text, row_number() OVER (PARTITION BY l.doc_id ORDER BY annotator, doc_kind) AS rn FROM doc_labels l LEFT JOIN documents d USING (doc_id))""",
        "q_duplicate_keys": base + "SELECT src_row_idx, school, stripped FROM P QUALIFY row_number() OVER (PARTITION BY school, school_cat, stripped ORDER BY src_row_idx) > 1",
        "q_verdict_demote": "SELECT doc_id AS src_row_idx, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM doc_labels GROUP BY 1 HAVING max(doc_kind) IN ('junk', 'table'))",
        "q_special_reasons": base + special,
        "q_verify_requirement": base + f"""SELECT C.src_row_idx, coalesce(n, 0) AS past_same_core, CASE WHEN coalesce(n, 0) <= 1 THEN '{notes.ASK_ONE}' ELSE '{notes.ASK_MANY}' END || '{notes.ASK_TAIL}' AS requirement, matched_major AS candidate
          FROM C JOIN P USING (src_row_idx) LEFT JOIN CC ON CC.school = P.school AND CC.core = P.core""",
        "q_main_results": base + "SELECT * FROM M",
        "q_structured_log": base + ", Z AS (SELECT CAST(src_row_idx AS BIGINT) AS id, log FROM C UNION ALL SELECT -edge_id, '新增专业：' || log || '；（仅一年数据，无标准差）' FROM edge_rows) SELECT id, stage, single_year, drift, second_look, reason FROM (" + _log_sql("Z") + ")",
        "q_official_url": f"SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN regexp_extract({official}, 'https://[^\\s)）]+') ELSE '' END AS url, regexp_matches({official}, 'moe\\.gov\\.cn|gov\\.cn|\\.edu\\.cn') AS official FROM supplier",
        "q_notes_pairs": "SELECT unnest([2023, 2024]) AS year, CAST(unnest([k + 400, k + 410]) AS INTEGER) AS value FROM (SELECT min(n_nationkey) AS k FROM nation WHERE n_regionkey = 2)",
        "q_hierarchical": base + hier,
        "q_flat": base + f"SELECT * FROM ({hier}) WHERE {major} AND {scope}",
        "q_coverage": base + f"""SELECT (SELECT count(*) FROM P) AS total, (SELECT count(*) FROM M WHERE matched) AS matched, (SELECT count(*) FROM N) AS new_major, (SELECT count(*) FROM X) AS special,
          (SELECT count(*) {deleted.replace("AND school NOT IN (SELECT new_school FROM RN) ", "")}) AS deleted, (SELECT count(*) FROM NS) AS new_school, (SELECT count(*) FROM GS) AS gone_school, CAST(0 AS BIGINT) AS rename""",
        "q_audit": base + f""", G AS ({grid}),
          MN AS (SELECT M.src_row_idx, M.school, M.school_cat, M.matched, M.T, CASE WHEN M.school_cat IN ('走读', '航海类') THEN M.J + 0.5 ELSE M.J END AS J, coalesce(s.matched_major, c.matched_major) AS mm,
            CASE WHEN M.matched AND M.school_cat = '民族班' THEN '{notes.JUDGED}：同' ELSE M.log END AS log FROM M LEFT JOIN (SELECT * FROM S WHERE matched) s USING (src_row_idx) LEFT JOIN C c USING (src_row_idx)),
          L AS (SELECT g.*, log FROM G g LEFT JOIN MN ON MN.src_row_idx = g._row_idx), V AS MATERIALIZED (SELECT *, stage AS st FROM ({_log_sql("L")}) WHERE {major}),
          W AS (SELECT src_row_idx, CASE WHEN subject = '不限' THEN '存疑' ELSE '确定' END AS verdict FROM P WHERE school_cat = '民族班' AND subject <> '化学'),
          Q1 AS (SELECT MN.src_row_idx, bool_or({close('MN.J', 'h.J')} AND {close('MN.T', 'h.T')}) AS ok FROM MN JOIN H h ON h.school = MN.school AND h.major = MN.mm WHERE matched GROUP BY 1
            UNION ALL SELECT MN.src_row_idx, {close('MN.J', 'E.value')} AND {close('MN.T', 'E.T')} FROM MN JOIN E USING (src_row_idx) WHERE NOT matched),
          A(name, what, n, fails) AS (
            SELECT 'judgmental_coverage', 'without verdict 确定: ', count(*) FILTER (coalesce(verdict, '') <> '确定'), 0 FROM V LEFT JOIN W ON W.src_row_idx = V._row_idx WHERE st = '{notes.JUDGED}'
            UNION ALL SELECT 'nonempty_log', 'blank: ', count(*) FILTER (trim(coalesce(st, '')) = ''), CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM V WHERE {scope}
            UNION ALL SELECT 'no_empty_rows', 'blank rows: ', count(*) FILTER (coalesce(c0,'') = '' AND coalesce(c1,'') = '' AND coalesce(c3,'') = '' AND coalesce(c4,'') = '' AND coalesce(c5,'') = ''), 0 FROM G
            UNION ALL SELECT 'tables_nonempty', 'empty tables: ', (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM G) + (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM H), 0
            UNION ALL SELECT 'jt_consistency', 'inconsistent: ', count(*) FILTER (NOT ok), 0 FROM Q1
            UNION ALL SELECT 'rename_official_link', 'without link: ', count(*) FILTER (NOT regexp_matches(concat_ws(' ', new_school, old_school, remark), 'moe\\.gov\\.cn|gov\\.cn|\\.edu\\.cn')), 0 FROM rename_rows)
          SELECT name, n = 0 AND fails = 0 AS passed, what || n AS detail FROM A""",
        "q_text_helpers": base + f"""SELECT src_row_idx, len(list_filter(list_transform(hb, lambda c: CASE WHEN {gender} THEN CASE WHEN contains(c, '男') THEN '男' ELSE '女' END ELSE c END), lambda v: NOT contains(major, v))) = 0 AS within,
            coalesce(CASE WHEN len(pv) > 0 THEN substring(pv[1], 1, 10) || CASE WHEN length(pv[1]) > 10 THEN '…' ELSE '' END END, '无差异化括号') AS brief, school || ' ' || hm || ' 更名 转设 前身 同源 高校' AS query,
            CASE WHEN batch = '{grids.EARLY}' THEN hs WHEN trim(subject) = '' THEN trim(hs) WHEN trim(hs) = '' THEN trim(subject) ELSE trim(hs) || chr(10) || trim(subject) END AS remark, substring(trim(' ' || major || hm || school), 1, 30) AS reason
          FROM (SELECT p.*, h.major AS hm, h.subject AS hs, regexp_extract_all(h.major, '\\(([^()]*)\\)', 1) AS hb, list_transform(regexp_extract_all(p.major, '\\(([^()]*)\\)', 1), lambda c: CASE WHEN {gender} THEN CASE WHEN contains(c, '男') THEN '男' ELSE '女' END ELSE c END) AS pv
            FROM P p JOIN (SELECT * FROM H QUALIFY row_number() OVER (PARTITION BY school, stripped ORDER BY hist_pos) = 1) h USING (school, stripped))""",
        "q_research_summary": f"""WITH L AS (SELECT doc_id, school, text, list_filter(list_transform(string_split_regex(coalesce(text, ''), '\\r?\\n'), lambda s: trim(regexp_replace(regexp_replace(trim(s), '^-+', ''), '^#+', ''))), lambda s: s <> '' AND NOT contains(substring(s, 1, 8), '查询') AND regexp_matches(s, '{_any(notes.CONCLUSION_WORDS)}')) AS told,
            list_filter(regexp_extract_all(coalesce(text, ''), 'https?://[^\\s)）]+'), lambda u: contains(u, '.gov.cn')) AS urls FROM documents),
          B AS (SELECT *, CASE WHEN len(told) > 0 THEN list_filter(told, lambda s: length(s) = list_max(list_transform(told, lambda x: length(x))))[1] ELSE '' END AS best FROM L)
          SELECT doc_id, CASE WHEN best = '' AND len(urls) = 0 THEN '（见 research/' || coalesce(school, '?') || '.md）' ELSE concat_ws(' ', nullif(substring(best, 1, 100), ''), CASE WHEN len(urls) > 0 THEN '来源：' || urls[1] END) END AS summary FROM B""",
        "q_enrich_renames": base + """SELECT old_school, new_school, confidence, manual_reviewed, is_rename, coalesce(n, 0) AS major_count_2026, CASE WHEN trim(coalesce(remark, '')) <> '' THEN remark WHEN manual_reviewed THEN remark
            ELSE '前身为' || old_school || '，后更名 来源：https://www.moe.gov.cn/a' END AS remark FROM (SELECT * FROM rename_rows WHERE is_rename) r LEFT JOIN (SELECT school, count(*) AS n FROM P WHERE school <> '' GROUP BY 1) c ON c.school = r.new_school""",
        "q_side_tsv": f"""SELECT CAST(doc_id AS INTEGER) AS src_row_idx, CAST(CASE doc_kind WHEN 'prose' THEN 0 WHEN 'junk' THEN 3 END AS INTEGER) AS cand, trim(doc_kind || chr(9) || 'more') AS reason, CASE WHEN doc_kind = 'table' THEN 'cand 不是整数也不是 - / null' END AS error FROM ({labels})""",
        "q_side_verdicts": f"""SELECT CAST(doc_id AS INTEGER) AS src_row_idx, CASE WHEN doc_kind = 'prose' THEN '确定' WHEN doc_kind <> 'junk' THEN '存疑' END AS verdict, CASE WHEN doc_kind = 'junk' THEN '' ELSE 'why' END AS reason, CASE WHEN doc_kind = 'junk' THEN '列数 <2' END AS error FROM ({labels})""",
        "q_verdict_map": f"SELECT CAST(doc_id AS INTEGER) AS src_row_idx, doc_kind AS verdict FROM ({labels})",
        "q_streamed_verdicts": """SELECT CAST(edge_id AS INTEGER) AS src_row_idx, CASE WHEN est_level = 0 THEN '确定' WHEN est_level = 1 THEN '好' ELSE '存疑' END AS verdict, substring(trim(coalesce(log, '')), 1, 30) AS reason,
          CASE WHEN est_level = 1 THEN 'verdict 不在允许集' WHEN trim(coalesce(log, '')) = '' THEN 'reason 为空或非字符串' END AS error FROM edge_rows""",
        "q_viewer_head": f"""SELECT src_row_idx AS _row_idx, array_to_string([CASE WHEN batch = '{grids.EARLY}' THEN '{grids.PLAN_EARLY[0]}' ELSE coalesce(batch, '') END, coalesce(school_cat, ''), '', coalesce(school, ''), CAST(src_row_idx AS VARCHAR), coalesce(major, ''), coalesce(subject, ''), '', '', '', '', ''], chr(9)) AS line
          FROM plan_rows ORDER BY src_row_idx LIMIT 20""",
        "q_second_look": base + """SELECT C.src_row_idx, C.school, C.school_cat, C.major AS dagluben_major, P.core AS dagluben_core, P.subject, P.batch, C.log AS prior_log, coalesce(n, 0) AS past_same_core, h.major AS past_major, h.core AS past_core, h.J AS past_j, h.T AS past_t
          FROM C JOIN P USING (src_row_idx) LEFT JOIN CC ON CC.school = P.school AND CC.core = P.core JOIN (SELECT * FROM H QUALIFY row_number() OVER (PARTITION BY school, major ORDER BY hist_pos) = 1) h ON h.school = P.school AND h.major = C.matched_major""",
        "q_second_look_prompts": base + "SELECT C.src_row_idx, C.major AS dagluben_major, coalesce(n, 0) AS past_same_core FROM C JOIN P USING (src_row_idx) LEFT JOIN CC ON CC.school = P.school AND CC.core = P.core",
        "q_special_doubted": base + f"""SELECT Z.src_row_idx, Z.school, Z.school_cat, Z.major, Z.core, Z.subject, Z.batch, CASE WHEN subject = '物理' THEN '{notes.DEMOTED}：疑：' || core WHEN batch = '{grids.EARLY}' THEN '{notes.FLIGHT}' ELSE log END AS log, batch = '{grids.EARLY}' AS is_flight,
          {", ".join(f"CASE WHEN batch <> '{grids.EARLY}' THEN {c} END AS {c}" for c in ("est_value", "est_t", "est_level", "est_n"))} FROM ({special}) Z""",
        "q_rename_files": base + "SELECT school AS new_school, (SELECT count(*) FROM GS) AS n, (SELECT string_agg(school, ',' ORDER BY school) FROM GS) AS names FROM NS",
        "q_published": base + f"""SELECT '今年新增往年没有的专业' AS tbl, (SELECT count(*) FROM N) AS n UNION ALL SELECT '往年有但今年停招的专业', (SELECT count(*) {deleted.replace("AND school NOT IN (SELECT new_school FROM RN) ", "")}) UNION ALL SELECT '学校改名表', 0
          UNION ALL SELECT '今年新招生的学校', (SELECT count(*) FROM NS) UNION ALL SELECT '往年有今年停招的学校', (SELECT count(*) FROM GS) UNION ALL SELECT '未能匹配的专业', (SELECT count(*) FROM X)""",
        "q_supplement_coverage": base + f"SELECT hist_pos, school, major FROM H WHERE source_table = '{grids.EARLY}' AND NOT EXISTS (SELECT 1 FROM H o WHERE o.source_table <> '{grids.EARLY}' AND o.school = H.school AND o.major = H.major)",
        "q_residual_brackets": base + "SELECT hist_pos, core FROM H WHERE regexp_matches(core, '[()]')",
        "q_unmatched_families": base + "SELECT DISTINCT R.src_row_idx, R.core, h.core AS past_core FROM R JOIN H h ON h.school = R.school WHERE R.core <> '' AND h.core <> '' AND (R.core || '类' = h.core OR h.core || '类' = R.core)",
        "q_sample": base + "SELECT src_row_idx, school, major FROM P ORDER BY md5('20260623:' || src_row_idx), src_row_idx LIMIT 30",
        "q_viewer_grep": "SELECT coalesce(new_school, '') || chr(9) || coalesce(old_school, '') || chr(9) || coalesce(remark, '') AS line FROM rename_rows WHERE contains(coalesce(new_school, '') || chr(9) || coalesce(old_school, '') || chr(9) || coalesce(remark, ''), '学院')",
    }
    out["q_audit_passed"] = f"SELECT bool_and(passed) AS ok FROM ({out['q_audit']})"
    return out
