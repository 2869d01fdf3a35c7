"""The whole run: sources to results, boundary tables, prompts and checks.

Everything is lazy until a table is written. Relations that feed many branches
are settled once in the shared folder.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import notes
from quern.operators import audit as checks
from quern.operators import contracts, match, order, results, schools
from quern.operators.estimate import REFERENCE_VARIANTS, estimate
from quern.session import settle
from quern.sources import files, grids
from quern.sources.xlsx import read_xlsx, sheet_names, write_xlsx

RENAMED = "old_school string, new_school string, confidence double, is_rename boolean, remark string, manual_reviewed boolean, pos long"


@dataclass
class Config:
    """Places and parameters of a run. Missing side files never fail a run."""

    plan: str
    history: str
    supplement: str | None = None
    judged_dir: str | None = None
    research_dir: str | None = None
    history_sheet: str | None = "统计结果"
    notes_sheet: str = "说明"
    cutoffs: Mapping[int, int] | None = None
    supplement_batches: Sequence[str] = grids.SUPPLEMENT_KEPT
    low_columns: Mapping[int, int] = field(default_factory=lambda: dict(grids.LOW_COLUMNS))
    plan_early_batches: Sequence[str] = grids.PLAN_EARLY
    batch_size: int = 20
    with_judged: bool = True
    flight_on_raw_batch: bool = False
    deleted_excludes_matched: bool = False
    subject_variants: str = REFERENCE_VARIANTS


def load(spark: SparkSession, c: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan grid, plan, past) of a run's workbooks."""
    grid = read_xlsx(spark, c.plan, columns=12)
    cutoffs = c.cutoffs
    if cutoffs is None:
        sheets = sheet_names(c.history)
        for s in [c.notes_sheet] if c.notes_sheet in sheets else sheets:
            if cutoffs := grids.cutoffs_from_notes(read_xlsx(spark, c.history, s, 12)):
                break
    past = grids.past_regular(read_xlsx(spark, c.history, c.history_sheet, 29))
    if c.supplement and os.path.exists(c.supplement):
        past = grids.past_rows(past, grids.past_early(read_xlsx(spark, c.supplement), cutoffs, c.supplement_batches, c.low_columns))
    return grid, grids.plan_rows(grid, c.plan_early_batches), past


def _lines(spark: SparkSession, folder: str | None, pattern: str) -> DataFrame | None:
    if not folder or not os.path.isdir(folder) or not any(True for f in os.listdir(folder)):
        return None
    return files.numbered_lines(spark, folder, pattern) if files.file_count(spark, folder, pattern) else None


def link(plan: DataFrame, past: DataFrame, c: Config | None = None, *, rename_lines: DataFrame | None = None, judged_lines: DataFrame | None = None, verdict_lines: DataFrame | None = None, research: DataFrame | None = None) -> dict[str, DataFrame]:
    """All relations of a run, by name. Renames go first, then the cascade of
    strict, coarse and judged matches, estimates, second look, boundary tables.
    Broken rename and verdict lines fail at the first, judged ones are listed."""
    c = c or Config("", "")
    spark = plan.sparkSession
    if rename_lines is not None:
        only = schools.new_schools(plan, past)
        told = contracts.raise_errors(contracts.check_renames(rename_lines, only), first_only=True).where("is_rename")
        renamed = told.select("old_school", "new_school", "confidence", "is_rename", "remark", F.lit(False).alias("manual_reviewed"), F.xxhash64("file").alias("_f"), "file", "lineno")
        renamed = settle(order.positions(renamed.drop("_f"), ["file", "lineno"]).drop("file", "lineno"), "renames")
        past = schools.apply_renames(past, renamed)
    else:
        renamed = spark.createDataFrame([], RENAMED)
    plan, past = settle(plan, "plan"), settle(past, "past")

    strict = settle(match.strict_match(plan, past), "strict")
    rest = match.unmatched(plan, strict)
    coarse = settle(match.coarse_match(rest, past), "coarse")
    rest = settle(match.unmatched(rest, coarse), "rest")
    matchers = [strict, coarse.drop("step")]
    if judged_lines is not None:
        checked = contracts.raise_errors(contracts.check_judged(judged_lines, rest, match.candidates(rest, past)))
        judged = settle(results.judged_matches(checked, plan, past), "judged")
        rest = settle(match.unmatched(rest, judged), "rest-judged")
    else:
        judged = strict.limit(0)
    new = schools.new_majors(rest, past)
    estimates = settle(estimate(new, past, variants=c.subject_variants), "estimates")

    doubted = None
    kept = judged
    if verdict_lines is not None:
        verdicts = contracts.raise_errors(contracts.check_verdicts(verdict_lines, judged.select("src_row_idx")), first_only=True)
        kept, doubted = results.demote(judged, verdicts)
    homes = strict.where("matched").select("src_row_idx").unionByName(coarse.select("src_row_idx")).unionByName(kept.where("matched").select("src_row_idx"))
    classified = homes.unionByName(new.select("src_row_idx"))
    remaining = settle(plan.join(classified.distinct(), "src_row_idx", "left_anti").select(*plan.columns), "remaining")
    label = grids.FLIGHT
    if c.flight_on_raw_batch and "raw_batch" in remaining.columns:
        remaining = remaining.withColumn("batch", F.col("raw_batch"))
    special = results.special_rows(remaining, past, estimate(remaining, past, variants=c.subject_variants), doubted=doubted, flight_label=label)
    main = settle(results.main_results(plan, [*matchers, kept], estimates, classified=homes), "main")
    named = None
    for m in [*matchers, kept]:
        one = m.where("matched").select("src_row_idx", "matched_major")
        named = one if named is None else named.unionByName(one)
    deleted = schools.deleted_majors(plan, past, renamed)
    if c.deleted_excludes_matched:
        used = main.where("matched").join(named, "src_row_idx").select("school", F.col("matched_major").alias("major")).distinct()
        deleted = deleted.join(used, ["school", "major"], "left_anti")
    fresh, gone = schools.new_schools(plan, past, renamed), schools.gone_schools(plan, past, renamed)
    enriched = schools.enrich_renames(renamed, plan, research)
    new_rows = new.select("src_row_idx", "school", "major", "subject").join(estimates, "src_row_idx")
    return {
        "plan": plan, "past": past, "strict": strict, "coarse": coarse, "judged": judged, "unresolved": rest, "main": main, "matched_names": named,
        "new_majors": new_rows, "estimates": estimates, "special": special, "deleted": deleted, "new_schools": fresh, "gone_schools": gone, "renamed": enriched,
        "coverage": results.coverage(plan, main, new, special, deleted, fresh, gone, renamed),
    }


def run(spark: SparkSession, c: Config) -> dict[str, DataFrame]:
    """A run over workbooks and side files; sources are checked to be unchanged."""
    sources = [p for p in (c.plan, c.history, c.supplement) if p and os.path.exists(p)]
    before = files.digests(spark, sources).collect()  # one row per source file
    grid, plan, past = load(spark, c)
    folder = c.judged_dir if c.with_judged else None
    research = files.research_texts(spark, c.research_dir) if c.research_dir and os.path.isdir(c.research_dir) else None
    out = link(
        plan, past, c, research=research,
        rename_lines=_lines(spark, folder, "rename_result.jsonl"), judged_lines=_lines(spark, folder, "batch_*_result.jsonl"), verdict_lines=_lines(spark, folder, "verify_*_result.jsonl"),
    )
    # the last reading of a source: all else is computed from settled relations
    out["hierarchical"] = settle(results.hierarchical(grid, out["main"]), "hierarchical")
    out["flat"] = results.flat(out["hierarchical"])
    files.assert_unchanged(before, files.digests(spark, sources).collect())
    return out


def prompts(out: dict[str, DataFrame], folder: str, size: int = 20) -> int:
    """Documents for the rows that need judging; the number of documents."""
    items = match.candidate_items(out["unresolved"], out["past"]).select("src_row_idx", "school", "school_cat", "major", "core", "subject", "batch", "candidates")
    return files.write_prompts(order.batches(items, ["src_row_idx"], size), folder, "batch_{}_prompt.json", {"output_schema": list(contracts.JUDGED_KEYS), "matching_rule": notes.RULE})


def second_look_prompts(out: dict[str, DataFrame], folder: str, size: int = 20) -> int:
    items = results.second_look_items(out["judged"], out["plan"], out["past"])
    return files.write_prompts(order.batches(items, ["src_row_idx"], size), folder, "verify_batch_{}.json", {"output_schema": list(contracts.VERDICT_KEYS)})


def rename_files(out: dict[str, DataFrame], folder: str) -> None:
    """The task for renames, and its candidates: one JSON line per new school."""
    files.write_text(notes.RENAME_TASK, os.path.join(folder, "rename_prompt.md"))
    pairs = schools.rename_candidates(out["plan"], out["past"], topk=0)
    lines = pairs.groupBy("new_school").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "old_school"))), lambda x: x["old_school"]).alias("candidate_old_schools"))
    files.write_json_lines(lines, os.path.join(folder, "rename_candidates"))


def tables(out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    t = results.edge_tables(out["new_majors"], out["deleted"], out["renamed"], out["new_schools"], out["gone_schools"], out["special"])
    return {"大绿本_完整版_含线差": out["hierarchical"], "大绿本_专业列表_含线差": out["flat"]} | t if "hierarchical" in out else t


def publish(out: dict[str, DataFrame], folder: str, *, workbooks: bool = False) -> None:
    """Every table as parquet, and as workbooks too where asked."""
    for name, df in tables(out).items():
        df.write.mode("overwrite").parquet(os.path.join(folder, name + ".parquet"))
        if workbooks:
            os.makedirs(folder, exist_ok=True)
            shown = df.orderBy("_row_idx").drop("_row_idx") if "_row_idx" in df.columns else df
            write_xlsx(shown, os.path.join(folder, name + ".xlsx"), name[:31], header="_row_idx" not in df.columns)


def audit(out: dict[str, DataFrame], verdicts: DataFrame | None) -> DataFrame:
    t = tables(out)
    named = out["main"].join(out["matched_names"], "src_row_idx", "left")
    return checks.audit([
        checks.judged_coverage(out["hierarchical"], verdicts), checks.stages_filled(out["flat"]), checks.no_blank_rows(t),
        checks.tables_filled(t), checks.figures_consistent(named, out["past"], out["estimates"]), checks.renames_sourced(out["renamed"]),
    ])
