"""Command line: python -m quern COMMAND.

run      link the workbooks, publish tables, write prompts for what is open
second   write prompts for the second look at judged matches
audit    run, then check; exit code 1 if a check fails
decide   turn picks by position (TSV) into result lines (JSON)
verdicts turn second-look verdicts (TSV) into result lines (JSON)
show     print rows of a workbook
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from quern.operators import contracts
from quern.plans import pipeline
from quern.session import build_session, ship
from quern.sources import files, grids
from quern.sources.xlsx import read_xlsx


def int_map(text: str) -> dict[int, int]:
    """``2025=441,2024=444`` as numbers."""
    return {int(k): int(v) for k, v in (p.split("=", 1) for p in text.split(",") if p.strip())}


def names(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quern", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = out.add_subparsers(dest="command", required=True)
    for name in ("run", "second", "audit"):
        p = sub.add_parser(name)
        p.add_argument("--plan", required=True)
        p.add_argument("--history", required=True)
        p.add_argument("--supplement")
        p.add_argument("--judged-dir")
        p.add_argument("--research-dir")
        p.add_argument("--out", default="out")
        p.add_argument("--workbooks", action="store_true")
        p.add_argument("--no-judged", action="store_true")
        p.add_argument("--cutoffs", type=int_map)
        p.add_argument("--supplement-batches", type=names, default=grids.SUPPLEMENT_KEPT)
        p.add_argument("--low-columns", type=int_map, default=dict(grids.LOW_COLUMNS))
        p.add_argument("--plan-early-batches", type=names, default=grids.PLAN_EARLY)
        p.add_argument("--batch-size", type=int, default=20)
    for name in ("decide", "verdicts"):
        p = sub.add_parser(name)
        p.add_argument("--prompts", required=True, help="folder of prompt documents")
        p.add_argument("--pattern", required=True, help="file names of the prompts")
        p.add_argument("--tsv", required=True)
        p.add_argument("--out", required=True)
    p = sub.add_parser("show")
    p.add_argument("path")
    p.add_argument("--sheet")
    p.add_argument("--head", type=int, default=20)
    p.add_argument("--grep")
    return out


def config(a: argparse.Namespace) -> pipeline.Config:
    return pipeline.Config(
        a.plan, a.history, a.supplement, a.judged_dir, a.research_dir, cutoffs=a.cutoffs, supplement_batches=a.supplement_batches,
        low_columns=a.low_columns, plan_early_batches=a.plan_early_batches, batch_size=a.batch_size, with_judged=not a.no_judged,
    )


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session("quern")
    ship(spark)
    if a.command == "show":
        for r in files.view(read_xlsx(spark, a.path, a.sheet), head=a.head, grep=a.grep).toLocalIterator():
            print(r["line"].rstrip("\t"))
        return 0
    if a.command in ("decide", "verdicts"):
        items = files.prompt_items(spark, a.prompts, a.pattern)
        lines = files.numbered_lines(spark, os.path.dirname(os.path.abspath(a.tsv)), os.path.basename(a.tsv))
        done = contracts.resolve_decisions(items, files.decisions(lines)) if a.command == "decide" else contracts.resolve_verdicts(items, files.verdict_decisions(lines))
        placed = done.withColumns({"file": F.lit(os.path.basename(a.tsv)), "lineno": F.col("src_row_idx")})
        files.write_json_lines(contracts.raise_errors(placed).drop("file", "lineno"), a.out)
        return 0
    out = pipeline.run(spark, config(a))
    if a.command == "second":
        print(pipeline.second_look_prompts(out, a.judged_dir or a.out, a.batch_size), "documents")
        return 0
    pipeline.publish(out, a.out, workbooks=a.workbooks)
    out["coverage"].show(truncate=False)
    if a.command == "run":
        if a.judged_dir:
            pipeline.rename_files(out, a.judged_dir)
            print(pipeline.prompts(out, a.judged_dir, a.batch_size), "documents to judge")
        return 0
    lines = pipeline._lines(spark, a.judged_dir, "verify_*_result.jsonl")
    report = pipeline.audit(out, files.verdict_map(lines) if lines is not None else None)
    report.show(truncate=False)
    return 0 if report.where("NOT passed").count() == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
