"""Side files: JSON and TSV lines with their places, texts, prompts, digests."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.operators.contracts import first_error


def numbered_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(file, lineno, value) of the lines of all files of ``folder`` that match
    ``pattern``; blank lines are counted and kept. No file, no rows.

    Large files are read in blocks: a task numbers its lines as they come, and
    the lines of the blocks before are added."""
    raw = spark.read.format("text").option("pathGlobFilter", pattern).load(folder)
    lines = raw.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = lines.groupBy("_path", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.select("_path", "_block", "_first", F.coalesce(earlier, F.lit(0)).alias("_before"))
    lineno = (F.col("_id") - F.col("_first") + F.col("_before") + 1).cast("int")
    return lines.join(placed, ["_path", "_block"]).select("file", lineno.alias("lineno"), "value")


def file_count(spark: SparkSession, folder: str, pattern: str) -> int:
    """How many files match; tells "no file" from "no rows"."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").count()


def verdict_map(lines: DataFrame) -> DataFrame:
    """(src_row_idx, verdict) of verdict lines; the last line of an id stands."""
    parsed = lines.where(F.trim("value") != "").select("file", "lineno", F.from_json("value", "src_row_idx int, verdict string").alias("r"))
    known = parsed.where("r.src_row_idx IS NOT NULL")
    return known.groupBy(F.col("r.src_row_idx").alias("src_row_idx")).agg(F.max(F.struct("file", "lineno", "r.verdict")).alias("_b")).select("src_row_idx", "_b.verdict")


def decisions(lines: DataFrame) -> DataFrame:
    """(src_row_idx, cand, reason, error) of lines "id TAB position TAB reason";
    '', - and null mean none; the reason may hold tabs; the last line of an id
    stands. Lines without a whole number for an id keep a NULL id."""
    parts = F.split("value", "\t", 3)
    rows = lines.where(F.trim("value") != "").select("file", "lineno", parts.alias("p"))
    cand = F.trim(F.get("p", F.lit(1)))
    idx = F.trim(F.get("p", F.lit(0))).try_cast("int")
    none = cand.isin("", "-", "null", "NULL", "None")
    rules = [(F.size("p") < 2, "列数 <2"), (idx.isNull(), "src_row_idx 不是整数"), (~none & cand.try_cast("int").isNull(), "cand 不是整数也不是 - / null")]
    out = rows.select("file", "lineno", idx.alias("src_row_idx"), F.when(~none, cand.try_cast("int")).alias("cand"), F.trim(F.coalesce(F.get("p", F.lit(2)), F.lit(""))).alias("reason"), first_error(rules).alias("error"))
    return _last(out, ["cand", "reason", "error"])


def verdict_decisions(lines: DataFrame) -> DataFrame:
    """(src_row_idx, verdict, reason, error) of lines "id TAB verdict TAB reason"."""
    p = F.split("value", "\t", 3)
    idx = F.trim(F.get(p, F.lit(0))).try_cast("int")
    rules = [(F.size(p) < 2, "列数 <2"), (idx.isNull(), "src_row_idx 不是整数")]
    out = lines.where(F.trim("value") != "").select("file", "lineno", idx.alias("src_row_idx"), F.trim(F.get(p, F.lit(1))).alias("verdict"), F.trim(F.coalesce(F.get(p, F.lit(2)), F.lit(""))).alias("reason"), first_error(rules).alias("error"))
    return _last(out, ["verdict", "reason", "error"])


def _last(rows: DataFrame, fields: list[str]) -> DataFrame:
    good = rows.where("src_row_idx IS NOT NULL").groupBy("src_row_idx").agg(F.max(F.struct("file", "lineno", F.struct(*fields).alias("_r"))).alias("_b"))
    bad = rows.where("src_row_idx IS NULL").select("src_row_idx", *fields)
    return good.select("src_row_idx", *[F.col(f"_b._r.{f}").alias(f) for f in fields]).unionByName(bad)


def prompt_items(spark: SparkSession, folder: str, pattern: str = "batch_*_prompt.json") -> DataFrame:
    """The items of prompt documents, one per row."""
    docs = spark.read.schema("batch int, items array<struct<src_row_idx int, school string, major string, candidates array<struct<major string, core string, J double, T double>>>>").option("multiLine", True).option("pathGlobFilter", pattern).json(folder)
    return docs.select("batch", F.explode("items").alias("i")).select("batch", "i.*")


def research_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(school, text) of the Markdown files named after schools."""
    raw = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").load(folder)
    return raw.select(F.regexp_replace("_metadata.file_name", r"\.md$", "").alias("school"), F.col("value").alias("text"))


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, sha256) of whole files."""
    return spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha256"))


def assert_unchanged(before: Iterable, after: Iterable) -> None:
    a, b = ({r["file"]: r["sha256"] for r in x} for x in (before, after))
    if changed := sorted(f for f in a if b.get(f) != a[f]):
        raise RuntimeError("source changed: " + ", ".join(changed))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields stay, non-ASCII isn't escaped."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_text(text: str, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def write_prompts(items: DataFrame, folder: str, name: str, extra: dict | None = None) -> int:
    """One document per batch of ``items`` (batch_no, then payload columns): the
    stale ones are removed first. Batches are small by construction; they come
    to the driver one at a time. Returns their number."""
    os.makedirs(folder, exist_ok=True)
    begin, end = name.split("{}")
    for f in os.listdir(folder):
        if f.startswith(begin) and f.endswith(end):
            os.remove(os.path.join(folder, f))
    payload = [c for c in items.columns if c != "batch_no"]
    packed = items.groupBy("batch_no").agg(F.sort_array(F.collect_list(F.struct("src_row_idx", F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("j")))).alias("items"))
    n = 0
    for r in packed.orderBy("batch_no").toLocalIterator():
        doc = {"batch": r["batch_no"], "items": [json.loads(i["j"]) for i in r["items"]]} | (extra or {})
        with open(os.path.join(folder, f"{begin}{r['batch_no']:02d}{end}"), "w", encoding="utf-8") as f:
            json.dump(doc, f, ensure_ascii=False, indent=2)
        n += 1
    return n


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def view(df: DataFrame, *, head: int = 20, grep: str | None = None, order: str = "_row_idx") -> DataFrame:
    """Rows as tab-joined lines: the first ``head`` in order, or all that hold
    ``grep`` (which leaves ``head`` out of account)."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns if c != order]
    lines = df.select(F.col(order), F.concat_ws("\t", *cells).alias("line"))
    return lines.where(F.contains("line", F.lit(grep))) if grep is not None else lines.orderBy(order).limit(head)
