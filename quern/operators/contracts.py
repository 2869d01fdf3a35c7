"""Checks of externally supplied result lines.

A line is parsed once, strictly; then every rule is a condition on a column and
the first that fails, in the rules' order, is the line's error. All errors are
collected; the policy (collect all, or stop at the first) is the caller's.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import cut_reason


class ContractError(ValueError):
    """Result lines break their contract."""


def _reader(keys: tuple[str, ...], wanted: tuple[str, ...]):
    """Arrow UDF: a JSON line to (error, values as text, types)."""
    schema = T.StructType([T.StructField("error", T.StringType())] + [T.StructField(f, T.StringType()) for k in wanted for f in (k, f"{k}_type")])

    @F.pandas_udf(schema)
    def read(lines: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in lines:
            row: dict[str, str | None] = {"error": None}
            try:
                obj = json.loads(raw.strip())
            except (ValueError, AttributeError):
                obj = None
                row["error"] = "JSON 解析失败"
            if row["error"] is None and not isinstance(obj, dict):
                row["error"] = "顶层不是 JSON 对象"
            elif row["error"] is None and (missing := [k for k in keys if k not in obj]):
                row["error"] = "缺少必需字段 " + ",".join(missing)
            for k in wanted:
                v = obj.get(k) if isinstance(obj, dict) else None
                kind = {type(None): "null", bool: "bool", int: "int", float: "float", str: "str"}.get(type(v), "other")
                row[f"{k}_type"] = kind
                row[k] = None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
            rows.append(row)
        return pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return read


def parse_lines(lines: DataFrame, keys: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Adds ``r``: a struct of the error, every field's text and its JSON type
    ('null' for a key that is missing or null; a missing required key is an
    error). ``lines`` has file, lineno, value; blank lines are left out but
    count for the line numbers."""
    read = _reader(tuple(keys), (*keys, *optional))
    return lines.where(F.trim("value") != "").withColumn("r", read(F.col("value")))


def first_error(rules: Sequence[tuple[Column, str | Column]]) -> Column:
    """The text of the first rule that is broken (a NULL condition isn't), or
    NULL. A rule is (condition of breach, text)."""
    out = F.lit(None).cast("string")
    for broken, text in reversed(list(rules)):
        out = F.when(broken, text if isinstance(text, Column) else F.lit(text)).otherwise(out)
    return out


def seen_before(key: Column, counts: Column, *order: str) -> Column:
    """Whether an earlier line (in ``order``) that ``counts`` has the same key."""
    # lines that don't count (all malformed ones) are spread, not put into one group
    w = Window.partitionBy(F.when(counts, key), F.when(~counts, F.xxhash64(*order))).orderBy(*order)
    return counts & (F.row_number().over(w) > 1)


def raise_errors(checked: DataFrame, *, first_only: bool = False, preview: int = 30) -> DataFrame:
    """``checked`` without its error column, or ContractError. Only the preview
    and the number of errors come to the driver."""
    bad = checked.where(F.col("error").isNotNull())
    shown = bad.orderBy("file", "lineno").limit(1 if first_only else preview).select("file", "lineno", "error").collect()
    if shown:
        total = 1 if first_only else bad.count()
        text = "\n".join(f"{r['file']}:{r['lineno']}: {r['error']}" for r in shown)
        raise ContractError(text if first_only else f"{total} errors\n{text}" + ("\n…" if total > len(shown) else ""))
    return checked.drop("error")


JUDGED_KEYS = ("src_row_idx", "school", "major", "match", "J", "T", "reason")
VERDICT_KEYS = ("src_row_idx", "verdict", "reason")
RENAME_KEYS = ("new_school", "old_school", "confidence", "is_rename")
VERDICTS = ("存疑", "确定")


def _index(c: str = "r.src_row_idx") -> Column:
    return F.when(F.col(c + "_type") == "int", F.col(c)).try_cast("int")


def check_judged(lines: DataFrame, sent: DataFrame, allowed: DataFrame) -> DataFrame:
    """(file, lineno, src_row_idx, match, J, T, reason, error) of judged lines.

    ``sent``: src_row_idx of the rows sent out; ``allowed``: (src_row_idx,
    major, hist_pos, J, T) of their candidates. A pick must be a candidate and
    echo its figures at two decimals; no pick needs no figures.
    """
    idx = _index()
    rows = parse_lines(lines, JUDGED_KEYS).withColumn("src_row_idx", idx)
    rows = rows.join(sent.select("src_row_idx", F.lit(True).alias("_sent")).distinct(), "src_row_idx", "left")
    rows = rows.withColumn("_again", seen_before(F.col("src_row_idx"), F.col("r.error").isNull() & F.col("_sent").isNotNull(), "file", "lineno"))
    rows = rows.withColumns({"match": F.when(F.col("r.match_type") == "str", F.col("r.match")), "_j": F.col("r.J").try_cast("double"), "_t": F.col("r.T").try_cast("double")})
    r2 = lambda c: F.round(F.col(c), 2)
    same = (r2("J").eqNullSafe(r2("_j"))) & (r2("T").eqNullSafe(r2("_t")))
    pool = allowed.withColumnRenamed("major", "match")
    near = rows.select("file", "lineno", "src_row_idx", "match", "_j", "_t").where("match IS NOT NULL").join(pool, ["src_row_idx", "match"])
    best = near.groupBy("file", "lineno").agg(F.min(F.struct((~same).alias("o"), "hist_pos", "J", "T")).alias("_b"))
    rows = rows.join(best, ["file", "lineno"], "left")
    picked = F.col("r.match_type") != "null"
    rules = [
        (F.col("r.error").isNotNull(), F.col("r.error")),
        (F.col("src_row_idx").isNull(), "src_row_idx 不是整数"),
        (F.col("_sent").isNull(), "src_row_idx 不在派发的行中"),
        (F.col("_again"), "src_row_idx 重复出现"),
        ((F.col("r.reason_type") != "str") | (F.trim("r.reason") == ""), "reason 为空或非字符串"),
        (picked & (F.col("r.match_type") != "str"), "match 既非字符串也非 null"),
        (picked & F.col("_b").isNull(), "match 不在候选集内"),
        (picked & ~r2("_b.J").eqNullSafe(r2("_j")), "J 与候选不一致"),
        (picked & ~r2("_b.T").eqNullSafe(r2("_t")), "T 与候选不一致"),
    ]
    return rows.select("file", "lineno", "src_row_idx", "match", F.col("_b.J").alias("J"), F.col("_b.T").alias("T"), F.col("_b.hist_pos").alias("hist_pos"), cut_reason(F.col("r.reason")).alias("reason"), first_error(rules).alias("error"))


def check_verdicts(lines: DataFrame, sent: DataFrame) -> DataFrame:
    """(file, lineno, src_row_idx, verdict, reason, error) of verdict lines."""
    rows = parse_lines(lines, VERDICT_KEYS).withColumn("src_row_idx", _index())
    rows = rows.join(sent.select("src_row_idx", F.lit(True).alias("_sent")).distinct(), "src_row_idx", "left")
    rows = rows.withColumn("_again", seen_before(F.col("src_row_idx"), F.col("r.error").isNull() & F.col("_sent").isNotNull(), "file", "lineno"))
    rules = [
        (F.col("r.error").isNotNull(), F.col("r.error")),
        (F.col("src_row_idx").isNull(), "src_row_idx 不是整数"),
        (F.col("_sent").isNull(), "src_row_idx 不在判断型匹配集中"),
        (F.col("_again"), "src_row_idx 重复出现"),
        ((F.col("r.verdict_type") != "str") | ~F.col("r.verdict").isin(*VERDICTS), "verdict 不在允许集"),
        ((F.col("r.reason_type") != "str") | (F.trim("r.reason") == ""), "reason 为空或非字符串"),
    ]
    return rows.select("file", "lineno", "src_row_idx", F.col("r.verdict").alias("verdict"), cut_reason(F.col("r.reason")).alias("reason"), first_error(rules).alias("error"))


def check_renames(lines: DataFrame, plan_only: DataFrame) -> DataFrame:
    """(file, lineno, new_school, old_school, confidence, is_rename, remark,
    error) of rename lines; a line that denies a rename needs no names beyond
    its new one. ``plan_only``: school."""
    rows = parse_lines(lines, RENAME_KEYS, ("note",))
    rows = rows.withColumns({
        "new_school": F.trim("r.new_school"), "old_school": F.when(F.col("r.old_school_type") == "str", F.trim("r.old_school")),
        "confidence": F.when(F.col("r.confidence_type").isin("int", "float"), F.col("r.confidence")).try_cast("double"),
        "is_rename": F.when(F.col("r.is_rename_type") == "bool", F.col("r.is_rename") == "true"),
    })
    rows = rows.join(plan_only.select(F.col("school").alias("new_school"), F.lit(True).alias("_only")), "new_school", "left")
    true = F.coalesce("is_rename", F.lit(False))
    rows = rows.withColumn("_again", seen_before(F.struct("new_school", "old_school"), true & F.col("r.error").isNull() & F.col("_only").isNotNull(), "file", "lineno"))
    rules = [
        (F.col("r.error").isNotNull(), F.col("r.error")),
        (F.col("is_rename").isNull(), "is_rename 不是布尔"),
        (F.col("confidence").isNull(), "confidence 不是数值"),
        (~F.col("confidence").between(0.0, 1.0) | F.isnan("confidence"), "confidence 不在 [0,1]"),
        ((F.col("r.new_school_type") != "str") | (F.col("new_school") == ""), "new_school 为空或非字符串"),
        (true & F.col("_only").isNull(), "new_school 不是今年独有校"),
        (true & (F.coalesce("old_school", F.lit("")) == ""), "is_rename=True 但 old_school 为空"),
        (F.col("_again"), "(new_school, old_school) 重复出现"),
    ]
    remark = F.when(F.col("r.note_type") == "str", F.trim("r.note")).otherwise(F.lit(""))
    return rows.select("file", "lineno", "new_school", "old_school", "confidence", "is_rename", remark.alias("remark"), first_error(rules).alias("error"))


def resolve_decisions(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Results from picks by position: ``items`` (src_row_idx, school, major,
    candidates) with ``decisions`` (src_row_idx, cand, reason, error). Every
    item needs a decision; cand is NULL for none, else a 0-based position."""
    d = decisions.select("src_row_idx", "cand", "reason", F.col("error").alias("_e"), F.lit(True).alias("_there"))
    rows = items.join(d, "src_row_idx", "left")
    beyond = F.col("cand").isNotNull() & ((F.col("cand") < 0) | (F.col("cand") >= F.size("candidates")))
    error = first_error([(F.col("_there").isNull(), "缺 decision"), (F.col("_e").isNotNull(), F.col("_e")), (beyond, "cand 越界")])
    pick = F.when(~F.coalesce(beyond, F.lit(False)), F.get("candidates", F.col("cand")))
    return rows.select("src_row_idx", "school", "major", pick["major"].alias("match"), pick["J"].alias("J"), pick["T"].alias("T"), F.trim(F.coalesce("reason", F.lit(""))).alias("reason"), error.alias("error"))


def resolve_verdicts(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """(src_row_idx, verdict, reason, error) for every item sent out."""
    d = decisions.select("src_row_idx", "verdict", "reason", F.lit(True).alias("_there"))
    rows = items.select("src_row_idx").join(d, "src_row_idx", "left")
    error = first_error([(F.col("_there").isNull(), "缺 decision"), (~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False)), "verdict 不在允许集")])
    return rows.select("src_row_idx", "verdict", F.trim(F.coalesce("reason", F.lit(""))).alias("reason"), error.alias("error"))
