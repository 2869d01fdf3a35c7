"""Queries of the training-data operators (problems 1, 2, 6, 7 and 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import oracles
from quern.llm.leakage import RUN, leaks
from quern.llm.linkage import link
from quern.llm.lookalikes import plain_spelling
from quern.llm.packing import broken_rules, containers, pack, token_counts, unpacked
from quern.llm.textstats import text_statistics
from quern.session import settle, table


def _name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, past = table(spark, sf_dir, "plan_rows"), table(spark, sf_dir, "history_rows")
    parts = [("plan_rows", plan, "src_row_idx", "major"), ("history_rows", past, "hist_pos", "major"), ("history_rows", past, "hist_pos", "school")]
    out = None
    for tbl, df, row_key, field in parts:
        one = df.select(F.lit(tbl).alias("tbl"), F.col(row_key).cast("long").alias("row_key"), F.lit(field).alias("field_name"), F.col(field).alias("text"))
        out = one if out is None else out.unionByName(one)
    return out


def p1_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field that isn't in its plain spelling, with that spelling."""
    return plain_spelling(_name_fields(spark, sf_dir), "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_plain(spark, sf_dir).select("tbl", "row_key", "field_name")


def p2_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a plan row and a history row of the same offer, with confidence."""
    return link(table(spark, sf_dir, "plan_rows"), table(spark, sf_dir, "history_rows"), table(spark, sf_dir, "rename_rows"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_linked(spark, sf_dir).select("src_row_idx", "hist_pos")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(token_counts(table(spark, sf_dir, "documents")), "sizes")


def _each(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, out = _sizes(spark, sf_dir), None
    for container in containers(table(spark, sf_dir, "token_containers")):
        one = pack(sizes, [container])
        out = one if out is None else out.unionByName(one)
    return out


def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in a container; all capacities are optimised jointly."""
    return pack(_sizes(spark, sf_dir), containers(table(spark, sf_dir, "token_containers")))


def p6_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in containers of one capacity, for each capacity alone."""
    return _each(spark, sf_dir)


def p6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents put together again from the jointly packed pieces."""
    return unpacked(p6_packed(spark, sf_dir), table(spark, sf_dir, "documents"))


def p6_each_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents put together again from the pieces of each capacity."""
    return unpacked(_each(spark, sf_dir), table(spark, sf_dir, "documents"), by=["container_id"])


def p6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a rule is broken, in the joint packing and in that of each capacity."""
    sizes, every = _sizes(spark, sf_dir), containers(table(spark, sf_dir, "token_containers"))
    out = broken_rules(pack(sizes, every), every).select(F.lit(0).alias("container_id"), "*")
    for c in every:
        out = out.unionByName(broken_rules(pack(sizes, [c]), [c]).select(F.lit(c[0]).alias("container_id"), "*"))
    return out


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins, tokens and unused share by capacity of the joint packing."""
    bins = p6_packed(spark, sf_dir).groupBy("container_id", "capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("used"))
    return bins.groupBy("container_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("bins"), F.sum("used").alias("tokens"), F.round(1 - F.sum("used") / F.sum("capacity_tokens"), 6).alias("unused_share")
    )


def p7_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items they leak, with run and alignment score: whole,
    in part (an unbroken run), or edited (by the score alone)."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.withColumn("how", F.when(F.col("score_share") >= 1, "whole").when(F.col("run_length") >= RUN, "part").otherwise("edited"))


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items they leak, and how, with the longest run."""
    return p7_scores(spark, sf_dir).select("doc_id", "item_id", "how", "run_length")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks with an unbroken run."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.where(F.col("run_length") >= RUN).select("doc_id", "item_id")


def p8_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and rule outcome of every document."""
    return text_statistics(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_stats(spark, sf_dir).where(F.col("kind") == "apart").select("doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_plain, p2_found, p2_linked, p6_packed, p6_each, p6_fill, p6_texts, p6_each_texts, p6_rules, p7_found, p7_leaks, p7_scores, p8_found, p8_stats)}


def oracle() -> dict[str, str]:
    return oracles.oracle()
