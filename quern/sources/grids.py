"""Positional grids to the two relations that are linked.

A grid has _row_idx and c0..cN. ``normalise`` is the text folding to use.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.numeric import line_diff, number
from quern.functions.text import category_in_major, core_name, fold, out_of_scope, split_school, strip_asides
from quern.operators.results import HEADER_CELLS

# Batches as the sources name them, and columns of the history
# sheet (0-based) and of the supplement's lowest scores.
PLAN_REGULAR = "4.常规批"
PLAN_EARLY = ("1.提前批A类", "2.提前批B类", "3.提前批—飞行技术(军队)")
FLIGHT = "3.提前批—飞行技术(军队)"
EARLY = "提前批"
PAST_KEPT = ("常规批一段线", "提前批")
SUPPLEMENT_KEPT = ("本科提前批A类", "本科提前批B类")
LOW_COLUMNS = {2025: 10, 2024: 14, 2023: 18}
#: Feeds come one after the other: a past row's place is its feed times this.
FEED = 1_000_000_000_000


def _data(grid: DataFrame) -> DataFrame:
    return grid.where(~F.coalesce(F.col("c0"), F.lit("")).isin(*HEADER_CELLS))


def named_parts(name: Column, normalise: Callable[[Column], Column] = fold) -> dict[str, Column]:
    """major, stripped and core of a raw name."""
    n = normalise(name)
    return {"major": n, "stripped": strip_asides(n), "core": core_name(n)}


def past_regular(grid: DataFrame, normalise: Callable[[Column], Column] = fold) -> DataFrame:
    """Past rows of a sheet that already has the figures."""
    rows = _data(grid).where(F.col("c0").isin(*PAST_KEPT) & ~out_of_scope(F.col("c5"), F.col("c8"), F.col("c3")))
    rows = rows.withColumns({"_s": normalise(F.col("c2")), "_m": normalise(F.col("c3"))})
    school, cat = split_school(F.col("_s"))
    return rows.select(
        (F.lit(0).cast("long") * FEED + F.col("_row_idx")).alias("hist_pos"), school.alias("school"),
        F.when(cat != "", cat).otherwise(category_in_major(F.col("_m"))).alias("school_cat"),
        F.col("_m").alias("major"), strip_asides(F.col("_m")).alias("stripped"), core_name(F.col("_m")).alias("core"),
        normalise(F.col("c4")).alias("subject"), number(F.col("c9")).alias("J"), number(F.col("c19")).alias("T"), F.col("c0").alias("source_table"),
    )


def past_early(grid: DataFrame, cutoffs: Mapping[int, int] | None = None, batches: Sequence[str] = SUPPLEMENT_KEPT, low_columns: Mapping[int, int] | None = None, normalise: Callable[[Column], Column] = fold) -> DataFrame:
    """Past rows of a sheet with yearly lowest scores only."""
    lows = {y: number(F.col(f"c{c}")) for y, c in (low_columns or LOW_COLUMNS).items()}
    j, t = line_diff(lows, cutoffs)
    rows = _data(grid).where(F.col("c0").isin(*batches)).withColumns({"_s": normalise(F.col("c3")), "_m": normalise(F.col("c5"))})
    school, _ = split_school(F.col("_s"))
    return rows.select(
        (F.lit(1).cast("long") * FEED + F.col("_row_idx")).alias("hist_pos"), school.alias("school"), normalise(F.col("c1")).alias("school_cat"),
        F.col("_m").alias("major"), strip_asides(F.col("_m")).alias("stripped"), core_name(F.col("_m")).alias("core"),
        normalise(F.col("c6")).alias("subject"), j.alias("J"), t.alias("T"), F.lit(EARLY).alias("source_table"),
    )


def past_rows(regular: DataFrame, early: DataFrame | None = None) -> DataFrame:
    """Both feeds, the regular one first; copies stay."""
    return regular if early is None else regular.unionByName(early)


def _plan(grid: DataFrame, batches: Sequence[str], label: str | None, normalise: Callable[[Column], Column]) -> DataFrame:
    offer = (F.coalesce("c4", F.lit("")) != "") & (F.coalesce("c5", F.lit("")) != "")
    rows = _data(grid).where(F.col("c0").isin(*batches) & offer & ~out_of_scope(F.col("c1"))).withColumn("_m", normalise(F.col("c5")))
    return rows.select(
        F.col("_row_idx").alias("src_row_idx"), normalise(F.col("c3")).alias("school"), normalise(F.col("c1")).alias("school_cat"), F.col("_m").alias("major"),
        strip_asides(F.col("_m")).alias("stripped"), core_name(F.col("_m")).alias("core"), normalise(F.col("c6")).alias("subject"),
        (F.col("c0") if label is None else F.lit(label)).alias("batch"), F.col("c0").alias("raw_batch"),
    )


def plan_regular(grid: DataFrame, normalise: Callable[[Column], Column] = fold) -> DataFrame:
    return _plan(grid, (PLAN_REGULAR,), None, normalise)


def plan_early(grid: DataFrame, batches: Sequence[str] = PLAN_EARLY, normalise: Callable[[Column], Column] = fold) -> DataFrame:
    """Offers of the early batches under one label; ``raw_batch`` keeps theirs."""
    return _plan(grid, batches, EARLY, normalise)


def plan_rows(grid: DataFrame, batches: Sequence[str] = PLAN_EARLY, normalise: Callable[[Column], Column] = fold) -> DataFrame:
    """All offers; ``feed`` orders regular before early ones."""
    regular = plan_regular(grid, normalise).withColumn("feed", F.lit(0))
    return regular.unionByName(plan_early(grid, batches, normalise).withColumn("feed", F.lit(1)))


def cutoffs_from_notes(grid: DataFrame) -> dict[int, int] | None:
    """The yearly cut-offs of the first cell that tells at least two of them.

    Cells are looked at row by row, column by column; one row comes to the
    driver. None where no cell does."""
    cells = [c for c in grid.columns if c != "_row_idx"]
    long = grid.select("_row_idx", F.posexplode(F.array(*[F.col(c) for c in cells])).alias("_c", "v")).where(F.contains("v", F.lit("一段线")))
    pairs = long.select("_row_idx", "_c", *[F.transform(F.regexp_extract_all("v", F.lit(r"(20\d{2})\s*=\s*(\d{2,3})"), g), lambda x: x.cast("int")).alias(n) for g, n in ((1, "years"), (2, "values"))])
    row = pairs.where(F.size(F.array_distinct("years")) >= 2).orderBy("_row_idx", "_c").first()
    return None if row is None else dict(zip(row["years"], row["values"]))
