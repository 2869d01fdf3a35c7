"""Positions, slices and first-wins in a stated order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import settle


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The first row per key in ``order``; other columns are kept. Aggregation,
    not a window, so copies collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(order.alias("_o"), F.struct(*rest).alias("_r"))).alias("_b"))
    return best.select(*keys, *[F.col(f"_b._r.`{c}`").alias(c) for c in rest]).select(*df.columns)


def positions(df: DataFrame, order: Sequence[str], name: str = "pos") -> DataFrame:
    """Adds the 1-based place of every row in ``order`` (which must be a key).

    Rows are range-partitioned and sorted; only one count per partition is
    looked at to number them on, so no task sees all rows."""
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    ranged = settle(ranged, "positions")
    counts = ranged.groupBy("_part").count()
    before = counts.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(before, "_part").withColumn(name, F.col("_rn") + F.col("_before")).drop("_part", "_rn", "_before")


def batches(df: DataFrame, order: Sequence[str], size: int = 20, name: str = "batch_no") -> DataFrame:
    """Adds the 1-based number of consecutive slices of ``size`` rows; a size of
    0 or less puts all rows in one slice."""
    if size <= 0:
        return df.withColumn(name, F.lit(1).cast("long"))
    return positions(df, order, "_pos").withColumn(name, F.ceil(F.col("_pos") / F.lit(size)).cast("long")).drop("_pos")


def stable_sample(df: DataFrame, key: str, n: int = 30, seed: int = 20260623) -> DataFrame:
    """``n`` rows by the order of a seeded hash of their key: the same rows on
    every run, whatever the partitioning."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).orderBy("_h", key).limit(n).drop("_h")
