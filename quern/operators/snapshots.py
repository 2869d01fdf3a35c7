"""Changes between consecutive full snapshots of a table.

Each record is reduced to (key, snapshot, load time, 96-bit content hash)
before anything is shuffled. One window per record, ordered by the snapshot's
index, then tells everything: a differing lag hash is a change, a gap in the
index is a removal and, at its far end, an addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.lookalike import key


def text_value(name: str) -> Column:
    """Comparison form of a text: missing, '' and blanks are one value."""
    return F.coalesce(key(F.col(name)), F.lit(""))


def number_value(name: str, scale: int = 2) -> Column:
    """Comparison form of a number: NULL and NaN are one value, -0.0 is 0.0."""
    v = F.col(name).cast("double")
    return F.coalesce(F.round(F.when(F.isnan(v), None).otherwise(v), scale) + F.lit(0.0), F.lit(float("-inf"))).cast("string")


def snapshot_changes(
    rows: DataFrame,
    keys: Sequence[str],
    texts: Sequence[str],
    numbers: Sequence[str] = (),
    *,
    snapshot: str = "snapshot_no",
    loaded: str = "loaded_at",
    scale: int = 2,
) -> DataFrame:
    """(snapshot, *keys, change_kind) for every record added, removed or changed.

    ``snapshot`` in the result is the later of two consecutive snapshots that
    are present; the first one present yields nothing. Within a snapshot the row
    of a record with the latest ``loaded`` stands (NULL counts as earliest;
    among ties the greatest content hash stands, so reruns agree). Texts are
    compared by ``lookalike.key``, numbers at ``scale`` decimals; other columns
    don't count. NULL keys are values like any other and come out as NULL; rows
    without a snapshot number have no place in the order and are left out. An
    empty table yields no rows.
    """
    content = [text_value(c) for c in texts] + [number_value(c, scale) for c in numbers]
    lean = rows.where(F.col(snapshot).isNotNull()).select(
        F.col(snapshot).alias("_snap"),
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct(F.col(loaded).alias("at"), F.xxhash64(*content).alias("h1"), F.hash(*content).alias("h2")).alias("_v"),
    )
    ks = [f"_k{i}" for i in range(len(keys))]
    # copies of one record collapse before the shuffle (partial aggregation)
    last = lean.groupBy("_snap", *ks).agg(F.max("_v").alias("_v"))
    order = Window.orderBy("_snap")  # over the distinct snapshot numbers only
    index = (
        rows.select(F.col(snapshot).alias("_snap")).where(F.col("_snap").isNotNull()).distinct()
        .withColumn("_i", F.row_number().over(order))
        .withColumn("_next", F.lead("_snap").over(order))
    )
    per_key = Window.partitionBy(*ks).orderBy("_i")
    seen = last.join(index, "_snap").withColumns(
        {
            "_pi": F.lag("_i").over(per_key),
            "_pv": F.lag("_v").over(per_key),
            "_ni": F.lead("_i").over(per_key),
        }
    )
    differs = (F.col("_v.h1") != F.col("_pv.h1")) | (F.col("_v.h2") != F.col("_pv.h2"))
    here = (
        F.when((F.col("_i") > 1) & (F.col("_pi").isNull() | (F.col("_pi") < F.col("_i") - 1)), F.lit("added"))
        .when(F.col("_pi").isNotNull() & differs, F.lit("changed"))
    )
    gone = F.when(F.col("_next").isNotNull() & (F.col("_ni").isNull() | (F.col("_ni") > F.col("_i") + 1)), F.lit("removed"))
    found = F.filter(
        F.array(
            F.struct(F.col("_snap").alias("s"), here.alias("kind")),
            F.struct(F.col("_next").alias("s"), gone.alias("kind")),
        ),
        lambda x: x["kind"].isNotNull(),
    )
    return seen.select(*ks, F.explode(found).alias("_f")).select(
        F.col("_f.s").alias(snapshot),
        *[F.col(a).alias(k) for a, k in zip(ks, keys)],
        F.col("_f.kind").alias("change_kind"),
    )
