"""Means and deviations across years, rounding and comparison."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The yearly cut-off scores taken where no notes tell others.
CUTOFFS = {2023: 443, 2024: 444, 2025: 441}


def number(col: Column) -> Column:
    """Lenient cast: blanks and anything that isn't a number are NULL."""
    return F.expr("try_cast(NULL AS DOUBLE)") if col is None else col.cast("string").try_cast("double")


def round2(col: Column) -> Column:
    """Two decimals through a decimal number, so that engines agree."""
    return F.round(col.cast("decimal(20,6)"), 2).cast("double")


@F.pandas_udf(DoubleType())
def exact_round2(v: pd.Series) -> pd.Series:
    """Two decimals of the exact binary value, half to even (as CPython)."""
    return v.map(lambda x: round(x, 2), na_action="ignore")


def line_diff(lows: Mapping[int, Column], cutoffs: Mapping[int, int] | None = None) -> tuple[Column, Column]:
    """(mean, population deviation) of low score minus cut-off over the years
    that have both; the deviation needs two years. Row-wise, no shuffle."""
    cut = CUTOFFS if cutoffs is None else cutoffs
    diffs = F.filter(F.array(*[F.lit(None).cast("double"), *[lows[y].cast("double") - F.lit(float(cut[y])) for y in sorted(lows) if y in cut]]), lambda x: x.isNotNull())
    n = F.size(diffs)
    mean = F.when(n > 0, F.aggregate(diffs, F.lit(0.0), lambda a, x: a + x) / n)
    square = F.aggregate(diffs, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return round2(mean), F.when(n >= 2, round2(F.sqrt(square / n)))


def same_number(a: Column, b: Column) -> Column:
    """Equal at two decimals; NULL equals NULL."""
    return round2(a).eqNullSafe(round2(b))


def close_number(a: Column, b: Column, tolerance: float = 0.011) -> Column:
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(F.abs(a - b) <= tolerance)


def short_number(v: Column) -> Column:
    """Up to four decimals without trailing zeros."""
    return F.regexp_replace(F.format_string("%.4f", v), r"\.?0+$", "")
