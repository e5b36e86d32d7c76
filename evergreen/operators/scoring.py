"""Weighted mean over the sources a song could have appeared in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_mean(dims: list[tuple[str, float, int | None]], year: Column) -> Column:
    """``dims``: (score column, weight, first tracked year).

    A dimension counts, in numerator and denominator, only for years from its
    start on.  A missing score of a counting dimension is 0; with no counting
    dimension the result is 0.
    """
    known = F.coalesce(year, F.lit(0))
    total, weight = F.lit(0.0), F.lit(0.0)
    for col, w, start in dims:
        score = F.coalesce(F.col(col), F.lit(0.0)) * w
        counts = F.lit(True) if start is None else known >= start
        total = total + F.when(counts, score).otherwise(0.0)
        weight = weight + F.when(counts, F.lit(w)).otherwise(0.0)
    return F.when(weight > 0, total / weight).otherwise(F.lit(0.0))


def with_floor(df: DataFrame, value: str, floor: str, flag: str) -> DataFrame:
    """Fill a missing ``value`` with its known lower bound and flag the rows filled."""
    return df.withColumns(
        {
            flag: F.col(value).isNull() & F.col(floor).isNotNull(),
            value: F.coalesce(value, floor),
        }
    ).drop(floor)
