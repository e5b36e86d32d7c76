"""Era percentiles from histograms.

Both percentiles depend only on how many rows of the cohort lie below, at and
above a value.  Rows are therefore first counted per (group, value), the counts
are accumulated in value order, and the result is looked up again.  No range
join, and no window over raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evergreen.operators.order import ordered_double
from evergreen.operators.skew import HOT_ROWS, skew_join

DIGIT_BITS = 21
FRACTIONAL = ("float", "double", "decimal")
WHOLE = ("tinyint", "smallint", "int", "bigint")


def histogram(df: DataFrame, group: list[str], value: str) -> DataFrame:
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))


def running_counts(hist: DataFrame, group: list[str], value: str, value_bits: int = 63) -> DataFrame:
    """Add ``below`` (rows of the group with a smaller value) and ``total`` (rows of the group).

    A cumulative sum over an unbounded number of distinct values must not sit in
    one task.  Values are cut into 21-bit digits: counts accumulate inside each
    block of equal higher digits, and recursively over the blocks, so that no
    window partition ever holds more than 2^21 rows, or 2^22 where values of both signs
    meet.  Doubles are cut as the whole numbers of their bits, in the same order: -0.0
    equals 0.0, and NaN stands above all others.  ``value_bits`` states the expected width of
    whole numbers and saves levels; it never changes the result.
    """
    if dict(hist.dtypes)[value] == "double":
        image = f"_bits_{value}"
        counted = running_counts(hist.withColumn(image, ordered_double(F.col(value))), group, image)
        return counted.select(*hist.columns, "below", "total")
    ordered = W.partitionBy(*group).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    if value_bits <= DIGIT_BITS:
        return hist.withColumns(
            {
                "below": F.coalesce(F.sum("n").over(ordered), F.lit(0)),
                "total": F.sum("n").over(W.partitionBy(*group)),
            }
        )
    high = f"_high_{value}"
    block = [*group, high]
    cut = hist.withColumn(high, F.shiftright(value, DIGIT_BITS))
    blocks = cut.groupBy(*block).agg(F.sum("n").alias("n"))
    offsets = running_counts(blocks, group, high, value_bits - DIGIT_BITS).select(
        *block, F.col("below").alias("_offset"), "total"
    )
    inside = W.partitionBy(*block).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, block)
        .withColumn("below", F.col("_offset") + F.col("_inside"))
        .select(*hist.columns, "below", "total")
    )


def mid_rank(higher_is_better: bool | Column) -> Column:
    """(beaten + half the ties) / cohort size."""
    above = F.col("total") - F.col("below") - F.col("n")
    flag = F.lit(higher_is_better) if isinstance(higher_is_better, bool) else higher_is_better
    beaten = F.when(flag, F.col("below")).otherwise(above)
    return (beaten + F.col("n") * 0.5) / F.col("total")


def average_rank() -> Column:
    """Average rank of tied rows / group size."""
    return (F.col("below") + (F.col("n") + 1) / 2) / F.col("total")


def _long(df: DataFrame, keys: list[str], group: str, metrics: list[str]) -> DataFrame:
    """One (keys, group, metric, value) row per non-null measure.

    Whole numbers stay whole; if a measure has fractions, all values are doubles.
    """
    kinds = {m: dict(df.dtypes)[m].split("(")[0] for m in metrics}
    if bad := {m: k for m, k in kinds.items() if k not in WHOLE + FRACTIONAL}:
        raise TypeError(f"measures must be numbers: {bad}")
    kind = "double" if any(k in FRACTIONAL for k in kinds.values()) else "bigint"
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast(kind).alias("value")) for m in metrics])
    exploded = df.select(*keys, F.col(group).alias("cohort"), F.explode(pairs).alias("_p"))
    return exploded.select(*keys, "cohort", "_p.*").filter(F.col("value").isNotNull())


def rolling_cohorts(hist: DataFrame, half_window: int) -> DataFrame:
    """Histogram in which every year also counts the rows of its neighbours."""
    years = F.sequence(F.col("cohort") - half_window, F.col("cohort") + half_window)
    return (
        hist.withColumn("cohort", F.explode(years))
        .groupBy("metric", "cohort", "value")
        .agg(F.sum("n").alias("n"))
    )


def _attach(
    df: DataFrame,
    keys: list[str],
    outputs: Mapping[str, str],
    long: DataFrame,
    hist: DataFrame,
    lookup: DataFrame,
    hot_rows: int,
) -> DataFrame:
    """Look the percentiles up for every row of ``df``.

    The narrow long form meets the lookup in a salted join, and the result is folded
    back to one row per key.
    """
    found = skew_join(
        long, lookup, ["metric", "cohort", "value"], hist, spread_by=keys, how="inner", hot_rows=hot_rows
    )
    folded = found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("pct"))).alias(out) for m, out in outputs.items()]
    )
    return df.join(folded, keys, "left")


def rolling_percentiles(
    df: DataFrame,
    keys: list[str],
    year: str,
    outputs: Mapping[str, str],
    higher_is_better: set[str],
    half_window: int,
    value_bits: int = 63,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mid-rank percentile of each metric among rows within ``half_window`` years.

    ``outputs`` maps metric columns to result columns.  ``df`` is read more than
    once, so pass a written table; ``keys`` must be unique in it.
    """
    long = _long(df, keys, year, list(outputs))
    hist = histogram(long, ["metric", "cohort"], "value")
    counted = running_counts(rolling_cohorts(hist, half_window), ["metric", "cohort"], "value", value_bits)
    up = F.col("metric").isin(*higher_is_better) if higher_is_better else F.lit(False)
    lookup = counted.select("metric", "cohort", "value", mid_rank(up).alias("pct"))
    return _attach(df, keys, outputs, long, hist, lookup, hot_rows)


def group_percentiles(
    df: DataFrame,
    keys: list[str],
    group: str,
    outputs: Mapping[str, str],
    value_bits: int = 63,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Average-rank percentile of each metric within its group; nulls stay null and uncounted."""
    long = _long(df, keys, group, list(outputs))
    hist = histogram(long, ["metric", "cohort"], "value")
    counted = running_counts(hist, ["metric", "cohort"], "value", value_bits)
    lookup = counted.select("metric", "cohort", "value", average_rank().alias("pct"))
    return _attach(df, keys, outputs, long, hist, lookup, hot_rows)


def decade(year: Column) -> Column:
    """First year of the decade; an unknown year falls in decade 0."""
    return (F.floor(F.coalesce(year, F.lit(0)) / 10) * 10).cast("int")
