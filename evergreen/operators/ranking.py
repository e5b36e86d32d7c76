"""Scaling, ordering and top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evergreen.session import materialize


def round_even(c: Column, digits: int) -> Column:
    """Scale, round half to even, scale back (the order of operations fixes the last bit)."""
    return F.rint(c * float(10**digits)) / float(10**digits)


def scale_to_100(df: DataFrame, col: str) -> DataFrame:
    """Divide by the largest value, times 100, two digits; unchanged unless that value is positive.

    The maximum is a scalar subquery, so ``df`` is not moved.  ``df`` is read
    twice: pass a written table.
    """
    top = df.agg(F.max(col)).scalar()
    scaled = round_even(F.col(col) / top * 100, 2)
    return df.withColumn(col, F.when(top > 0, scaled).otherwise(F.col(col)))


def ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """Dense 1..N positions of the whole table in ``order``, which must be total.

    Spark sorts into range partitions; each row's place inside its partition is
    frozen in a written table, and the row counts of the preceding partitions
    (one row per partition, hence small) are added.  No task sees all rows.
    """
    local = (1 << 33) - 1
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = (F.col("_offset") + F.col("_at").bitwiseAND(local) + 1).cast("bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(position.alias(rank), *df.columns)
    )


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_ranked(df: DataFrame, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows with positions; the window runs over at most ``n`` rows."""
    kept = top_n(df, order, n)
    return kept.select(F.row_number().over(W.orderBy(*order)).cast("bigint").alias(rank), *df.columns)


def top_n_by(df: DataFrame, value: str, ties: list[str], n: int) -> DataFrame:
    """The ``n`` largest non-null values."""
    return top_n(df.filter(F.col(value).isNotNull()), [F.col(value).desc(), *[F.col(t) for t in ties]], n)


def candidate_pool(df: DataFrame, scores: list[str], keep: list[str], ties: list[str], n: int) -> DataFrame:
    """Distinct union of the top ``n`` by each score."""
    pools = [top_n_by(df, s, ties, n).select(*keep) for s in scores]
    out = pools[0]
    for p in pools[1:]:
        out = out.union(p)
    return out.distinct()
