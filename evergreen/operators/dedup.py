"""One row per key, as aggregates.

Each survivor is picked by an explicit total order, so the choice never depends on
partitioning, and map-side partial aggregation reduces a hot key to one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.functions.text import has_word
from evergreen.operators.order import order_image
from evergreen.operators.skew import HOT_ROWS, counted_join, skew_join


def _least_row(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of every key, folded row by row; such buffers are sorted, not hashed."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def first_per_key(
    df: DataFrame, keys: list[str], order: list[str | Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The first row of every key in ``order`` (which must break all ties).

    In two steps: the least image of the order per key, a number of fixed width, comes
    from a hash aggregate; a join then brings back the rows that have it.  Rows with one
    image, which their order's later parts tell apart, are folded one by one.  A key with
    many rows is folded where they lie, and only its few least rows meet; where many share the
    image they are split.  ``df`` is read twice.  An order that starts with a text has no
    image and is folded in one step.
    """
    image = order_image(df, order)
    if image is None:
        return _least_row(df, keys, order)
    marked = df.withColumns({"_keys": F.struct(*keys), "_image": image})
    least = marked.groupBy("_keys").agg(F.min("_image").alias("_image"), F.count(F.lit(1)).alias("n"))
    spread_by = [c for c in df.columns if c not in keys] or keys
    found = counted_join(marked, least, ["_keys", "_image"], spread_by, hot_rows)
    return _least_row(found.select(*df.columns), keys, order)


def largest_first(value: str) -> list[Column]:
    """Sort key for "largest value first, nulls last" under ascending order."""
    return [F.col(value).isNull().alias("_missing"), (-F.col(value)).alias("_negated")]


def best_per_key(df: DataFrame, keys: list[str], value: str, ties: list[str]) -> DataFrame:
    """The row with the largest ``value`` per key; ``ties`` break equal values, ascending.

    In one step, as a source is read once: its rows are counted while they are read.
    """
    return _least_row(df, keys, [*largest_first(value), *ties])


def best_with_authority(
    df: DataFrame, keys: list[str], value: str, ties: list[str], word: str, title: str = "title"
) -> DataFrame:
    """Best row per key plus ``authoritative``: a plain winner that beat a variant sibling."""
    rest = [c for c in df.columns if c not in keys]
    variant = has_word(F.col(title), word)
    return (
        df.withColumn("_variant", variant)
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct(*rest, "_variant"), F.struct(*largest_first(value), *ties)).alias("_row"),
            F.bool_or("_variant").alias("_any_variant"),
        )
        .select(*keys, "_row.*", "_any_variant")
        .withColumn("authoritative", F.col("_any_variant") & ~F.col("_variant"))
        .select(*df.columns, "authoritative")
    )


def authoritative_rows(
    df: DataFrame, keys: list[str], word: str, spread_by: list[str], title: str = "title", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Flag every plain row that shares its key with a variant row.

    The group-wide fact is aggregated and joined back with hot keys split, so
    no window task has to buffer a whole group.
    """
    flagged = df.withColumn("_variant", has_word(F.col(title), word))
    groups = (
        flagged.groupBy(*keys)
        .agg(F.bool_or("_variant").alias("_any_variant"), F.count(F.lit(1)).alias("n"))
        .filter("_any_variant")
    )
    return (
        skew_join(flagged, groups.drop("n"), keys, groups.drop("_any_variant"), spread_by, "left", hot_rows)
        .withColumn("authoritative", F.col("_any_variant").isNotNull() & ~F.col("_variant"))
        .select(*df.columns, "authoritative")
    )


def union_in_order(frames: list[DataFrame], order_col: str) -> DataFrame:
    """Union by name, numbering the inputs so that precedence survives the shuffle."""
    numbered = [f.withColumn(order_col, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def unseen(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``stored`` lacks; keys with nulls count as equal, too."""
    known = stored.select(F.struct(*keys).alias("_key")).distinct()
    return new.withColumn("_key", F.struct(*keys)).join(known, "_key", "left_anti").drop("_key")


def append_new(
    existing: DataFrame, new: DataFrame, keys: list[str], order: list[str | Column] | None = None
) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key it lacks, one per new key.

    The first row of a key in ``order`` is taken (by default in the order of the other
    columns).  Repeats of a key go before the rows meet what is stored.
    """
    first = first_per_key(new, keys, order or [c for c in new.columns if c not in keys])
    return existing.unionByName(unseen(first, existing, keys))
