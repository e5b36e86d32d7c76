"""Lookup join that splits hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
#: At most this many keys are split by a sketch, and a key is split into at most so many parts.
MOST_HOT = 1024
TRACKED = 1 << 15


def heavy_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_hash, _copies): the hashes of the keys with the most rows, from one pass with a sketch of bounded size.

    A key counts as heavy from ``hot_rows`` rows, or one in ``MOST_HOT`` of all rows if that is
    more: so there are at most ``MOST_HOT`` of them, whatever the size.  The sketch of ``TRACKED``
    items is off by a few parts in ``TRACKED`` of all rows; that only moves the limit.
    Rows are folded to the sketch where they lie, none are shuffled.
    """
    hashed = rows.select(F.xxhash64(*keys).alias("_hash"))
    top = hashed.agg(
        F.expr(f"approx_top_k(_hash, {MOST_HOT}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_all")
    )
    least = F.greatest(F.lit(hot_rows), F.ceil(F.col("_all") / MOST_HOT))
    found = top.select(F.explode("_top").alias("_t"), least.alias("_least")).filter("_t.count > _least")
    return found.select(F.col("_t.item").alias("_hash"), F.ceil(F.col("_t.count") / F.col("_least")).cast("int").alias("_copies"))


def counted_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join with a ``lookup`` of one row per key that says itself, as ``n``, how many ``rows`` its key has."""
    copies = F.ceil(F.col("n") / hot_rows).cast("int")
    hot = F.broadcast(lookup.filter(F.col("n") > hot_rows).select(*keys, copies.alias("_copies")))
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_copies", F.lit(1))).cast("int")
    salted = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_copies")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1))).drop("n")
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")


def sketch_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``skew_join`` where the rows of a key have not been counted: hot keys come from ``heavy_keys``.

    ``rows`` are read twice, once for their keys alone; they are shuffled once.
    """
    hot = F.broadcast(heavy_keys(rows, keys, hot_rows))
    copies = F.coalesce("_copies", F.lit(1))
    salted = rows.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), copies).cast("int")).drop("_copies", "_hash")
    repeated = lookup.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies", "_hash")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def skew_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    counts: DataFrame,
    spread_by: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (at most one row per key) without hot partitions.

    ``counts`` holds (keys, n) with n at least the number of ``rows`` of the key.
    A key with more than ``hot_rows`` rows is spread over ceil(n / hot_rows)
    salts by the hash of ``spread_by``, and its lookup row is repeated once per
    salt.  At most sum(n) / hot_rows keys can be hot, which bounds the broadcast
    list.  All other rows have salt 0; nothing is dropped.  The plan is the same at
    every size: where no key is hot, the list is empty.
    """
    hot = F.broadcast(
        counts.filter(F.col("n") > hot_rows).select(*keys, F.ceil(F.col("n") / hot_rows).cast("int").alias("_copies"))
    )
    salt = F.when(F.col("_copies").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.col("_copies")).cast("int")
    )
    salted = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_copies")
    repeated = (
        lookup.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
        .drop("_copies")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
