"""Resumable loading: keep what is stored, append only unseen keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from evergreen.operators.dedup import first_per_key, unseen

PART = "_part"


def part_of(key: str, parts: int) -> Column:
    """The folder of a row: its leading key's hash, so that a table of many keys has few folders."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias(PART)


def stored_rows(spark: SparkSession, table_path: str, like: DataFrame, parts: int | None = None) -> DataFrame | None:
    """The stored table in the columns of ``like``, and its folder column if it has folders; None before the first batch."""
    schema = like.schema if parts is None else StructType([*like.schema.fields, StructField(PART, IntegerType())])
    try:
        return spark.read.schema(schema).parquet(table_path)
    except Exception as e:  # noqa: BLE001 - the first batch finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def unstored(batch: DataFrame, table_path: str, keys: list[str], parts: int) -> DataFrame:
    """The rows of ``batch`` (one per key) whose key the folders of its own keys lack, with their folder.

    The folders that the batch falls into, at most ``parts`` of them, are listed first: the
    scan of the stored table is cut to them before it starts.
    """
    placed = batch.withColumn(PART, part_of(keys[0], parts))
    touched = [r[0] for r in placed.select(PART).distinct().collect()]
    stored = stored_rows(batch.sparkSession, table_path, batch, parts)
    if stored is None:
        return placed
    known = stored.filter(F.col(PART).isin(touched)) if touched else stored.filter("false")
    return unseen(placed, known.select(*keys), keys)


def append_unseen(
    batch: DataFrame, table_path: str, keys: list[str], order: list[str] | None = None, parts: int | None = None
) -> None:
    """Append the rows of ``batch`` whose key the table lacks.  Repeating a batch adds nothing.

    Of rows with one key the first in ``order`` is taken; keys with nulls count as equal.
    With ``parts`` the table lies in so many folders by its leading key (a column
    ``_part``), and a batch reads only the folders that it falls into: new weeks do not
    read the old ones.  A table keeps the number it was begun with.
    """
    fresh = first_per_key(batch, keys, order or [c for c in batch.columns if c not in keys])
    if parts is None:
        stored = stored_rows(batch.sparkSession, table_path, batch)
        if stored is not None:
            fresh = unseen(fresh, stored.select(*keys), keys)
        fresh.write.mode("append").parquet(table_path)
        return
    # Files of a folder are written together, large folders by several tasks.
    rows = unstored(fresh, table_path, keys, parts).hint("rebalance", PART)
    rows.write.mode("append").partitionBy(PART).parquet(table_path)


def ingest(
    stream: DataFrame, table_path: str, keys: list[str], checkpoint: str, parts: int | None = None
) -> StreamingQuery:
    """Drain the available input into ``table_path``; interrupted runs resume from ``checkpoint``."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: append_unseen(batch, table_path, keys, parts=parts))
        .start()
    )
