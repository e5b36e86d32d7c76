"""Landed chart snapshots and payloads, and what is still to be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evergreen.operators.dedup import unseen


def calendar_weeks(bounds: DataFrame, start: Column, end: Column, step_weeks: int) -> DataFrame:
    """Every ``step_weeks`` weeks from start to end inclusive, for each row of ``bounds``."""
    step = F.make_dt_interval(F.lit(7 * step_weeks))
    return bounds.select(F.explode(F.sequence(start, end, step)).alias("week_date"))


def calendar_between(spark: SparkSession, start: str, end: str, step_weeks: int = 4) -> DataFrame:
    return calendar_weeks(spark.range(1), F.lit(start).cast("date"), F.lit(end).cast("date"), step_weeks)


def pending(wanted: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``wanted`` that are not loaded yet."""
    return unseen(wanted, loaded, keys)


def flatten_snapshots(snapshots: DataFrame, keep: list[str], entries: str = "entries") -> DataFrame:
    """One row per entry of a nested snapshot, with its 1-based position."""
    exploded = snapshots.select(*keep, F.posexplode(entries).alias("_pos", "_entry"))
    return exploded.select(*keep, (F.col("_pos") + 1).alias("position"), "_entry.*")


def payload_counts(df: DataFrame, keep: list[str], payload: str, fields: dict[str, str]) -> DataFrame:
    """Counts from a JSON payload; a missing field counts as 0, an error or a bad number makes the whole row 0.

    ``fields`` maps output columns to JSON paths.
    """
    found = {out: F.get_json_object(payload, path) for out, path in fields.items()}
    failed = F.get_json_object(payload, "$.error").isNotNull()
    for text in found.values():
        failed = failed | (text.isNotNull() & text.try_cast("bigint").isNull())
    zero = F.lit(0).cast("bigint")
    cols = [
        F.when(failed, zero).otherwise(F.coalesce(text.try_cast("bigint"), zero)).alias(out) for out, text in found.items()
    ]
    return df.select(*keep, *cols)
