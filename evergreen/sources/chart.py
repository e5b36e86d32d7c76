"""Weekly chart rows and their aggregate per song."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.config import Settings
from evergreen.functions.text import with_keys
from evergreen.operators.percentile import decade, rolling_percentiles
from evergreen.sources.files import calendar_date, whole_number
from evergreen.session import materialize, remove, write_aside

KEYS = ["key_title", "key_artist"]


def is_unread(raw: DataFrame) -> Column:
    """Whether a raw row's position, weeks or date cannot be read; such rows make no song."""
    parts = calendar_date(raw, "date"), whole_number(raw, "peak_pos"), whole_number(raw, "weeks_on_chart")
    return reduce(lambda a, b: a | b, [p.isNull() for p in parts])


def chart_rows(raw: DataFrame) -> DataFrame:
    """Typed chart rows: date, title, artist, peak_pos, weeks_on_chart, ord → plus year.

    Rows whose position, weeks or date cannot be read are dropped.
    """
    return (
        raw.select(
            calendar_date(raw, "date").alias("date"),
            "title",
            "artist",
            whole_number(raw, "peak_pos").alias("peak_pos"),
            whole_number(raw, "weeks_on_chart").alias("weeks_on_chart"),
            "ord",
        )
        .withColumn("year", F.year("date"))
        .na.drop(subset=["peak_pos", "weeks_on_chart", "year"])
    )


def fold_credits(rows: DataFrame) -> DataFrame:
    """One row per spelled credit and date: first place and best position."""
    return rows.groupBy("title", "artist", "date").agg(F.min("ord").alias("ord"), F.min("peak_pos").alias("peak_pos"))


def chart_aggregate(rows: DataFrame, settings: Settings) -> DataFrame:
    """One row per song: first credit, best position, debut year, distinct chart dates.

    Rows are folded per spelled credit and date first.  That step has only
    fixed-width aggregates, so it hashes on the map side, drops repeated rows,
    and spreads the costlier normalisation evenly.  The exact distinct count
    groups by (song, date) before it groups by song, so a hot song never meets
    a single task with all its rows.
    """
    return _aggregate(fold_credits(rows), settings)


def _aggregate(folded: DataFrame, settings: Settings) -> DataFrame:
    keyed = with_keys(folded, settings.aliases)
    return (
        keyed.groupBy(*KEYS)
        .agg(
            F.min(F.struct("ord", "title", "artist")).alias("_first"),
            F.min("peak_pos").alias("bb_peak"),
            F.year(F.min("date")).alias("year"),
            F.count_distinct("date").cast("int").alias("bb_chart_weeks"),
        )
        .select(*KEYS, "_first.title", "_first.artist", "bb_peak", "year", "bb_chart_weeks")
        .withColumn("decade", decade(F.col("year")))
    )


def chart_scored(raw: DataFrame, settings: Settings, **limits: int) -> DataFrame:
    """Chart aggregate with both rolling percentiles and their weighted mean ``bb_score``."""
    # In two writes, so that the shuffles of the raw rows are gone before the songs are grouped.
    folded, path = write_aside(fold_credits(chart_rows(raw)), "chart-folded")
    songs = materialize(_aggregate(folded, settings), "chart")
    remove(raw.sparkSession, path)
    w = settings.peak_weight
    return rolling_percentiles(
        songs,
        KEYS,
        "year",
        {"bb_peak": "peak_pct", "bb_chart_weeks": "weeks_pct"},
        {"bb_chart_weeks"},
        settings.half_window,
        value_bits=31,
        **limits,
    ).withColumn("bb_score", F.lit(w) * F.col("peak_pct") + F.lit(1 - w) * F.col("weeks_pct"))
