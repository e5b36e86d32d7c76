"""Track exports with varying headers, and the link lookups built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evergreen.functions.parse import release_year, track_url
from evergreen.functions.text import link_title_key, primary_artist
from evergreen.operators.dedup import first_per_key
from evergreen.sources.files import EXPORT_REQUIRED, EXPORT_SYNONYMS, carried, read_text_columns, to_number


def canonical_export(df: DataFrame) -> DataFrame | None:
    """Map header synonyms to canonical columns, or None when a required one is missing."""
    chosen = {name: next((c for c in options if c in df.columns), None) for name, options in EXPORT_SYNONYMS.items()}
    if any(chosen[name] is None for name in EXPORT_REQUIRED):
        return None
    cols = [
        (F.lit(None) if header is None else F.col(f"`{header}`")).cast("string").alias(name)
        for name, header in chosen.items()
    ]
    return df.select(*cols, *carried(df))


def union_exports(frames: list[DataFrame]) -> DataFrame:
    """All usable exports; the position of a file in the list is its precedence."""
    usable = [f for f in map(canonical_export, frames) if f is not None]
    if not usable:
        raise ValueError("no export has the required columns")
    return reduce(DataFrame.unionByName, [f.withColumn("file_ord", F.lit(i)) for i, f in enumerate(usable)])


def read_exports(spark: SparkSession, paths: list[str], rescue: bool = False) -> DataFrame:
    """Exports read from files in sorted path order; ``rescue`` keeps the lines of malformed rows."""
    return union_exports([read_text_columns(spark, p, rescue=rescue) for p in sorted(paths)])


def link_rows(exports: DataFrame) -> DataFrame:
    """Keyed links: kt, kp, spotify_url, duration_ms, release_year, file_ord, ord."""
    known = exports.filter(F.col("title").isNotNull() & F.col("artist").isNotNull())
    return known.select(
        link_title_key(F.col("title")).alias("kt"),
        primary_artist(F.col("artist")).alias("kp"),
        track_url(F.col("uri")).alias("spotify_url"),
        to_number(F.col("duration_ms"), "bigint").alias("duration_ms"),
        release_year(F.col("release_date")).alias("release_year"),
        "file_ord",
        "ord",
    )


def links_by_pair(links: DataFrame) -> DataFrame:
    """First link per (title, primary artist)."""
    return first_per_key(links, ["kt", "kp"], ["file_ord", "ord", "spotify_url"])


def links_by_title(by_pair: DataFrame) -> DataFrame:
    """Links of titles held by exactly one primary artist.

    ``by_pair`` has one row per artist of a title, so counting its rows counts artists.
    """
    rest = [c for c in by_pair.columns if c != "kt"]
    return (
        by_pair.groupBy("kt")
        .agg(F.count(F.lit(1)).alias("_artists"), F.min_by(F.struct(*rest), "kp").alias("_row"))
        .filter(F.col("_artists") == 1)
        .select("kt", "_row.*")
    )
