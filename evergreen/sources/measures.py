"""Per-song totals and playlists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.config import MeasureDim, Settings
from evergreen.functions.text import apply_aliases, artist_key, first_of_list, title_key, with_keys
from evergreen.operators.dedup import best_per_key, best_with_authority
from evergreen.sources.files import to_number

KEYS = ["key_title", "key_artist"]


def measure_rows(raw: DataFrame, dim: MeasureDim, settings: Settings) -> DataFrame:
    """Keyed totals: key_title, key_artist, title, artist, ord, value column."""
    typed = raw.select("title", "artist", "ord", to_number(F.col(dim.value_col), "bigint").alias(dim.value_col))
    return with_keys(typed, settings.aliases).select(*KEYS, "title", "artist", "ord", dim.value_col)


def measure_source(raw: DataFrame, dim: MeasureDim, settings: Settings, flag_plain: bool = False) -> DataFrame:
    """One row per key with the largest total; optionally flags trusted plain titles."""
    keyed = measure_rows(raw, dim, settings)
    ties = ["ord", "title", "artist"]
    if flag_plain:
        return best_with_authority(keyed, KEYS, dim.value_col, ties, settings.variant_word)
    return best_per_key(keyed, KEYS, dim.value_col, ties)


def playlist_keys(raw: DataFrame, settings: Settings) -> DataFrame:
    """Distinct keys of a playlist; the first listed artist stands for the track."""
    known = raw.filter(F.col("title").isNotNull() & F.col("artists").isNotNull())
    keyed = known.select(
        title_key(F.col("title")).alias("key_title"), artist_key(first_of_list(F.col("artists"))).alias("key_artist")
    )
    return apply_aliases(keyed, "key_artist", settings.aliases).distinct()


def floor_table(playlists: dict[str, DataFrame], settings: Settings) -> DataFrame | None:
    """(keys, floor): the first configured playlist that holds the key decides."""
    frames = [
        playlist_keys(playlists[f.playlist], settings).select(
            *KEYS, F.lit(i).alias("priority")
        )
        for i, f in enumerate(settings.floors)
        if f.playlist in playlists
    ]
    if not frames:
        return None
    first = reduce(DataFrame.unionByName, frames).groupBy(*KEYS).agg(F.min("priority").alias("priority"))
    floor = F.element_at(F.array(*[F.lit(f.value).cast("bigint") for f in settings.floors]), F.col("priority") + 1)
    return first.select(*KEYS, floor.alias("floor"))


def in_playlist(songs: DataFrame, keys: DataFrame, flag: str) -> DataFrame:
    """Flag the songs whose key is in a playlist's distinct keys."""
    return songs.join(keys.select(*KEYS, F.lit(True).alias(flag)), KEYS, "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )
