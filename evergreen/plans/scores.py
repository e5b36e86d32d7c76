"""The ranking itself: sources → one row per song → scores → rank."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.config import MeasureDim, Settings
from evergreen.operators.cluster import cluster_changes, to_canonical
from evergreen.operators.dedup import union_in_order
from evergreen.operators.percentile import decade, group_percentiles
from evergreen.operators.ranking import ranked, scale_to_100
from evergreen.operators.scoring import weighted_mean, with_floor
from evergreen.session import materialize
from evergreen.sources.chart import KEYS, chart_scored
from evergreen.sources.measures import floor_table, measure_source

CHART_COLUMNS = ["bb_score", "bb_peak", "bb_chart_weeks", "year"]
RAW_COLUMNS = ["source", *KEYS, "title", "artist", "value", "authoritative", *CHART_COLUMNS]


@dataclass(frozen=True)
class Sources:
    """Raw inputs.  An absent one is left out and contributes no dimension.

    ``chart``: date, title, artist, peak_pos, weeks_on_chart, ord.  Each measure
    (by the name of its MeasureDim): title, artist, ord and its value column.
    Playlists (by name): title, artists.
    """

    chart: DataFrame | None = None
    measures: dict[str, DataFrame] = field(default_factory=dict)
    playlists: dict[str, DataFrame] = field(default_factory=dict)
    #: The chart's scored songs, if they are there already as a written table.
    scored_chart: DataFrame | None = None

    def dims(self, settings: Settings) -> list[MeasureDim]:
        return [m for m in settings.measures if m.name in self.measures]


def _chart_part(sources: Sources, settings: Settings) -> DataFrame:
    scored = sources.scored_chart if sources.scored_chart is not None else chart_scored(sources.chart, settings)
    return scored.select(
        F.lit("chart").alias("source"),
        *KEYS,
        "title",
        "artist",
        F.lit(None).cast("bigint").alias("value"),
        F.lit(False).alias("authoritative"),
        *CHART_COLUMNS,
    )


def _measure_part(raw: DataFrame, dim: MeasureDim, settings: Settings) -> DataFrame:
    best = measure_source(raw, dim, settings, flag_plain=dim.trusted)
    return best.select(
        F.lit(dim.name).alias("source"),
        *KEYS,
        "title",
        "artist",
        F.col(dim.value_col).alias("value"),
        (F.col("authoritative") if dim.trusted else F.lit(False)).alias("authoritative"),
        F.lit(None).cast("double").alias("bb_score"),
        *[F.lit(None).cast("int").alias(c) for c in CHART_COLUMNS[1:]],
    )


def source_rows(sources: Sources, settings: Settings) -> DataFrame:
    """All sources, one row per key and source, numbered in order of precedence.

    Each source is written by itself, so that the shuffles of one are gone before the next begins.
    """
    parts = []
    if sources.chart is not None:
        chart = _chart_part(sources, settings)
        parts.append(chart if sources.scored_chart is not None else materialize(chart, "rows"))
    parts += [materialize(_measure_part(sources.measures[d.name], d, settings), "rows") for d in sources.dims(settings)]
    if not parts:
        raise ValueError("no source given")
    return union_in_order(parts, "source_ord")


def clustered_rows(sources: Sources, settings: Settings) -> DataFrame:
    """Source rows under the key of their cluster; ``own_artist`` is the key before."""
    rows = source_rows(sources, settings)
    return to_canonical(rows, cluster_changes(rows, settings.aliases))


def _best(fields: list[str], when: Column, order: Column) -> Column:
    """Fields of the first row in ``order`` among the rows of one source (null when it has none)."""
    return F.min_by(F.struct(*fields), F.when(when, order))


def merge_sources(
    rows: DataFrame, sources: Sources, settings: Settings, floors: DataFrame | None = None
) -> DataFrame:
    """One row per song: credit, chart facts, every measure, and its floor.

    The song list is the union of all keys, so every source row meets its song.
    That makes the whole merge one aggregation, and one shuffle, of the stacked
    rows; floors ride along as rows that cannot create a song.
    """
    dims = sources.dims(settings)
    is_song = F.col("source") != "floor"
    if floors is not None and dims:
        rows = rows.unionByName(
            floors.select(F.lit("floor").alias("source"), *KEYS, F.col("floor").alias("value")),
            allowMissingColumns=True,
        )
    by_size = F.struct(F.col("value").isNull(), -F.col("value"), F.col("own_artist"))
    by_score = F.struct(-F.col("bb_score"), F.col("own_artist"))
    credit = ["title", "artist"]
    aggs = [F.bool_or(is_song).alias("_is_song"), F.max(F.when(~is_song, F.col("value"))).alias("_floor")]
    if sources.chart is not None:
        aggs.append(_best([*credit, *CHART_COLUMNS], F.col("source") == "chart", by_score).alias("_chart"))
    for d in dims:
        aggs.append(_best([*credit, "value", "authoritative"], F.col("source") == d.name, by_size).alias(f"_{d.name}"))
    grouped = rows.groupBy(*KEYS).agg(*aggs).filter("_is_song")

    order = (["_chart"] if sources.chart is not None else []) + [f"_{d.name}" for d in dims]
    trusted = [F.when(F.col(f"_{d.name}.authoritative"), F.col(f"_{d.name}")) for d in dims if d.trusted]
    picks = {c: F.coalesce(*[t[c] for t in trusted], *[F.col(f"{o}.{c}") for o in order]) for c in credit}
    chart = (
        [F.col(f"_chart.{c}") for c in CHART_COLUMNS]
        if sources.chart is not None
        else [F.lit(None).cast("int").alias("year")]
    )
    songs = grouped.select(
        *KEYS,
        *[c.alias(n) for n, c in picks.items()],
        *chart,
        *[F.col(f"_{d.name}.value").alias(d.value_col) for d in dims],
        "_floor",
    )
    for d in dims:
        if d.trusted:
            return with_floor(songs, d.value_col, "_floor", f"{d.value_col}_is_floor")
    return songs.drop("_floor")


def merged_songs(sources: Sources, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    """Merged songs with their decade, floors applied; ``rows`` are the clustered rows if already there."""
    if rows is None:
        rows = clustered_rows(sources, settings)
    songs = merge_sources(rows, sources, settings, floor_table(sources.playlists, settings))
    return songs.withColumn("decade", decade(F.col("year")))


def song_list(sources: Sources, settings: Settings) -> DataFrame:
    """Distinct songs under their preferred credit."""
    return merge_sources(clustered_rows(sources, settings), sources, settings).select("title", "artist")


def score_songs(songs: DataFrame, sources: Sources, settings: Settings, **limits: int) -> DataFrame:
    """Era percentiles and the unscaled weighted mean ``final_score`` for merged songs.

    ``songs`` is read more than once: pass a written table.
    """
    dims = sources.dims(settings)
    scored = group_percentiles(songs, KEYS, "decade", {d.value_col: d.score_col for d in dims}, **limits)
    parts = [("bb_score", settings.chart_weight, None)] if sources.chart is not None else []
    parts += [(d.score_col, d.weight, d.start_year) for d in dims]
    return scored.withColumn("final_score", weighted_mean(parts, F.col("year")))


def rank_songs(weighted: DataFrame) -> DataFrame:
    """Scale to a best score of 100 and number all songs; ``weighted`` is a written table."""
    order = [F.col("final_score").desc(), F.col("key_title"), F.col("key_artist")]
    return ranked(scale_to_100(weighted, "final_score"), order)


def ranked_songs(sources: Sources, settings: Settings | None = None) -> DataFrame:
    """All songs with rank 1..N, scaled to a best score of 100."""
    settings = settings or Settings()
    songs = materialize(merged_songs(sources, settings), "songs")
    return rank_songs(materialize(score_songs(songs, sources, settings), "weighted"))
