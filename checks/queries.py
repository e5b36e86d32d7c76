"""One query per operator, over whole tables."""

from __future__ import annotations

import dataclasses
import os
import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import MEASURE_VIEWS, SETTINGS, export_files, exports, sources, table, view
from evergreen.functions import display as D
from evergreen.functions import parse as P
from evergreen.functions import text as T
from evergreen.operators import cluster, dedup, lookup, percentile, ranking
from evergreen.plans import links as links_plan
from evergreen.plans import reports, run, scores, sinks
from evergreen.session import checkpoint_root, materialize
from evergreen.sources import chart, files, measures, pages, snapshots
from evergreen.sources import exports as export_source
from evergreen.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["key_title", "key_artist"]


# Tables that several queries start from, written once per session, as a run writes
# its scores once and every later step reads them.  ``popularity_index``,
# ``score_missing_source``, ``songs_only`` and ``quick_run`` compute everything themselves.


@lru_cache(maxsize=None)
def _rows(spark: SparkSession, d: str) -> DataFrame:
    return scores.source_rows(sources(spark, d), SETTINGS)


@lru_cache(maxsize=None)
def _chart(spark: SparkSession, d: str) -> DataFrame:
    return materialize(_chart_agg(spark, d), "chart")


@lru_cache(maxsize=None)
def _clustered(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    return materialize(cluster.to_canonical(rows, cluster.cluster_changes(rows, SETTINGS.aliases)), "clustered")


@lru_cache(maxsize=None)
def _songs(spark: SparkSession, d: str) -> DataFrame:
    return materialize(scores.merged_songs(sources(spark, d), SETTINGS, rows=_clustered(spark, d)), "songs")


@lru_cache(maxsize=None)
def _weighted(spark: SparkSession, d: str) -> DataFrame:
    return materialize(scores.score_songs(_songs(spark, d), sources(spark, d), SETTINGS), "weighted")


@lru_cache(maxsize=None)
def _index(spark: SparkSession, d: str) -> DataFrame:
    return scores.rank_songs(_weighted(spark, d))


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), f"evergreen-{name}-{uuid.uuid4().hex}")


def _csv_round_trip(spark: SparkSession, df: DataFrame, order: str | None = None) -> DataFrame:
    path = _scratch(spark, "csv")
    run.write_table(df, path, "csv", order)
    return spark.read.schema(df.schema).options(header=True, escape='"', multiLine=True).csv(path)


def _credits(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct credit of three views."""
    views = [view(spark, d, v).select("artist") for v in ("credit_src", "chart_src", "link_src")]
    return reduce(DataFrame.union, views).distinct()


def _measure_rows(spark: SparkSession, d: str, name: str) -> DataFrame:
    return measures.measure_rows(view(spark, d, MEASURE_VIEWS[name]), SETTINGS.measure(name), SETTINGS)


def _chart_agg(spark: SparkSession, d: str) -> DataFrame:
    return chart.chart_aggregate(chart.chart_rows(view(spark, d, "chart_src")), SETTINGS)


def _chart_scored(spark: SparkSession, d: str) -> DataFrame:
    return chart.chart_scored(view(spark, d, "chart_src"), SETTINGS)


def _all_links(spark: SparkSession, d: str) -> DataFrame:
    return export_source.link_rows(exports(spark, d))


# scans and sources


def scan_chart(spark, d):
    return chart.chart_rows(view(spark, d, "chart_src"))


def scan_measures(spark, d):
    parts = [
        _measure_rows(spark, d, n).withColumnRenamed(SETTINGS.measure(n).value_col, "value").withColumn("source", F.lit(n))
        for n in MEASURE_VIEWS
    ]
    return reduce(DataFrame.unionByName, parts)


def scan_synonyms(spark, d):
    return reduce(DataFrame.unionByName, map(export_source.canonical_export, export_files(spark, d)))


def scan_union_files(spark, d):
    return exports(spark, d)


def scan_mixed_texts(spark, d):
    """Dates and numbers in several spellings, some of them unreadable."""
    return chart.chart_rows(view(spark, d, "mixed_src"))


def scan_csv_exports(spark, d):
    """The exports as CSV folders of several files, read back: the first link per title and artist."""
    root = _scratch(spark, "exports")
    for name, part in zip("ab", export_files(spark, d), strict=True):
        part.orderBy("ord", "`Track URI`").drop("ord").write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{root}/{name}")
    links = export_source.link_rows(export_source.read_exports(spark, [f"{root}/b", f"{root}/a"]))
    return export_source.links_by_pair(links).select("kt", "kp", "spotify_url", "duration_ms", "release_year")


def score_missing_source(spark, d):
    full = sources(spark, d)
    some = {n: m for n, m in full.measures.items() if n != "subscription"}
    return scores.ranked_songs(dataclasses.replace(full, measures=some), SETTINGS)


def extract_page_items(spark, d):
    rows = pages.page_rows(table(spark, d, "pages"), ["page_id"], pages.LINK_LIST, 1)
    return rows.select("page_id", "pos", pages.cell_text(F.get("cells", F.lit(0))).alias("item"))


def _lines(spark, d):
    """The lines in as many parts as a shuffle has: their pages cost much more to read than the small file they come from."""
    return view(spark, d, "raw_line_src").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ord")


def _table_pages(spark, d):
    """Every line of the view as a page whose table also has a short row."""
    html = F.concat(
        F.lit("<html><table><thead><tr><th>Name</th></tr></thead><tbody><tr><td>no number</td></tr>\n"),
        F.lit('<tr><td class="text"><div><a href="x">'),
        "raw",
        F.lit("</a></div></td>\n<td> "),
        "num",
        F.lit(" </td></tr>\n</tbody></table></html>"),
    )
    return _lines(spark, d).select(F.col("ord").alias("page"), html.alias("html"))


def _wide_pages(spark, d):
    """The same with five cells a row, a row inside a comment, and cells and rows without end tags."""
    html = F.concat(
        F.lit("<table><tbody><!-- <tr><td>a - b<td>1<td>2<td>3<td>4 --><tr><td>short - row<td>1<td>2<td>3\n<tr><td>"),
        "raw",
        F.lit("<td>1<td>2</td><td>3<td>"),
        "num",
        F.lit("</tbody></table>"),
    )
    return _lines(spark, d).select(F.col("ord").alias("page"), html.alias("html"))


def extract_table_totals(spark, d):
    narrow, wide = _table_pages(spark, d), _wide_pages(spark, d)
    kinds = {
        "videos": (narrow, pages.VIDEO_TOTALS),
        "streams": (narrow, pages.STREAM_TOTALS),
        "store": (wide, pages.STORE_TOTALS),
        "subscription": (wide, pages.SUBSCRIPTION_TOTALS),
    }
    parts = [
        pages.extract_totals(landed, ["page"], page).select(
            F.lit(kind).alias("kind"), "artist", "title", F.col(page.value_col).alias("total")
        )
        for kind, (landed, page) in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def calendar_weeks(spark, d):
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, d, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return snapshots.calendar_weeks(bounds, F.col("lo"), F.col("hi"), 4)


def pending_weeks(spark, d):
    loaded = table(spark, d, "orders").filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    dates = loaded.select(F.col("o_orderdate").cast("date").alias("week_date"))
    return snapshots.pending(calendar_weeks(spark, d), dates, ["week_date"])


def flatten_snapshot(spark, d):
    """A text as a nested list of its lines, flattened."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("size")))
    nested = table(spark, d, "documents").select("doc_id", lines.alias("entries"))
    return snapshots.flatten_snapshots(nested, ["doc_id"])


def json_defaults(spark, d):
    fields = {"playcount": "$.k", "listeners": "$.listeners"}
    return snapshots.payload_counts(table(spark, d, "events"), ["event_id"], "props", fields)


def json_positive(spark, d):
    return json_defaults(spark, d).filter(F.col("playcount") > 0)


# sinks


def sink_scores(spark, d):
    """Published twice: the second version is in force."""
    path = _scratch(spark, "sink")
    sinks.publish(_index(spark, d).filter("rank <= 10"), path)
    sinks.publish(_index(spark, d), path, order="rank")
    return sinks.published(spark, path).select("rank", "title", "artist", "final_score")


def songs_only(spark, d):
    return scores.song_list(sources(spark, d), SETTINGS)


def full_export(spark, d):
    index = _index(spark, d)
    return links_plan.full_export(index, links_plan.resolve_links(index, exports(spark, d), SETTINGS))


def songs_csv(spark, d):
    return _csv_round_trip(spark, song_list(spark, d).select("title", "artist"))


def export_csv(spark, d):
    return _csv_round_trip(spark, full_export(spark, d), "rank")


def append_dedup(spark, d):
    stored = view(spark, d, "store_src").select("title", "artist", F.col("itunes_total").alias("playcount"))
    new = view(spark, d, "streams_src").select("title", "artist", F.col("spotify_streams").alias("playcount"))
    return dedup.append_new(stored, new, ["title", "artist"])


def append_stored(spark, d):
    """The same append to a stored table in folders, the batch given three times."""
    path = _scratch(spark, "store")
    stored = view(spark, d, "store_src").select("title", "artist", F.col("itunes_total").alias("playcount"))
    new = view(spark, d, "streams_src").select("title", "artist", F.col("spotify_streams").alias("playcount"))
    for batch in (stored, new, new, new):
        incremental.append_unseen(batch, path, ["title", "artist"], parts=16)
    return spark.read.parquet(path).select("title", "artist", "playcount")


# projections and predicates


def coerce_numeric(spark, d):
    return view(spark, d, "link_src").select(
        "ord",
        files.to_number(F.col("release_date")).alias("release_number"),
        files.to_number(F.col("duration_ms"), "bigint").alias("duration_ms"),
    )


def decade_bucket(spark, d):
    years = view(spark, d, "link_src").select("ord", P.release_year(F.col("release_date")).alias("release_year"))
    return years.withColumn("decade", percentile.decade(F.col("release_year")))


def variant_flag(spark, d):
    return view(spark, d, "raw_line_src").select("ord", "raw", T.has_word(F.col("raw"), "live").alias("is_variant"))


# joins


def chart_aggregate(spark, d):
    return _chart_agg(spark, d)


def merge_measures(spark, d):
    merged = scores.merge_sources(_clustered(spark, d), sources(spark, d), SETTINGS)
    return merged.drop("spotify_streams_is_floor")


def playlist_membership(spark, d):
    keys = measures.playlist_keys(view(spark, d, "playlist_hi"), SETTINGS)
    return measures.in_playlist(_chart(spark, d).select(*KEYS), keys, "in_playlist")


def link_lookup(spark, d):
    return links_plan.link_songs(_songs(spark, d), exports(spark, d))


def unambiguous_titles(spark, d):
    by_title = export_source.links_by_title(export_source.links_by_pair(_all_links(spark, d)))
    return by_title.select("kt", "kp", "spotify_url", "duration_ms", "release_year")


def validated_join(spark, d):
    left = view(spark, d, "chart_src").select("ord", "title", "artist")
    return lookup.validated_left_join(left, view(spark, d, "store_src").drop("ord"), ["title", "artist"], ["ord"])


def last_wins_lookup(spark, d):
    return lookup.last_per_key(
        view(spark, d, "link_src").select("title", "artist", "ord", "uri"), ["title", "artist"], ["ord", "uri"]
    ).drop("ord")


def alias_map(spark, d):
    own = view(spark, d, "chart_src").select("ord", "artist", T.artist_key(F.col("artist")).alias("own_key"))
    return T.apply_aliases(own.withColumn("key_artist", F.col("own_key")), "key_artist", SETTINGS.aliases)


# aggregations


def year_value_hist(spark, d):
    return percentile.histogram(_chart(spark, d), ["year"], "bb_peak")


def scale_to_100(spark, d):
    return ranking.scale_to_100(_weighted(spark, d), "final_score").select(*KEYS, "final_score")


def audit_counts(spark, d):
    index = _index(spark, d)
    found = links_plan.resolve_links(index, exports(spark, d), SETTINGS)
    rows = pages.page_totals(_table_pages(spark, d), ["page"], pages.VIDEO_TOTALS)
    landed, seen = run.watched(dataclasses.replace(sources(spark, d), chart=view(spark, d, "mixed_src")))
    # The loads of a run, each source once; their dropped rows are counted on the way.
    materialize(chart.chart_rows(landed.chart), "audit-chart")
    for name, raw in landed.measures.items():
        materialize(measures.measure_source(raw, SETTINGS.measure(name), SETTINGS), "audit-measure")
    materialize(measures.floor_table(landed.playlists, SETTINGS), "audit-floors")
    return run.audit(index, found, "spotify_streams_is_floor", rows, pages.is_usable(pages.VIDEO_TOTALS), seen)


# windows


def rolling_percentile_low(spark, d):
    return _chart_scored(spark, d).select(*KEYS, "year", "bb_peak", "peak_pct")


def rolling_percentile_high(spark, d):
    return _chart_scored(spark, d).select(*KEYS, "year", "bb_chart_weeks", "weeks_pct")


def _score(spark, d):
    return scores.score_songs(_songs(spark, d), sources(spark, d), SETTINGS)


def decade_percentile(spark, d):
    return _score(spark, d).select(*KEYS, "decade", *[m.score_col for m in SETTINGS.measures])


def best_per_key(spark, d):
    return measures.measure_source(view(spark, d, "video_src"), SETTINGS.measure("videos"), SETTINGS)


def first_per_key(spark, d):
    credits = view(spark, d, "chart_src").select("title", "artist", "ord")
    keyed = T.with_keys(credits, SETTINGS.aliases).select(*KEYS, "ord", "title", "artist")
    return dedup.first_per_key(keyed, KEYS, ["ord", "title", "artist"])


def authoritative_flag(spark, d):
    rows = _measure_rows(spark, d, "streams")
    return dedup.authoritative_rows(rows, KEYS, SETTINGS.variant_word, ["title", "artist"])


def final_rank(spark, d):
    return scores.rank_songs(_weighted(spark, d)).select("rank", *KEYS, "final_score")


# sorts and limits


def top_n(spark, d):
    kept = _index(spark, d).filter(F.col("rank") <= SETTINGS.top_n)  # ranks are dense
    return kept.select("rank", "title", "artist", "final_score")


def top_n_measure(spark, d):
    best = ranking.top_n_by(_index(spark, d), "youtube_views", KEYS, SETTINGS.source_top_n)
    return best.select(*KEYS, "title", "artist", "youtube_views")


# set operations


def song_list(spark, d):
    return scores.merge_sources(_clustered(spark, d), sources(spark, d), SETTINGS).select(*KEYS, "title", "artist")


def candidate_pool(spark, d):
    return ranking.candidate_pool(
        _index(spark, d), ["final_score", "bb_score"], ["title", "artist"], KEYS, SETTINGS.candidate_pool_n
    )


# entity resolution


def artist_tokens(spark, d):
    return cluster.artist_tokens(view(spark, d, "credit_src"), SETTINGS.aliases, ["ord"])


def entity_clusters(spark, d):
    rows = _rows(spark, d)
    return cluster.cluster_map(rows, cluster.cluster_changes(rows, SETTINGS.aliases))


def clusters_after_batch(spark, d):
    """The first source's clusters, written, then updated by the rows of all others: the map of a whole run."""
    rows = _rows(spark, d)
    stored, new = rows.filter(F.col("source_ord") == 0), rows.filter(F.col("source_ord") > 0)
    before = materialize(cluster.cluster_changes(stored, SETTINGS.aliases), "clusters")
    return cluster.cluster_map(rows, cluster.update_changes(stored, before, new, SETTINGS.aliases))


def apply_clusters(spark, d):
    rows = cluster.to_canonical(_rows(spark, d), cluster.cluster_changes(_rows(spark, d), SETTINGS.aliases))
    rows = materialize(rows, "clustered")  # read twice below
    order = [*dedup.largest_first("bb_score"), (-F.col("value")).alias("_by_value"), "own_artist"]
    best = dedup.first_per_key(rows, ["source", *KEYS], order)
    return best.select("source", *KEYS, "own_artist", "title", "artist", "value", "bb_score")


# scoring


def chart_score(spark, d):
    return _chart_scored(spark, d).select(*KEYS, "bb_score")


def stream_floors(spark, d):
    songs = scores.merged_songs(sources(spark, d), SETTINGS, rows=_clustered(spark, d))
    return songs.select(*KEYS, "spotify_streams", "spotify_streams_is_floor")


def weighted_score(spark, d):
    return _score(spark, d).select(*KEYS, "final_score")


# scalar functions


def strip_accents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_accents(F.col("text")).alias("text"))


def title_key(spark, d):
    return view(spark, d, "chart_src").select("ord", "title", T.title_key(F.col("title")).alias("key_title"))


def artist_key(spark, d):
    return _credits(spark, d).select("artist", T.artist_key(F.col("artist")).alias("key_artist"))


def link_title_key(spark, d):
    return view(spark, d, "link_src").select("ord", "title", T.link_title_key(F.col("title")).alias("kt"))


def primary_artist(spark, d):
    return _credits(spark, d).select("artist", T.primary_artist(F.col("artist")).alias("kp"))


def split_featured(spark, d):
    main, featured = T.split_featured(F.col("artist"))
    return _credits(spark, d).select("artist", main.alias("main"), featured.alias("featured"))


def split_collaborators(spark, d):
    return view(spark, d, "credit_src").select("ord", F.posexplode(T.collaborators(F.col("artist"))).alias("pos", "name"))


def parse_lines(spark, d):
    parsed = view(spark, d, "raw_line_src").select("ord", "raw", P.parse_line(F.col("raw")).alias("_pair"))
    return parsed.select("ord", "raw", "_pair.artist", "_pair.title")


def parse_numbers(spark, d):
    rows = view(spark, d, "raw_line_src").select("ord", "num", P.parse_count(F.col("num")).alias("total"))
    return rows.filter(F.col("total").isNotNull())


def release_year(spark, d):
    return view(spark, d, "link_src").select(
        "ord", "release_date", P.release_year(F.col("release_date")).alias("release_year")
    )


def uri_to_url(spark, d):
    return view(spark, d, "link_src").select("ord", P.track_url(F.col("uri")).alias("url"))


def first_of_list(spark, d):
    return view(spark, d, "playlist_hi").select("title", "artists", T.first_of_list(F.col("artists")).alias("artist"))


def collaborators_joined(spark, d):
    return _credits(spark, d).select("artist", T.collaborators_joined(F.col("artist")).alias("names"))


def display_credit(spark, d):
    return _credits(spark, d).select("artist", T.display_credit(F.col("artist")).alias("display"))


def display_format(spark, d):
    return _index(spark, d).select(
        *KEYS,
        D.plain_int(F.col("year")).alias("year"),
        D.fixed_1(F.col("final_score")).alias("score"),
        D.plain_int(F.col("bb_peak"), prefix="#").alias("peak"),
        D.plain_int(F.col("bb_chart_weeks"), suffix="w").alias("weeks"),
        D.grouped_int(F.col("spotify_streams"), F.col("spotify_streams_is_floor")).alias("spotify_streams"),
        *[D.grouped_int(F.col(m.value_col)).alias(m.value_col) for m in SETTINGS.measures[1:]],
        D.plain_int(F.col("decade"), suffix="s").alias("decade"),
        D.percent_1(F.col("sp_score")).alias("era_percentile"),
    )


# whole runs


def popularity_index(spark, d):
    return scores.ranked_songs(sources(spark, d), SETTINGS)


def resolve_links(spark, d):
    return links_plan.resolve_links(_index(spark, d), exports(spark, d), SETTINGS)


def report_overall(spark, d):
    index = _index(spark, d)
    found = links_plan.resolve_links(index, exports(spark, d), SETTINGS)
    return reports.overall_report(index, found, SETTINGS)


def report_chart(spark, d):
    return reports.chart_report(view(spark, d, "chart_src"), SETTINGS)


def report_source(spark, d):
    index = _index(spark, d)
    parts = [reports.source_report(index, n, SETTINGS).withColumn("source", F.lit(n)) for n in MEASURE_VIEWS]
    return reduce(DataFrame.unionByName, parts)


def quick_run(spark, d):
    return run.run(sources(spark, d), settings=SETTINGS, quick=True)["full_export"]


def full_run(spark, d):
    """Every table of a full run, its size, and a checksum over all its columns."""
    tables = run.run(sources(spark, d), exports(spark, d), SETTINGS)
    return reduce(
        DataFrame.union,
        [
            sinks.portable_checksum(t).select(F.lit(k).alias("name"), F.col("rows").alias("n"), "checksum")
            for k, t in tables.items()
        ],
    )


_ALL = [
    scan_mixed_texts, scan_csv_exports, songs_csv, export_csv, full_run,
    scan_chart, scan_measures, scan_synonyms, scan_union_files, score_missing_source, extract_page_items,
    extract_table_totals, calendar_weeks, pending_weeks, flatten_snapshot, json_defaults, json_positive,
    sink_scores, songs_only, full_export, append_dedup, append_stored, coerce_numeric, decade_bucket, variant_flag,
    chart_aggregate, merge_measures, playlist_membership, link_lookup, unambiguous_titles, validated_join,
    last_wins_lookup, alias_map, year_value_hist, scale_to_100, audit_counts, rolling_percentile_low,
    rolling_percentile_high, decade_percentile, best_per_key, first_per_key, authoritative_flag, final_rank,
    top_n, top_n_measure, song_list, candidate_pool, artist_tokens, entity_clusters, clusters_after_batch, apply_clusters,
    chart_score,
    stream_floors, weighted_score, strip_accents, title_key, artist_key, link_title_key, primary_artist,
    split_featured, split_collaborators, parse_lines, parse_numbers, release_year, uri_to_url, first_of_list,
    collaborators_joined, display_credit, display_format, popularity_index, resolve_links, report_overall,
    report_chart, report_source, quick_run,
]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}
