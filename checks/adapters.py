"""The test tables seen as ranking sources.

Each view is one SQL text that both engines run.  A song is a part name
performed by a supplier; some credits also name a second act (brand and part
number), so that sources disagree about who comes first.  All views read whole
tables: the flags of a line decide which source it feeds, nothing is sampled.
"""

from __future__ import annotations

from dataclasses import replace
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from evergreen.config import DEFAULT_ALIASES, DEFAULT_MEASURES, Floor, Settings
from evergreen.plans.scores import Sources
from evergreen.sources.exports import union_exports

TABLES = ("lineitem", "part", "supplier", "orders", "events", "documents", "pages")

SETTINGS = Settings(
    half_window=1,
    measures=tuple(
        replace(m, start_year={"store": 1996, "subscription": 1998}.get(m.name))
        for m in DEFAULT_MEASURES
    ),
    floors=(Floor("playlist_hi", 500), Floor("playlist_lo", 100)),
    aliases={**DEFAULT_ALIASES, "supplier000000003": "supplier000000004"},
)

TRACKS = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS ord, l.l_linenumber AS line, l.l_quantity AS quantity,
       l.l_extendedprice AS price, l.l_returnflag AS flag, l.l_linestatus AS status,
       CAST(l.l_shipdate AS DATE) AS ship_date, p.p_type AS type, p.p_brand AS brand, p.p_size AS size,
       CASE WHEN l.l_quantity <= 3 THEN concat(p.p_name, ' ', CAST(p.p_partkey AS VARCHAR(20))) ELSE p.p_name END AS name,
       s.s_name AS act, concat(p.p_brand, ' ', CAST(p.p_partkey AS VARCHAR(20))) AS guest,
       concat('spotify:track:', CAST(l.l_orderkey AS VARCHAR(20)), '-', CAST(l.l_linenumber AS VARCHAR(20)), '-',
              CAST(l.l_partkey AS VARCHAR(20)), '-', CAST(l.l_suppkey AS VARCHAR(20))) AS uri,
       CASE l.l_linenumber WHEN 1 THEN ' Featuring ' WHEN 2 THEN ' & ' WHEN 3 THEN ', ' WHEN 4 THEN ' x '
            WHEN 5 THEN ' vs. ' WHEN 6 THEN ' with ' ELSE '/' END AS sep
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""

VIEWS = {
    "chart_src": f"""
SELECT ord,
       CASE flag WHEN 'A' THEN concat(name, ' - ', type, ' Version') WHEN 'N' THEN concat(upper(name), ' (', type, ')')
            ELSE name END AS title,
       CASE WHEN quantity >= 40 THEN concat(act, sep, guest) WHEN status = 'O' THEN concat('The ', act)
            ELSE act END AS artist,
       ship_date AS date, line AS peak_pos, CAST(quantity AS INT) AS weeks_on_chart
FROM ({TRACKS}) t""",
    "streams_src": f"""
SELECT min(ord) AS ord, title, artist, CAST(sum(quantity) AS BIGINT) AS spotify_streams
FROM (SELECT ord, quantity, act AS artist, CASE WHEN status = 'O' THEN name ELSE concat(name, ' (Remix)') END AS title
      FROM ({TRACKS}) t WHERE flag = 'R') r
GROUP BY title, artist""",
    "video_src": f"""
SELECT min(ord) AS ord, title, artist, CAST(sum(quantity) * 100 AS BIGINT) + max(size) AS youtube_views
FROM (SELECT ord, quantity, size, concat(name, ' [Take ', CAST(line AS VARCHAR(2)), ']') AS title,
             CASE WHEN quantity >= 40 THEN guest WHEN quantity >= 35 THEN concat(act, ' & ', guest) ELSE act END AS artist
      FROM ({TRACKS}) t WHERE flag = 'A') v
GROUP BY title, artist""",
    "store_src": f"""
SELECT min(ord) AS ord, name AS title, act AS artist, CAST(sum(quantity) AS BIGINT) AS itunes_total
FROM ({TRACKS}) t WHERE flag = 'N' GROUP BY name, act""",
    "sub_src": f"""
SELECT min(ord) AS ord, name AS title, upper(act) AS artist, CAST(sum(quantity) AS BIGINT) AS apple_total
FROM ({TRACKS}) t WHERE status = 'O' AND year(ship_date) >= 1998 GROUP BY name, act""",
    "playlist_hi": f"""
SELECT DISTINCT name AS title, concat(act, ';', brand) AS artists FROM ({TRACKS}) t WHERE price >= 80000""",
    "playlist_lo": f"""
SELECT DISTINCT name AS title, concat(act, ';', brand) AS artists FROM ({TRACKS}) t WHERE price BETWEEN 60000 AND 85000""",
    "link_src": f"""
SELECT min(ord) AS ord, min(uri) AS uri, title, artist, duration_ms, release_date FROM (
  SELECT ord, uri, concat(upper(name), CASE WHEN line IN (3, 6) THEN ' - Remastered 2011' ELSE '' END) AS title,
         CASE WHEN quantity <= 3 THEN concat(brand, ';', type) ELSE concat(act, ';', brand) END AS artist,
         CAST(size * 1000 AS VARCHAR(20)) AS duration_ms,
         CASE WHEN line <= 2 THEN concat(CAST(1960 + size AS VARCHAR(4)), '-05-01')
              WHEN line <= 4 THEN CAST(1960 + size AS VARCHAR(4)) WHEN line = 5 THEN 'unknown' ELSE NULL END AS release_date
  FROM ({TRACKS}) t) l
GROUP BY title, artist, duration_ms, release_date""",
    "credit_src": """
SELECT p_partkey AS ord, p_name AS title, CASE p_partkey % 8
  WHEN 0 THEN concat(p_brand, ' Featuring ', p_type)   WHEN 1 THEN concat(p_brand, ', ', p_type, ' & ', p_name)
  WHEN 2 THEN concat('The ', p_brand)                  WHEN 3 THEN concat(p_brand, ' x ', p_type)
  WHEN 4 THEN concat('"AC/DC: ', p_type, '"')          WHEN 5 THEN concat(p_brand, ' vs. ', p_type)
  WHEN 6 THEN concat(p_brand, '/', p_type)             ELSE concat('Lil Nas X ft. ', p_brand) END AS artist
FROM {part} p""",
    "raw_line_src": """
SELECT p_partkey AS ord, CASE p_partkey % 9
  WHEN 0 THEN concat(p_brand, ' - ', p_name, ' - live') WHEN 1 THEN concat(p_brand, ' – ', p_name)
  WHEN 2 THEN concat(p_brand, ' — ', p_name)            WHEN 3 THEN concat(p_brand, ' || ', p_name)
  WHEN 4 THEN concat(p_brand, ' | ', p_name)            WHEN 5 THEN concat('[MV] ', p_brand, ' _ ', p_name)
  WHEN 6 THEN concat(p_brand, ': ', p_name, ' (Official)') WHEN 7 THEN concat(p_brand, ' ‘', p_name, '’ MV')
  ELSE p_name END AS raw,
  CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE concat(CAST(p_size AS VARCHAR(10)), ',000') END AS num
FROM {part} p""",
}

VIEWS["mixed_src"] = f"""
SELECT ord, CASE WHEN quantity = 7 THEN NULL ELSE name END AS title, act AS artist,
       CASE line WHEN 2 THEN concat(CAST(month(ship_date) AS VARCHAR(2)), '/', CAST(day(ship_date) AS VARCHAR(2)), '/',
                                    CAST(year(ship_date) AS VARCHAR(4)))
            WHEN 3 THEN 'soon' ELSE CAST(ship_date AS VARCHAR(10)) END AS date,
       CASE line WHEN 4 THEN '4.0' WHEN 5 THEN 'n/a' ELSE CAST(line AS VARCHAR(2)) END AS peak_pos,
       concat(CAST(CAST(quantity AS INT) AS VARCHAR(4)), CASE WHEN status = 'O' THEN '.00' ELSE '' END) AS weeks_on_chart
FROM ({TRACKS}) t"""

MEASURE_VIEWS = {"streams": "streams_src", "videos": "video_src", "store": "store_src", "subscription": "sub_src"}


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    sql = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def view_sql(name: str) -> str:
    """The same view as plain SQL over tables of their own names."""
    sql = VIEWS[name]
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        chart=view(spark, sf_dir, "chart_src"),
        measures={name: view(spark, sf_dir, v) for name, v in MEASURE_VIEWS.items()},
        playlists={p: view(spark, sf_dir, p) for p in ("playlist_hi", "playlist_lo")},
    )


def export_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The link view split into two exports with different headers; together they hold every row.

    The second one has no release date.
    """
    links = view(spark, sf_dir, "link_src")
    head = ["uri as `Track URI`", "title as `Track Name`", "artist as `Artist Name(s)`"]
    first = links.filter("ord % 2 = 0").selectExpr(
        *head, "duration_ms as `Duration (ms)`", "release_date as `Release Date`", "ord"
    )
    second = links.filter("ord % 2 = 1").selectExpr(*head, "duration_ms as `Track Duration (ms)`", "ord")
    return [first, second]


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_exports(export_files(spark, sf_dir))
