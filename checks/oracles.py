"""Independent SQL answers, written for DuckDB.

Each answer is assembled from named steps.  Wherever there is a choice the SQL
takes another route than the library: row_number instead of aggregates, range
self-joins instead of cumulative histograms, a recursive closure instead of
star contraction, left joins instead of one merged aggregation.
"""

from __future__ import annotations

from checks.adapters import MEASURE_VIEWS, SETTINGS, VIEWS, view_sql
from evergreen.functions import parse as P
from evergreen.functions import text as T

ACT_SLASH = T.SLASH_STAND_IN


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, {q(flags)})"


def strip(x: str) -> str:
    return sub(x, r"^\s+|\s+$")


def squeeze(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


NOT_WORD = r"[^\p{L}\p{N}_\s]"


def _tail(x: str) -> str:
    for p in (r"\([^)]*\)", r"\[[^\]]*\]", r" - .*$", NOT_WORD):
        x = sub(x, p)
    return squeeze(x)


def title_key(x: str) -> str:
    return _tail(f"strip_accents({strip(f'lower({x})')})")


def link_title_key(x: str) -> str:
    return _tail(strip(f"lower(strip_accents({x}))"))


def artist_base(x: str) -> str:
    x = f"replace(strip_accents({strip(f'lower({x})')}), '$', 's')"
    for p in (
        r"^the\s+",
        r"\(.*",
        r"\b(feat|ft|featuring)\b.*",
        r"\bwith\b.*",
        r"\bvs\b.*",
        r",.*",
        r"[ \t][&x][ \t]\S.*",
        r"/.*",
        NOT_WORD,
    ):
        x = sub(x, p)
    return squeeze(x)


def alias(x: str) -> str:
    cases = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in SETTINGS.aliases.items())
    return f"CASE {x} {cases} ELSE {x} END"


def primary(x: str) -> str:
    x = sub(x, r"\b(?:featuring|feat|ft|with)\b.*", "", "i")
    x = sub(x, r"[;,:].*", "", "")
    x = sub(x, r"\b(?:and|x)\b\s*\S.*|&.*", "", "i")
    return link_title_key(x)


def strip_quotes(x: str) -> str:
    return strip(f"trim({strip(x)}, {q(T.QUOTES)})")


def collaborators(x: str) -> str:
    x = strip_quotes(x)
    for act in T.ATOMIC_ACTS:
        a, b = act.split("/")
        x = sub(x, f"({a})/({b})", rf"\1{ACT_SLASH}\2", "gi")
    pattern = r"(?i)\s*,\s*|\s*&\s*|\s*/\s*|\s*:\s*|\s+x\s+|\s+with\s+|\s+vs\.?\s+|[ \t](?:featuring|feat\.?|ft\.?)[ \t]"
    parts = f"regexp_split_to_array({x}, {q(pattern)})"
    names = f"list_transform({parts}, lambda p: replace({strip_quotes('p')}, '{ACT_SLASH}', '/'))"
    return f"list_filter({names}, lambda n: n <> '')"


def featured(x: str) -> tuple[str, str]:
    parts = f"regexp_matches({strip_quotes(x)}, '(?i)[ \\t](?:featuring|feat\\.?|ft\\.?)[ \\t]')"
    cut = r"(?is)^(.*?)[ \t](?:featuring|feat\.?|ft\.?)[ \t](.*)$"
    a = strip_quotes(x)
    main = f"CASE WHEN {parts} THEN {strip(f'regexp_extract({a}, {q(cut)}, 1)')} ELSE {a} END"
    feat = f"CASE WHEN {parts} THEN {strip(f'regexp_extract({a}, {q(cut)}, 2)')} END"
    return main, feat


def display_credit(x: str) -> str:
    main, feat = featured(x)
    return f"CASE WHEN {feat} <> '' THEN concat({main}, ' feat. ', {feat}) ELSE {main} END"


def grouped_int(x: str, flag: str | None = None) -> str:
    text = f"format('{{:,}}', {x})"
    if flag:
        text = f"{text} || CASE WHEN {flag} THEN '+' ELSE '' END"
    return f"coalesce({text}, '—')"


def plain(x: str, prefix: str = "", suffix: str = "") -> str:
    return f"coalesce({q(prefix)} || CAST({x} AS VARCHAR) || {q(suffix)}, '—')"


def fixed_1(x: str) -> str:
    return f"format('{{:.1f}}', {x})"


def percent_1(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '—' ELSE {fixed_1(f'{x} * 100')} || '%' END"


def round_even(x: str, digits: int) -> str:
    return f"round_even({x} * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE"


# --- named steps -------------------------------------------------------------

STEPS: dict[str, tuple[list[str], str]] = {name: ([], view_sql(name)) for name in VIEWS}


def step(name: str, needs: list[str], sql: str) -> None:
    STEPS[name] = (needs, sql)


def answer(select: str, *needs: str) -> str:
    """``select`` with every step it needs, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for d in STEPS[n][0]:
                visit(d)
            order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return select
    body = ",\n".join(
        f"{n}{STEPS[n][1][: STEPS[n][1].index(')') + 1]} AS ({STEPS[n][1][STEPS[n][1].index(')') + 1 :]})"
        if STEPS[n][1].startswith("(")
        else f"{n} AS MATERIALIZED ({STEPS[n][1]})"
        for n in order
    )
    return f"WITH RECURSIVE {body}\n{select}"


def keyed(view: str, extra: str) -> str:
    return (
        f"SELECT {title_key('title')} AS key_title, {alias('ka')} AS key_artist, title, artist, {extra} "
        f"FROM (SELECT *, {artist_base('artist')} AS ka FROM {view}) t"
    )


KEYS = "key_title, key_artist"
step("chart_keyed", ["chart_src"], keyed("chart_src", "ord, date, year(date) AS year, peak_pos, weeks_on_chart"))
step(
    "chart_agg",
    ["chart_keyed"],
    f"""
SELECT {KEYS}, title, artist, bb_peak, year, bb_chart_weeks, CAST(year // 10 * 10 AS INT) AS decade FROM (
  SELECT {KEYS}, title, artist, row_number() OVER (PARTITION BY {KEYS} ORDER BY ord, title, artist) AS rn,
         min(peak_pos) OVER k AS bb_peak, CAST(min(year) OVER k AS INT) AS year
  FROM chart_keyed WINDOW k AS (PARTITION BY {KEYS})) f
JOIN (SELECT {KEYS}, CAST(count(*) AS INT) AS bb_chart_weeks FROM (SELECT DISTINCT {KEYS}, date FROM chart_keyed) d
      GROUP BY {KEYS}) w USING ({KEYS})
WHERE rn = 1""",
)


def rolling(col: str, better: str) -> str:
    """Compare every distinct (year, value) with every row group within the window."""
    return f"""
SELECT a.year, a.v, (sum(CASE WHEN b.v {better} a.v THEN b.n ELSE 0 END)::DOUBLE
       + 0.5::DOUBLE * sum(CASE WHEN b.v = a.v THEN b.n ELSE 0 END)::DOUBLE) / sum(b.n)::DOUBLE AS pct
FROM (SELECT year, {col} AS v FROM chart_agg GROUP BY ALL) a
JOIN (SELECT year, {col} AS v, count(*) AS n FROM chart_agg GROUP BY ALL) b
  ON b.year BETWEEN a.year - {SETTINGS.half_window} AND a.year + {SETTINGS.half_window}
GROUP BY a.year, a.v"""


step("peak_lookup", ["chart_agg"], rolling("bb_peak", ">"))
step("weeks_lookup", ["chart_agg"], rolling("bb_chart_weeks", "<"))
step(
    "chart_scored",
    ["chart_agg", "peak_lookup", "weeks_lookup"],
    f"""
SELECT c.*, p.pct AS peak_pct, w.pct AS weeks_pct,
       {SETTINGS.peak_weight}::DOUBLE * p.pct + {1 - SETTINGS.peak_weight}::DOUBLE * w.pct AS bb_score
FROM chart_agg c JOIN peak_lookup p ON p.year = c.year AND p.v = c.bb_peak
JOIN weeks_lookup w ON w.year = c.year AND w.v = c.bb_chart_weeks""",
)

VALUE = {name: SETTINGS.measure(name).value_col for name in MEASURE_VIEWS}
for _name, _view in MEASURE_VIEWS.items():
    step(f"{_name}_keyed", [_view], keyed(_view, f"ord, {VALUE[_name]} AS value"))
    step(
        f"{_name}_flagged",
        [f"{_name}_keyed"],
        f"""
SELECT *, bool_or(v) OVER k AND bool_or(NOT v) OVER k AND NOT v AS authoritative
FROM (SELECT *, coalesce(regexp_matches(title, '(?i)\\b{SETTINGS.variant_word}\\b'), false) AS v FROM {_name}_keyed) t
WINDOW k AS (PARTITION BY {KEYS})""",
    )
    step(
        f"{_name}_best",
        [f"{_name}_flagged"],
        f"""
SELECT {KEYS}, title, artist, ord, value, {'authoritative' if _name == 'streams' else 'false AS authoritative'} FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY value DESC NULLS LAST, ord, title, artist) AS rn
  FROM {_name}_flagged) t WHERE rn = 1""",
    )

ORDER = ["chart", *MEASURE_VIEWS]
step(
    "source_rows",
    ["chart_scored", *[f"{n}_best" for n in MEASURE_VIEWS]],
    f"""
SELECT 0 AS source_ord, 'chart' AS source, {KEYS}, title, artist, CAST(NULL AS BIGINT) AS value, false AS authoritative,
       bb_score, bb_peak, bb_chart_weeks, year FROM chart_scored
"""
    + "".join(
        f"UNION ALL SELECT {i}, '{n}', {KEYS}, title, artist, value, authoritative, NULL, NULL, NULL, NULL FROM {n}_best\n"
        for i, n in enumerate(ORDER)
        if n != "chart"
    ),
)
step("source_rows_m", ["source_rows"], "SELECT * FROM source_rows WHERE source <> 'subscription'")

for _x in ("", "_m"):
    _src = f"source_rows{_x}"
    step(
        f"names{_x}",
        [_src],
        f"""
    SELECT DISTINCT {KEYS}, {alias('base')} AS token
    FROM (SELECT {KEYS}, {artist_base('name')} AS base
          FROM (SELECT {KEYS}, unnest({collaborators('artist')}) AS name FROM {_src}) u) v WHERE base <> ''""",
    )
    step(
        f"nodes{_x}",
        [_src],
        f"""
    SELECT {KEYS}, source_ord, coalesce(-value, 9223372036854775807) AS negated FROM (
      SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY source_ord, value DESC NULLS LAST) AS rn FROM {_src}) t
    WHERE rn = 1""",
    )
    step(
        f"neighbours{_x}",
        [f"names{_x}"],
        f"SELECT DISTINCT a.key_title, a.key_artist AS x, b.key_artist AS y FROM names{_x} a JOIN names{_x} b "
        "ON a.key_title = b.key_title AND a.token = b.token",
    )
    step(
        f"reach{_x}",
        [f"nodes{_x}", f"neighbours{_x}"],
        f"(key_title, x, y) SELECT key_title, key_artist, key_artist FROM nodes{_x} "
        f"UNION SELECT r.key_title, r.x, n.y FROM reach{_x} r JOIN neighbours{_x} n ON n.key_title = r.key_title AND n.x = r.y",
    )
    step(
        f"canon{_x}",
        [f"reach{_x}", f"nodes{_x}"],
        f"""
    SELECT key_title, x AS key_artist, canonical FROM (
      SELECT r.key_title, r.x, r.y AS canonical,
             row_number() OVER (PARTITION BY r.key_title, r.x ORDER BY n.source_ord, n.negated, n.key_artist) AS rn
      FROM reach{_x} r JOIN nodes{_x} n ON n.key_title = r.key_title AND n.key_artist = r.y) t WHERE rn = 1""",
    )
    step(
        f"clustered{_x}",
        [_src, f"canon{_x}"],
        f"""
    SELECT s.* EXCLUDE (key_artist), s.key_artist AS own_artist, c.canonical AS key_artist
    FROM {_src} s JOIN canon{_x} c ON c.key_title = s.key_title AND c.key_artist = s.key_artist""",
    )

for _tag, _rows in (("c", "clustered"), ("m", "clustered_m")):
    step(
        f"best_{_tag}",
        [_rows],
        f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, {KEYS}
    ORDER BY bb_score DESC NULLS LAST, value DESC NULLS LAST, own_artist) AS rn FROM {_rows}) t WHERE rn = 1""",
    )
    step(
        f"songs_{_tag}",
        [f"best_{_tag}"],
        f"""
SELECT {KEYS}, title, artist FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEYS}
      ORDER BY CASE WHEN authoritative THEN -1 ELSE source_ord END) AS pick FROM best_{_tag}) t WHERE pick = 1""",
    )

_floor_cases = []
for _i, _f in enumerate(SETTINGS.floors):
    step(
        f"{_f.playlist}_keys",
        [_f.playlist],
        f"""
SELECT DISTINCT {title_key('title')} AS key_title, {alias('ka')} AS key_artist
FROM (SELECT title, {artist_base("split_part(artists, ';', 1)")} AS ka FROM {_f.playlist}) t""",
    )
HI, LO = SETTINGS.floors


def measures_of(tag: str) -> list:
    return [m for m in SETTINGS.measures if tag != "m" or m.name != "subscription"]


def merged(tag: str) -> str:
    names = [m.name for m in measures_of(tag)]
    joins = "".join(
        f"LEFT JOIN (SELECT {KEYS}, value AS {VALUE[n]} FROM best_{tag} WHERE source = '{n}') {n} USING ({KEYS})\n"
        for n in names
    )
    return f"""
SELECT {KEYS}, s.title, s.artist, c.bb_score, c.bb_peak, c.bb_chart_weeks, c.year,
       CASE WHEN spotify_streams IS NOT NULL THEN spotify_streams WHEN h.hit THEN {HI.value} WHEN l.hit THEN {LO.value} END
         AS spotify_streams,
       spotify_streams IS NULL AND (h.hit IS NOT NULL OR l.hit IS NOT NULL) AS spotify_streams_is_floor,
       {', '.join(VALUE[n] for n in names[1:])},
       CAST(floor(coalesce(c.year, 0) / 10.0) * 10 AS INT) AS decade
FROM songs_{tag} s
LEFT JOIN (SELECT * FROM best_{tag} WHERE source = 'chart') c USING ({KEYS})
{joins}LEFT JOIN (SELECT *, true AS hit FROM {HI.playlist}_keys) h USING ({KEYS})
LEFT JOIN (SELECT *, true AS hit FROM {LO.playlist}_keys) l USING ({KEYS})"""


def pct(col: str) -> str:
    return (
        f"CASE WHEN {col} IS NOT NULL THEN (rank() OVER (PARTITION BY decade ORDER BY {col} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY decade, {col}) - 1) / 2.0::DOUBLE)"
        f" / count({col}) OVER (PARTITION BY decade) END"
    )


def dims_of(tag: str) -> list[tuple[str, float, int | None]]:
    rest = [(m.score_col, m.weight, m.start_year) for m in measures_of(tag)]
    return [("bb_score", SETTINGS.chart_weight, None), *rest]


def weighted(dims: list[tuple[str, float, int | None]]) -> str:
    def when(start: int | None, x: str) -> str:
        return x if start is None else f"CASE WHEN coalesce(year, 0) >= {start} THEN {x} ELSE 0::DOUBLE END"

    num = " + ".join(["0::DOUBLE", *[when(s, f"coalesce({c}, 0) * {w}::DOUBLE") for c, w, s in dims]])
    den = " + ".join(["0::DOUBLE", *[when(s, f"{w}::DOUBLE") for _, w, s in dims]])
    return f"CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE 0::DOUBLE END"


for _tag in "cum":
    step(
        f"merged_{_tag}",
        [f"songs_{_tag}", f"best_{_tag}", f"{HI.playlist}_keys", f"{LO.playlist}_keys"],
        merged(_tag),
    )
    step(
        f"scored_{_tag}",
        [f"merged_{_tag}"],
        "SELECT *, "
        + ", ".join(f"{pct(m.value_col)} AS {m.score_col}" for m in measures_of(_tag))
        + f" FROM merged_{_tag}",
    )
    step(f"weighted_{_tag}", [f"scored_{_tag}"], f"SELECT *, {weighted(dims_of(_tag))} AS final_score FROM scored_{_tag}")
    step(
        f"index_{_tag}",
        [f"weighted_{_tag}"],
        f"""
SELECT row_number() OVER (ORDER BY final_score DESC, {KEYS}) AS rank, * FROM (
  SELECT * EXCLUDE (final_score), CASE WHEN top > 0 THEN {round_even('(final_score / top * 100)', 2)}
         ELSE final_score END AS final_score
  FROM (SELECT *, max(final_score) OVER () AS top FROM weighted_{_tag}) w) s""",
    )
INDEX = "SELECT * EXCLUDE (top) FROM index_{}"

step(
    "link_rows",
    ["link_src"],
    f"""
SELECT {link_title_key('title')} AS kt, {primary('artist')} AS kp,
       replace(uri, {q(P.TRACK_URI_PREFIX)}, {q(P.TRACK_URL_PREFIX)}) AS spotify_url,
       TRY_CAST(duration_ms AS BIGINT) AS duration_ms,
       CASE WHEN ord % 2 = 0 THEN TRY_CAST(regexp_extract(release_date, '\\d{{4}}') AS INT) END AS release_year,
       CAST(ord % 2 AS INT) AS file_ord, ord
FROM link_src""",
)
step(
    "by_pair",
    ["link_rows"],
    """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY kt, kp ORDER BY file_ord, ord, spotify_url) AS rn
FROM link_rows) t WHERE rn = 1""",
)
step(
    "by_title",
    ["link_rows"],
    """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY kt ORDER BY file_ord, ord, spotify_url) AS rn
FROM link_rows WHERE kt IN (SELECT kt FROM link_rows GROUP BY kt HAVING count(DISTINCT kp) = 1)) t WHERE rn = 1""",
)


def linked(songs: str) -> str:
    return f"""
SELECT s.title, s.artist,
       CASE WHEN b.kt IS NOT NULL THEN b.spotify_url ELSE t.spotify_url END AS spotify_url,
       CASE WHEN b.kt IS NOT NULL THEN b.duration_ms ELSE t.duration_ms END AS duration_ms,
       CASE WHEN b.kt IS NOT NULL THEN b.release_year ELSE t.release_year END AS release_year
FROM (SELECT title, artist, {link_title_key('title')} AS kt, {primary('artist')} AS kp FROM {songs}) s
LEFT JOIN by_pair b ON b.kt = s.kt AND b.kp = s.kp LEFT JOIN by_title t ON t.kt = s.kt"""


step("top_songs", ["index_c"], f"SELECT * FROM index_c WHERE rank <= {SETTINGS.top_n}")
step("links", ["top_songs", "by_pair", "by_title"], linked("top_songs"))


# --- answers -----------------------------------------------------------------


def long_measures(suffix: str, cols: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS source, {cols} FROM {n}_{suffix}" for n in MEASURE_VIEWS)


def parsed_lines() -> str:
    """The line rules, written once more as a CASE over positions."""

    def clean(t: str) -> str:
        return strip(sub(sub(strip(t), P.TITLE_FEATURING, "", "i"), P.TITLE_META, "", ""))

    rules = [("raw", s) for s in P.LINE_SEPARATORS] + [("stripped", P.TAGGED_SEPARATOR), ("raw", P.COLON_SEPARATOR)]
    quotes = f"[{P.TITLE_QUOTES}]([^{P.TITLE_QUOTES}]+)[{P.TITLE_QUOTES}]"
    lead, inner = (strip(f"regexp_extract(raw, {q('(?s)^(.*?)' + quotes)}, {i})") for i in (1, 2))
    artist = " ".join(f"WHEN contains({c}, {q(s)}) THEN {strip(f'split_part({c}, {q(s)}, 1)')}" for c, s in rules)
    title = " ".join(
        f"WHEN contains({c}, {q(s)}) THEN {clean(f'substr({c}, strpos({c}, {q(s)}) + {len(s)})')}" for c, s in rules
    )
    found = f"{lead} <> '' AND {inner} <> ''"
    return f"""
SELECT ord, raw, num, CASE {artist} WHEN {found} THEN {lead} END AS artist,
       CASE {title} WHEN {found} THEN {clean(inner)} END AS title
FROM (SELECT *, {sub('raw', P.TAG_PREFIX, '', '')} AS stripped FROM raw_line_src) t"""


step("parsed", ["raw_line_src"], parsed_lines())
COUNT = "TRY_CAST(replace(num, ',', '') AS BIGINT)"
step(
    "table_rows",
    ["parsed"],
    f"""
SELECT 'videos' AS kind, artist, title, {COUNT} AS total FROM parsed
UNION ALL
SELECT 'streams', CASE WHEN contains(raw, ' - ') THEN {strip("split_part(raw, ' - ', 1)")} END,
       CASE WHEN contains(raw, ' - ') THEN {strip("substr(raw, strpos(raw, ' - ') + 3)")} END, {COUNT} FROM parsed
UNION ALL
SELECT kind, CASE WHEN contains(raw, ' - ') THEN {strip("split_part(raw, ' - ', 1)")} END,
       CASE WHEN contains(raw, ' - ') THEN {strip("substr(raw, strpos(raw, ' - ') + 3)")} END, {COUNT}
FROM parsed, (VALUES ('store'), ('subscription')) k(kind)""",
)
USABLE = "artist IS NOT NULL AND title IS NOT NULL AND total IS NOT NULL AND (kind <> 'videos' OR (artist <> '' AND title <> ''))"
WEEKS = """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 28 DAY)) AS DATE) AS week_date FROM (
  SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders) b"""
TEXTS = "(SELECT artist FROM credit_src UNION SELECT artist FROM chart_src UNION SELECT artist FROM link_src)"
EXPORT = "SELECT ord, uri, title, artist, duration_ms, CASE WHEN ord % 2 = 0 THEN release_date END AS release_date"
PAYLOAD = (
    "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS playcount, "
    "CAST(0 AS BIGINT) AS listeners FROM events"
)
MIXED = """SELECT ord, title, artist, d AS date, CAST(p AS INT) AS peak_pos, CAST(w AS INT) AS weeks_on_chart,
       CAST(year(d) AS INT) AS year
FROM (SELECT ord, title, artist, TRY_CAST(peak_pos AS DOUBLE) AS p, TRY_CAST(weeks_on_chart AS DOUBLE) AS w,
             CAST(coalesce(TRY_CAST(TRY_CAST(date AS DATE) AS TIMESTAMP), try_strptime(date, '%m/%d/%Y')) AS DATE) AS d
      FROM mixed_src) x"""
READ = "date IS NOT NULL AND peak_pos IS NOT NULL AND weeks_on_chart IS NOT NULL"
_main, _feat = featured("artist")
INDEX_COLUMNS = (
    f"rank, {KEYS}, title, artist, bb_score, bb_peak, bb_chart_weeks, year, spotify_streams, spotify_streams_is_floor, "
    "youtube_views, itunes_total, apple_total, decade, sp_score, yt_score, itunes_score, apple_score, final_score"
)


def export_select(linked: bool) -> str:
    url, extra, join = (
        ("k.spotify_url", "k.release_year, k.duration_ms,", "LEFT JOIN (SELECT * FROM links WHERE spotify_url <> '') k USING (title, artist)")
        if linked
        else ("CAST(NULL AS VARCHAR) AS spotify_url", "", "")
    )
    return f"""
SELECT rank, i.title, array_to_string({collaborators('i.artist')}, ';') AS artist, year, {extra} decade, bb_peak,
       bb_chart_weeks, bb_score, spotify_streams, sp_score, youtube_views, yt_score, itunes_total, itunes_score,
       apple_total, apple_score, final_score, {url}
FROM index_c i {join}"""


CELLS = f"""{plain('year')} AS year, {fixed_1('final_score')} AS score, {plain('bb_peak', '#')} AS peak,
       {plain('bb_chart_weeks', '', 'w')} AS weeks, {grouped_int('spotify_streams', 'spotify_streams_is_floor')} AS spotify_streams,
       {grouped_int('youtube_views')} AS youtube_views, {grouped_int('itunes_total')} AS itunes_total,
       {grouped_int('apple_total')} AS apple_total"""


OVERALL_REPORT = (
    f"SELECT rank, title, {display_credit('artist')} AS artist, {CELLS}, spotify_url "
    "FROM top_songs JOIN links USING (title, artist)"
)
CHART_REPORT = (
    f"SELECT rank, title, {display_credit('artist')} AS artist, {plain('year')} AS year, score, "
    f"{plain('bb_peak', '#')} AS peak, {plain('bb_chart_weeks', '', 'w')} AS weeks FROM ("
    f"SELECT *, row_number() OVER (ORDER BY score DESC, {KEYS}) AS rank FROM "
    f"(SELECT *, {round_even('(bb_score * 100)', 1)} AS score FROM chart_scored) s) t "
    f"WHERE rank <= {SETTINGS.chart_top_n}"
)


def source_report(name: str, named: bool = True) -> str:
    m = SETTINGS.measure(name)
    source = f"'{name}' AS source, " if named else ""
    return f"""
SELECT {source}rank, title, {display_credit('artist')} AS artist, {plain('year')} AS year,
       {plain('decade', '', 's')} AS decade, {grouped_int(m.value_col)} AS value, {percent_1(m.score_col)} AS era_percentile
FROM (SELECT * EXCLUDE (rank), row_number() OVER (ORDER BY {m.value_col} DESC, {KEYS}) AS rank FROM index_c
      WHERE {m.value_col} IS NOT NULL) t WHERE rank <= {SETTINGS.source_top_n}"""


SCORES = ("bb_score", "sp_score", "yt_score", "itunes_score", "apple_score", "final_score")
REPORT = "rank title artist year"
#: Columns of a run's tables; ``SCORES``, and the chart report's score, hold fractions.
RUN_COLUMNS = {
    "scores": [c.strip() for c in INDEX_COLUMNS.split(",")],
    "full_export": [
        "rank", "title", "artist", "year", "release_year", "duration_ms", "decade", "bb_peak", "bb_chart_weeks",
        "spotify_streams", "youtube_views", "itunes_total", "apple_total", *SCORES, "spotify_url",
    ],
    "links": ["title", "artist", "spotify_url", "duration_ms", "release_year"],
    "report_overall": [
        *REPORT.split(), "score", "peak", "weeks", "spotify_streams", "youtube_views", "itunes_total", "apple_total", "spotify_url",
    ],
    "report_chart": [*REPORT.split(), "score", "peak", "weeks"],
    "report_source": [*REPORT.split(), "decade", "value", "era_percentile"],
}


def summed(name: str, sql: str, columns: list[str]) -> str:
    """Name, rows and the portable checksum of a table."""
    fractions = {*SCORES, "score"} if name == "report_chart" else SCORES
    parts = [f"CAST(round({c} * 1000000) AS BIGINT)" if c in fractions else c for c in sorted(columns)]
    row = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '-')" for p in parts)
    head = f"CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 8) AS BIGINT)"
    return f"SELECT '{name}' AS name, count(*) AS n, CAST(coalesce(sum({head}), 0) AS BIGINT) AS checksum FROM ({sql}) t_{name}"


LI, A_TAG = r"(?is)<li\b[^>]*>(.*?)</li>", r"(?is)<a\b[^>]*>(.*?)</a>"


def entities(x: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def oracle_sql() -> dict[str, str]:
    a = answer
    found = {
        # scans and sources
        "scan_chart": a(
            "SELECT ord, title, artist, date, peak_pos, weeks_on_chart, CAST(year(date) AS INT) AS year FROM chart_src",
            "chart_src",
        ),
        "scan_measures": a(
            long_measures("keyed", f"{KEYS}, title, artist, ord, value"), *[f"{n}_keyed" for n in MEASURE_VIEWS]
        ),
        "scan_synonyms": a(f"{EXPORT} FROM link_src", "link_src"),
        "scan_union_files": a(f"{EXPORT}, CAST(ord % 2 AS INT) AS file_ord FROM link_src", "link_src"),
        "scan_mixed_texts": a(f"SELECT * FROM ({MIXED}) m WHERE {READ}", "mixed_src"),
        "scan_csv_exports": a("SELECT kt, kp, spotify_url, duration_ms, release_year FROM by_pair", "by_pair"),
        "score_missing_source": a("SELECT * EXCLUDE (top) FROM index_m", "index_m"),
        "extract_page_items": f"""
SELECT page_id, CAST(pos - 1 AS INT) AS pos, {strip(entities(strip(sub('item', r'\s*<[^>]*>\s*'))))} AS item FROM (
  SELECT page_id, pos, regexp_extract(li, {q(A_TAG)}, 1) AS item FROM (
    SELECT page_id, unnest(l) AS li, generate_subscripts(l, 1) AS pos
    FROM (SELECT page_id, regexp_extract_all(html, {q(LI)}, 1) AS l FROM pages) p) r
  WHERE regexp_matches(li, {q(A_TAG)})) t""",
        "extract_table_totals": a(f"SELECT * FROM table_rows WHERE {USABLE}", "table_rows"),
        "calendar_weeks": WEEKS,
        "pending_weeks": f"SELECT week_date FROM ({WEEKS}) w WHERE week_date NOT IN (SELECT CAST(o_orderdate AS DATE) "
        "FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')",
        "flatten_snapshot": "SELECT doc_id, CAST(position AS INT) AS position, line, CAST(length(line) AS INT) AS size FROM ("
        "SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS position FROM "
        "(SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) d) t",
        "json_defaults": PAYLOAD,
        "json_positive": f"SELECT * FROM ({PAYLOAD}) p WHERE playcount > 0",
        # sinks
        "sink_scores": a("SELECT rank, title, artist, final_score FROM index_c", "index_c"),
        "songs_only": a("SELECT title, artist FROM songs_c", "songs_c"),
        "full_export": a(export_select(True), "index_c", "links"),
        "songs_csv": a("SELECT title, artist FROM songs_c", "songs_c"),
        "export_csv": a(export_select(True), "index_c", "links"),
        "append_dedup": a(
            "SELECT title, artist, itunes_total AS playcount FROM store_src UNION ALL "
            "SELECT title, artist, spotify_streams FROM streams_src s WHERE NOT EXISTS "
            "(SELECT 1 FROM store_src e WHERE e.title = s.title AND e.artist = s.artist)",
            "store_src",
            "streams_src",
        ),
        # projections and predicates
        "coerce_numeric": a(
            "SELECT ord, CAST(TRY_CAST(release_date AS DOUBLE) AS INT) AS release_number, "
            "TRY_CAST(duration_ms AS BIGINT) AS duration_ms FROM link_src",
            "link_src",
        ),
        "decade_bucket": a(
            "SELECT ord, y AS release_year, CAST(coalesce(y, 0) // 10 * 10 AS INT) AS decade FROM "
            "(SELECT ord, TRY_CAST(regexp_extract(release_date, '\\d{4}') AS INT) AS y FROM link_src) t",
            "link_src",
        ),
        "variant_flag": a(
            "SELECT ord, raw, coalesce(regexp_matches(raw, '(?i)\\blive\\b'), false) AS is_variant FROM raw_line_src",
            "raw_line_src",
        ),
        # joins
        "chart_aggregate": a("SELECT * FROM chart_agg", "chart_agg"),
        "merge_measures": a(
            f"SELECT {KEYS}, title, artist, bb_score, bb_peak, bb_chart_weeks, year, "
            "CASE WHEN NOT spotify_streams_is_floor THEN spotify_streams END AS spotify_streams, "
            "youtube_views, itunes_total, apple_total FROM merged_c",
            "merged_c",
        ),
        "playlist_membership": a(
            f"SELECT {KEYS}, EXISTS (SELECT 1 FROM {HI.playlist}_keys k WHERE k.key_title = c.key_title "
            "AND k.key_artist = c.key_artist) AS in_playlist FROM chart_agg c",
            "chart_agg",
            f"{HI.playlist}_keys",
        ),
        "link_lookup": a(linked("songs_c"), "songs_c", "by_pair", "by_title"),
        "unambiguous_titles": a(
            "SELECT kt, kp, spotify_url, duration_ms, release_year FROM by_title", "by_title"
        ),
        "validated_join": a(
            "SELECT c.ord, c.title, c.artist, s.itunes_total FROM chart_src c LEFT JOIN store_src s "
            "ON s.title = c.title AND s.artist = c.artist",
            "chart_src",
            "store_src",
        ),
        "last_wins_lookup": a(
            "SELECT title, artist, uri FROM (SELECT *, row_number() OVER (PARTITION BY title, artist "
            "ORDER BY ord DESC, uri DESC) AS rn FROM link_src) t WHERE rn = 1",
            "link_src",
        ),
        "alias_map": a(
            f"SELECT ord, artist, ka AS own_key, {alias('ka')} AS key_artist "
            f"FROM (SELECT *, {artist_base('artist')} AS ka FROM chart_src) t",
            "chart_src",
        ),
        # aggregations
        "year_value_hist": a("SELECT year, bb_peak, count(*) AS n FROM chart_agg GROUP BY year, bb_peak", "chart_agg"),
        "scale_to_100": a(f"SELECT {KEYS}, final_score FROM index_c", "index_c"),
        "audit_counts": a(
            "SELECT (SELECT count(*) FROM index_c) AS songs, "
            "(SELECT count(*) FROM index_c WHERE spotify_streams_is_floor) AS floors_applied, "
            "(SELECT count(*) FROM links) AS songs_looked_up, (SELECT count(spotify_url) FROM links) AS links_found, "
            f"(SELECT count(*) FROM table_rows WHERE kind = 'videos' AND NOT ({USABLE})) AS rejected_rows, "
            f"(SELECT count(*) FROM ({MIXED}) m WHERE NOT ({READ})) AS chart_rows_unread, "
            f"(SELECT count(*) FROM ({MIXED}) m WHERE {READ} AND title IS NULL) AS rows_without_name",
            "index_c",
            "links",
            "table_rows",
            "mixed_src",
        ),
        # windows
        "rolling_percentile_low": a(f"SELECT {KEYS}, year, bb_peak, peak_pct FROM chart_scored", "chart_scored"),
        "rolling_percentile_high": a(
            f"SELECT {KEYS}, year, bb_chart_weeks, weeks_pct FROM chart_scored", "chart_scored"
        ),
        "decade_percentile": a(
            f"SELECT {KEYS}, decade, sp_score, yt_score, itunes_score, apple_score FROM scored_c", "scored_c"
        ),
        "best_per_key": a(
            f"SELECT {KEYS}, title, artist, ord, value AS youtube_views FROM videos_best", "videos_best"
        ),
        "first_per_key": a(
            f"SELECT {KEYS}, ord, title, artist FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} "
            "ORDER BY ord, title, artist) AS rn FROM chart_keyed) t WHERE rn = 1",
            "chart_keyed",
        ),
        "authoritative_flag": a(
            f"SELECT {KEYS}, title, artist, ord, value AS spotify_streams, authoritative FROM streams_flagged",
            "streams_flagged",
        ),
        "final_rank": a(f"SELECT rank, {KEYS}, final_score FROM index_c", "index_c"),
        # sorts and limits
        "top_n": a(f"SELECT rank, title, artist, final_score FROM index_c WHERE rank <= {SETTINGS.top_n}", "index_c"),
        "top_n_measure": a(
            f"SELECT {KEYS}, title, artist, youtube_views FROM index_c WHERE youtube_views IS NOT NULL "
            f"ORDER BY youtube_views DESC, {KEYS} LIMIT {SETTINGS.source_top_n}",
            "index_c",
        ),
        # set operations
        "song_list": a(f"SELECT {KEYS}, title, artist FROM songs_c", "songs_c"),
        "candidate_pool": a(
            "SELECT title, artist FROM ("
            f"SELECT title, artist FROM index_c ORDER BY final_score DESC, {KEYS} LIMIT {SETTINGS.candidate_pool_n}) x "
            "UNION SELECT title, artist FROM (SELECT title, artist FROM index_c WHERE bb_score IS NOT NULL "
            f"ORDER BY bb_score DESC, {KEYS} LIMIT {SETTINGS.candidate_pool_n}) y",
            "index_c",
        ),
        # entity resolution
        "artist_tokens": a(
            f"SELECT DISTINCT ord, {alias('base')} AS token FROM (SELECT ord, {artist_base('name')} AS base FROM "
            f"(SELECT ord, unnest({collaborators('artist')}) AS name FROM credit_src) u) v WHERE base <> ''",
            "credit_src",
        ),
        "entity_clusters": a("SELECT * FROM canon", "canon"),
        "clusters_after_batch": a("SELECT * FROM canon", "canon"),
        "apply_clusters": a(
            f"SELECT source, {KEYS}, own_artist, title, artist, value, bb_score FROM best_c", "best_c"
        ),
        # scoring
        "chart_score": a(f"SELECT {KEYS}, bb_score FROM chart_scored", "chart_scored"),
        "stream_floors": a(f"SELECT {KEYS}, spotify_streams, spotify_streams_is_floor FROM merged_c", "merged_c"),
        "weighted_score": a(f"SELECT {KEYS}, final_score FROM weighted_c", "weighted_c"),
        # scalar functions
        "strip_accents": "SELECT doc_id, strip_accents(text) AS text FROM documents",
        "title_key": a(f"SELECT ord, title, {title_key('title')} AS key_title FROM chart_src", "chart_src"),
        "artist_key": a(
            f"SELECT artist, {artist_base('artist')} AS key_artist FROM {TEXTS} t", "credit_src", "chart_src", "link_src"
        ),
        "link_title_key": a(f"SELECT ord, title, {link_title_key('title')} AS kt FROM link_src", "link_src"),
        "primary_artist": a(
            f"SELECT artist, {primary('artist')} AS kp FROM {TEXTS} t", "credit_src", "chart_src", "link_src"
        ),
        "split_featured": a(
            f"SELECT artist, {_main} AS main, {_feat} AS featured FROM {TEXTS} t", "credit_src", "chart_src", "link_src"
        ),
        "split_collaborators": a(
            "SELECT ord, CAST(generate_subscripts(names, 1) - 1 AS INT) AS pos, unnest(names) AS name "
            f"FROM (SELECT ord, {collaborators('artist')} AS names FROM credit_src) t",
            "credit_src",
        ),
        "parse_lines": a("SELECT ord, raw, artist, title FROM parsed", "parsed"),
        "parse_numbers": a(f"SELECT ord, num, {COUNT} AS total FROM raw_line_src WHERE {COUNT} IS NOT NULL", "raw_line_src"),
        "release_year": a(
            "SELECT ord, release_date, TRY_CAST(regexp_extract(release_date, '\\d{4}') AS INT) AS release_year FROM link_src",
            "link_src",
        ),
        "uri_to_url": a(
            f"SELECT ord, replace(uri, {q(P.TRACK_URI_PREFIX)}, {q(P.TRACK_URL_PREFIX)}) AS url FROM link_src", "link_src"
        ),
        "first_of_list": a(
            f"SELECT title, artists, split_part(artists, ';', 1) AS artist FROM {HI.playlist}", HI.playlist
        ),
        "collaborators_joined": a(
            f"SELECT artist, array_to_string({collaborators('artist')}, ';') AS names FROM {TEXTS} t",
            "credit_src",
            "chart_src",
            "link_src",
        ),
        "display_credit": a(
            f"SELECT artist, {display_credit('artist')} AS display FROM {TEXTS} t", "credit_src", "chart_src", "link_src"
        ),
        "display_format": a(
            f"SELECT {KEYS}, {CELLS}, {plain('decade', '', 's')} AS decade, {percent_1('sp_score')} AS era_percentile "
            "FROM index_c",
            "index_c",
        ),
        # whole runs
        "popularity_index": a(f"SELECT {INDEX_COLUMNS} FROM index_c", "index_c"),
        "resolve_links": a("SELECT * FROM links", "links"),
        "report_overall": a(
            OVERALL_REPORT,
            "top_songs",
            "links",
        ),
        "report_chart": a(CHART_REPORT, "chart_scored"),
        "report_source": a(" UNION ALL ".join(source_report(n) for n in MEASURE_VIEWS), "index_c"),
        "quick_run": a(export_select(False), "index_c"),
    }
    run = {
        "scores": f"SELECT {INDEX_COLUMNS} FROM index_c",
        "full_export": export_select(True),
        "links": "SELECT * FROM links",
        "report_overall": OVERALL_REPORT,
        "report_chart": CHART_REPORT,
        **{f"report_{m.name}": source_report(m.name, named=False) for m in SETTINGS.measures},
    }
    sums = [summed(name, sql, RUN_COLUMNS[name if name in RUN_COLUMNS else "report_source"]) for name, sql in run.items()]
    found["full_run"] = a(" UNION ALL ".join(sums), "index_c", "links", "top_songs", "chart_scored")
    found["append_stored"] = found["append_dedup"]
    return found
