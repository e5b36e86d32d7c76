import datetime as dt

import pytest
from pyspark.sql import functions as F

from evergreen.config import Floor, MeasureDim, Settings
from evergreen.plans import run
from evergreen.plans.scores import Sources, merged_songs, ranked_songs, song_list
from evergreen.sources import exports, files, pages, snapshots
from evergreen.sources.chart import chart_aggregate, chart_rows
from evergreen.streaming.incremental import ingest

CHART = "date string, title string, artist string, peak_pos string, weeks_on_chart string, ord long"


@pytest.fixture(scope="module")
def small(spark):
    chart = spark.createDataFrame(
        [
            ("2005-01-01", "We Found Love", "Rihanna Featuring Calvin Harris", "1", "3", 1),
            ("2005-01-08", "We Found Love", "Rihanna Featuring Calvin Harris", "2", "4", 2),
            ("2005-01-08", "We Found Love (Live)", "Rihanna", "5", "1", 3),
            ("2018-03-03", "Save Your Tears", "The Weeknd & Ariana Grande", "4", "1", 4),
            ("bad date", "Dropped", "X", "1", "1", 5),
            ("2018-03-03", "Dropped", "X", "n/a", "1", 6),
            ("2018-03-10", "Known From List", "Someone", "9", "1", 7),
        ],
        CHART,
    )
    streams = spark.createDataFrame(
        [
            ("We Found Love", "Calvin Harris", 900, 1),
            ("Save Your Tears", "The Weeknd", 700, 2),
            ("Save Your Tears (Remix)", "The Weeknd", 300, 3),
            ("Only Here", "Nobody", 50, 4),
        ],
        "title string, artist string, spotify_streams long, ord long",
    )
    videos = spark.createDataFrame([("Only Here", "Nobody", 7, 1)], "title string, artist string, youtube_views long, ord long")
    playlists = {
        "playlist_hi": spark.createDataFrame([("Known From List", "Someone;Else")], "title string, artists string"),
        "playlist_lo": spark.createDataFrame(
            [("Known From List", "Someone"), ("We Found Love", "Rihanna")], "title string, artists string"
        ),
    }
    return Sources(chart, {"streams": streams, "videos": videos}, playlists)


def test_chart_rows_drop_unreadable_and_aggregate(small):
    rows = {r.key_title: r for r in chart_aggregate(chart_rows(small.chart), Settings()).collect()}
    assert set(rows) == {"we found love", "save your tears", "known from list"}
    love = rows["we found love"]
    assert (love.title, love.artist, love.bb_peak, love.bb_chart_weeks, love.year, love.decade) == (
        "We Found Love", "Rihanna Featuring Calvin Harris", 1, 2, 2005, 2000,
    )


def test_whole_ranking(small):
    rows = {r.key_title: r for r in ranked_songs(small).collect()}
    assert len(rows) == 4 and sorted(r["rank"] for r in rows.values()) == [1, 2, 3, 4]
    love = rows["we found love"]
    assert (love.key_artist, love.spotify_streams, love.spotify_streams_is_floor) == ("rihanna", 900, False)
    tears = rows["save your tears"]
    assert (tears.title, tears.artist, tears.spotify_streams) == ("Save Your Tears", "The Weeknd", 700)
    listed = rows["known from list"]
    assert (listed.spotify_streams, listed.spotify_streams_is_floor) == (500_000_000, True)
    assert (rows["only here"].year, rows["only here"].decade, rows["only here"].bb_score) == (None, 0, None)
    assert max(r.final_score for r in rows.values()) == 100.0


def test_row_order_does_not_matter(small):
    shuffled = Sources(
        small.chart.orderBy(F.rand(1)),
        {n: m.orderBy(F.rand(2)) for n, m in small.measures.items()},
        small.playlists,
    )
    assert sorted(ranked_songs(small).collect()) == sorted(ranked_songs(shuffled).collect())


@pytest.mark.parametrize("missing", ["chart", "streams", "videos", "playlists"])
def test_missing_sources(small, missing):
    src = {
        "chart": Sources(None, small.measures, small.playlists),
        "playlists": Sources(small.chart, small.measures),
    }.get(missing) or Sources(small.chart, {n: m for n, m in small.measures.items() if n != missing}, small.playlists)
    index = ranked_songs(src)
    gone = {"chart": "bb_score", "streams": "spotify_streams", "videos": "youtube_views"}.get(missing)
    assert gone not in index.columns and "year" in index.columns
    assert index.count() == {"chart": 3, "streams": 4, "videos": 4, "playlists": 4}[missing]


def test_no_source_is_an_error():
    with pytest.raises(ValueError):
        ranked_songs(Sources())


def test_song_list_and_merge_keep_one_row_per_key(small):
    assert song_list(small, Settings()).count() == 4
    merged = merged_songs(small, Settings())
    assert merged.count() == merged.select("key_title", "key_artist").distinct().count() == 4


def test_run_modes(spark, small, tmp_path):
    links = spark.createDataFrame(
        [("spotify:track:1", "Save Your Tears", "The Weeknd", "1000", "2020-03-20", 1)],
        "`Track URI` string, `Track Name` string, `Artist Name(s)` string, `Duration (ms)` string, `Release Date` string, ord long",
    )
    out = run.run(small, exports.union_exports([links]))
    assert set(out) == {
        "scores", "full_export", "links", "report_overall", "report_chart", "report_streams", "report_videos",
    }
    found = {r.title: (r.spotify_url, r.duration_ms, r.release_year) for r in out["links"].collect()}
    assert found["Save Your Tears"] == ("https://open.spotify.com/track/1", 1000, 2020)
    export = {r.title: r for r in out["full_export"].collect()}
    assert export["We Found Love"].artist == "Rihanna;Calvin Harris" and export["We Found Love"].spotify_url is None
    assert out["full_export"].columns[:5] == ["rank", "title", "artist", "year", "release_year"]
    assert [r["rank"] for r in out["report_streams"].collect()] == [1, 2, 3, 4]
    assert {r.peak for r in out["report_chart"].collect()} == {"#1", "#4", "#9"}
    quick = run.run(small, quick=True)
    assert set(quick) == {"scores", "full_export"}
    for fmt in ("csv", "parquet"):
        run.write_table(out["scores"], str(tmp_path / fmt), fmt, order="rank")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == out["scores"].columns and back.count() == 4
    audit = run.audit(out["scores"], out["links"], "spotify_streams_is_floor").first()
    assert tuple(audit) == (4, 1, 4, 1)


def test_settings_are_parameters(spark, small):
    settings = Settings(
        measures=(MeasureDim("streams", "spotify_streams", "sp_score", 1.0, trusted=True),), chart_weight=0.0, floors=(Floor("playlist_lo", 5),)
    )
    rows = {r.key_title: r for r in ranked_songs(small, settings).collect()}
    assert rows["known from list"].spotify_streams == 5
    assert rows["we found love"].final_score == 100.0


def test_csv_inputs(spark, tmp_path):
    (tmp_path / "chart.csv").write_text(
        '1Date,Song,Artist,Peak Position,Weeks in Charts,Extra\n2001-02-03,"Hello, ""You""",NA,7,2,z\n'
    )
    raw = files.pick(files.read_text_columns(spark, str(tmp_path / "chart.csv")), files.CHART_COLUMNS)
    row = chart_rows(raw).first()
    assert (row.title, row.artist, row.peak_pos, row.year, row.date) == ('Hello, "You"', "NA", 7, 2001, dt.date(2001, 2, 3))
    a, b, c = (tmp_path / n for n in ("a.csv", "b.csv", "c.csv"))
    b.write_text("Track URI,Track Name,Artist Name(s),Track Duration (ms),Album Release Date\nu2,T,A,5,1999\n")
    a.write_text("Track Name,Artist Name(s),Track URI,Duration (ms)\nT,A,u1,x\n")
    c.write_text("Track Name,Other\nT,A\n")
    links = exports.link_rows(exports.read_exports(spark, [str(p) for p in (b, c, a)]))
    got = exports.links_by_pair(links).collect()
    assert [(r.spotify_url, r.duration_ms, r.release_year, r.file_ord) for r in got] == [("u1", None, None, 0)]


def test_short_and_overlong_lines_are_rescued(spark, tmp_path):
    """Every line is a row or in the rescued column, and malformed ones are counted while they are read."""
    lines = ["2001-02-03,T1,A,7,2", "2001-02-03,T2,A", "2001-02-03,T3,A,7,2,extra,more", '2001-02-03,"T,4",A,7,2']
    (tmp_path / "chart.csv").write_text("\n".join(["1Date,Song,Artist,Peak Position,Weeks in Charts", *lines]) + "\n")
    for multi_line in (True, False):
        raw = files.read_text_columns(spark, str(tmp_path / "chart.csv"), multi_line=multi_line, rescue=True)
        picked = files.pick(raw, files.CHART_COLUMNS)
        got = {r.title: (r.peak_pos, r.rescued) for r in picked.collect()}
        assert got == {"T1": ("7", None), "T2": (None, lines[1]), "T3": ("7", lines[2]), "T,4": ("7", None)}
        # Two columns of the file are enough: pruned columns do not hide that a line is malformed.
        assert picked.select("title", "rescued").filter("rescued is not null").count() == 2
        read, seen = run.watched(Sources(picked))
        assert {r.title for r in chart_rows(read.chart).collect()} == {"T1", "T3", "T,4"}
        counts = run.dropped_rows(spark, seen).first()
        assert (counts.malformed_lines, counts.chart_rows_unread, counts.rows_without_name) == (2, 1, 0)


def test_rescued_lines_of_exports(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Track URI,Track Name,Artist Name(s)\nu1,T,A\nu2,T2\nu3,T3,C,x\n")
    rows = exports.read_exports(spark, [str(tmp_path / "a.csv")], rescue=True)
    assert {(r.uri, r.rescued) for r in rows.collect()} == {("u1", None), ("u2", "u2,T2"), ("u3", "u3,T3,C,x")}
    assert exports.link_rows(rows).count() == 2
    (tmp_path / "b.csv").write_text("rescued,b\n1,2\n")
    with pytest.raises(ValueError, match="rescued"):
        files.read_text_columns(spark, str(tmp_path / "b.csv"), rescue=True)


TABLE = """<html><table class="x"><thead><tr><th>h</th></tr></thead><tbody>
<tr><td class="text"><div><a href="u">AC/DC - Back &amp; Black</a></div></td><td>1,234</td><td/><td>.</td><td>77</td></tr>
<tr><td>No separator</td><td>9</td></tr><tr><td>A - B</td><td>n/a</td></tr><tr><td>only one</td></tr>
<tr><td>A | B ft. C</td><td>5</td></tr></tbody></table><table><tbody><tr><td>X - Y</td><td>1</td></tr></tbody></table></html>"""


def test_page_totals(spark):
    df = spark.createDataFrame([("u", TABLE)], "url string, html string")

    def read(page):
        return [(r.artist, r.title, r[4]) for r in pages.extract_totals(df, ["url"], page).orderBy("pos").collect()]

    assert read(pages.STREAM_TOTALS) == [("AC/DC", "Back & Black", 1234)]
    assert read(pages.VIDEO_TOTALS) == [("AC/DC", "Back & Black", 1234), ("A", "B", 5)]
    assert pages.page_totals(df, ["url"], pages.VIDEO_TOTALS).count() == 4


def test_store_page_reads_the_fifth_cell(spark):
    html = "<table><tbody><tr><td>A - B</td><td>1</td><td>2</td><td>3</td><td>4,000</td></tr><tr><td>C - D</td></tr></tbody></table>"
    df = spark.createDataFrame([("u", html)], "url string, html string")
    assert [tuple(r) for r in pages.extract_totals(df, ["url"], pages.STORE_TOTALS).collect()] == [("u", 0, "A", "B", 4000)]


def test_calendar_and_pending(spark):
    weeks = snapshots.calendar_between(spark, "1958-08-04", "1958-10-27")
    assert [str(r.week_date) for r in weeks.orderBy("week_date").collect()] == [
        "1958-08-04", "1958-09-01", "1958-09-29", "1958-10-27",
    ]
    loaded = weeks.filter("week_date < date'1958-09-15'")
    assert snapshots.pending(weeks, loaded, ["week_date"]).count() == 2


def test_payload_defaults(spark):
    bodies = ['{"track": {"playcount": "12"}}', '{"error": 6, "track": {"playcount": "9"}}', "not json", '{"track": {"playcount": "x"}}', None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = snapshots.payload_counts(df, ["i"], "body", {"playcount": "$.track.playcount"}).orderBy("i").collect()
    assert [r.playcount for r in got] == [12, 0, 0, 0, 0]


def test_one_bad_number_zeroes_the_row(spark):
    df = spark.createDataFrame([('{"p": "12", "l": "x"}',), ('{"p": "12"}',), ('{"p": "3", "l": "4"}',)], "body string")
    got = snapshots.payload_counts(df, [], "body", {"p": "$.p", "l": "$.l"}).collect()
    assert [tuple(r) for r in got] == [(0, 0), (12, 0), (3, 4)]


def test_other_dates_and_tolerant_numbers(spark):
    from pyspark.sql import functions as F

    from evergreen.sources import files

    texts = ["1958-08-04", "8/4/1958", "August 4, 1958", "4 Aug 1958", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r[0]) for r in df.select(files.calendar_date(df, "t")).collect()]
    assert got == ["1958-08-04"] * 4 + ["None"] * 2
    numbers = spark.createDataFrame([(t,) for t in ["210000.0", "9007199254740993", "x", None]], "t string")
    got = [r[0] for r in numbers.select(files.to_number(F.col("t"), "bigint")).collect()]
    assert got == [210000, 9007199254740993, None, None]


def test_quoted_line_breaks_and_file_order(spark, tmp_path):
    from evergreen.operators.dedup import first_per_key
    from evergreen.sources.files import read_text_columns

    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"{i % 50},late\n" for i in range(3000)))
    (tmp_path / "a.csv").write_text('k,v\n0,"two\nlines"\n1,early\n')
    rows = read_text_columns(spark, str(tmp_path))
    assert rows.count() == 3002
    first = {r.k: r.v for r in first_per_key(rows, ["k"], ["ord"]).collect()}
    assert first["0"] == "two\nlines" and first["1"] == "early" and first["2"] == "late"


def test_ingest_resumes_and_keeps_stored_rows(spark, tmp_path):
    schema = "week_date string, title string, rank int"
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def drop(rows):
        spark.createDataFrame(rows, schema).write.mode("append").json(src)

    def drain():
        ingest(spark.readStream.schema(schema).json(src), out, ["week_date", "title"], ck).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    drop([("2001-01-01", "a", 1), ("2001-01-01", "b", 2)])
    first = drain()
    drop([("2001-01-01", "a", 9), ("2001-01-29", "a", 3), ("2001-01-29", "a", 4)])
    assert drain() == sorted(first + [("2001-01-29", "a", 3)])


def test_pages_with_comments_and_without_end_tags(spark):
    html = "<table><tbody><!-- <tr><td>no</td><td>0</td></tr> --><tr><td>a<td>1<tr><td>b</td><td>2</td></tr></tbody></table>"
    df = spark.createDataFrame([(1, html)], "i int, html string")
    got = pages.page_rows(df, ["i"], pages.TABLE, 2).orderBy("pos").collect()
    assert [list(r.cells) for r in got] == [["a", "1"], ["b", "2"]]


def test_a_run_leaves_no_folder(spark, small, tmp_path):
    import os

    from evergreen.session import checkpoint_root, materialize, run_folder

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with run_folder(spark) as folder:
        run.write_table(run.run(small)["full_export"], str(tmp_path / "out"), order="rank")
        assert os.path.isdir(folder.removeprefix("file:"))
        kept = materialize(spark.range(3), "kept", keep=True)
    assert [n.split("-")[1] for n in set(os.listdir(root)) - before] == ["kept"] and kept.count() == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_the_trusted_measure_may_stand_anywhere(spark, small):
    measures = (
        MeasureDim("videos", "youtube_views", "yt_score", 0.5),
        MeasureDim("streams", "spotify_streams", "sp_score", 0.5, trusted=True),
    )
    got = {r.key_title: r for r in ranked_songs(small, Settings(measures=measures)).collect()}
    assert got["save your tears"].title == "Save Your Tears"
    assert got["known from list"].spotify_streams == 500_000_000 and got["known from list"].spotify_streams_is_floor
    none = tuple(MeasureDim(m.name, m.value_col, m.score_col, m.weight) for m in measures)
    plain = {r.key_title: r for r in ranked_songs(small, Settings(measures=none)).collect()}
    assert plain["known from list"].spotify_streams is None


def test_dropped_rows_are_counted_by_reason(spark, small):
    nameless = spark.createDataFrame([(None, "x", 1, 1)], small.measures["streams"].schema)
    sources = Sources(small.chart, {"streams": small.measures["streams"].union(nameless)}, small.playlists)
    scores = spark.createDataFrame([(1, False)], "rank int, floor boolean")
    links = spark.createDataFrame([("u",), (None,)], "spotify_url string")
    read, seen = run.watched(sources)
    ranked_songs(read)
    row = run.audit(scores, links, "floor", seen=seen).first()
    assert (row.songs, row.links_found, row.chart_rows_unread, row.rows_without_name) == (1, 1, 2, 1)


def test_csv_sink_keeps_every_text_that_is_not_empty(spark, tmp_path):
    rows = [(1, ' a, "b" '), (2, "line\nbreak"), (3, "back\\slash"), (4, None)]
    path = str(tmp_path / "csv")
    run.write_table(spark.createDataFrame(rows, "id int, t string"), path, "csv", "id")
    back = spark.read.schema("id int, t string").options(header=True, escape='"', multiLine=True).csv(path)
    assert sorted((r.id, r.t) for r in back.collect()) == rows


def test_character_references(spark):
    cases = {"a &amp; b": "a & b", "&#39;&#x1F600;": "'\U0001f600", "&no; & &": "&no; & &", "&#1114112;&#xD800;": "��",
             "&eacute;\n&apos;&copy": "é\n'&copy", "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.got for r in df.select("t", pages.decode_references(F.col("t")).alias("got")).collect()} == cases
