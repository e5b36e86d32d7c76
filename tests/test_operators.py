import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evergreen.operators import cluster, dedup, lookup, order, percentile, ranking, scoring, skew

KEYS = ["key_title", "key_artist"]


def brute_rolling(rows, half, up):
    out = {}
    for k, y, v in rows:
        cohort = [w for _, z, w in rows if abs(z - y) <= half]
        beaten = sum(w < v for w in cohort) if up else sum(w > v for w in cohort)
        out[k] = (beaten + 0.5 * cohort.count(v)) / len(cohort)
    return out


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 5}], ids=["plain", "salted"])
def test_rolling_percentile_against_brute_force(spark, limits):
    rng = random.Random(7)
    rows = [(str(i), rng.randint(1990, 1999), rng.choice([1, 1, 1, 2, 5, 9, 40])) for i in range(300)]
    df = spark.createDataFrame([("t", k, y, v, v) for k, y, v in rows], "key_title string, key_artist string, y int, a int, b int")
    got = percentile.rolling_percentiles(df, KEYS, "y", {"a": "pa", "b": "pb"}, {"b"}, 2, **limits).collect()
    assert {r.key_artist: r.pa for r in got} == brute_rolling(rows, 2, False)
    assert {r.key_artist: r.pb for r in got} == brute_rolling(rows, 2, True)


def test_rolling_percentile_worked_example(spark):
    df = spark.createDataFrame(
        [("t", "a", 2000, 1), ("t", "b", 2000, 5), ("t", "c", 2003, 5), ("t", "d", 2010, 5)],
        "key_title string, key_artist string, y int, v int",
    )
    got = percentile.rolling_percentiles(df, KEYS, "y", {"v": "p"}, set(), 5).collect()
    assert {r.key_artist: r.p for r in got} == {"a": 2.5 / 3, "b": 1 / 3, "c": 1 / 3, "d": 0.5}


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 3}], ids=["plain", "salted"])
def test_group_percentile(spark, limits):
    rng = random.Random(3)
    values = [10, 10, 30, None, 2**21, 2**21 + 1, 2**45, 2**45 + 7, 2**62, 0] + [rng.randrange(2**50) for _ in range(60)]
    rows = [("t", str(i), i % 2 * 1990, v) for i, v in enumerate(values * 2)]
    df = spark.createDataFrame(rows, "key_title string, key_artist string, g int, v long")
    got = {r.key_artist: r.p for r in percentile.group_percentiles(df, KEYS, "g", {"v": "p"}, **limits).collect()}
    for _, k, g, v in rows:
        peers = [w for _, _, h, w in rows if h == g and w is not None]
        below, ties = sum(w < v for w in peers) if v is not None else 0, peers.count(v)
        assert got[k] == (None if v is None else (below + (ties + 1) / 2) / len(peers))


def test_group_percentile_worked_example(spark):
    df = spark.createDataFrame(
        [("t", k, 0, v) for k, v in zip("abcd", [10, 10, 30, None])], "key_title string, key_artist string, g int, v long"
    )
    got = {r.key_artist: r.p for r in percentile.group_percentiles(df, KEYS, "g", {"v": "p"}).collect()}
    assert got == {"a": 0.5, "b": 0.5, "c": 1.0, "d": None}


def test_fractional_measures(spark):
    """Values keep their fractions, whatever plan they take."""
    rows = [("t", k, 0, v) for k, v in zip("abcde", [1.2, 1.7, 3.0, None, -0.5])]
    df = spark.createDataFrame(rows, "key_title string, key_artist string, g int, v double")
    for limits in ({}, {"hot_rows": 1}):
        got = {r.key_artist: r.p for r in percentile.group_percentiles(df, KEYS, "g", {"v": "p"}, **limits).collect()}
        assert got == {"e": 0.25, "a": 0.5, "b": 0.75, "c": 1.0, "d": None}
    with pytest.raises(TypeError):
        percentile.group_percentiles(df.withColumn("v", F.lit("x")), KEYS, "g", {"v": "p"})


def test_running_counts_levels_agree(spark):
    rng = random.Random(1)
    rows = [(i % 3, rng.randrange(2**60), rng.randint(1, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, v long, n long").groupBy("g", "v").agg(F.sum("n").alias("n"))
    flat = {tuple(r) for r in percentile.running_counts(df, ["g"], "v", 21).collect()}
    deep = {tuple(r) for r in percentile.running_counts(df, ["g"], "v", 63).collect()}
    assert flat == deep and len(flat) == df.count()


def test_skew_join_equals_plain_join(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 50).cast("int").alias("k"))
    side = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("x"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        plain = sorted(map(tuple, rows.join(side, ["k"], how).select("id", "k", "x").collect()), key=str)
        salted = skew.skew_join(rows, side, ["k"], counts, ["id"], how, hot_rows=30).select("id", "k", "x").collect()
        assert sorted(map(tuple, salted), key=str) == plain


def test_best_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5), ("a", 3, 5), ("b", 9, None), ("b", 4, None)], "k string, ord int, v int"
    )
    assert sorted(map(tuple, dedup.best_per_key(df, ["k"], "v", ["ord"]).collect())) == [("a", 2, 5), ("b", 4, None)]
    assert sorted(map(tuple, dedup.first_per_key(df, ["k"], ["ord"]).collect())) == [("a", 1, None), ("b", 4, None)]
    assert sorted(map(tuple, lookup.last_per_key(df, ["k"], ["ord"]).collect())) == [("a", 3, 5), ("b", 9, None)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_authoritative(spark, hot_rows):
    rows = [
        ("save your tears", "w", "Save Your Tears", 9),
        ("save your tears", "w", "Save Your Tears (Remix)", 5),
        ("alone", "w", "Alone (Remix)", 1),
        ("plain", "w", "Plain", 1),
        ("lost", "w", "Lost", 1),
        ("lost", "w", "Lost (remix)", 7),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "key_title string, key_artist string, title string, v int, ord int")
    flagged = dedup.authoritative_rows(df, KEYS, "remix", ["ord"], hot_rows=hot_rows)
    assert {r.title for r in flagged.collect() if r.authoritative} == {"Save Your Tears", "Lost"}
    best = dedup.best_with_authority(df, KEYS, "v", ["ord"], "remix").collect()
    assert {r.title: r.authoritative for r in best} == {
        "Save Your Tears": True, "Alone (Remix)": False, "Plain": False, "Lost (remix)": False,
    }


def brute_components(rows, tokens):
    """Breadth-first search over an explicit list of neighbours."""
    nodes = sorted({(kt, ka) for kt, ka, *_ in rows})
    neighbours = {n: [m for m in nodes if m[0] == n[0] and tokens[m] & tokens[n]] for n in nodes}
    first = defaultdict(list)
    for kt, ka, _, src, v in rows:
        first[kt, ka].append((src, -v, ka))
    found = {}
    for start in nodes:
        if start in found:
            continue
        reached, front = {start}, [start]
        while front:
            front = [m for n in front for m in neighbours[n] if m not in reached and not reached.add(m)]
        canonical = min(x for n in reached for x in first[n])[2]
        found |= dict.fromkeys(reached, canonical)
    return found


@pytest.mark.parametrize("hot_rows", [1_000_000, 4])
def test_clusters_against_brute_force(spark, hot_rows):
    rng = random.Random(11)
    rows = []
    for i in range(60):  # a long chain, a hub, and random links
        rows.append(("chain", f"c{i:02d}", f"c{i:02d} & c{(i * 7 + 7) % 420 // 7:02d}", 0, i))
        rows.append(("chain2", f"d{i:02d}", f"d{i:02d} & d{i + 1:02d}", 1, rng.randrange(50)))
        rows.append(("hub", f"h{i:02d}", f"h{i:02d}, star", 2, rng.randrange(99)))
        a, b = rng.randrange(90), rng.randrange(90)
        rows.append(("random", f"r{a}", f"r{a} x r{b}", rng.randrange(2), 5))
        rows.append(("alone", f"s{i}", f"s{i}", 0, 1))
    rows = list({(r[0], r[1], r[3]): r for r in rows}.values())
    tokens = defaultdict(set)
    for kt, ka, credit, *_ in rows:
        for p in credit.replace(" & ", ",").replace(" x ", ",").split(","):
            tokens[(kt, ka)].add(p.strip())
    df = spark.createDataFrame(rows, "key_title string, key_artist string, artist string, source_ord int, value long")
    changes = cluster.cluster_changes(df, {}, hot_rows)
    got = {(r.key_title, r.key_artist): r.canonical for r in cluster.cluster_map(df, changes).collect()}
    assert got == brute_components(rows, tokens)


def test_clusters_after_new_rows_equal_a_whole_run(spark):
    """Random batches: joined and new components, titles left alone, keys that get a credit or an earlier source."""
    rng = random.Random(3)
    schema = "key_title string, key_artist string, artist string, source_ord int, value long"
    rows = []
    for _ in range(300):
        a, b = rng.randrange(30), rng.randrange(30)
        rows.append((f"t{rng.randrange(12)}", f"a{a}", f"a{a} & a{b}", rng.randrange(3), rng.randrange(9)))
    rows = list({(r[0], r[1], r[3]): r for r in rows}.values())
    stored, batch = rows[:150], [r for r in rows[150:] if r[0] in ("t1", "t2", "t3")] + [("new", "x", "x & y", 0, 1), ("new", "y", "y", 1, 1)]
    old, new = (spark.createDataFrame(part, schema) for part in (stored, batch))
    before = cluster.cluster_changes(old, {})
    got = cluster.update_changes(old, before, new, {}).collect()
    whole = cluster.cluster_changes(old.unionByName(new), {}).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole)) and ("new", "y", "x") in map(tuple, got)
    untouched = [r for r in before.collect() if r.key_title not in ("t1", "t2", "t3")]
    assert untouched and set(untouched) <= set(got)
    assert sorted(cluster.update_changes(old, before, new.filter("false"), {}).collect()) == sorted(before.collect())


def test_only_touched_titles_are_clustered_again(spark, monkeypatch):
    seen = []
    whole = cluster.cluster_changes
    monkeypatch.setattr(cluster, "cluster_changes", lambda rows, *a: seen.append(rows.count()) or whole(rows, *a))
    schema = "key_title string, key_artist string, artist string, source_ord int, value long"
    old = spark.createDataFrame([(f"t{i % 100}", f"a{i}", f"a{i}", 0, 1) for i in range(1000)], schema)
    new = spark.createDataFrame([("t5", "b", "b & a5", 1, 1)], schema)
    got = cluster.update_changes(old, whole(old, {}), new, {}).collect()
    assert [tuple(r) for r in got] == [("t5", "b", "a5")] and seen == [11]


def test_clusters_stay_within_a_title(spark):
    rows = [
        ("we found love", "rihanna", "Rihanna Featuring Calvin Harris", 0, None),
        ("we found love", "calvin harris", "Calvin Harris", 1, 5),
        ("other", "rihanna", "Rihanna", 0, None),
        ("other", "calvin harris", "Calvin Harris", 1, 5),
    ]
    df = spark.createDataFrame(rows, "key_title string, key_artist string, artist string, source_ord int, value long")
    changes = cluster.cluster_changes(df, {}).collect()
    assert [tuple(r) for r in changes] == [("we found love", "calvin harris", "rihanna")]


def test_ranked_is_dense_and_ordered(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([0.0, 0.0, 1.5, 2.5, rng.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s double").repartition(7)
    got = ranking.ranked(df, [F.col("s").desc(), F.col("id")]).orderBy("rank").collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r["rank"], r.id) for r in got] == [(i + 1, r[0]) for i, r in enumerate(want)]


def test_scaling(spark):
    df = spark.createDataFrame([(0.5,), (0.25,), (0.1234567,)], "s double")
    assert [r.s for r in ranking.scale_to_100(df, "s").collect()] == [100.0, 50.0, 24.69]
    zero = spark.createDataFrame([(0.0,)], "s double")
    assert [r.s for r in ranking.scale_to_100(zero, "s").collect()] == [0.0]


def test_weighted_mean_worked_examples(spark):
    dims = [("c", 0.4, None), ("s", 0.25, None), ("v", 0.15, None), ("i", 0.1, 2010), ("a", 0.1, 2017)]
    rows = [(2005, 0.8, 0.5, None, None, None), (2018, 0.8, 0.5, None, None, 0.9), (None, None, None, None, 0.9, None)]
    df = spark.createDataFrame(rows, "year int, c double, s double, v double, i double, a double")
    got = [r[0] for r in df.select(scoring.weighted_mean(dims, F.col("year"))).collect()]
    assert got == pytest.approx([0.55625, 0.535, 0.0])
    only_late = df.select(scoring.weighted_mean([("a", 0.1, 2017)], F.col("year"))).collect()
    assert [r[0] for r in only_late] == pytest.approx([0.0, 0.9, 0.0])


@pytest.mark.parametrize("how", [{}, {"hot_rows": 1}], ids=["plain", "salted"])
def test_validated_join(spark, how):
    left = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), ("c", "z")], "title string, artist string")
    right = spark.createDataFrame([("a", "x", 1), ("b", None, 2)], "title string, artist string, u int")
    got = lookup.validated_left_join(left, right, ["title", "artist"], ["title"], **how).collect()
    assert Counter(map(tuple, got)) == Counter([("a", "x", 1), ("a", "x", 1), ("b", None, 2), ("c", "z", None)])
    twice = right.union(spark.createDataFrame([("q", "q", 1), ("q", "q", 2)], right.schema))
    with pytest.raises(Exception, match="repeats a join key"):
        lookup.validated_left_join(left, twice, ["title", "artist"], ["title"], **how).collect()
    joined = lookup.validated_left_join(left, twice, ["title", "artist"], ["title"], **how)
    for pruned in (joined.select("title"), joined.groupBy().count()):
        with pytest.raises(Exception, match="repeats a join key"):
            pruned.collect()


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 1}])
def test_two_level_lookup_takes_the_whole_row_of_one_level(spark, limits):
    pair = spark.createDataFrame([("golden", "harry", "u1", None), ("solo", "one", "u2", 7)], "kt string, kp string, url string, d int")
    title = pair.filter("kt = 'solo'")
    songs = spark.createDataFrame(
        [("1", "golden", "harry"), ("2", "golden", "huntrx"), ("3", "solo", "other"), ("4", "none", "x")],
        "id string, kt string, kp string",
    )
    got = lookup.two_level_lookup(songs, pair, title, ["url", "d"], ["id"], **limits).collect()
    assert {r.id: (r.url, r.d) for r in got} == {"1": ("u1", None), "2": (None, None), "3": ("u2", 7), "4": (None, None)}


def test_candidate_pool_and_append(spark):
    df = spark.createDataFrame([("a", 1, 9), ("b", 2, None), ("c", 3, 1)], "t string, x int, y int")
    assert {r.t for r in ranking.candidate_pool(df, ["x", "y"], ["t"], ["t"], 1).collect()} == {"a", "c"}
    new = spark.createDataFrame([("a", 7, 7), ("d", 5, 5), ("d", 4, 4)], df.schema)
    got = Counter(tuple(r) for r in dedup.append_new(df, new, ["t"]).collect())
    assert got == Counter([("a", 1, 9), ("b", 2, None), ("c", 3, 1), ("d", 4, 4)])


def test_append_with_null_keys_and_an_order(spark):
    new = spark.createDataFrame([(None, 3, 1), (None, 3, 0), ("a", 9, 0), ("a", 3, 1)], "t string, v int, ord int")
    stored = new.filter("false")
    for _ in range(3):
        stored = spark.createDataFrame(dedup.append_new(stored, new, ["t"], ["ord"]).collect(), new.schema)
    assert Counter(map(tuple, stored.collect())) == Counter([(None, 3, 0), ("a", 9, 0)])


def bits_of(v):
    import math
    import struct

    if math.isnan(v):
        return (2047 << 52) + 1
    whole = struct.unpack("<Q", struct.pack("<d", abs(v)))[0]
    return -whole if v < 0 else whole


def test_ordered_doubles_are_their_bits(spark):
    import math
    import struct

    rng = random.Random(2)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    powers = [2.0**e for e in range(-1074, 1024)]
    values += powers + [-p for p in powers] + [math.nextafter(p, 0) for p in powers] + [math.nextafter(p, math.inf) for p in powers]
    values += [0.0, -0.0, math.inf, -math.inf, math.nan, 0.1, 1 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", order.ordered_double(F.col("v")).alias("b")).collect()
    assert all(r.b == bits_of(r.v) for r in got)
    assert spark.range(1).select(order.ordered_double(F.lit(None).cast("double")).alias("b")).first().b is None


def test_percentiles_of_fractions_special_values(spark):
    """-0.0 ties with 0.0, NaN stands above infinity, and no window holds many values."""
    nan, inf = float("nan"), float("inf")
    values = [-inf, -1.5, -0.0, 0.0, 5e-324, 0.25, 0.75, inf, nan, nan, None]
    df = spark.createDataFrame([("t", str(i), 0, v) for i, v in enumerate(values)], "key_title string, key_artist string, g int, v double")
    got = {r.key_artist: r.p for r in percentile.group_percentiles(df, KEYS, "g", {"v": "p"}).collect()}
    assert [got[str(i)] for i in range(11)] == [0.1, 0.2, 0.35, 0.35, 0.5, 0.6, 0.7, 0.8, 0.95, 0.95, None]
    up = percentile.rolling_percentiles(df.filter("v is not null"), KEYS, "g", {"v": "p"}, {"v"}, 1).collect()
    assert {r.key_artist: r.p for r in up}["8"] == 0.9


def test_fractions_are_spread_over_window_partitions(spark):
    n = 200_000
    hist = spark.range(n).select(F.lit(1).alias("g"), (F.col("id") / n).alias("v"), F.lit(1).alias("n"))
    blocks = hist.groupBy(F.shiftright(order.ordered_double(F.col("v")), percentile.DIGIT_BITS).alias("b")).count()
    assert blocks.agg(F.max("count")).first()[0] < 100  # a window partition is one block
    got = percentile.running_counts(hist, ["g"], "v").filter("below <> round(v * 200000)").count()
    assert got == 0


ORDERS = [["a", "s"], ["s"], ["st", "a"], ["b", "day", "at"], ["descending d", "s"]]


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_first_per_key_by_any_order(spark, hot_rows):
    """Against one fold over whole rows, with nulls, texts, structs, ties in the image, and hot keys."""
    import datetime

    rng = random.Random(hot_rows)
    pick = lambda *xs: rng.choice([None, *xs])
    rows = [
        (pick("x", "y"), pick("k", ""), pick(-5, 0, 2**31 - 1, -(2**31)), pick("same beginning " + str(rng.randrange(9)), "same", "", "ÿ"),
         pick(0.0, -0.0, -1.5, 1e300, float("nan")), (pick(1, 2), pick("p", "q")) if rng.random() < 0.8 else None,
         pick(True, False), pick(datetime.date(1969, 1, 1), datetime.date(2020, 5, 5)),
         pick(datetime.datetime(1960, 1, 1), datetime.datetime(2020, 1, 1, 1, 1, 1, 5)), i)
        for i in range(250)
    ]
    df = spark.createDataFrame(rows, "k1 string, k2 string, a int, s string, d double, st struct<x:bigint,y:string>, b boolean, day date, at timestamp, i int")
    for by in ORDERS:
        total = [c for o in by for c in ([F.col("d").isNull(), -F.col("d")] if o == "descending d" else [o])] + ["i"]
        got = {tuple(r) for r in dedup.first_per_key(df, ["k1", "k2"], total, hot_rows).select("k1", "k2", "i").collect()}
        want = {tuple(r) for r in dedup._least_row(df, ["k1", "k2"], total).select("k1", "k2", "i").collect()}
        assert got == want, by


def test_images_compare_as_their_order(spark):
    rows = [(a, b, s) for a in (None, -3, 0, 7) for b in (None, -(2**31), 5) for s in (None, "", "a", "abcdefgh", "abcdefgi", "é")]
    df = spark.createDataFrame(rows, "a int, b int, s string")
    image = order.order_image(df, ["a", "b", "s"])
    got = [(r.image, r.a, r.b, r.s) for r in df.orderBy("a", "b", "s").select("a", "b", "s", image.alias("image")).collect()]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    assert len({g[0] for g in got}) == len(rows) - 12  # texts that begin alike leave the order open
    assert order.order_image(df, ["s", "a"]) is None


def test_sketch_join_equals_plain_join(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 50).cast("int").alias("k"))
    side = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("x"))
    heavy = skew.heavy_keys(rows, ["k"], 100).collect()
    assert len(heavy) == 1 and heavy[0]["_copies"] >= 15
    assert skew.heavy_keys(rows.filter("false"), ["k"], 1).collect() == []
    for how in ("left", "inner"):
        plain = sorted(map(tuple, rows.join(side, ["k"], how).select("id", "k", "x").collect()), key=str)
        split = skew.sketch_join(rows, side, ["k"], ["id"], how, hot_rows=100).select("id", "k", "x").collect()
        assert sorted(map(tuple, split), key=str) == plain
    counted = side.join(rows.groupBy("k").agg(F.count("*").alias("n")), "k")
    plain = sorted(map(tuple, rows.join(side, ["k"]).select("id", "k", "x").collect()))
    assert sorted(map(tuple, skew.counted_join(rows, counted, ["k"], ["id"], 100).select("id", "k", "x").collect())) == plain


def test_the_list_of_heavy_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_HOT", 8)
    rows = spark.range(4000).select((F.col("id") % 20).alias("k"))
    assert skew.heavy_keys(rows, ["k"], 1).count() <= 8
