import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from evergreen.config import Settings
from evergreen.functions import display as D
from evergreen.functions import parse as P
from evergreen.functions import text as T

TITLES = {
    "Take My Breath - Single Version": "take my breath",
    "Save Your Tears (Remix)": "save your tears",
    "Hello [Live]": "hello",
    "  Mr.  Brightside ": "mr brightside",
    "???": "",
    "a_b!": "a_b",
    "Beyoncé Ünïq": "beyonce uniq",
    "[a (b] c)": "a",
    "x - y\nz": "x y z",
    "plain words 12": "plain words 12",
}
ARTISTS = {
    "Mo$$y": "mossy",
    "The Blue Herons": "blue herons",
    "The The": "the",
    "The Lamplight Featuring Odd Harbor": "lamplight",
    "Vera N, Tin Fox & K Moreno": "vera n",
    "Quill 77 x Tobias Renn": "quill 77",
    "Pia Kol X": "pia kol x",
    "Ines Mar Alto vs. Pavel Gorski": "ines mar alto",
    "Tom Birch with Ana Vale": "tom birch",
    "OV/ER": "ov",
    "QRN(구름)": "qrn",
    "Soulja Boy Tell'em": "soulja boy",
    "Lady A": "lady antebellum",
    "with you": "",
    "vsop": "vsop",
    "Aftershock": "aftershock",
    "Pia Kol X ft. Juno": "pia kol x",
}
PRIMARY = {
    "Pia Kol X Featuring Sam Oak Reed": "pia kol x",
    "Maren;Olle Brand": "maren",
    "Clementine and the Engine": "clementine",
    "A & B": "a",
    "Pia Kol X": "pia kol x",
    # the first line loses "ft y", then its "x" (text follows on the next line); only one cut of each kind
    "x ft y\nand more": "and more",
}
ALL_NAMES = {
    "Dario VV, Old Mill, Nora H, Siem & K Moreno": ["Dario VV", "Old Mill", "Nora H", "Siem", "K Moreno"],
    '"HUNTR/X: LARK, Edda Moon & TAM TAM"': ["HUNTR/X", "LARK", "Edda Moon", "TAM TAM"],
    "AC/DC": ["AC/DC"],
    "Jon Fell/Glass River Band": ["Jon Fell", "Glass River Band"],
    "A vs. B with C": ["A", "B", "C"],
}


def apply(spark, inputs, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("o")).collect()]


@pytest.mark.parametrize(
    "vectors, make",
    [(TITLES, T.title_key), (PRIMARY, T.primary_artist), (ALL_NAMES, T.collaborators)],
    ids=["title", "primary", "collaborators"],
)
def test_vectors(spark, vectors, make):
    assert apply(spark, vectors, make) == list(vectors.values())


def test_artist_vectors(spark):
    df = spark.createDataFrame([("t", a) for a in ARTISTS], "title string, artist string")
    got = {r.artist: r.key_artist for r in T.with_keys(df, Settings().aliases).collect()}
    assert got == ARTISTS


def test_null_names_are_kept_out_of_matching(spark):
    df = spark.createDataFrame([("t", None), (None, "a"), ("None", "NA")], "title string, artist string")
    assert [(r.key_title, r.key_artist) for r in T.with_keys(df, {}).collect()] == [("none", "na")]


def test_accents_follow_canonical_decomposition(spark):
    texts = ["plain", "Crème Brûlée", "ガ方탄", "İstanbul", "ȩ́x", "", "½ ﬁ Ǆ", "\U0001d15e"]
    want = ["".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn") for t in texts]
    assert apply(spark, texts + [None], T.strip_accents) == want + [None]


def test_every_character_of_a_text_decomposes_by_itself(spark):
    odd = [chr(c) for c in (0x9CB, 0xC48, 0xDDD, 0x1B40, 0x1D160, 0x2F800, 0xAC00, 0xAC01, 0xD7A3, 0x344, 0x1E9B)]
    texts = [f"a{c}\n{d}" for c in odd for d in odd]
    want = ["".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn") for t in texts]
    assert apply(spark, texts, T.strip_accents) == want


def test_artist_keys_over_many_small_credits(spark):
    """Properties of the key, among them that the shortcut for plain names agrees with the full chain."""
    import itertools

    bits = ["the ", "a", "x ", " x ", " & ", "b", " feat. ", " ft ", "with", " vs. ", ",", "/", "(", "é", "_", "$", " "]
    texts = ["".join(c) for c in itertools.product(bits, repeat=3)]
    keys = apply(spark, texts, T.artist_key)
    assert all(re.fullmatch(r"[\w]+( [\w]+)*|", k) for k in keys)
    # A mark that ends the name ends it wherever it stands; a leading bracket leaves nothing.
    for mark in (",", "/", "(", " & Zed", " vs. Zed", " feat. Zed", " with Zed"):
        assert apply(spark, ["plain name" + mark, "plain name" + mark + " more"], T.artist_key) == ["plain name"] * 2
    # A character that the key drops sends a name through the full chain; the plain form takes the shortcut.
    plain = ["".join(c) for c in itertools.product(["ab", "the ", " x", "x ", "12", " "], repeat=4)]
    assert apply(spark, [f"{p.strip()}!" for p in plain], T.artist_key) == apply(spark, plain, T.artist_key)
    # Case and accents make no difference.
    assert apply(spark, [t.upper() for t in texts], T.artist_key) == keys
    assert apply(spark, [unicodedata.normalize("NFD", t) for t in texts], T.artist_key) == keys


def test_featured(spark):
    df = spark.createDataFrame([("Velvet Anchors Featuring Mira Quist",), ("Otto Lind",)], "v string")
    main, feat = T.split_featured(F.col("v"))
    rows = df.select(main, feat, T.display_credit(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Velvet Anchors", "Mira Quist", "Velvet Anchors feat. Mira Quist"),
        ("Otto Lind", None, "Otto Lind"),
    ]


def test_lines(spark):
    lines = {
        "NADIRA || Attic Sessions #12": ("NADIRA", "Attic Sessions #12"),
        "[MV] QRN(구름하늘) _ RAIN(비)": ("QRN(구름하늘)", "RAIN"),
        "QRN ‘Lanterns’ Official MV": ("QRN", "Lanterns"),
        "Lanterns": None,
        "A - B - C": ("A", "B - C"),
        "A – B — C": ("A", "B — C"),
        " - B": ("", "B"),
        "A: B ft. C": ("A", "B"),
        "‘B’": None,
    }
    got = apply(spark, lines, P.parse_line)
    assert [None if g is None else tuple(g) for g in got] == list(lines.values())


def test_numbers_and_years(spark):
    assert apply(spark, [" 1,234,567 ", "n/a", "", "-5", "1.5"], P.parse_count) == [1234567, None, None, -5, None]
    assert apply(spark, ["1999-05-01", "1999", "c. 2004", "x", None], P.release_year) == [1999, 1999, 2004, None, None]


def test_one_decimal_matches_exact_rounding(spark):
    xs = [97.25, 97.35, 0.05, 0.25, 0.15, 100.0, 33.33, 12.45, 0.0, 66.65, 99.95] + [i / 100 for i in range(0, 10001, 7)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(D.fixed_1(F.col("x"))).collect()]
    assert got == [f"{x:.1f}" for x in xs]


def test_display(spark):
    df = spark.createDataFrame([(1234567, True), (None, None)], "n long, f boolean")
    rows = df.select(D.grouped_int(F.col("n"), F.col("f")), D.plain_int(F.col("n"), prefix="#")).collect()
    assert [tuple(r) for r in rows] == [("1,234,567+", "#1234567"), ("—", "—")]


def test_single_names_are_their_own_token(spark):
    """The shortcut must agree with splitting for every credit it accepts."""
    import itertools

    bits = ["the ", "a", " x ", "x", " & ", " feat. ", "ft", " with ", "vs", ",", "/", "(", '"', "’", ":", "é", "$", " "]
    texts = ["".join(c) for c in itertools.product(bits, repeat=3)]
    df = spark.createDataFrame([(t,) for t in texts], "v string").filter(T.is_single_name(F.col("v")))
    names = F.transform(T.collaborators(F.col("v")), lambda n: n)
    got = df.select("v", names.alias("n"), T.artist_key(F.col("v")).alias("k")).collect()
    first = df.select("v", T.artist_key(F.get(T.collaborators(F.col("v")), F.lit(0))).alias("k")).collect()
    assert len(got) > 500 and all(len(r.n) <= 1 for r in got)
    assert [(r.v, r.k) for r in first if r.k is not None] == [(r.v, r.k) for r in got if r.n]
    assert all(r.k == "" for r in got if not r.n)
