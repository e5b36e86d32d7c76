"""SimHash, its links and components against plain code."""

import random

import pytest
import xxhash

from evergreen.llm import simhash
from evergreen.llm.graph import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    """Flood fill; the least node names the component."""
    left, found = set(nodes), {}
    while left:
        front = {min(left)}
        group = set()
        while front:
            group |= front
            left -= front
            front = {y for y in left if any(linked(x, y) for x in front)}
        found |= dict.fromkeys(group, min(group))
    return found


def test_fingerprint_matches_plain_code():
    texts = [None, "", " \n\t", "One", "two words", "a b c d", "A b C d e f", "ÄÖ\xa0x y z w v", "w " * 1000, "x y z " * 50_000]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_every_close_pair_meets_in_some_table():
    rng = random.Random(5)
    for level in range(3):
        masks = simhash.covering_masks(level)
        assert len(masks) == 31 and all((m & (1 << 64) - 1).bit_count() == 32 for m in masks)
        for _ in range(3000):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            assert any(not flips & m for m in masks)


@pytest.mark.parametrize("small", [512, 6])
def test_components_of_near_fingerprints(spark, monkeypatch, small):
    """Also with tiny buckets, so that large ones are dealt again level by level."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(small)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(fps)[:4]:
        for _ in range(60):
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    rows = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = {r["node"]: r["root"] for r in simhash.link_components(rows).collect()}
    want = plain_components(signed.values(), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {s: got.get(s, s) for s in want} == want


def test_graph_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(999, 100 + 200), (5, 5)]
    links += [(301, 302), (302, 303), (303, 301), (303, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    ends = {(min(e), max(e)) for e in links if e[0] != e[1]}
    nodes = {n for e in ends for n in e}
    assert got == plain_components(nodes, lambda a, b: (min(a, b), max(a, b)) in ends)


def test_near_duplicates_of_documents(spark):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(900)}" for _ in range(120)] for _ in range(6)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(30):
        words = list(rng.choice(base))
        if i % 3:
            words[rng.randrange(120)] = "changed"
        rows.append((50 - i if i < 10 else 100 + i, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "  "), (503, None), (503, None), (7, "SAME text"), (6, "same TEXT"), (None, "same text")]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, fp long, component_id string")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect() if r["doc_id"] is not None)
    ids = [(i, plain_fingerprint(t)) for i, t in rows if i is not None]
    of = plain_components(range(len(ids)), lambda a, b: (ids[a][1] ^ ids[b][1]).bit_count() <= 4)
    least = {}
    for k, root in of.items():
        least[root] = min(least.get(root, 1 << 60), ids[k][0])
    assert got == sorted((ids[k][0], least[of[k]]) for k in range(len(ids)))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    stay = [r["doc_id"] for r in kept.collect()]
    assert set(stay) == {b for a, b in got if a == b} | {None}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0


def test_repeated_ids_keep_one_row_of_each_text(spark):
    """Rows of one id with different texts go or stay one by one: no text is lost."""
    a, b = "the quick brown fox jumps over it", "an entirely different text about some other thing"
    docs = spark.createDataFrame([(7, a), (7, b), (9, a), (3, b), (None, a), (5, None), (4, "")], "doc_id long, text string")
    kept = sorted(map(tuple, simhash.keep_one(docs).collect()), key=repr)
    assert kept == sorted([(7, a), (3, b), (None, a), (4, "")], key=repr)


def test_hot_fingerprints_and_centres_are_split(spark, monkeypatch):
    from evergreen.llm import graph

    monkeypatch.setattr(simhash, "HOT", 3)
    monkeypatch.setattr(graph, "HOT", 3)
    star = [(0, i) for i in range(1, 200)] + [(i, i + 500) for i in range(1, 40)]
    links = spark.createDataFrame(star, "a long, b long")
    assert {r.root for r in components(links).collect()} == {0}
    text = "one two three four five six"
    docs = spark.createDataFrame([(i, text if i % 3 else None) for i in range(60)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: 1 if i % 3 else 0 for i in range(60)}
