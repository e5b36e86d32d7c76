"""Phrase mining against a plain count."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from evergreen.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def plain(rows, support, best):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        c = counts.setdefault(lang, Counter())
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            c.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        inside = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if inside[p] < a:
                score, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def made(seed, n, words=40):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "ÄÖ", "\xa0x", "日本", "a" * 60, "a" * 60 + "b", "it's", "\x1c"] + [f"w{i}" for i in range(20)]
    fixed = ["new york city", "one two three four five six", "the of the of the of"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, words)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; "]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "de", None])))
    return rows + [(None, None, "en"), (5, "", None), (6, " . \t", "fr"), (7, "new york city " * 500, "de"), (7, "new york city " * 500, "de")]


@pytest.mark.parametrize("support, best", [(5, 2000), (40, 10), (1, 50)])
def test_matches_plain_count(spark, support, best):
    rows = made(support, 150)
    got = phrases.collocations(docs(spark, rows), support, best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, support, best)


def test_stretches_and_few_bits_change_nothing(spark, monkeypatch):
    """Long texts in stretches, counts handed on early, and a bitmap so small that hashes meet."""
    monkeypatch.setattr(phrases, "STRETCH", 7)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "LEAST_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 15)
    rows = made(3, 60)
    assert sorted(map(tuple, phrases.collocations(docs(spark, rows), 6).collect())) == plain(rows, 6, 2000)


def test_nothing_to_find(spark):
    assert phrases.collocations(docs(spark, [])).collect() == []
    assert phrases.collocations(docs(spark, [(1, None, None), (2, "few words here", "en")])).collect() == []


def test_large_products_are_exact(spark):
    counts = [("en", 1, "a", 3_000_000_019), ("en", 1, "b", 2_999_999_999), ("en", 2, "a b", 2_999_999_998)]
    frequent = spark.createDataFrame(counts, "lang string, size int, phrase string, n long")
    totals = spark.createDataFrame([("en", 9_000_000_000_000)], "lang string, total long")
    row = phrases.scored(frequent, totals).collect()[0]
    assert row["score"] == 1000 * 2_999_999_998 * 9_000_000_000_000 // (3_000_000_019 * 2_999_999_999)


def test_a_phrase_of_the_corpus_is_frequent_in_a_shard(spark):
    """What the lowered support rests on: no phrase with the whole support is below it everywhere."""
    rows = phrases.prepared(docs(spark, made(9, 200)))
    assert rows.select("shard").distinct().count() == phrases.SHARDS
    counts = phrases.local_counts(rows, range(1, 2), None)
    shares = {r["cell"]: r for r in phrases.shares(counts, rows).collect()}
    assert sum(r["words"] for r in shares.values()) == sum({r["lang"]: r["total"] for r in shares.values()}.values())
    whole, best = Counter(), {}
    for r in counts.collect():
        if r["g"] != phrases.TOTAL:
            whole[r["g"]] += r["n"]
            part = shares[r["cell"]]
            best[r["g"]] = max(best.get(r["g"], 0), r["n"] * part["total"] / part["words"])
    assert all(best[g] >= n - 1e-9 for g, n in whole.items())


def test_words_of_a_batch():
    texts = pa.array(["skip me", "A b\tc. d", None, "", "e", "f,g" + "x" * 100], pa.string()).slice(1)
    w = phrases.Words(texts)
    found = [(int(w.row[i]), w.text(i, 1)) for i in range(len(w.start))]
    assert found == [(0, "a"), (0, "b"), (0, "c"), (0, "d"), (3, "e"), (4, "f"), (4, "g" + "x" * 100)]
    assert len(set(w.piece.tolist())) == 5 and w.text(0, 3) == "a b c"
