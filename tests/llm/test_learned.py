"""The fitted operators: planted cases, held-out accuracy, and odd inputs."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evergreen.llm import brown, langid, quality, toxicity

WORDS = {
    "aa": "bado rilo mena tolu saki deno paru".split(),
    "bb": "grück schtan wöfel pfirz knüsch drömel zwarg".split(),
    "cc": "çavou étrelle quoix nêmée aurois plègue vouêt".split(),
}


def make(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "n"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text, lang, toxic, quality): stems mark the toxic, shouting the poor."""
    rng, rows = random.Random(3), []
    for i in range(600):
        lang = ("aa", "bb", "cc")[i % 3]
        text = make(rng, lang, rng.randint(20, 120))
        toxic = int(i % 7 == 0)
        if toxic:
            words = text.split()
            for _ in range(1 + len(words) // 40):
                words.insert(rng.randrange(len(words)), "vilk" + rng.choice(["or", "amus", "est"]))
            text = " ".join(words)
        poor = i % 5 == 0
        rows.append((i, text.upper().replace(" ", "!! ") if poor else text, lang, toxic, int(not poor)))
    return rows


ODD = [(9001, None), (9002, ""), (9003, " \n "), (9004, "?! 123"), (9004, "?! 123"), (None, "x"), (9005, "long word " * 60_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "s", 1, "l") for i, t in ODD], "doc_id long, text string, score string, n long, lang string")


def frame(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string, lang string, toxic int, quality int")


def test_folding_meets_plain_spelling():
    for t in ("IDIOT", "1d10t", "іdіоt", "ïdïot", "ｉｄｉｏｔ", "id­iot", "id!ot!!", "(idi0t)"):
        assert toxicity.fold(t).split() == ["idiot"], t
    assert toxicity.fold("wow!! 2024 a1 $$$ x***").split() == ["wow", "a", "x"]


def test_toxicity(spark, corpus, odd):
    rows = frame(spark, corpus)
    lexicon = toxicity.fit(rows.filter("doc_id % 2 = 0"), bound=1000)
    assert any(" vilk".startswith(e) or e.startswith(" vilk") for e in lexicon.weights)
    got = {r["doc_id"]: r for r in toxicity.score(rows, lexicon).collect()}
    wrong = [i for i, _, _, toxic, _ in corpus if i % 2 and got[i]["predicted"] != toxic]
    assert len(wrong) <= 6
    disguised = spark.createDataFrame([(1, make(random.Random(1), "aa", 30) + " v1lkam и v!lkor VILKEST")], "doc_id long, text string")
    assert toxicity.score(disguised, lexicon).first()["predicted"] == 1
    found = toxicity.score(odd, lexicon).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] < 0.7 and r["predicted"] == 0 for r in found)
    assert toxicity.keep_clean(odd, lexicon).columns == odd.columns and toxicity.keep_clean(odd, lexicon).count() == len(ODD)


def test_toxicity_exceptions(spark):
    """A phrase in which the entry is harmless does not count."""
    rng = random.Random(8)
    rows = [(i, make(rng, "aa", 30) + (" vilkor now" if i % 2 else " vilkor festival" if i % 20 == 0 else ""), i % 2) for i in range(400)]
    lexicon = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert "vilkor festival" in lexicon.exceptions
    machine = toxicity.automaton(lexicon.weights)
    assert toxicity.density("a vilkor festival b", machine, lexicon.exceptions)[2] == 0
    assert toxicity.density("a vilkor b", machine, lexicon.exceptions)[2] > 0


def test_toxicity_hits_match_a_plain_search():
    entries = {" vil": 2.0, " vilkor": 3.0, " ab ": 1.0}
    machine, text = toxicity.automaton(entries), " x vilk vilkor ab abc evil "
    want = Counter()
    for i in range(len(text)):
        here = [e for e in entries if text.startswith(e, i)]
        if here:
            want[max(here, key=entries.get)] += 1
    assert Counter(h[0] for h in toxicity.hits(text, text.split(), machine)) == want


def test_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(none)).collect()} == {0.0}
    model = quality.fit(spark.createDataFrame([], "doc_id long, text string, grade int"))
    assert quality.keep_good(odd, model).count() == len(ODD)
    assert {r["keep"] for r in quality.grade(odd, model).collect()} == {True}
    found = langid.predict(odd, langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")))
    assert {r["lang_pred"] for r in found.collect()} == {"und"}


def test_quality(spark, corpus, odd):
    rows = frame(spark, corpus).withColumn("grade", F.expr("CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END"))
    model = quality.fit(rows.filter("doc_id % 2 = 0"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    got = {r["doc_id"]: r for r in quality.grade(rows, model).collect()}
    assert sum(got[i]["keep"] != bool(good) for i, _, _, _, good in corpus if i % 2) <= 3
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail_probability"] <= 1 for r in got.values())
    kept = quality.keep_good(rows, model)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["keep"]}
    assert quality.grade(odd, model).count() == len(ODD)


def test_ordinal_score_is_the_gradient():
    rng = np.random.default_rng(2)
    x, y, w = rng.random((40, quality.WIDTH)), rng.integers(0, 3, 40), np.ones(40)
    model = quality.OrdinalModel(rng.normal(0, 0.05, quality.WIDTH), np.array([-0.3, 0.4]))

    def likelihood(at):
        tails = quality._tails(quality.OrdinalModel(at[: quality.WIDTH], at[quality.WIDTH :]), x)
        p = np.hstack([np.ones((40, 1)), tails]) - np.hstack([tails, np.zeros((40, 1))])
        return np.log(p[np.arange(40), y]).sum()

    at = np.r_[model.weights, model.thresholds]
    score, info = quality._step(model, x, y, w)
    for k in (0, 7, quality.WIDTH, quality.WIDTH + 1):
        step = np.zeros(len(at))
        step[k] = 1e-5
        assert (likelihood(at + step) - likelihood(at - step)) / 2e-5 == pytest.approx(score[k], rel=1e-3, abs=1e-4)
    assert np.allclose(info, info.T) and np.linalg.eigvalsh(info).min() > -1e-6


def test_language(spark, corpus, odd):
    rows = frame(spark, corpus)
    model = langid.fit(rows.filter("doc_id % 4 <> 0"), per_language=2)
    got = {r["doc_id"]: r for r in langid.predict(rows, model).collect()}
    assert sum(got[i]["lang_pred"] != lang for i, _, lang, _, _ in corpus if i % 4 == 0) <= 2
    assert all(0 < r["score"] <= 1 for r in got.values())
    found = [(r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()]
    assert found[:5] == [("und", 0.0)] * 5 and found[5][0] in WORDS and len(found) == len(ODD)
    strange = spark.createDataFrame([(1, "нечто совсем другое и чужое " * 5)], "doc_id long, text string")
    assert langid.predict(strange, model).first()["rejected"]


def plain_base(rows):
    """Counts and add-one scores in plain Python."""
    def words(t):
        return [*(t or "").encode().lower().split(), b""]

    counts = Counter(w for _, t, held in rows if not held for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(i, len(words(t)), sum(counts[w] > 0 for w in words(t)),
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t, _ in rows]


@pytest.mark.parametrize("common", [65_536, 8])
def test_brown_base_scores(spark, corpus, monkeypatch, common):
    """Also with few common words, so that most meet their counts in the shuffle."""
    monkeypatch.setattr(brown.common_words, "__defaults__", (common,))
    rows = [(i, t, i % 7 == 2) for i, t, *_ in corpus] + [(i, t, k % 2 == 0) for k, (i, t) in enumerate(ODD[:-1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, held boolean, base string")
    got = brown.score_corpus(docs, F.col("held")).collect()
    n, want = plain_base(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
    assert len(found) == len(want)
    for a, b in zip(found, sorted(want, key=key)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
    assert {r["train_tokens"] for r in got} == {n}
    better = [r["score"] > r["base_score"] for r in got if r["held_out"] and r["n_tokens"] > 15]
    assert sum(better) > 0.9 * len(better)


def test_brown_probabilities_add_up(spark, corpus):
    """Over all known words and one unknown per suffix unit, the next word's probabilities are at most 1."""
    docs = spark.createDataFrame([(t, True) for _, t, *_ in corpus], "text string, train boolean")
    vocabulary = brown.count_words(docs)
    counts = {bytes(r["token"]): r["n_train"] for r in vocabulary.collect()}
    m = brown.fit(docs, vocabulary, counts)
    for before in range(0, brown.CLASSES, 13):
        assert sum(10 ** m.transition[before]) == pytest.approx(1)
        total = 0.0
        for w, c in counts.items():
            u = m.unit(w)
            own = math.log10(c + 1) if u >= len(m.unit_of) else 0.0
            total += 10 ** (m.transition[before, m.owner[u]] + m.emission[u] - m.inside[u] + own)
        assert 0.5 < total <= 1 + 1e-9


@pytest.mark.parametrize("common", [8, brown.COMMON])
def test_brown_words_have_classes_of_their_own(spark, monkeypatch, common):
    """Words beyond the seeds that share their last three bytes, but follow different words."""
    monkeypatch.setattr(brown, "UNITS", 8)
    monkeypatch.setattr(brown.common_words, "__defaults__", (common,))
    rng, rows = random.Random(5), []
    for i in range(400):
        words = []
        for _ in range(12):
            kind = rng.choice("lr")
            own = {"l": "lot", "r": "rum"}[kind] if rng.random() < 0.3 else f"{kind}{rng.randrange(40)}ing"
            words += [{"l": "left", "r": "right"}[kind], own, "stop"]
        rows.append((i, " ".join(words), False))
    for i in range(40):
        rows += [(1000 + i, f"left l{i}ing stop right r{i}ing stop", True), (2000 + i, f"left r{i}ing stop right l{i}ing stop", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r for r in brown.score_corpus(docs, F.col("held")).collect()}
    for i in range(40):
        assert got[1000 + i]["base_score"] == pytest.approx(got[2000 + i]["base_score"])
        assert got[1000 + i]["score"] > got[2000 + i]["score"] + 1


@pytest.mark.parametrize("common", [8, brown.COMMON])
def test_brown_score_matches_plain_code(spark, monkeypatch, common):
    """All training words are seeds; unseen ones have the class of their last three bytes, also if these are a word."""
    monkeypatch.setattr(brown.common_words, "__defaults__", (common,))
    rng = random.Random(8)
    words = ["abc", "xyz", "one", "stone", "of", "a"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(20)), True) for i in range(50)]
    rows += [(100, "abc zabc one zone of", False), (101, "", False), (102, "zzz stone Abc loof", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("held_out", ~F.col("train"))
    vocabulary = brown.count_words(docs)
    counts = {bytes(r["token"]): r["n_train"] for r in vocabulary.collect()}
    often = counts if common > 8 else {w: counts[w] for w in (b"", b"abc", b"of")}
    model, coded = brown.fit_rows(docs, vocabulary, often)
    seen = {w: n for w, n in counts.items() if n}
    chosen = model.owner
    for r in brown.score(coded, model).collect():
        want, before = 0.0, chosen[model.unit(b"")]
        for w in brown.tokens(next(t for i, t, _ in rows if i == r["doc_id"])):
            unseen = model.suffix_of.get(w[-3:], model.other)
            k = chosen[model.unit(w) if w in seen else unseen]
            if common > 8 or w in often or w not in seen:
                want += model.transition[before, k] + math.log10(seen.get(w, 0) + 1) - model.divisors[k]
                before = k
            else:
                break  # a word that chose its own class
        else:
            assert r["score"] == pytest.approx(want, rel=1e-9)


def test_best_classes_are_those_of_the_exchange():
    """The gains over sparse counts against the likelihood taken anew for every class."""
    rng = np.random.default_rng(1)
    pairs = rng.poisson(0.6, (60, 60)).astype(float)
    owner = np.arange(60) % 4

    def bigrams(owner):
        hot = np.eye(4)[owner]
        return hot.T @ pairs @ hot

    def likelihood(owner):
        n = bigrams(owner)
        f = lambda v: sum(x * math.log(x) for x in v.ravel() if x > 0)
        return f(n) - f(n.sum(0)) - f(n.sum(1))

    cells, counts = [], []
    for u in range(60):
        others = np.arange(60) != u
        into, out = np.bincount(owner[others], pairs[others, u], 4), np.bincount(owner[others], pairs[u, others], 4)
        n = np.r_[into, out, pairs[u, u]]
        cells.append(np.flatnonzero(n))
        counts.append(n[n > 0])
    best = brown.best_classes(cells, counts, owner, bigrams(owner))
    for u in range(60):
        tried = [likelihood(np.where(np.arange(60) == u, c, owner)) for c in range(4)]
        assert tried[best[u]] == pytest.approx(max(tried), abs=1e-6)


def test_exchange_ends_where_no_single_move_helps():
    """Units of one kind mostly follow their own kind; the likelihood is taken anew for every possible move."""
    rng = np.random.default_rng(0)
    kind = np.arange(30) % 3
    pairs = np.where(kind[:, None] == kind[None, :], rng.integers(20, 60, (30, 30)), rng.integers(0, 2, (30, 30))).astype(float)

    def likelihood(owner):
        hot = np.eye(4)[owner]
        n = hot.T @ pairs @ hot
        f = lambda v: sum(x * math.log(x) for x in v.ravel() if x > 0)
        return f(n) - f(n.sum(0)) - f(n.sum(1))

    owner = brown.exchange(pairs, classes=4, sweeps=50)
    for k in range(3):
        assert len({int(c) for c in owner[kind == k]} & {int(c) for c in owner[kind != k]}) == 0
    best = likelihood(owner)
    for u in range(30):
        for c in range(4):
            other = owner.copy()
            other[u] = c
            assert likelihood(other) <= best + 1e-6


def test_brown_without_training(spark, odd):
    got = brown.score_corpus(odd, F.lit(True)).collect()
    assert len(got) == len(ODD)
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert brown.score_corpus(odd.filter("false"), F.lit(False)).count() == 0


def test_numbers_are_no_letters():
    for text in ("²", "½ Ⅷ", "12 ³_!", ""):
        assert not langid.has_letter(text)
    for text in ("² a", "é", "日", "ª"):
        assert langid.has_letter(text)


CLEAN_SENTENCES = [
    "the vilkings sailed along the coast and rested there",
    "a wilkor of an old sort was found by the river",
    "evilkor is the name of a town that nobody has heard of",
    "vil and kor are two words that stand alone",
]


def test_toxicity_words_are_whole(spark, corpus):
    """Words that only begin like an entry, or hold one, are clean; a stem holds where all its words agree."""
    rows = frame(spark, corpus)
    lexicon = toxicity.fit(rows, bound=1000)
    one = toxicity.scorer(lexicon)
    assert one("bado rilo vilkor mena")[0] > 0.7
    for sentence in CLEAN_SENTENCES[1:]:
        assert one(sentence)[0] < 0.7, sentence
    beginnings = [e for e in lexicon.weights if not e.endswith(" ")]
    assert all(len(e) > toxicity.SHORTEST for e in beginnings)
    single = [(i, make(random.Random(i), "aa", 30) + (" pathetic now" if i % 2 else ""), i % 2) for i in range(300)]
    lexicon = toxicity.fit(spark.createDataFrame(single, "doc_id long, text string, toxic int"))
    assert " pathetic " in lexicon.weights
    assert toxicity.scorer(lexicon)("we followed the path down to the river and rested there")[0] < 0.7


def test_toxicity_disguises_of_whole_words():
    cases = {"1d107": "idiot", "a55": "ass", "!diot": "idiot", "1diot!": "idiot", "$tup1d": "stupid", "idiot!!": "idiot", "2024": "", "a1": "a", "x|y": "xly"}
    for text, want in cases.items():
        assert toxicity.fold(text).split() == want.split(), text
    lexicon = toxicity.Lexicon({" clown ": 5.0, " loser ": 5.0, " idiot ": 5.0}, frozenset(), 4.0, -3.0)
    one = toxicity.scorer(lexicon)
    for text in ("c1own", "1oser", "|oser", "c|own", "1d1ot", "|d|0t"):
        assert one(text)[0] > 0.7, text
    for text in ("cown", "lo ser", "idol", "clowns"):
        assert one(text)[0] < 0.7, text


def test_toxicity_counts_are_handed_on_in_parts():
    """All entries are counted, whatever the parts; neither counting nor sketching holds a whole batch's words."""
    rng = random.Random(8)
    words = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(300)) for _ in range(300)]
    ids, ys = list(range(300)), [i % 2 for i in range(300)]
    add, take = toxicity.count_entries()
    got, most = Counter(), 0
    step = toxicity.COUNTED_ROWS
    tracemalloc.start()
    for at in range(0, 300, step):
        if add(ids[at : at + step], words[at : at + step], ys[at : at + step]):
            entries, _, *counts = take()
            most = max(most, len(entries))
            got.update({e: sum(c) for e, c in zip(entries, zip(*counts)) if e.endswith(" ")})
    entries, _, *counts = take()
    assert tracemalloc.get_traced_memory()[1] < 60e6
    got.update({e: sum(c) for e, c in zip(entries, zip(*counts)) if e.endswith(" ")})
    assert got == Counter(f" {w} " for text in words for w in set(text.split()))
    assert toxicity.HELD_ENTRIES <= most <= toxicity.HELD_ENTRIES + step * 300 * 5 and take()[0] == []
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    out = toxicity.prepare()(ids, words, ys)
    assert out[2] == words and tracemalloc.get_traced_memory()[1] - held < 3 * sum(map(len, words))
    tracemalloc.stop()


def test_toxicity_score_matches_plain_code():
    """Hits, exceptions and the normalisation, written out word by word."""
    lexicon = toxicity.Lexicon({" bad ": 3.0, " ugly": 2.0, " big ": 4.0}, frozenset({"bad weather", "very big"}), 2.0, -3.0)
    one = toxicity.scorer(lexicon)
    rng = random.Random(4)
    vocabulary = ["bad", "weather", "ugly", "uglier", "very", "big", "bib", "x", "b4d", "BIG", "bad.", "ok"]
    for _ in range(200):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))
        words = [{"b4d": "bad", "bad.": "bad"}.get(w, w.lower()) for w in text.split()]
        total = hits = 0
        for i, w in enumerate(words):
            weight = {"bad": 3.0, "big": 4.0}.get(w, 2.0 if w.startswith("ugly") else 0)
            before, after = " ".join(words[max(0, i - 1) : i + 1]), " ".join(words[i : i + 2])
            if weight and not {before, after} & lexicon.exceptions:
                total, hits = total + weight, hits + 1
        z = 2.0 * np.log1p(100 * total / (len(words) + 20)) - 3.0
        got = one(text)
        assert abs(got[0] - 1 / (1 + np.exp(-z))) < 1e-12 and got[1:] == (len(words), hits)
