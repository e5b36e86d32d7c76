"""Toxicity by a weighted lexicon.

Texts are folded first (case, compatibility forms, accents, look-alike letters,
digits and signs that stand for letters), so that disguised spellings meet the
lexicon's plain ones.  The lexicon holds whole words with their log odds between marked
and unmarked documents, and stems where all words that a stem covers agree; an entry must
tell in both halves of the sample.  All are found in one pass by an Aho-Corasick automaton,
which takes i for l and l for i where a sign may have stood for either.  Phrases in which a lexicon entry turned out harmless are
exceptions: a hit inside such a phrase counts nothing.  The sum of the weights is
divided by the text's length and turned into a probability.

Null and empty texts have no hits and get the score of a text without hits.
Repeated rows are scored one by one; without any labels the lexicon is empty and
every score is 0.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_sample, gather_rows, in_fold, keep_rows, map_rows, read, small_table

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ß": "ss",
    "ø": "o", "đ": "d", "ł": "l",
}
# Digits and signs that stand for letters inside a word.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

LETTERS = str.maketrans(LOOK_ALIKES | {chr(c): None for c in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010))})
SIGNS = str.maketrans(STAND_INS)
#: A run with a sign in it, from its beginning; signs that end a sentence may follow.
DISGUISED = re.compile(r"(?<![a-z0-9@$!|])[a-z]*[0-9@$!|][a-z0-9@$!|]*")
#: Inside a run of two, what starts with a letter, digit or sign and ends with a letter.
SHORT = re.compile(r"[a-z0-9@$][a-z0-9@$!|]*[a-z]")
HAS_SIGN = re.compile(r"[0134578@$!|][a-z]|[a-z][0134578@$!|]")
BLANKS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))

SHORTEST = 5  # letters of a stem
MOST_SWAPS = 6  # letters i and l of an entry whose other spellings are looked for
SMOOTHING_WORDS = 20
HELD_ENTRIES = 1 << 16  # candidates counted by a task before it hands them on
COUNTED_ROWS = 16  # texts between two looks at how many are held
CUT = 0.7


def _letters(m: re.Match) -> str:
    """A run without its signs: all of them stand for letters, but for marks at the end of a plain word."""
    run = m[0].rstrip("!|")
    tail = m[0][len(run) :]
    if len(run) > 2 and not run.isdigit() and any("a" <= c <= "z" for c in run):
        return run.translate(SIGNS) + tail
    return SHORT.sub(lambda x: x[0].translate(SIGNS), m[0])


def fold(text: str) -> str:
    """Words of plain letters, each after exactly one kind of separator: blanks."""
    s = text.lower()
    if not s.isascii():
        s = unicodedata.normalize("NFKD", s).translate(LETTERS)
    if HAS_SIGN.search(s):
        s = DISGUISED.sub(_letters, s)
    return s.encode("utf-8", "replace").translate(BLANKS).decode("utf-8")


def entries_of(words: set[str]) -> set[tuple[str, str]]:
    """Candidate entries with the words they are from: whole words, and the beginnings of longer ones."""
    found = set()
    for w in words:
        found.add((f" {w} ", w))
        for n in range(SHORTEST, len(w)):
            found.add((f" {w[:n]}", w))
    return found


def spellings(entry: str) -> Iterator[str]:
    """The entry with every choice of i and l: a sign may have stood for either."""
    at = [k for k, c in enumerate(entry) if c in "il"][:MOST_SWAPS]
    for letters in itertools.product("il", repeat=len(at)):
        other = list(entry)
        for k, c in zip(at, letters):
            other[k] = c
        yield "".join(other)


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    slope: float = 0.0
    intercept: float = -math.inf


def automaton(entries: dict[str, float]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for e, w in entries.items():
        for other in spellings(e):
            if other == e or other not in entries:
                found.add_word(other, (e, w))
    found.make_automaton()
    return found


def hits(folded: str, words: list[str], machine) -> list[tuple[str, float, str, str]]:
    """(entry, weight, phrase with the word before, phrase with the word after) of every hit."""
    padded = f" {' '.join(words)} "
    best: dict[int, tuple[str, float]] = {}
    for end, (entry, weight) in machine.iter(padded):
        start = end - len(entry) + 1
        if start not in best or abs(weight) > abs(best[start][1]):
            best[start] = (entry, weight)
    found = []
    for start, (entry, weight) in best.items():
        stop = padded.index(" ", start + 1)
        word = padded[start + 1 : stop]
        before = padded[padded.rfind(" ", 0, start) + 1 : start] if start else ""
        after = padded[stop + 1 : max(padded.find(" ", stop + 1), stop + 1)]
        found.append((entry, weight, f"{before} {word}", f"{word} {after}"))
    return found


def density(text: str | None, machine, exceptions: frozenset[str]) -> tuple[float, int, int]:
    """Weight per word on a log scale, words, counted hits."""
    folded = fold(text or "")
    words = folded.split()
    total, n = 0.0, 0
    if machine is not None:
        for _, weight, left, right in hits(folded, words, machine):
            if left not in exceptions and right not in exceptions:
                total += weight
                n += 1
    return math.log1p(100 * max(total, 0.0) / (len(words) + SMOOTHING_WORDS)), len(words), n


def _sketch(words: list[str]) -> list[str]:
    """Three pairs of minimum hashes of the runs of three words, by which near copies in the sample meet."""
    runs = {zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))}
    factors = (2654435761, 2246822519, 3266489917, 668265263, 374761393, 2860486313)
    least = [min(h * a & 0xFFFFFFFF for h in runs) for a in factors]
    return [f"{least[i]} {least[i + 1]}" for i in (0, 2, 4)]


def prepare():
    """Folded words and sketch of every text, the words of one text at a time."""

    def work(ids, texts, ys):
        joined, sketches = [], []
        for t in texts:
            words = fold(t or "").split()
            joined.append(" ".join(words))
            sketches.append(_sketch(words))
        return [ids, ys, joined, *([s[i] for s in sketches] for i in range(3))]

    return work


def count_entries():
    """Of every candidate, the plain and marked texts with it by half; a task holds little more than ``HELD_ENTRIES``."""
    seen: dict[tuple[str, str], list[int]] = {}

    def add(ids, words, ys) -> bool:
        for i, w, y in zip(ids, words, ys):
            half = zlib.crc32(str(i).encode()) & 1
            for e in entries_of(set(w.split())):
                seen.setdefault(e, [0, 0, 0, 0])[2 * y + half] += 1
        return len(seen) >= HELD_ENTRIES

    def take() -> list:
        columns = [[e for e, _ in seen], [w for _, w in seen], *([v[k] for v in seen.values()] for k in range(4))]
        seen.clear()
        return columns

    return add, take


def fit(rows: DataFrame, bound: int = 5000, label: str = "toxic") -> Lexicon:
    """Learn entries, exceptions and the length-normalised scale from (doc_id, text, label 0/1).

    ``bound`` rows per class are used, one of each group of near copies among them; so the
    lexicon is bounded by what those rows hold.
    """
    rows = rows.select("doc_id", "text", F.col(label).alias("y")).filter("y IN (0, 1)")

    keys = ["m0", "m1", "m2"]
    fields = [("doc_id", "long"), ("y", "int"), ("words", "string"), *((k, "string") for k in keys)]
    picked = bounded_sample(rows, "y", bound).select(F.col("doc_id").cast("long"), "text", F.col("y").cast("int"))
    sample = map_rows(picked, prepare, fields)
    for k in keys:
        rest = [c for c in sample.columns if c not in (k, "y")]
        sample = sample.groupBy("y", k).agg(F.min(F.struct(*rest)).alias("r")).select("y", k, "r.*")
    sample = small_table(sample.select("doc_id", "y", "words"), "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    marked, plain = sizes.get(1, 0), sizes.get(0, 0)
    if not marked or not plain:
        return Lexicon()

    names = ["c0", "c1", "t0", "t1"]
    fields = [("entry", "string"), ("word", "string"), *((n, "long") for n in names)]
    by_word = gather_rows(sample.select("doc_id", "words", "y"), count_entries, fields, COUNTED_ROWS).groupBy("entry", "word")
    by_word = by_word.agg(*[F.sum(n).alias(n) for n in names]).withColumns(
        {"t": F.col("t0") + F.col("t1"), "c": F.col("c0") + F.col("c1")}
    )
    odds = lambda t, c: F.log((t + 0.5) / (marked + 1)) - F.log((c + 0.5) / (plain + 1))
    agrees = odds(F.col("t"), F.col("c")) > math.log(2)
    counts = by_word.groupBy("entry").agg(
        *[F.sum(n).alias(n) for n in (*names, "t", "c")],
        F.count(F.lit(1)).alias("covered"),
        F.bool_and(agrees).alias("agree"),
        F.count_if(F.col("t") > 1).alias("often"),
    )
    # Log-likelihood ratio of the entry's counts against one common rate.
    share = (F.col("t") + F.col("c")) / (marked + plain)
    part = lambda n, size: F.when(n > 0, n * F.log(n / (size * share))).otherwise(0.0)
    is_word = F.col("entry").endswith(" ")
    telling = (
        counts.filter(is_word | (F.col("agree") & (F.col("often") > 1)))
        .filter((F.col("t0") > 1) & (F.col("t1") > 1) & (F.col("t") >= 0.002 * marked))
        .withColumn("weight", odds(F.col("t"), F.col("c")))
        # Each half for itself must speak for the entry.
        .filter((F.col("weight") > math.log(8)) & (F.col("t0") > 2 * F.col("c0")) & (F.col("t1") > 2 * F.col("c1")))
        .withColumn("gain", 2 * (part(F.col("t"), marked) + part(F.col("c"), plain)))
        .filter("gain >= 12")
        .orderBy(F.desc("gain"), F.length("entry"), "entry")
    )
    weights: dict[str, float] = {}
    best_gain = None
    for r in telling.collect():
        best_gain = best_gain or r["gain"]
        if r["gain"] < min(24.0, 0.3 * best_gain):
            break
        e = r["entry"]
        if not any(e.startswith(x) or x.startswith(e) for x in weights):
            weights[e] = float(r["weight"])

    def phrases():
        machine = automaton(weights) if weights else None

        def work(words, ys):
            out: dict[str, list[int]] = {}
            for w, y in zip(words, ys):
                seen = {p for h in hits(w, w.split(), machine) for p in h[2:]} if machine else ()
                for p in seen:
                    out.setdefault(p, [0, 0])[y] += 1
            return [list(out), [v[1] for v in out.values()], [v[0] for v in out.values()]]

        return work

    harmless = (
        map_rows(sample.select("words", "y"), phrases, [("phrase", "string"), ("t", "long"), ("c", "long")])
        .groupBy("phrase")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .filter((F.col("c") >= 2) & (F.col("c") * marked > 4 * (F.col("t") + 0.25) * plain))
    )
    exceptions = frozenset(r["phrase"] for r in harmless.collect())

    def place():
        machine = automaton(weights) if weights else None
        return lambda words, ys: [[round(density(w, machine, exceptions)[0], 2) for w in words], ys]

    bins = map_rows(sample.select("words", "y"), place, [("x", "double"), ("y", "int")]).groupBy("x", "y").count().collect()
    slope, intercept = _logistic([(r["x"], r["y"], r["count"]) for r in bins])
    return Lexicon(weights, exceptions, slope, intercept)


def _logistic(bins: list[tuple[float, int, int]], ridge: float = 0.05) -> tuple[float, float]:
    """Newton steps for a one-variable logistic curve on counted points; classes weigh the same."""
    size = {y: sum(n for _, z, n in bins if z == y) for y in (0, 1)}
    a = b = 0.0
    for _ in range(40):
        ga, gb, haa, hab, hbb = -ridge * a, 0.0, ridge, 0.0, 1e-6
        for x, y, n in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            w = n / size[y] * 100
            ga += w * (y - p) * x
            gb += w * (y - p)
            haa += w * p * (1 - p) * x * x
            hab += w * p * (1 - p) * x
            hbb += w * p * (1 - p)
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + max(-2.0, min(2.0, da)), b + max(-2.0, min(2.0, db))
    return a, b


def scorer(lexicon: Lexicon):
    """A function from a text to (score, words, counted hits)."""
    machine = automaton(lexicon.weights) if lexicon.weights else None

    def one(text: str | None) -> tuple[float, int, int]:
        x, words, n = density(text, machine, lexicon.exceptions)
        z = lexicon.slope * x + lexicon.intercept
        return (1 / (1 + math.exp(-z)) if z > -500 else 0.0), words, n

    return one


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, predicted, n_words, n_hits) for every row, from its text alone."""

    def make():
        one = scorer(lexicon)

        def work(ids, texts):
            rows = [one(t) for t in texts]
            return [ids, [r[0] for r in rows], [int(r[0] >= CUT) for r in rows], [r[1] for r in rows], [r[2] for r in rows]]

        return work

    fields = [("doc_id", "long"), ("score", "double"), ("predicted", "int"), ("n_words", "long"), ("n_hits", "long")]
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, fields)


def keep_clean(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows that score below the cut, with all their columns."""

    def make():
        one = scorer(lexicon)
        return lambda texts: [one(t)[0] < CUT for t in texts]

    return keep_rows(docs, "text", make)


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = 5000) -> DataFrame:
    """Documents of about ``bound`` labels per class outside the held-out fold.

    The labels are sampled before they meet the texts; their number is bounded by
    then, so they are sent to every task and no text is shuffled.
    """
    marks = labels.filter("toxic IS NOT NULL").filter(~in_fold(3, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = small_table(bounded_sample(marks, "toxic", bound), "toxicity-labels")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lexicon = fit(training_rows(docs, read(spark, sf_dir, "labels")))
    return score(docs, lexicon).select("*", F.coalesce(in_fold(3, 1), F.lit(False)).alias("held_out"))
