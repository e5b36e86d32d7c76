"""Language by the nearest of several centroids per language.

A text is the TF-IDF vector of its lower-cased letter n-grams (runs of one, two and
three bytes of UTF-8, digits and signs blanked), hashed to a fixed width and scaled
to length one.  Each language has several centroids, found by spherical k-means on
a bounded sample; the nearest by cosine names the language.  A text farther from
that centroid than nearly all of the centroid's own training texts is ``rejected``.

Null texts and texts without a letter are ``und`` with score 0.  Equal cosines go
to the centroid listed first (language name, then number).  Without any training
row every text is ``und``.  Only the named columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_sample, in_fold, map_rows, read, small_table

WIDTH = 4096
LETTER = re.compile(r"[^\W\d_]")  # also finds signs such as superscripts, which are numbers
BLANK = np.array([c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)], dtype=np.uint32)
KINDS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def counts(text: str) -> np.ndarray:
    """Hashed counts of one-, two- and three-byte runs."""
    raw = BLANK[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)]
    total = np.zeros(WIDTH)
    code = np.zeros(len(raw), dtype=np.uint32)
    for n, factor in enumerate(KINDS):
        code = (code[: len(raw) - n] << np.uint32(8)) | raw[n:]
        total += np.bincount((code * factor) >> np.uint32(20), minlength=WIDTH)
    return total


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    points: np.ndarray
    owner: np.ndarray
    reach: np.ndarray


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts(text)) * idf)


def fit(rows: DataFrame, bound: int = 1500, per_language: int = 4, rounds: int = 5) -> Centroids:
    """Centroids from (doc_id, text, lang); about ``bound`` rows per language are used.

    Each round is one Spark job that assigns the sample's rows and adds up a vector
    per centroid; only centroids, never rows, come to the driver.
    """
    rows = rows.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sample = small_table(bounded_sample(rows, "lang", bound), "langid-sample")
    sizes = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Centroids([], np.zeros(WIDTH), np.zeros((0, WIDTH)), np.zeros(0, int), np.zeros(0))

    def seen():
        def work(texts):
            n = np.zeros(WIDTH)
            for t in texts:
                n += counts(t) > 0
            return [[0], [n.tobytes()]]

        return work

    def added(df: DataFrame) -> dict[int, np.ndarray]:
        """Sums of the binary vectors by key: each task sends one per key it met."""
        total: dict[int, np.ndarray] = {}
        for r in df.collect():
            v = np.frombuffer(r["v"])
            total[r["k"]] = total.get(r["k"], 0) + v
        return total

    pair = [("k", "int"), ("v", "binary")]
    df_counts = added(map_rows(sample.select("text"), seen, pair))[0]
    idf = np.log((sum(sizes.values()) + 1) / (df_counts + 1)) + 1
    place = {x: i for i, x in enumerate(languages)}
    owner = np.repeat(np.arange(len(languages)), per_language)
    points: np.ndarray | None = None
    for _ in range(rounds + 1):

        def assign(points=points):
            def work(ids, texts, langs):
                sums: dict[int, np.ndarray] = {}
                for d, t, x in zip(ids, texts, langs):
                    v = vector(t, idf)
                    first = place[x] * per_language
                    if points is None:  # split by a hash of the id at first
                        k = first + (int(d or 0) * 2654435761 >> 7) % per_language
                    else:
                        k = first + int(np.argmax(points[first : first + per_language] @ v))
                    sums[k] = sums.get(k, 0) + v
                return [list(sums), [s.tobytes() for s in sums.values()]]

            return work

        found = added(map_rows(sample.select(F.col("doc_id").cast("long"), "text", "lang"), assign, pair))
        fresh = np.zeros((len(owner), WIDTH))
        for k in range(len(owner)):
            kept = found.get(k)
            first = k // per_language * per_language
            if kept is None:  # an empty centroid starts again at its language's middle
                kept = sum((found.get(j, 0) for j in range(first, first + per_language)), np.zeros(WIDTH))
            fresh[k] = kept
        points = unit(fresh)

    def far(points=points):
        def work(texts, langs):
            out: dict[tuple[int, int], int] = {}
            for t, x in zip(texts, langs):
                first = place[x] * per_language
                c = points[first : first + per_language] @ vector(t, idf)
                key = (first + int(np.argmax(c)), int(100 * c.max()))
                out[key] = out.get(key, 0) + 1
            return [[k for k, _ in out], [b for _, b in out], list(out.values())]

        return work

    near = map_rows(sample.select("text", "lang"), far, [("k", "int"), ("bin", "int"), ("n", "long")])
    by: dict[int, list[tuple[int, int]]] = {}
    for r in near.groupBy("k", "bin").agg(F.sum("n").alias("n")).collect():
        by.setdefault(r["k"], []).append((r["bin"], r["n"]))
    reach = np.zeros(len(owner))
    for k, bins in by.items():
        left = 0.005 * sum(n for _, n in bins)
        for b, n in sorted(bins):
            left -= n
            if left <= 0:
                reach[k] = b / 100
                break
    return Centroids(languages, idf, points, owner, reach)


def predict(docs: DataFrame, model: Centroids, sharpness: float = 25.0) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row; the score weighs languages by e^(sharpness * cosine)."""

    def make():
        n = len(model.languages)

        def one(text):
            if text is None or not n or not has_letter(text):
                return "und", 0.0, True
            cosines = model.points @ vector(text, model.idf)
            k = int(np.argmax(cosines))
            best = np.array([cosines[model.owner == i].max() for i in range(n)])
            share = np.exp(sharpness * (best - best.max()))
            return model.languages[model.owner[k]], float(1 / share.sum()), bool(cosines[k] < model.reach[k])

        def work(ids, texts):
            rows = [one(t) for t in texts]
            return [ids, *([r[i] for r in rows] for i in range(3))]

        return work

    fields = [("doc_id", "long"), ("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")]
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, fields)


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang").filter(~in_fold(3, 1)))
    return predict(docs, model).select("*", F.coalesce(in_fold(3, 1), F.lit(False)).alias("held_out"))
