"""Quality by ordinal regression on graded ratings.

A cumulative-link (proportional odds) model: one weight vector over hashed text
features is shared by all grades, and ordered thresholds cut its value into grades:
P(grade > j) = logistic(w . x - threshold_j).  The expected grade and the tail
probability P(grade >= 1) follow, and the tail probability selects documents.

Features of a whole text, hashed to a fixed width: the shapes of its tokens (runs of
upper case, lower case, digits and each sign), its byte trigrams, its length class and
how often its tokens repeat.  Each group has length one, so long and short texts compare.

The ratings at hand are two marks; together they give three grades: 0 low quality,
1 good but toxic, 2 good.  Null and empty texts have only the length feature.  Without
ratings, or with a single grade, every row gets that grade (the highest, if there is
none) and is kept.  Repeated rows are scored one by one; other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_sample, in_fold, keep_rows, map_rows, read, small_table

SHAPES, RUNS, EXTRA = 256, 256, 32
WIDTH = SHAPES + RUNS + EXTRA + 1
SHAPE_OF = bytes(
    0x20 if c in (9, 10, 11, 12, 13, 32)
    else ord("A") if chr(c).isascii() and chr(c).isupper()
    else ord("a") if c >= 0x80 or chr(c).islower()
    else ord("0") if chr(c).isdigit()
    else c
    for c in range(256)
)
REPEATED = re.compile(rb"([^ ])\1+")
CUT = 0.5


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.linalg.norm(v)), 1e-12)


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "replace")
    out = np.zeros(WIDTH)
    out[-1] = 1.0
    shapes = Counter(REPEATED.sub(rb"\1", raw.translate(SHAPE_OF)).split())
    for s, n in shapes.items():
        out[zlib.crc32(s) % SHAPES] += n
    out[:SHAPES] = _unit(np.sqrt(out[:SHAPES]))
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    if len(b) > 2:
        code = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)
        out[SHAPES : SHAPES + RUNS] = _unit(np.sqrt(np.bincount(code >> np.uint32(24), minlength=RUNS)))
    tokens = raw.lower().split()
    extra = SHAPES + RUNS
    out[extra + min(15, len(tokens).bit_length())] = 0.5
    distinct = len(set(tokens)) / len(tokens) if tokens else 1.0
    out[extra + 16 + int(15 * (1 - distinct))] = 0.5
    return out


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades; empty: a single grade
    only_grade: int = 0


def _tails(model: OrdinalModel, x: np.ndarray) -> np.ndarray:
    """P(grade >= 1), P(grade >= 2), ... per row."""
    z = (x @ model.weights)[:, None] - model.thresholds[None, :]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _step(model: OrdinalModel, x: np.ndarray, y: np.ndarray, row_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score vector and expected information of (weights, thresholds) for the cumulative-link likelihood."""
    k = len(model.thresholds)
    tail = np.hstack([np.ones((len(x), 1)), _tails(model, x), np.zeros((len(x), 1))])
    p = np.maximum(tail[:, :-1] - tail[:, 1:], 1e-9)  # per grade
    slope = tail * (1 - tail)  # of each tail in its argument; 0 at the ends
    rows = np.arange(len(x))
    up, down = slope[rows, y], slope[rows, y + 1]
    own = p[rows, y]
    by_w = row_weight * (up - down) / own
    score = np.zeros(WIDTH + k)
    score[:WIDTH] = x.T @ by_w
    info = np.zeros((WIDTH + k, WIDTH + k))
    d = slope[:, :-1] - slope[:, 1:]  # derivative of each grade's probability in w . x
    info[:WIDTH, :WIDTH] = (x * (row_weight * (d**2 / p).sum(1))[:, None]).T @ x
    for j in range(k):
        score[WIDTH + j] = (row_weight * (np.where(y == j, down, 0) - np.where(y == j + 1, up, 0)) / own).sum()
        cross = slope[:, j + 1] * (d[:, j] / p[:, j] - d[:, j + 1] / p[:, j + 1])
        info[:WIDTH, WIDTH + j] = info[WIDTH + j, :WIDTH] = x.T @ (row_weight * cross)
        info[WIDTH + j, WIDTH + j] = (row_weight * slope[:, j + 1] ** 2 * (1 / p[:, j] + 1 / p[:, j + 1])).sum()
        if j:
            both = -(row_weight * slope[:, j] * slope[:, j + 1] / p[:, j]).sum()
            info[WIDTH + j, WIDTH + j - 1] = info[WIDTH + j - 1, WIDTH + j] = both
    return score, info


def fit(rows: DataFrame, bound: int = 3000, rounds: int = 8, ridge: float = 1.0, no_grade: int = 2) -> OrdinalModel:
    """Fit on (doc_id, text, grade); about ``bound`` rows per grade are used, grades weigh the same.

    Every round is one Spark job over the sample's feature table: each task adds up
    the score and information of its rows, and only those sums come to the driver.
    """
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.col("grade").cast("int")).filter("grade IS NOT NULL")
    picked = bounded_sample(rows, "grade", bound).select("doc_id", "text", "grade")

    def featurise():
        return lambda ids, texts, grades: [ids, grades, [features(t).astype("f4").tobytes() for t in texts]]

    sample = small_table(
        map_rows(picked, featurise, [("doc_id", "long"), ("grade", "int"), ("x", "binary")]), "quality-sample", 4
    )
    sizes = {r["grade"]: r["count"] for r in sample.groupBy("grade").count().collect()}
    grades = sorted(sizes)
    if len(grades) < 2:
        return OrdinalModel(np.zeros(WIDTH), np.zeros(0), grades[0] if grades else no_grade)
    place = {g: i for i, g in enumerate(grades)}
    model = OrdinalModel(np.zeros(WIDTH), np.linspace(-0.5, 0.5, len(grades) - 1) if len(grades) > 2 else np.zeros(1))
    share = {g: 1000 / n for g, n in sizes.items()}
    size = WIDTH + len(grades) - 1
    upper = np.triu_indices(size)  # the information is symmetric: half of it travels
    for _ in range(rounds):

        def sums(model=model):
            def work(xs, ys):
                x = np.frombuffer(b"".join(xs), dtype="f4").reshape(len(xs), WIDTH).astype("f8")
                y = np.array([place[v] for v in ys])
                score, info = _step(model, x, y, np.array([share[v] for v in ys]))
                return [[score.tobytes()], [info[upper].tobytes()]]

            return work

        parts = map_rows(sample.select("x", "grade"), sums, [("score", "binary"), ("info", "binary")])
        score, half = np.zeros(size), np.zeros(size * (size + 1) // 2)
        for r in parts.toLocalIterator():
            score += np.frombuffer(r["score"])
            half += np.frombuffer(r["info"])
        info = np.zeros((size, size))
        info[upper] = half
        info += np.triu(info, 1).T
        penalty = np.r_[np.full(WIDTH - 1, ridge), 1e-3, np.full(len(grades) - 1, 1e-3)]
        at = np.r_[model.weights, model.thresholds]
        move = np.linalg.solve(info + np.diag(penalty + 1e-6), score - penalty * at)
        move *= min(1.0, 30.0 / max(float(np.linalg.norm(move)), 1e-12))
        at = at + move
        model = OrdinalModel(at[:WIDTH], np.maximum.accumulate(at[WIDTH:]))
        if np.linalg.norm(move) < 1e-4 * max(1.0, np.linalg.norm(at)):
            break
    return model


def keep_good(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows whose tail probability reaches the cut, with all their columns."""

    def make():
        if not len(model.thresholds):
            return lambda texts: [True] * len(texts)
        return lambda texts: [bool(_tails(model, features(t)[None, :])[0, 0] >= CUT) for t in texts]

    return keep_rows(docs, "text", make)


def grade(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, keep) for every row, from its text alone."""
    columns = [F.col("doc_id").cast("long"), F.col("text")]

    def make():
        def work(ids, texts):
            if not len(model.thresholds):
                sure = float(model.only_grade >= 1)
                return [ids, [float(model.only_grade)] * len(ids), [sure] * len(ids), [True] * len(ids)]
            tails = np.vstack([_tails(model, features(t)[None, :]) for t in texts])
            return [ids, tails.sum(1).tolist(), tails[:, 0].tolist(), (tails[:, 0] >= CUT).tolist()]

        return work

    fields = [("doc_id", "long"), ("expected_grade", "double"), ("tail_probability", "double"), ("keep", "boolean")]
    return map_rows(docs.select(*columns), make, fields)


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = 3000) -> DataFrame:
    """Documents of about ``bound`` ratings per grade outside the held-out fold, with their grade.

    The ratings are sampled before they meet the texts; their number is bounded by
    then, so they are sent to every task and no text is shuffled.
    """
    graded = F.expr("CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END")
    rated = labels.filter("quality IS NOT NULL").filter(~in_fold(3, 1)).groupBy("doc_id").agg(F.min(graded).alias("grade"))
    picked = small_table(bounded_sample(rated, "grade", bound), "quality-labels")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(training_rows(docs, read(spark, sf_dir, "labels")))
    return grade(docs, model).select("*", F.coalesce(in_fold(3, 1), F.lit(False)).alias("held_out"))
