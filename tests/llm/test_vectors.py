"""Whitening and vector dedup against plain code."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from evergreen.llm import quantise, whiten

NAN, INF = float("nan"), float("inf")
TYPE = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("n", T.StringType()),  # names that the operators use themselves
        T.StructField("node", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TYPE)


# The solver.


@pytest.mark.parametrize("kind", ["full", "deficient", "small", "ties"])
def test_solver_matches_plain_eigenvectors(kind):
    rng = np.random.default_rng(len(kind))
    for _ in range(25):
        d, n = int(rng.integers(1, 30)), int(rng.integers(1, 60))
        x = rng.integers(-200, 200, size=(n, d))
        if kind == "deficient":
            x[:, : d // 2] = x[:, -1:]
        elif kind == "small":
            x //= 100
        elif kind == "ties":
            x = np.eye(d, dtype="i8") * 7
        x = np.unique(x, axis=0)
        block = None
        for part in np.array_split(x, min(len(x), 4)):
            b = whiten.block_of(part)
            block = b if block is None else block.merged(b)
        assert block.n == len(x) and block.sums == x.sum(0).tolist()
        centred = x - x.mean(0)
        v = centred.T @ centred / len(x)
        want = np.linalg.eigvalsh(v)[::-1]
        a, b, w = whiten.bidiagonal(block.r)
        assert np.allclose(w.T @ w, np.eye(d))
        assert np.allclose(whiten.squared_singular_values(a, b) / len(x), want, atol=1e-9 * max(1, want[0]))
        model = whiten.solve(block)
        for e, z in zip(model.values, model.directions):
            if e:
                assert np.linalg.norm(v @ z - e * z) <= 1e-9 * max(want[0], 1)
        some = [i for i, e in enumerate(model.values) if e]
        y = whiten.whitened(x, model)[1][:, some]
        assert not some or np.abs(np.cov(y.T, bias=True) - np.eye(len(some))).max() < 1e-6


def test_small_singular_values_are_accurate():
    """dqds keeps the relative accuracy of values far below the largest."""
    a, b = np.array([1.0, 1e-5, 1e-10, 1e-15]), np.array([1e-3, 1e-8, 1e-13])
    product = 1.0
    got = whiten.squared_singular_values(a, b)
    for x in got:
        product *= x
    assert math.isclose(product, float(np.prod(a**2)), rel_tol=1e-12)


def plain_whitening(rows):
    """n, S and the covariance in exact or plain arithmetic."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in good}))
    centred = x - x.mean(0)
    return good, x, centred.T @ centred / len(x)


def test_whitening_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(200)]
    rows += [(500 + i, rows[0][1], 1) for i in range(300)]  # copies count once in the fit
    rows += [(None, rows[1][1], None), (1, rows[2][1], 2), (7, None, 1), (8, [], 1), (9, [NAN] * 8, 1), (9, [None] * 8, 1), (9, [INF] * 8, 1)]
    good, x, v = plain_whitening(rows)
    got = whiten.whiten(table(spark, rows)).collect()
    assert len(got) == 4 * len(good) and {r["n"] for r in got} == {len(x)}
    n, s = len(x), x.sum(0)
    values, vectors = np.linalg.eigh(v)
    want = sorted((i is not None, i or 0, sum((n * c - int(t)) ** 2 for c, t in zip(vec, s))) for i, vec in good)
    assert sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"]) for r in got if r["component"] == 1) == want
    by_id = {i: np.array(vec) for i, vec in good}
    for k in range(4):
        rows_k = [r for r in got if r["component"] == k + 1 and r["vec_id"] not in (None, 1)]
        z = np.array([(by_id[r["vec_id"]] - s / n) @ vectors[:, -1 - k] / math.sqrt(values[-1 - k]) for r in rows_k])
        w = np.array([r["whitened"] for r in rows_k])
        assert min(np.abs(z - w).max(), np.abs(z + w).max()) < 1e-10
        assert all(math.isclose(r["explained"], values[-1 - k] / np.trace(v), rel_tol=1e-9) for r in rows_k)
    assert all(r["identity_error"] < 1e-9 for r in got) and len({r["identity_error"] for r in got}) == 1


def test_whitening_corner_cases(spark):
    assert whiten.whiten(table(spark, [])).collect() == []
    same = whiten.whiten(table(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(1, 0, None, 0.0, None)] * 4
    # Each length is a fit of its own; large entries stay within 64 bits, too large a deviation is null.
    mixed = [(1, [1.0], 1), (2, [3.0], 1), (3, [1.0, 2.0], 1), (4, [2.0, 1.0], 1), (5, [1e300, -1e300, 0.0], 1), (6, [0.0, 0.0, 1.0], 1)]
    got = {(r["vec_id"], r["component"]): r for r in whiten.whiten(table(spark, mixed)).collect()}
    assert len(got) == 1 + 1 + 2 + 2 + 3 + 3
    assert abs(abs(got[1, 1]["whitened"]) - 1) < 1e-12 and got[1, 1]["deviation"] == (2 * 256 - 1024) ** 2
    assert got[3, 2]["whitened"] is None and got[3, 2]["explained"] == 0.0
    assert got[5, 1]["deviation"] is None and abs(abs(got[5, 1]["whitened"]) - 1) < 1e-9


# Vector dedup.


def plain_links(rows, cosine=0.98):
    """(vec_id, links, component, kept) of every row."""

    def usable(v, label):
        return label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)

    def unit(v):
        x = np.array(v) / max(abs(c) for c in v)
        return x / math.sqrt(x @ x)

    near = [[] for _ in rows]
    units = [unit(v) if usable(v, label) else None for _, v, label in rows]
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            if units[i] is not None and units[j] is not None and label == rows[j][2] and len(v) == len(rows[j][1]):
                if units[i] @ units[j] >= cosine:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            front = [k for f in front for k in near[f] if k not in seen and not seen.add(k)]
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, len(near[i]), component, vec_id == component))
    return sorted(out, key=repr)


def near_copies(rng, n, size, groups, noise):
    rows = [(i, rng.normal(size=size).tolist(), int(i % 3)) for i in range(n)]
    for g in range(groups):
        base = np.array(rows[g][1])
        for _ in range(int(rng.integers(2, 14))):
            scale = float(rng.uniform(0.1, 10))
            rows.append((len(rows), ((base + noise * rng.normal(size=size) * np.linalg.norm(base) / math.sqrt(size)) * scale).tolist(), rows[g][2]))
    return rows


@pytest.mark.parametrize("size", [64, 100, 7, 1])
def test_every_link_is_found(spark, size):
    rng = np.random.default_rng(size)
    rows = near_copies(rng, 90, size, 20, 0.13)
    rows += [(10_000 + i, rows[0][1], rows[0][2]) for i in range(20)]
    rows += [(3, None, 1), (None, rows[1][1], rows[1][2]), (11, [0.0] * size, 1), (12, [NAN] * size, 1), (13, [None] * size, 1)]
    rows += [(14, rows[2][1], None), (14, rows[2][1], rows[2][2]), (14, rows[2][1], rows[2][2]), (15, [], 1), (16, [1e300] * size, 0), (17, [2.0] * size, 0)]
    rows += [(18, [1e-300] * size, 0), (19, [5.0] * (size + 1), 0)]
    got = quantise.near_duplicates(table(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_links(rows)


@pytest.mark.parametrize("limits", [{"SMALL": 2, "BLOCK": 8}, {"WIDE": 2}, {"WIDE": 6, "BLOCK": 16, "HOT": 10}])
def test_other_ways_give_the_same(spark, monkeypatch, limits):
    """Tiles of large buckets, wide vectors that meet all rows of their label, split keys."""
    for name, value in limits.items():
        monkeypatch.setattr(quantise, name, value)
    rng = np.random.default_rng(8)
    rows = near_copies(rng, 60, 64, 8, 0.12)
    assert sorted((tuple(r) for r in quantise.near_duplicates(table(spark, rows)).collect()), key=repr) == plain_links(rows)


def test_dedup_of_nothing(spark):
    assert quantise.near_duplicates(table(spark, [])).collect() == []
    rows = [(1, None, 1), (2, [0.0], None)]
    assert sorted(map(tuple, quantise.near_duplicates(table(spark, rows)).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_above_the_threshold_meet_in_a_table():
    """The guarantee behind the search, also for pairs made to differ in the worst place."""
    rng = np.random.default_rng(4)
    w = quantise.learn_rotation(rng.normal(size=(300, 64)))
    assert np.allclose(w.T @ w, np.eye(64))
    budget = 0.04 / 16 + 1e-9
    cut = quantise.chunks(64, 1 << 15)
    assert len(cut) == 4
    for trial in range(300):
        y = quantise.unit(rng.normal(size=(1, 64)))[0]
        step = rng.normal(size=64) if trial % 2 else -y * (np.abs(y) < np.quantile(np.abs(y), rng.uniform(0.1, 0.5)))
        z = y + step * rng.uniform(0.05, 1.999) * 0.1 / np.linalg.norm(step)
        z /= np.linalg.norm(z)
        if y @ z < 0.98:
            continue
        sets = [[quantise.reached(v[part], budget) for part in cut] for v in (y, z)]
        wide = any(codes is None for own in sets for codes in own)  # such vectors meet all others
        assert wide or any(set(a) & set(b) for a, b in zip(*sets))


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 64)) * np.linspace(0.2, 3, 64) + 0.1
    on = (quantise.unit(x) @ quantise.learn_rotation(x) >= 0).mean(0)
    assert 0.3 < on.min() and on.max() < 0.7


def test_random_seed_is_not_shared():
    random.seed(1)
    before = random.random()
    random.seed(1)
    quantise.learn_rotation(np.random.default_rng(0).normal(size=(50, 16)))
    assert random.random() == before
