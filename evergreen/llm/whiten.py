"""Whitening of vectors by a bidiagonal qd solver.

Components x become whole numbers floor(256 x).  Every different vector counts once: the
fit list is split into blocks, each block is centred by its own mean and reduced to a
triangle R by QR, and blocks are merged by the QR of both triangles and of the
difference of their means, which is exact for the centred whole.  Householder reflections
make R bidiagonal; dqds finds its squared singular values to high relative accuracy; and a
twisted factorisation for each wanted value gives its direction, from the row in which the
two eliminations, from the top and from the bottom, meet with the least remainder.

Rows whose vector is null or holds null or non-finite entries are left out.  Vectors of
each length are a fit of their own, held in one task as a triangle of that size, and vectors
without entries have no components.  Equal vectors have no variance: a component without it
has ``explained`` 0 and ``whitened`` null and takes no part in ``identity_error``.  Entries
beyond 64 bits count as the nearest whole number of 64 bits, and a ``deviation`` beyond 64
bits is null.  Repeated rows come back one by one, as do null ids.  Only the named columns
are read.  Models, one per length, go to the driver and to every task: four
directions of that length each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_batches, read
from evergreen.session import materialize

BLOCK = 4096
FAN_IN = 16
EPS = float(np.finfo("f8").eps)
TOP = (1 << 63) - 1


def whole_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): the entries as whole numbers, unusable vectors left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.filter(F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v")
    )


# Blocks of the fit list.


@dataclass
class Block:
    """Count, exact sums per dimension, and the triangle R with R'R = the sum of centred products."""

    n: int
    sums: list[int]
    r: np.ndarray

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def merged(self, other: Block) -> Block:
        n = self.n + other.n
        # Exact difference of the means, as (n2 s1 - n1 s2) / (n1 n2).
        gap = np.array([(other.n * a - self.n * b) / (self.n * other.n) for a, b in zip(self.sums, other.sums)])
        r = np.linalg.qr(np.vstack([self.r, other.r, math.sqrt(self.n * other.n / n) * gap]), mode="r")
        return Block(n, [a + b for a, b in zip(self.sums, other.sums)], r)


def column_sums(x: np.ndarray) -> list[int]:
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return [int(s) for s in (x if largest * len(x) < TOP else x.astype(object)).sum(0)]


def block_of(x: np.ndarray) -> Block:
    """Of a matrix of whole numbers, one row each."""
    sums = column_sums(x)
    centred = x.astype("f8") - np.array([s / len(x) for s in sums])
    return Block(len(x), sums, np.linalg.qr(centred, mode="r"))


def by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as a matrix) for every length above zero."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    ends = np.cumsum(sizes)
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        yield at, values[(ends[at] - size)[:, None] + np.arange(size)]


BLOCK_TYPE = "size int, n long, sums array<string>, r binary"
BLOCK_SCHEMA = pa.schema(
    [("size", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("r", pa.binary())]
)


def packed(size: int, b: Block) -> pa.RecordBatch:
    row = [size, b.n, [str(s) for s in b.sums], b.r.astype("<f8").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)


def unpacked(size: int, n: int, sums: list[str], r: bytes) -> Block:
    return Block(n, [int(s) for s in sums], np.frombuffer(r, dtype="<f8").reshape(-1, size))


def reduce_blocks(distinct: DataFrame) -> DataFrame:
    """One block per task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Block] = {}
        for batch in batches:
            if batch.num_rows:
                for _, x in by_length(batch.column(0)):
                    for at in range(0, len(x), BLOCK):
                        b, size = block_of(x[at : at + BLOCK]), x.shape[1]
                        held[size] = held[size].merged(b) if size in held else b
        for size, b in held.items():
            yield packed(size, b)

    return bounded_batches(distinct.select("v")).mapInArrow(run, BLOCK_TYPE)


# The solver.


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w): r = u B w' with B upper bidiagonal, diagonal a and b above it, by Householder reflections."""
    m = np.zeros((r.shape[1], r.shape[1]))
    m[: len(r)] = r
    d = len(m)
    w = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        scale = np.abs(x).max(initial=0.0)
        if not scale or not np.abs(x[1:]).max(initial=0.0):
            return None
        v = x / scale
        v[0] += math.copysign(math.sqrt(v @ v), v[0])
        return v / math.sqrt(v @ v)

    for k in range(d):
        if (v := reflection(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2 and (v := reflection(m[k, k + 1 :])) is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds step: the arrays of B'B - shift, and its d; None if it is not positive."""
    nq, ne, ds = [0.0] * len(q), [0.0] * len(e), [0.0] * len(q)
    d = q[0] - shift
    for i, f in enumerate(e):
        if d < 0:
            return None
        ds[i] = d
        nq[i] = t = d + f
        if t == 0:
            ne[i], d = 0.0, q[i + 1] - shift
            continue
        ratio = q[i + 1] / t
        ne[i] = f * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    nq[-1] = ds[-1] = d
    return nq, ne, ds


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Falling squares of the singular values of the bidiagonal matrix, by dqds.

    Shifts are lower bounds of the least value left: the sum of the inverses of an unshifted
    step's d bounds its inverse, and a bolder guess is taken back if it goes too far.
    """
    found: list[float] = []
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not scale:
        return np.zeros(len(a))
    todo = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    while todo:
        q, e, gone = todo.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (gone + q[i + 1]) or e[i] < 1e-300), None)
            if len(q) == 1:
                found.append(gone + q[0])
                break
            if cut == len(e) - 1:
                found.append(gone + q.pop())
                e.pop()
                continue
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], gone))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            plain = _sweep(q, e, 0.0)
            ds = plain[2]
            least = 0.0 if min(ds) <= 0 else 1 / sum(1 / d for d in ds)
            bold = min(ds) * (1 - 2 * math.sqrt(e[-1] / q[-1])) if ds[-1] == min(ds) and e[-1] < q[-1] / 16 else 0.0
            step = None
            for shift in (bold, least * (1 - 8 * len(q) * EPS)):
                if shift > EPS * gone and shift > 0 and (step := _sweep(q, e, shift)):
                    gone += shift
                    break
            q, e, _ = step or plain
    return np.array(sorted(found, reverse=True)) * scale * scale


def twisted(a: np.ndarray, b: np.ndarray, value: float, taken: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for ``value``, free of those ``taken``.

    Stationary elimination from the top and progressive elimination from the bottom meet
    in the row with the least remainder; from there the entries follow by products alone.
    """
    n = len(a)
    tiny = EPS * EPS * max(value, np.abs(a).max() ** 2, 1e-290)
    solid = np.where(np.abs(a) > EPS * np.abs(a).max(), a, np.copysign(EPS * np.abs(a).max(), a))
    pivot, ratio = solid**2, b / solid[:-1]
    s, up = np.zeros(n), np.zeros(n)  # from the top
    lower, upper = np.zeros(max(0, n - 1)), np.zeros(max(0, n - 1))
    s[0] = -value
    for i in range(n - 1):
        top = pivot[i] + s[i]
        top = top if abs(top) > tiny else math.copysign(tiny, top)
        lower[i] = pivot[i] * ratio[i] / top
        s[i + 1] = lower[i] * ratio[i] * s[i] - value
    up[-1] = pivot[-1] - value
    for i in range(n - 2, -1, -1):
        low = pivot[i] * ratio[i] ** 2 + up[i + 1]
        low = low if abs(low) > tiny else math.copysign(tiny, low)
        upper[i] = pivot[i] * ratio[i] / low
        up[i] = up[i + 1] * pivot[i] / low - value
    remainder = np.abs(s + up + value)
    for at in np.argsort(remainder, kind="stable"):
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -upper[i] * z[i]
        if not np.isfinite(z).all():
            continue
        z /= np.abs(z).max()
        z /= math.sqrt(z @ z)
        for t in taken:  # close values share a plane; within it directions must differ
            z -= (t @ z) * t
        left = math.sqrt(z @ z)
        if left > 1e-3:
            z /= left
            for t in taken:
                z -= (t @ z) * t
            return z / math.sqrt(z @ z)
    raise ArithmeticError("no direction left")


@dataclass
class Model:
    n: int
    sums: list[int]
    values: list[float]  # falling variances of the leading components
    directions: np.ndarray  # one row each
    trace: float


def solve(block: Block, components: int = 4) -> Model:
    """Leading directions of variance."""
    a, b, w = bidiagonal(block.r)
    squares = squared_singular_values(a, b)
    top = squares[: min(components, len(squares))]
    floor = (len(a) * EPS) ** 2 * squares[0] if len(squares) else 0.0
    directions: list[np.ndarray] = []
    for value in top:
        directions.append(np.zeros(len(a)) if value <= floor else twisted(a, b, float(value), directions))
    values = [float(v) / block.n if v > floor else 0.0 for v in top]
    trace = float((block.r**2).sum()) / block.n
    return Model(block.n, block.sums, values, np.array(directions) @ w.T, trace)


# Rows.


def whitened(x: np.ndarray, model: Model) -> tuple[list[int | None], np.ndarray]:
    """(deviations, whitened with a row per vector) of whole vectors; components without variance are NaN."""
    sums = np.array(model.sums, dtype=object)
    largest = model.n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in model.sums)
    small = largest * largest * x.shape[1] < TOP
    gap = model.n * x - sums.astype("i8") if small else model.n * x.astype(object) - sums
    squares = (gap * gap).sum(1)
    deviation = squares.tolist() if small else [s if s <= TOP else None for s in squares]
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(np.array(model.values) > 0, 1 / np.sqrt(model.values), np.nan)
    return deviation, (gap.astype("f8") / model.n) @ model.directions.T * scale


def identity_errors(distinct: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length, the largest absolute entry of the whitened fit list's covariance less the identity."""
    used = {s: np.flatnonzero(np.array(m.values) > 0) for s, m in models.items()}
    schema = pa.schema([("size", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("m2", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for _, x in by_length(batch.column(0)):
                size = x.shape[1]
                if not len(used[size]):
                    continue
                y = whitened(x, models[size])[1][:, used[size]]
                mean = y.mean(0)
                row = [size, len(y), mean.tolist(), ((y - mean).T @ (y - mean)).ravel().tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    parts = bounded_batches(distinct.select("v")).mapInArrow(run, "size int, n long, mean array<double>, m2 array<double>")
    # Sums of block means and products merge by plain sums: of n, n m, and m2 + n m m'.
    k = F.sqrt(F.size("m2")).cast("int")
    spread = parts.select(
        "size", "n", k.alias("k"), "mean", F.posexplode("m2").alias("p", "v")
    ).withColumns({"i": F.floor(F.col("p") / F.col("k")).cast("int"), "j": (F.col("p") % F.col("k")).cast("int")})
    mi, mj = F.get("mean", F.col("i")), F.get("mean", F.col("j"))
    rows = spread.groupBy("size", "i", "j").agg(
        F.sum("n").alias("n"),
        F.sum("v").alias("v"),
        F.sum(F.col("n") * mi).alias("a"),
        F.sum(F.col("n") * mj).alias("b"),
        F.sum(F.col("n") * mi * mj).alias("ab"),
    )
    found: dict[int, float] = {}
    for r in rows.collect():
        cov = (r["v"] + r["ab"] - r["a"] * r["b"] / r["n"]) / r["n"]
        found[r["size"]] = max(found.get(r["size"], 0.0), abs(cov - (r["i"] == r["j"])))
    return found


OUT = pa.schema(
    [
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
    ]
)


def fit(distinct: DataFrame, components: int = 4) -> dict[int, Model]:
    """A model per vector length: blocks merge in tasks, the solver runs in the task that holds the last triangle."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Block] = {}
        for batch in batches:
            for size, *row in zip(*(batch.column(c).to_pylist() for c in BLOCK_SCHEMA.names)):
                b = unpacked(size, *row)
                held[size] = held[size].merged(b) if size in held else b
        for size, b in held.items():
            yield packed(size, b)

    blocks = materialize(reduce_blocks(distinct), "whiten-blocks")
    tasks = blocks.count()
    while tasks > FAN_IN * max(1, blocks.select("size").distinct().count()):
        tasks = -(-tasks // FAN_IN)
        blocks = materialize(bounded_batches(blocks.repartition(tasks)).mapInArrow(merge, BLOCK_TYPE), "whiten-blocks")
        if blocks.count() <= tasks:
            break

    def last(key: tuple, frame):
        import pandas as pd

        block = None
        for row in frame[["size", "n", "sums", "r"]].itertuples(index=False):
            b = unpacked(int(row[0]), int(row[1]), list(row[2]), row[3])
            block = b if block is None else block.merged(b)
        m = solve(block, components)
        return pd.DataFrame(
            {"size": [key[0]], "n": [m.n], "sums": [[str(s) for s in m.sums]], "values": [m.values],
             "directions": [m.directions.ravel().tolist()], "trace": [m.trace]}
        )

    solved = blocks.groupBy("size").applyInPandas(
        last, "size int, n long, sums array<string>, values array<double>, directions array<double>, trace double"
    )
    return {
        r["size"]: Model(r["n"], [int(s) for s in r["sums"]], list(r["values"]), np.array(r["directions"]).reshape(-1, r["size"]), r["trace"])
        for r in solved.collect()
    }


def whiten(table: DataFrame, components: int = 4) -> DataFrame:
    """A row per usable vector and leading component."""
    rows = whole_vectors(table)
    distinct = materialize(rows.select("v").distinct(), "whiten-distinct")
    models = fit(distinct, components)
    errors = identity_errors(distinct, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id")
            for at, x in by_length(batch.column("v")):
                m = models[x.shape[1]]
                deviation, y = whitened(x, m)
                k = len(m.values)
                share = [v / m.trace if m.trace > 0 else 0.0 for v in m.values]
                wide = np.repeat(np.arange(len(at)), k)
                columns = [
                    ids.take(pa.array(at[wide])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), len(at))),
                    pa.array(np.full(len(wide), m.n, dtype="i8")),
                    pa.array(deviation, pa.int64()).take(pa.array(wide)),
                    pa.array(y.ravel(), mask=np.isnan(y.ravel())),
                    pa.array(np.tile(np.array(share), len(at))),
                    pa.array([errors.get(x.shape[1])] * len(wide), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=OUT)

    return bounded_batches(rows).mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
