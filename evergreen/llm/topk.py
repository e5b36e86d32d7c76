"""Exact top-k inner products by block-at-a-time pruning.

Vectors are laid out in blocks: ranges of rows ordered by the nearest of some centroids
and by id, so that a block's vectors are alike.  A block keeps, for every term (vector
component), the largest and least value in it, and its rows as a forward index.  For a
query the blocks are ordered by the sum over terms of the largest product that each may
reach, and scored one after the other until the next bound is below the k-th score so
far.  Bounds hold for all rows of a block, so the result is exact; blocks whose bound
equals the k-th score are still scored, as ties go to the smaller id.

The queries are a stated set; groups of queries meet groups of blocks in a grid, each
cell of which is one bounded piece of work, and the cells' best are ranked once more.
The centroids come from a bounded sample and only decide the layout, never the result.

Components x become floor(256 x); vectors that are null or hold null, NaN or infinite
components take no part, as queries or candidates.  Vectors of different length are not
compared.  A query's own id is never its candidate, repeated rows with that id included;
other repeated rows are candidates one by one, and repeated query rows are queries one by
one, each with its own ranks.  Sums that could leave the exact range of doubles are taken in
whole numbers of any size; components and scores beyond 64 bits count as the nearest number
of 64 bits.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evergreen.llm.common import map_rows, read
from evergreen.session import materialize

K = 5
EVERY = 50
BLOCK_ROWS = 512
GROUP_ROWS = 8192
QUERY_ROWS = 512
EXACT = float(1 << 53)


def whole_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): the components as whole numbers, unusable vectors left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v")
    )


def fit_centroids(vectors: DataFrame, bound: int = 4096, centroids: int = 64) -> dict[int, np.ndarray]:
    """Centroids by vector length, by a few rounds of k-means on about ``bound`` vectors."""
    n = vectors.count()
    share = 1 << 30 if n <= bound else int((1 << 30) * bound / n)
    sample = vectors.filter(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 30)) < share)
    by: dict[int, list] = {}
    for r in sample.collect():
        by.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for size, rows in by.items():
        x = np.unique(np.array(rows, dtype="f8").reshape(len(rows), size), axis=0)
        c = x[np.linspace(0, len(x) - 1, min(centroids, len(x))).astype(int)]
        for _ in range(5):
            near = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
            c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        out[size] = c
    return out


def lay_out(vectors: DataFrame, centroids: dict[int, np.ndarray], rows: int) -> DataFrame:
    """(part, size, ids, data, high, low): blocks of at most ``BLOCK_ROWS`` rows of one length."""
    import pyarrow as pa

    def place():
        def work(ids, vs):
            cells = []
            for v in vs:
                c = centroids.get(len(v))
                cells.append(-1 if c is None else int(((c**2).sum(1) - 2 * c @ np.array(v, dtype="f8")).argmin()))
            return [ids, vs, [len(v) for v in vs], cells]

        return work

    placed = map_rows(vectors, place, [("vec_id", "long"), ("v", "array<long>"), ("size", "int"), ("cell", "int")])
    parts = max(1, -(-rows // GROUP_ROWS))
    dealt = placed.repartitionByRange(parts, "size", "cell", "vec_id").sortWithinPartitions("size", "cell", "vec_id")

    schema = pa.schema(
        [("size", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("high", pa.binary()), ("low", pa.binary())]
    )

    def pack(batches):
        held: list[tuple[int, list[int]]] = []

        def block():
            ids = np.array([i for i, _ in held], dtype="i8")
            data = np.array([v for _, v in held], dtype="i8").reshape(len(held), len(held[0][1]))
            high, low = (data.max(0), data.min(0)) if data.shape[1] else (data[0], data[0])
            row = [data.shape[1], ids.tobytes(), data.tobytes(), high.tobytes(), low.tobytes()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (len(held) == BLOCK_ROWS or len(held[0][1]) != len(v)):
                    yield block()
                held.append((i, v))
        if held:
            yield block()

    packed = dealt.select("vec_id", "v").mapInArrow(pack, "size int, ids binary, data binary, high binary, low binary")
    return packed.withColumn("part", F.spark_partition_id())


def within_64_bits(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.maximum(x, -(1 << 63)), (1 << 63) - 1) if x.dtype == object else x


def best_of(query: tuple[int, np.ndarray], order, bounds, blocks, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows, best first; stops where bounds fall below the k-th score."""
    own, q = query
    top: list[tuple[int, int]] = []
    for b in order:
        if len(top) == k and bounds[b] < top[-1][0]:
            break
        ids, data = blocks[b]
        scores = within_64_bits(data @ q)
        wanted = ids != own
        if len(top) == k:
            wanted &= scores >= top[-1][0]
        at = np.flatnonzero(wanted)
        if len(at) > k:  # rows that can be among the k best of this block, all ties with the last included
            at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
        top = sorted([*top, *((int(scores[i]), int(ids[i])) for i in at)], key=lambda x: (-x[0], x[1]))[:k]
    return top


def search(table: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query."""
    vectors = materialize(whole_vectors(table), "topk-vectors")
    n = vectors.count()
    index = materialize(lay_out(vectors, fit_centroids(vectors), n), "topk-blocks")
    queries = materialize(vectors.filter(is_query).withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    parts = max(1, -(-n // GROUP_ROWS))
    asked = queries.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    offered = index.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def cell(left, right):
        import pandas as pd

        found = {"query_id": [], "q": [], "vec_id": [], "score": []}
        for size in set(right["size"]) & set(left["v"].map(len)):
            some = right[right["size"] == size]
            blocks = [
                (np.frombuffer(i, dtype="i8"), np.frombuffer(d, dtype="i8").reshape(len(i) // 8, size))
                for i, d in zip(some["ids"], some["data"])
            ]
            high, low = (np.array([np.frombuffer(x, dtype="i8") for x in some[c]]) for c in ("high", "low"))
            own = left[left["v"].map(len) == size]
            ids, numbers = own["vec_id"].tolist(), own["q"].tolist()
            q = np.array(own["v"].tolist(), dtype="i8").reshape(len(own), size)
            largest = lambda x: float(np.abs(x.astype("f8")).max()) if x.size else 0.0
            exact = largest(q) * max(largest(high), largest(low)) * size < EXACT
            kind = "f8" if exact else object
            q, high, low = q.astype(kind), high.astype(kind), low.astype(kind)
            blocks = [(i, d.astype(kind)) for i, d in blocks]
            zero = np.zeros_like(q)
            bounds = within_64_bits(np.maximum(q, zero) @ high.T + np.minimum(q, zero) @ low.T)
            for j, query_id in enumerate(ids):
                order = np.argsort(-bounds[j], kind="stable")
                for score, vec_id in best_of((query_id, q[j]), order, bounds[j], blocks, k):
                    found["query_id"].append(query_id)
                    found["q"].append(numbers[j])
                    found["vec_id"].append(vec_id)
                    found["score"].append(score)
        return pd.DataFrame(found).astype("int64")

    best = (
        asked.groupBy("g", "part")
        .cogroup(offered.groupBy("g", "part"))
        .applyInPandas(cell, "query_id long, q long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
