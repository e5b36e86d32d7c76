"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Vectors are scaled to length one and projected on at most 64 principal directions, turned
by a learned rotation (alternating signs and a Procrustes fit) so that the signs of the
coordinates make balanced binary codes.  Codes are cut into chunks, one table each, and
vectors that meet in a table are compared anew by their original components.

How far a table looks around a code follows from the threshold.  Two unit vectors with
cosine c differ by 2 - 2c in squared length, under any projection by no more.  A sign that
differs costs at least (|y| + |y'|)^2 of that, so the smaller of both squares is at most a
quarter of it; and one of m chunks holds at most the m-th part.  So each vector enters a
table under every code that its signs reach by flips whose squares sum to (2 - 2c) / 4m:
each pair above the threshold meets in some table for certain, whatever the rotation.
A vector so flat that a chunk would give it more than ``WIDE`` codes enters no table; it is
compared with every row of its label, in blocks.

Equal vectors of one label are folded first.  A meeting whose short sketches are too far
apart is dropped before original vectors are fetched; buckets are compared in tiles of
bounded size, which return counts and a spanning tree of their links, never pairs.  A pair
is counted in the first bucket that both entered.

Labels that are null, and vectors that are null, zero, or hold null or non-finite
components link with nothing; neither do vectors of different length.  Repeated rows, of
one vec_id too, are vectors one by one.  A null vec_id is linked and counted; it names a
component only if the component has no other id.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_batches, read
from evergreen.llm.graph import components
from evergreen.operators.skew import skew_join
from evergreen.session import materialize

BITS = 64
WIDE = 1024
SKETCH = 16
SMALL = 512
BLOCK = 1024
FULLEST = 16
ALL = -1  # the bucket in which wide vectors meet all rows of their label
HOT = 1 << 16
SHIFT = 40  # table number above the bits of the code


def usable(label: Column, vector: Column) -> Column:
    """Whether a row can link at all."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def distinct_vectors(table: DataFrame) -> DataFrame:
    """(node, space, vector, copies, first): equal vectors of a label folded; a space is a label and a length."""
    space = F.concat_ws(":", F.size("vector").cast("string"), F.col("label").cast("string"))
    folded = table.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    numbered = folded.select(F.monotonically_increasing_id().alias("node"), "label", space.alias("space"), "vector", "copies", "first")
    return materialize(numbered, "vectors-distinct")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest entry first, so that no square leaves the range."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def learn_rotation(sample: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthonormal columns whose signs make the codes: principal directions, turned towards their signs."""
    x = unit(sample)
    bits = min(BITS, x.shape[1])
    _, directions = np.linalg.eigh((x - x.mean(0)).T @ (x - x.mean(0)))
    w = directions[:, ::-1][:, :bits]
    p = x @ w
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(p @ turn >= 0, 1.0, -1.0).T @ p)
        turn = vt.T @ u.T
    return w @ turn


def fit(nodes: DataFrame, bound: int = 4096) -> dict[int, np.ndarray]:
    """A rotation per vector length, learned from about ``bound`` vectors; it affects the work, never the result."""
    n = nodes.count()
    share = 1 << 30 if n <= bound else int((1 << 30) * bound / n)
    by: dict[int, list] = {}
    for r in nodes.filter(F.pmod(F.xxhash64(F.lit("sample"), "node"), F.lit(1 << 30)) < share).select("vector").collect():
        by.setdefault(len(r["vector"]), []).append(r["vector"])
    return {size: learn_rotation(np.array(rows, dtype="f8")) for size, rows in by.items()}


def chunks(bits: int, rows: int) -> list[np.ndarray]:
    """The bits of each table: as many bits as the row count has, or a little more, as in multi-index hashing."""
    width = min(32, max(8, math.ceil(math.log2(max(2, rows)))))
    return np.array_split(np.arange(bits), max(1, bits // width))


def reached(y: np.ndarray, budget: float) -> list[int] | None:
    """Codes that the signs of ``y`` reach by flips whose squares sum to ``budget``; None if over ``WIDE``."""
    code = sum(1 << i for i, v in enumerate(y.tolist()) if v >= 0)
    cost = y * y
    near = [(float(cost[i]), 1 << int(i)) for i in np.argsort(cost, kind="stable") if cost[i] <= budget]
    found = [code]
    stack = [(0, budget, code)]
    while stack:
        at, left, c = stack.pop()
        for j in range(at, len(near)):
            if near[j][0] > left:
                break
            found.append(c ^ near[j][1])
            if len(found) > WIDE:
                return None
            stack.append((j + 1, left - near[j][0], c ^ near[j][1]))
    return found


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as a matrix) for every length in the column."""
    values, sizes = flat(column)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, values[(ends[at] - size)[:, None] + np.arange(size)].astype("f8")


def enter(nodes: DataFrame, rotations: dict[int, np.ndarray], rows: int, cosine: float) -> DataFrame:
    """(node, space, codes, sketches): the buckets that each vector enters; only ``ALL`` for a wide one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes: list[list[int]] = [[] for _ in range(batch.num_rows)]
            sketches: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for at, vectors in by_length(batch.column("vector")):
                w = rotations.get(vectors.shape[1])
                y = unit(vectors) @ (np.eye(vectors.shape[1])[:, :BITS] if w is None else w)
                cut = chunks(y.shape[1], rows)
                budget = (2 - 2 * cosine) / (4 * len(cut)) + 1e-9
                short = np.clip(np.rint(y * 128), -127, 127).astype("i1")
                for row, values, coarse in zip(at.tolist(), y, short):
                    own, sketch = [], []
                    for c, part in enumerate(cut):
                        more = reached(values[part], budget)
                        if more is None:
                            own, sketch = [ALL], [b""]
                            break
                        own += [c << SHIFT | code for code in more]
                        sketch += [coarse[cut[(c + 1) % len(cut)][:SKETCH]].tobytes()] * len(more)
                    codes[row], sketches[row] = own, sketch
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("space"), pa.array(codes, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.binary()))],
                names=["node", "space", "codes", "sketches"],
            )

    entered = bounded_batches(nodes.select("node", "space", "vector")).mapInArrow(
        run, "node long, space string, codes array<long>, sketches array<binary>"
    )
    return materialize(entered, "vectors-codes")


def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    changed = np.zeros(len(keys[0]), dtype=bool)
    changed[:1] = True
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return np.r_[np.flatnonzero(changed), len(changed)]


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches cut so that no run of equal keys is parted; what is held is bounded by a batch and a run."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        last = runs([held.column(k).to_numpy() for k in keys])[-2]
        if last:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None:
        yield held


def near_sketches(buckets: DataFrame, cosine: float) -> DataFrame:
    """The rows (space, bucket, node) of small buckets with another row whose sketch is near enough for the threshold."""
    # A coordinate is off by at most half a step of 1/128 on either side.
    radius = 128 * math.sqrt(2 - 2 * cosine) + math.sqrt(SKETCH) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["space", "bucket"]):
            bounds = runs([table.column("space").to_numpy(), table.column("bucket").to_numpy()])
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            texts = table.column("sketch").to_pylist()
            s = np.zeros((len(texts), SKETCH), dtype="i4")
            for size in {len(t) for t in texts}:
                at = [i for i, t in enumerate(texts) if len(t) == size]
                s[at, :size] = np.frombuffer(b"".join(texts[i] for i in at), dtype="i1").reshape(len(at), size)
            keep = np.zeros(len(group), dtype=bool)
            left, step = np.arange(len(group)), 1
            while len(left := left[left + step < len(group)]) and len(left := left[group[left] == group[left + step]]):
                gap = s[left] - s[left + step]
                met = left[(gap * gap).sum(1) <= radius * radius]
                keep[met] = keep[met + step] = True
                step += 1
            yield from table.select(["space", "bucket", "node"]).filter(pa.array(keep)).to_batches()

    sorted_rows = buckets.repartition("space", "bucket").sortWithinPartitions("space", "bucket")
    return bounded_batches(sorted_rows.select("space", "bucket", "node", "sketch")).mapInArrow(run, "space string, bucket long, node long")


def tiles(met: DataFrame, nodes: DataFrame, entered: DataFrame) -> DataFrame:
    """Members of every bucket dealt to tiles (i, j) of two blocks, with their vectors; i holds wide rows in ``ALL``."""
    wide = F.array_contains("codes", F.lit(ALL))
    members = met.join(entered.select("node", "codes"), "node").withColumn("asks", wide | (F.col("bucket") != ALL))
    members = materialize(members.join(nodes.select("node", "vector", "copies"), "node"), "vectors-members")
    sizes = members.groupBy("space", "bucket").agg(F.count_if("asks").alias("asking"), F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.filter("asking > 0 and n > 1"), "vectors-sizes")
    blocks = F.ceil(F.col("asking") / BLOCK).cast("int")
    others = F.ceil((F.col("n") - F.col("asking")) / BLOCK).cast("int")
    dealt = skew_join(members, sizes, ["space", "bucket"], sizes.select("space", "bucket", "n"), ["node"], "inner", HOT)
    dealt = dealt.withColumns({"blocks": blocks, "others": others})
    place = F.when(F.col("asks"), F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(
        F.col("blocks") + F.pmod(F.xxhash64("node"), F.greatest("others", F.lit(1)))
    )
    last = F.when(F.col("asks"), F.col("blocks") + F.col("others")).otherwise(F.col("blocks")) - 1
    dealt = dealt.withColumn("block", place.cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    i, j = F.least("block", "with"), F.greatest("block", "with")
    return dealt.select("space", "bucket", i.alias("i"), j.alias("j"), "block", "node", "vector", "copies", "codes")


def links_of(dealt: DataFrame, cosine: float) -> DataFrame:
    """(node, other, links): for each tile the links counted by node (other null), and a spanning tree (links 0)."""
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
    keys = ["space", "bucket", "i", "j"]

    def unseen(linked: np.ndarray, a: np.ndarray, b: np.ndarray, values: np.ndarray, sizes: np.ndarray, bucket: int) -> None:
        """Unlink the pairs that share a bucket before this one: first by the fullest buckets, then pair by pair."""
        some = np.zeros(len(sizes), dtype=bool)
        some[a[linked.any(1)]] = some[b[linked.any(0)]] = True
        row = np.repeat(np.arange(len(sizes)), sizes)
        before = some[row] & (values < bucket)
        _, code, count = np.unique(values[before], return_inverse=True, return_counts=True)
        has = np.zeros((len(sizes), int((count > 1).sum())), dtype=bool)
        number = np.cumsum(count > 1) - 1
        shared = count[code] > 1
        has[row[before][shared], number[code[shared]]] = True
        for k in np.argsort(-has.sum(0), kind="stable")[:FULLEST]:
            linked[np.ix_(has[a, k], has[b, k])] = False
        bits = np.packbits(has, axis=1)
        i, j = np.nonzero(linked)
        for at in range(0, len(i), BLOCK):
            x, y = i[at : at + BLOCK], j[at : at + BLOCK]
            linked[x, y] = ~(bits[a[x]] & bits[b[y]]).any(1)

    def compare(table: pa.Table):
        """Tile by tile; columns are taken apart once for all tiles of the table."""
        column = {c: table.column(c).to_numpy() for c in [*keys, "node", "block", "copies"]}
        values, sizes = flat(table.column("vector").combine_chunks())
        codes, counts = flat(table.column("codes").combine_chunks())
        value_at, code_at = np.r_[0, np.cumsum(sizes)], np.r_[0, np.cumsum(counts)]
        bounds = runs([column[k] for k in keys]).tolist()
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            nodes, block, copies = (column[c][lo:hi] for c in ("node", "block", "copies"))
            i, j, bucket = (column[c][lo] for c in ("i", "j", "bucket"))
            x = unit(values[value_at[lo] : value_at[hi]].astype("f8").reshape(hi - lo, -1))
            a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            linked = x[a] @ x[b].T >= cosine
            if i == j:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            tree = spanning(linked, a, b)
            if bucket != ALL:
                unseen(linked, a, b, codes[code_at[lo] : code_at[hi]], counts[lo:hi], bucket)
            count = np.zeros(hi - lo, dtype="i8")
            count[a] += linked @ copies[b]
            if i != j:
                count[b] += linked.T @ copies[a]
            some = np.flatnonzero(count)
            yield nodes[some], np.full(len(some), -1), count[some]
            yield nodes[tree[:, 0]], nodes[tree[:, 1]], np.zeros(len(tree), dtype="i8")

    def spanning(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = int(max(a.max(), b.max())) + 1
        near = np.zeros((size, size), dtype=bool)
        near[np.ix_(a, b)] = linked
        near |= near.T
        left, edges = near.any(1), []
        while left.any():
            root = int(np.argmax(left))
            left[root] = False
            front = near[root] & left
            while front.any():
                left &= ~front
                edges += [(root, int(k)) for k in np.flatnonzero(front)]
                front = near[front].any(0) & left
        return np.array(edges, dtype="i8").reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, keys):
            found = list(compare(table))
            if found:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys)
    found = bounded_batches(sorted_rows).mapInArrow(run, "node long, other long, links long")
    return materialize(found, "vectors-links")


def linked_nodes(nodes: DataFrame, cosine: float) -> DataFrame:
    """Links and spanning trees of all distinct vectors, see ``links_of``."""
    n = nodes.count()
    entered = enter(nodes, fit(nodes), n, cosine)
    place = F.explode(F.arrays_zip("codes", "sketches")).alias("p")
    rows = entered.select("space", "node", place).select("space", "node", F.col("p.codes").alias("bucket"), F.col("p.sketches").alias("sketch"))
    wide = materialize(entered.filter(F.array_contains("codes", F.lit(ALL))).select("space").distinct(), "vectors-wide")
    counts = materialize(rows.groupBy("space", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "vectors-buckets")
    ordinary = counts.filter(F.col("bucket") != ALL)
    live = skew_join(rows, ordinary, ["space", "bucket"], ordinary, ["node"], "inner", HOT)
    live = materialize(live, "vectors-live")
    large = live.filter(F.col("n") > SMALL).select("space", "bucket", "node")
    small = live.filter(F.col("n") <= SMALL)
    met = near_sketches(small, cosine).unionByName(large)
    if not wide.isEmpty():
        per_space = entered.groupBy("space").agg(F.count(F.lit(1)).alias("n"))
        everyone = skew_join(entered.select("space", "node"), wide, ["space"], per_space, ["node"], "inner", HOT)
        met = met.unionByName(everyone.select("space", F.lit(ALL).cast("long").alias("bucket"), "node"))
    return links_of(tiles(materialize(met, "vectors-met"), nodes, entered), cosine)


def near_duplicates(table: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    rows = table.select(F.col("vec_id").cast("long"), "label", v.alias("vector"))
    usable_row = usable(F.col("label"), F.col("vector"))
    some = rows.filter(usable_row)
    nodes = distinct_vectors(some)
    found = linked_nodes(nodes, cosine)
    links = found.filter("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    tree = found.filter("links = 0").select(F.col("node").alias("a"), F.col("other").alias("b"))
    root = components(tree)
    placed = (
        nodes.select("node", "label", "vector", "copies", "first")
        .join(links, "node", "left")
        .join(root, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    placed = materialize(placed, "vectors-placed")
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = skew_join(placed, least.drop("n"), ["root"], least.select("root", "n"), ["node"], "inner", HOT).select(
        "label", "vector", "component_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    counts = named.select("label", "vector", F.col("copies").alias("n"))
    joined = skew_join(some, named.drop("copies"), ["label", "vector"], counts, ["vec_id"], "inner", HOT)
    alone = rows.filter(~usable_row).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = joined.select("vec_id", F.col("n_links").cast("long"), "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
