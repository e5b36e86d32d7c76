"""Connected components of a link table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.operators.skew import sketch_join
from evergreen.session import materialize

HOT = 1 << 16


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the component's least node.

    Each round hooks every node to its least neighbour if that is less, follows the
    hooks to their ends by doubling, and goes on with the links between the ends.
    Contracted nodes never come back, so rounds end; nothing is gathered in one task, and the
    rows of a node that very many others hook to are split.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edge = materialize(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    maps: list[DataFrame] = []
    while not edge.isEmpty():
        both = edge.select(F.explode(ends).alias("e")).select("e.a", "e.b")
        up = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        up = materialize(up, "hooks")
        while True:
            step = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
            nxt = materialize(sketch_join(up, step, ["up"], ["node"], "inner", HOT).select("node", "up", "further"), "hooks")
            moved = not nxt.filter("further <> up").isEmpty()
            up = nxt.select("node", F.col("further").alias("up"))
            if not moved:
                break
        maps.append(up)
        left = up.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = up.select(F.col("node").alias("b"), F.col("up").alias("y"))
        met = sketch_join(edge, left, ["a"], ["b"], "inner", HOT)
        met = sketch_join(met, right, ["b"], ["a"], "inner", HOT).filter("x <> y")
        edge = materialize(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not maps:
        return edge.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = maps[-1].select("node", F.col("up").alias("root"))
    for earlier in reversed(maps[:-1]):
        later = root.select(F.col("node").alias("up"), "root")
        root = sketch_join(earlier, later, ["up"], ["node"], "left", HOT).select("node", F.coalesce("root", "up").alias("root"))
    return root
