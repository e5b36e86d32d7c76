"""One song credited to different acts: connected components within a title.

Nodes are (key_title, key_artist); two nodes of a title are linked when their
credits share a name.  Components are found by alternating star contractions
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014), which
needs a logarithmic number of rounds whatever the chain lengths and never
gathers a component in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.functions.text import apply_aliases, artist_key, collaborators, is_single_name
from evergreen.operators.skew import HOT_ROWS, skew_join
from evergreen.session import materialize, remove, write_aside


def artist_tokens(
    df: DataFrame, aliases: dict[str, str], keep: list[str], artist: str = "artist", own_key: str | None = None
) -> DataFrame:
    """One (keep, token) row per distinct, normalised name in the credit.

    ``own_key`` names the column with the credit's key, if known: a credit that
    is a single name has that key as its only token, which saves deriving it again.
    """
    names = collaborators(F.col(artist))
    own = F.lit(None).cast("string")
    if own_key:
        own = F.col(own_key)
        names = F.when(is_single_name(F.col(artist)), F.array(F.lit(None).cast("string"))).otherwise(names)
    split = df.select(*keep, own.alias("_own"), F.explode(names).alias("_name"))
    tokens = apply_aliases(split.withColumn("token", artist_key(F.col("_name"))), "token", aliases)
    return (
        tokens.select(*keep, F.when(F.col("_name").isNull(), F.col("_own")).otherwise(F.col("token")).alias("token"))
        .filter(F.col("token") != "")
        .distinct()
    )


def _nodes(rows: DataFrame) -> DataFrame:
    """Per key: its place in source order (``node``) and its distinct credits.

    A node compares by source, then size, then name, so the least node of a
    component is the first one in source order.  A key has one row per source,
    which bounds the credit set.
    """
    place = F.struct(F.col("source_ord"), F.coalesce(-F.col("value"), F.lit((1 << 63) - 1)).alias("negated"))
    return (
        rows.groupBy("key_title", "key_artist")
        .agg(F.min(place).alias("_place"), F.collect_set("artist").alias("_credits"))
        .select(
            "key_title",
            F.struct("_place.source_ord", "_place.negated", "key_artist").alias("node"),
            F.explode("_credits").alias("artist"),
        )
    )


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: one parent per child, no parent a child."""
    ends = F.explode(
        F.array(
            F.struct(F.col("child").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")),
            F.struct(F.col("parent").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")),
        )
    )
    broken = (F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))
    ends_of = (
        links.select("key_title", ends.alias("e"))
        .groupBy("key_title", "e.x")
        .agg(F.sum("e.down").alias("down"), F.max("e.up").alias("up"))
    )
    return ends_of.filter(broken).isEmpty()


def _contract(links: DataFrame, hot_rows: int) -> DataFrame:
    """One large-star and one small-star step on (child, parent) links with parent < child."""
    least = links.groupBy("key_title", "child").agg(F.min("parent").alias("least"), F.count(F.lit(1)).alias("n"))
    fan_in = links.groupBy("key_title", "parent").agg(F.count(F.lit(1)).alias("n"))
    grand = least.select("key_title", F.col("child").alias("parent"), "least")
    lifted = skew_join(links, grand, ["key_title", "parent"], fan_in, ["child"], "left", hot_rows).select(
        "key_title", "child", F.coalesce("least", "parent").alias("parent")
    )
    lowest = lifted.groupBy("key_title", "child").agg(F.min("parent").alias("least"))
    met = skew_join(
        lifted,
        lowest,
        ["key_title", "child"],
        least.select("key_title", "child", "n"),
        ["parent"],
        "inner",
        hot_rows,
    )
    pairs = F.explode(
        F.array(
            F.struct(F.col("child"), F.col("least").alias("parent")),
            F.struct(F.col("parent").alias("child"), F.col("least").alias("parent")),
        )
    )
    return (
        met.select("key_title", pairs.alias("p"))
        .select("key_title", "p.child", "p.parent")
        .filter(F.col("child") != F.col("parent"))
        .distinct()
    )


def cluster_changes(rows: DataFrame, aliases: dict[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key_title, key_artist, canonical) for every node that is not its own representative.

    ``rows``: key_title, key_artist, artist, source_ord, value, at most one row
    per key and source.
    """
    spark = rows.sparkSession
    tokens = artist_tokens(_nodes(rows), aliases, ["key_title", "node"], own_key="node.key_artist")
    edges, credits = write_aside(tokens, "credits")
    owners = (
        edges.groupBy("key_title", "token")
        .agg(F.min("node").alias("parent"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    links = (
        skew_join(
            edges,
            owners.drop("n"),
            ["key_title", "token"],
            owners.select("key_title", "token", "n"),
            ["node"],
            "inner",
            hot_rows,
        )
        .select("key_title", F.col("node").alias("child"), "parent")
        .filter(F.col("child") != F.col("parent"))
        .distinct()
    )
    links, path = write_aside(links, "links")
    remove(spark, credits)
    # Each round moves links to lesser parents, so rounds end by themselves.
    while not _settled(links):
        before = path
        links, path = write_aside(_contract(links, hot_rows), "links")
        remove(spark, before)
    return links.select(
        "key_title", F.col("child.key_artist").alias("key_artist"), F.col("parent.key_artist").alias("canonical")
    )


def update_changes(
    stored_rows: DataFrame,
    stored_changes: DataFrame,
    new_rows: DataFrame,
    aliases: dict[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``cluster_changes`` of the stored and the new rows together, from the stored rows' changes.

    Links never leave a title, so only the titles of new rows are clustered again: their
    stored rows are picked by a semi-join before any credit is split, and all other
    changes are kept as they are.
    """
    touched = materialize(new_rows.filter(F.col("key_title").isNotNull()).select("key_title").distinct(), "touched")
    columns = ["key_title", "key_artist", "artist", "source_ord", "value"]
    again = stored_rows.join(touched, "key_title", "left_semi").select(columns).unionByName(new_rows.select(columns))
    kept = stored_changes.join(touched, "key_title", "left_anti")
    return kept.unionByName(cluster_changes(again, aliases, hot_rows))


def cluster_map(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Every node with its representative (itself, unless it changed)."""
    nodes = rows.select("key_title", "key_artist").distinct()
    return nodes.join(changes, ["key_title", "key_artist"], "left").withColumn(
        "canonical", F.coalesce("canonical", "key_artist")
    )


def to_canonical(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rewrite ``key_artist`` to the representative, keeping the old one as ``own_artist``."""
    return (
        rows.join(changes, ["key_title", "key_artist"], "left")
        .withColumnRenamed("key_artist", "own_artist")
        .withColumn("key_artist", F.coalesce("canonical", "own_artist"))
        .drop("canonical")
    )
