"""Benchmark decontamination by size-partitioned MinHash containment search.

An item counts as found in a document when the document holds at least four fifths of
the item's distinct shingles of five words.  A document is far longer than an item, so a
sketch of the document says little about one item; the item's own minima are looked up
in the document instead.  Items are partitioned by size (powers of two of their number of
shingles), and each partition has its own sketch length: the k least hashes of an item, k one more
than the number of shingles that an item of the partition may lack.  A document that
contains the item thus always holds at least one of them, and no pair is missed.  Pairs
found this way are verified by counting the shared shingles themselves.

Everything is DataFrame functions; whether the sketches are broadcast is left to the
planner, which sees the size of the written table.  Words are runs of letters and digits in lower case.
An item of fewer than five words is one shingle of all its words; items and documents
without words, or null, match nothing.  Rows with the same id are one document or item, null among the
item ids too; a document must hold one of an item's texts in one of its rows, and the figures are
those of the text that it holds most of.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import read
from evergreen.session import materialize

SHINGLE = 5
NEEDED, OUT_OF = 4, 5  # the share of an item's shingles that must be found, as a fraction


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(of: str, length: str) -> Column:
    """Distinct runs of ``length`` words, joined by blanks."""
    starts = F.sequence(F.lit(1), F.size(of) - F.col(length) + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(of, i, F.col(length)), " ")))


def item_shingles(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, version, length, wanted, shingle): one row per distinct shingle of an item's text."""
    split = benchmark.select("item_id", F.xxhash64("text").alias("version"), words("text").alias("w")).filter(F.size("w") > 0)
    sized = split.withColumn("length", F.least(F.lit(shingle), F.size("w")))
    return (
        sized.withColumn("s", _shingles("w", "length"))
        .select("item_id", "version", "length", F.size("s").alias("wanted"), F.explode("s").alias("shingle"))
        .distinct()
    )


def sketches(items: DataFrame) -> DataFrame:
    """(item_id, version, length, partition, wanted, hash): the least hashes of every text, as many as its partition asks for."""
    partition = F.ceil(F.log2(F.col("wanted"))).cast("int")
    lacking = F.floor(F.pow(F.lit(2.0), F.col("partition")) * (OUT_OF - NEEDED) / OUT_OF).cast("int")
    return (
        items.groupBy("item_id", "version", "length", "wanted")
        .agg(F.array_sort(F.collect_list(F.xxhash64(F.lit("item"), "shingle"))).alias("hashes"))
        .withColumn("partition", partition)
        .withColumn("hash", F.explode(F.slice("hashes", F.lit(1), lacking + 1)))
        .select("item_id", "version", "length", "partition", "wanted", "hash")
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, item_id, shared, wanted, containment) for every contained item."""
    items = materialize(item_shingles(benchmark, shingle), "decontaminate-items")
    sketch = materialize(sketches(items), "decontaminate-sketches")
    lengths = sorted(r["length"] for r in sketch.select("length").distinct().collect())  # at most ``shingle`` values
    split = docs.select("doc_id", F.xxhash64("text").alias("copy"), words("text").alias("w"))
    found = None
    for n in lengths:
        run = F.array_join(F.slice("w", F.col("i"), F.lit(n)), " ")
        placed = (
            split.filter(F.size("w") >= n)
            .select("doc_id", "copy", "w", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
            .select("doc_id", "copy", (F.size("w") - n + 1).alias("places"), F.xxhash64(F.lit("item"), run).alias("hash"))
        )
        # A document with too few places for the item's partition cannot contain it.
        hit = placed.join(sketch.filter(F.col("length") == n), "hash").filter(
            F.col("places") * OUT_OF >= F.col("wanted") * NEEDED
        )
        hit = hit.select("doc_id", "copy", "item_id", "version")
        found = hit if found is None else found.unionByName(hit)
    if found is None:  # no item has a word
        ids = F.struct(docs["doc_id"], F.lit(None).cast(dict(benchmark.dtypes)["item_id"]).alias("item_id"))
        return docs.select(ids.alias("r")).filter("false").selectExpr("r.*", "0L shared", "0 wanted", "0D containment")
    pairs = materialize(found.distinct(), "decontaminate-pairs")
    return _verified(docs, items, pairs, lengths)


def _verified(docs: DataFrame, items: DataFrame, pairs: DataFrame, lengths: list[int]) -> DataFrame:
    """Count the shingles that each candidate pair shares, and keep the pairs that share enough."""
    hits = pairs.select("doc_id", "copy").distinct()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("copy"), "text").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.copy") == F.col("h.copy"))
    texts = keyed.join(hits.alias("h"), same, "left_semi").select("doc_id", "copy", words("text").alias("w"))
    own = (
        texts.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
        .filter(F.size("w") >= F.col("length"))
        .select("doc_id", "copy", "length", F.explode(_shingles("w", "length")).alias("shingle"))
    )
    shared = own.join(items, ["length", "shingle"])
    return (
        shared.alias("s")
        .join(
            pairs.alias("p"),
            F.col("s.doc_id").eqNullSafe(F.col("p.doc_id"))
            & (F.col("s.copy") == F.col("p.copy"))
            & F.col("s.item_id").eqNullSafe(F.col("p.item_id"))
            & (F.col("s.version") == F.col("p.version")),
            "left_semi",
        )
        .groupBy("doc_id", "copy", "item_id", "version", "wanted")
        .agg(F.count_distinct("shingle").alias("shared"))
        .filter(F.col("shared") * OUT_OF >= F.col("wanted") * NEEDED)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("shared") / F.col("wanted")).alias("containment"), "shared", "wanted")).alias("m"))
        .select("doc_id", "item_id", "m.shared", "m.wanted", "m.containment")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns; rows without an id stay."""
    leaky = materialize(find_leaks(docs, benchmark).select("doc_id").distinct(), "decontaminate-leaky")
    return docs.join(leaky, "doc_id", "left_anti").select(*docs.columns)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
