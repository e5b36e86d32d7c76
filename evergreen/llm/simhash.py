"""SimHash near duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits, one per bit of the hashes of the text's word shingles, set
where more than half of the hashes have it set.  Fingerprints link at four or fewer
differing bits, and linked documents share a component.

Each bit gets a vector of five binary coordinates; a table for each of the 31 non-zero
vectors v keeps the bits whose vector has an odd product with v.  Any four differing
bits leave some v with even products for all of them, so every pair within the radius
agrees on all bits that some table keeps: it collides there for certain.

Only distinct fingerprints are dealt to the tables.  A bucket of at most ``SMALL``
fingerprints is compared in one task, which returns a spanning tree of its links.  A
larger bucket whose members are linked already needs no comparison; any other is dealt
again by a second set of masks over all bits, with the same guarantee, until its parts
are small (a part keeps more bits every time, and few free bits leave few fingerprints).

Null, empty and blank texts have fingerprint zero and are linked like any other.
Repeated rows share a component.  Rows with one doc_id and different texts are linked each
by its own text; ``keep_one`` keeps or drops them one by one.  Only the named columns are read.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import map_rows, read
from evergreen.llm.graph import components
from evergreen.operators.skew import sketch_join
from evergreen.session import materialize

BITS, RADIUS = 64, 4
SHINGLE = 4
SMALL = 512
BLOCK = 1 << 16
HOT = 1 << 12


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def covering_masks(level: int) -> list[int]:
    """One mask of 32 bits per non-zero vector, as signed numbers; other levels deal the vectors otherwise."""
    vectors = [i % (1 << (RADIUS + 1)) for i in range(BITS)]
    random.Random(level).shuffle(vectors)
    masks = []
    for v in range(1, 1 << (RADIUS + 1)):
        masks.append(_signed(sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)))
    return masks


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - SHINGLE + 1)
    first, last = starts[:n].tolist(), (ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, fp): the text's hash, and the fingerprint as a signed number."""

    def make():
        def work(ids, digests, texts):
            return [ids, digests, np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)]

        return work

    rows = docs.select(F.col("doc_id").cast("long"), text_digest().alias("digest"), "text")
    return map_rows(rows, make, [("doc_id", "long"), ("digest", "long"), ("fp", "long")])


def text_digest() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.col("text"), F.col("text").isNull())


def _dealt(members: DataFrame, level: int) -> DataFrame:
    """Members (mask, fp) under every mask of the level joined to the bits they agree on already."""
    masks = F.explode(F.array(*(F.lit(m).cast("long") for m in covering_masks(level))))
    wider = members.withColumn("more", masks).select(F.col("mask").bitwiseOR(F.col("more")).alias("mask"), "fp")
    return wider.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _compared(buckets: DataFrame) -> DataFrame:
    """Links (a, b) that span what is linked inside each bucket of (fps)."""

    def make():
        def work(lists):
            a, b = [], []
            for fps in lists:
                x = np.unique(np.array(fps, dtype=np.int64))
                near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= RADIUS
                seen = np.zeros(len(x), dtype=bool)
                for i in range(len(x)):
                    if seen[i]:
                        continue
                    seen[i] = True
                    reached = front = near[i] & ~seen
                    while front.any():
                        seen |= front
                        front = near[front].any(0) & ~seen
                        reached = reached | front
                    b += x[reached].tolist()
                    a += [int(x[i])] * int(reached.sum())
            return [a, b]

        return work

    return map_rows(buckets.select("fps"), make, [("a", "long"), ("b", "long")])


def _links(members: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Links inside the small buckets of a level, and the members of the large ones that are not linked yet."""
    dealt = _dealt(members, level)
    sizes = dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialize(sizes, "simhash-buckets")
    small = (
        dealt.join(sizes.filter(F.col("n") <= SMALL).select("mask", "key"), ["mask", "key"])
        .groupBy("mask", "key")
        .agg(F.collect_list("fp").alias("fps"))
    )
    links = materialize(_compared(small), "simhash-links")
    large = dealt.join(sizes.filter(F.col("n") > SMALL).select("mask", "key"), ["mask", "key"])
    return links, materialize(large, "simhash-large")


def _close_links(fps: DataFrame) -> DataFrame:
    """Links between fingerprints that differ in one block of four bits only: at most 16 share the rest."""
    rest = [_signed((1 << BITS) - 1 ^ 0xF << (4 * i)) for i in range(BITS // 4)]
    placed = fps.select("fp", F.posexplode(F.array(*(F.lit(m).cast("long") for m in rest))).alias("block", "m"))
    least = placed.withColumn("key", F.col("fp").bitwiseAND(F.col("m"))).groupBy("block", "key")
    together = least.agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return together.select("a", F.explode("fps").alias("b")).filter("a <> b").distinct()


def link_components(fps: DataFrame) -> DataFrame:
    """(node, root) of all linked fingerprints, from distinct (fp)."""
    links, large = _links(fps.select(F.lit(0).cast("long").alias("mask"), "fp"), 0)
    root = components(links)
    level = 1
    if not large.isEmpty():
        links = links.unionByName(_close_links(large.select("fp").distinct()))
        root = materialize(components(links), "simhash-components")
    while not large.isEmpty():
        # A bucket whose members share a component has nothing more to tell.
        placed = large.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        open_ = placed.groupBy("mask", "key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        members = materialize(large.join(open_.select("mask", "key"), ["mask", "key"]).select("mask", "fp"), "simhash-open")
        if members.isEmpty():
            break
        more, large = _links(members, level)
        links = links.unionByName(more)
        root = materialize(components(links), "simhash-components")
        level += 1
    return root


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, fp, component_id): the least doc_id that the document's links reach, for every row."""
    rows = materialize(fingerprints(docs), "simhash-fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    root = link_components(fps.select("fp"))
    linked = fps.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    linked = materialize(linked, "simhash-linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = sketch_join(linked.select("fp", "root"), least, ["root"], ["fp"], "inner", HOT).select("fp", "component_id")
    return sketch_join(rows, named, ["fp"], ["doc_id", "digest"], "inner", HOT)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of the least document of every component, with all their columns; rows without an id stay."""
    others = near_duplicates(docs).filter("doc_id <> component_id").select("doc_id", "digest").distinct()
    marked = docs.withColumns({"_doc": F.col("doc_id").cast("long"), "_text": text_digest()})
    others = materialize(others.toDF("_doc", "_text"), "simhash-others")
    return marked.join(others, ["_doc", "_text"], "left_anti").select(*docs.columns)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
