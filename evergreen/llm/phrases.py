"""Collocated phrases by SON partitioning.

Documents are dealt to a fixed number of shards.  A phrase that the corpus holds at least
``support`` times is held by some shard at least in proportion to that shard's words.  So
every shard is mined completely at that lowered support: words first, then pairs of words,
then longer phrases, each counted only where its parts of the step before are frequent in some
shard, and all shards together hold them often enough.  The locally frequent phrases are
united and counted again over all documents, which gives their exact counts.
Words count like phrases, as they are parts of cuts.

Shards are no tasks: a shard's counts are added up by the shuffle, so that their number,
and with it the local support, does not fall with the size of the corpus.  Tasks learn
what is frequent from a bitmap of phrase hashes, whose size is bounded by ``MOST_BITS``;
if hashes meet there, more is counted and nothing lost.  The last count goes by the words
themselves.

Null and empty texts hold no words, a null lang counts as ``und``.  Repeated rows count
each time.  Without documents, or without a phrase that is frequent, the result is empty.
Long texts are worked through in stretches.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evergreen.llm.common import bounded_batches, read
from evergreen.operators.skew import skew_join
from evergreen.session import materialize

SHARDS = 8
LONGEST = 5
STRETCH = 1 << 20  # words worked on at once
HELD = 1 << 22  # keys held before they are counted
SMALL = 100_000  # shards of langs that go to every task
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
BUCKET = 1 << 15  # bits of a piece of Spark's bitmaps

# Classes of bytes: parts of words, blanks, ends of pieces.
KIND = np.zeros(256, dtype="u1")
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
LOWER = np.arange(256, dtype="u1")
LOWER[65:91] += 32
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype="u8")  # masks of the first n bytes


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a batch of texts: where they are, to which row and piece they belong, their hashes."""

    LONG = 64  # bytes; what a longer word has beyond them is hashed on its own

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype="i8")[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype="u1")[at[0] : at[-1]] if data else np.zeros(0, dtype="u1")
        at = at - at[0]
        self.bytes = np.zeros(len(raw) + 8, dtype="u1")  # words are read eight bytes at a time
        self.bytes[: len(raw)] = LOWER[raw]
        kind = KIND[raw]
        inside = kind == 0
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[at] = True  # rows stand one behind the other
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(self.start, at)))
        parted = np.searchsorted(self.start, np.flatnonzero((kind == 2) | first[:-1]))
        self.piece = np.bincount(parted, minlength=len(self.start) + 1)[: len(self.start)].cumsum()

    def hashes(self, lo: int, hi: int, seed: int) -> np.ndarray:
        """By eight bytes at a time."""
        start, left = self.start[lo:hi], (self.stop - self.start)[lo:hi]
        eights = np.ndarray((len(self.bytes) - 7,), dtype="<u8", buffer=self.bytes, strides=(1,))
        h = left.astype("u8") + np.uint64(seed << 40)
        at = np.arange(len(start))
        for step in range(0, self.LONG, 8):
            rest = left[at] - step
            if step:
                at = at[rest > 0]
                rest = rest[rest > 0]
            if not len(at):
                break
            part = eights[start[at] + step] & FIRST[np.minimum(rest, 8)]
            h[at] = mix(h[at] * np.uint64(0x9E3779B97F4A7C15) + part)
        for i in np.flatnonzero(left > self.LONG).tolist():
            h[i] ^= np.uint64(xxhash.xxh64_intdigest(self.bytes[start[i] : start[i] + left[i]].tobytes(), seed))
        return h

    def text(self, first: int, count: int) -> str:
        words = (self.bytes[self.start[i] : self.stop[i]].tobytes() for i in range(first, first + count))
        return b" ".join(words).decode("utf-8", "replace")


def stretches(words: Words) -> Iterator[tuple[int, int, int]]:
    """(first, end of the starts, end of the words): stretches whose phrases start in them."""
    n = len(words.start)
    for lo in range(0, n, STRETCH):
        yield lo, min(n, lo + STRETCH), min(n, lo + STRETCH + LONGEST - 1)


def grown(grams: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of phrases of ``length`` words from those one word shorter."""
    n = max(0, len(words) - length + 1)
    return mix(grams[:n] * np.uint64(0x9E3779B97F4A7C15) + words[length - 1 :][:n] + np.uint64(length))


def together(piece: np.ndarray, length: int) -> np.ndarray:
    """Whether a phrase of ``length`` words that starts here stays in its piece."""
    n = max(0, len(piece) - length + 1)
    return piece[:n] == piece[length - 1 :][:n]


class Bitmap:
    """A set of hashes, or more."""

    def __init__(self, bits: int, pieces: list[tuple[int, bytes]]):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, dtype="u1")
        for number, piece in pieces:
            self.data[(number - 1) * BUCKET // 8 : number * BUCKET // 8] = np.frombuffer(piece, dtype="u1")

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.data[(at >> np.uint64(3)).astype("i8")] >> (at & np.uint64(7)).astype("u1")) & 1 == 1


def bitmap_of(hashes: DataFrame) -> Bitmap | None:
    """The bitmap of a column ``g``, built in the cluster; its size follows the rows up to a bound."""
    n = hashes.count()
    if not n:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n - 1).bit_length()))
    at = F.col("g").bitwiseAND(F.lit(bits - 1)) + 1
    pieces = (
        hashes.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("piece"))
    )
    return Bitmap(bits, [(r["number"], bytes(r["piece"])) for r in pieces.collect()])


def lang_or_und() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")


def prepared(docs: DataFrame) -> DataFrame:
    shard = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(SHARDS)).cast("int")
    return docs.select(lang_or_und(), shard.alias("shard"), "text")


def row_hashes(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(langs, number of each row's lang, hash of each row's lang)."""
    coded = batch.column("lang").dictionary_encode()
    langs, codes = coded.dictionary, coded.indices.to_numpy()
    seeds = np.array([xxhash.xxh64_intdigest(s.encode(), 1) for s in langs.to_pylist()], dtype="u8")
    return langs, codes, seeds[codes] if len(codes) else np.zeros(0, dtype="u8")


COUNTED = pa.schema([("cell", pa.int64()), ("g", pa.int64()), ("n", pa.int64())])
TOTAL = 0  # in place of a phrase's hash, for all words


def local_counts(docs: DataFrame, sizes: range, frequent: Bitmap | None) -> DataFrame:
    """(cell, g, n): counts of phrases of those sizes by cell, which is a shard of a lang.

    Words are counted all, and as the total; of longer phrases those whose parts, one
    word shorter than the shortest of ``sizes``, are ``frequent``.  A task adds up what it can
    hold; rows of one phrase come to one place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for cell, keys in held.items():
                g, n = np.unique(np.concatenate(keys), return_counts=True)
                columns = [np.full(len(g), cell, dtype="u8").view("i8"), g.view("i8"), n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTED)], schema=COUNTED)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words(batch.column("text"))
            seeds = row_hashes(batch)[2]
            cells = seeds ^ batch.column("shard").to_numpy().astype("u8")
            for lo, starts, hi in stretches(words):
                rows, piece = words.row[lo:hi], words.piece[lo:hi]
                w = words.hashes(lo, hi, 0)
                g = mix(w ^ seeds[rows])
                known = np.ones(len(g), dtype=bool)
                for k in range(1, sizes.stop):
                    if k > 1:
                        g = grown(g, w, k)
                        known = known[: len(g)] & known[1 : len(g) + 1] if k >= sizes.start else known[: len(g)]
                    if k == sizes.start - 1:
                        known = frequent.holds(g)
                    if k not in sizes:
                        continue
                    at = np.flatnonzero(known[: starts - lo] & together(piece, k)[: starts - lo])
                    cell = cells[rows[at]]
                    order = np.argsort(cell, kind="stable")
                    cell, found = cell[order], g[at][order]
                    edges = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)] if len(cell) else []
                    for a, b in zip(edges[:-1], edges[1:]):
                        held.setdefault(int(cell[a]), []).append(found[a:b])
                    size += len(found)
                if size > HELD:
                    if sizes.start == 1:
                        yield whole(held)
                    yield from counted()
                    size = 0
        if sizes.start == 1:
            yield whole(held)
        yield from counted()

    def whole(held: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        """The total of each cell."""
        cells = np.array(list(held), dtype="u8").view("i8")
        n = [sum(map(len, keys)) for keys in held.values()]
        columns = [cells, np.full(len(n), TOTAL, dtype="i8"), n]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTED)], schema=COUNTED)

    rows = bounded_batches(docs).mapInArrow(run, "cell long, g long, n long").repartition("g")
    return rows.groupBy("g", "cell").agg(F.sum("n").alias("n"))


WRITTEN = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def global_counts(docs: DataFrame, frequent: list[Bitmap]) -> DataFrame:
    """(lang, size, phrase, n): exact counts of every phrase that may be among the locally frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words(batch.column("text"))
            langs, codes, seeds = row_hashes(batch)
            for lo, starts, hi in stretches(words):
                rows = words.row[lo:hi]
                w, other = words.hashes(lo, hi, 0), words.hashes(lo, hi, 1)
                g = mix(w ^ seeds[rows])
                check = mix(other ^ seeds[rows])
                known = np.ones(len(g) + 1, dtype=bool)
                for k, bitmap in enumerate(frequent, 1):
                    if k > 1:
                        g, check = grown(g, w, k), grown(check, other, k)
                    known = known[: len(g)] & known[1:][: len(g)] & bitmap.holds(g) & together(words.piece[lo:hi], k)
                    at = np.flatnonzero(known[: starts - lo])
                    first, n = first_and_count(g[at], check[at])
                    first = at[first]
                    columns = [
                        langs.take(pa.array(codes[rows[first]])),
                        np.full(len(first), k, dtype="i4"),
                        [words.text(lo + i, k) for i in first.tolist()],
                        n,
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WRITTEN)], schema=WRITTEN)

    rows = bounded_batches(docs).mapInArrow(run, "lang string, size int, phrase string, n long")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def first_and_count(g: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of each different pair of hashes: 128 bits tell phrases apart."""
    order = np.lexsort((check, g)) if len(g) else np.zeros(0, dtype="i8")
    a, b = g[order], check[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(g) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    return order[at], np.diff(np.r_[at, len(g)])


def shares(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """(cell, words, total): the words of every cell and of its lang."""
    cells = docs.select("lang", "shard").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = row_hashes(batch)[2]
            cell = (seeds ^ batch.column("shard").to_numpy().astype("u8")).view("i8")
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(cell)], names=["lang", "cell"])

    named = cells.mapInArrow(run, "lang string, cell long")
    words = counts.filter(F.col("g") == TOTAL).select("cell", F.col("n").alias("words")).join(named, "cell")
    return words.join(words.groupBy("lang").agg(F.sum("words").alias("total")), "lang")


def left_over(counts: DataFrame, share: DataFrame, support: int) -> DataFrame:
    """(g, enough): phrases that some shard holds in proportion; whether all shards together hold ``support``."""
    share = share.groupBy("cell").agg(F.max("words").alias("words"), F.min("total").alias("total"))
    if share.count() <= SMALL:
        met = counts.join(F.broadcast(share), "cell")
    else:
        met = skew_join(counts, share, ["cell"], share.select("cell", F.col("words").alias("n")), ["g"], "inner")
    # n / words >= support / total, in whole numbers of any size.
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    local = wide("n") * wide("total") >= wide("words") * F.lit(support).cast("decimal(19,0)")
    summed = met.filter(F.col("g") != TOTAL).groupBy("g").agg(F.sum("n").alias("n"), F.bool_or(local).alias("local"))
    return summed.filter("local").select("g", (F.col("n") >= support).alias("enough"))


def frequent_phrases(docs: DataFrame, support: int, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, n) of all words and phrases with at least ``support`` occurrences, (lang, total))."""
    rows = prepared(docs)
    counts = materialize(local_counts(rows, range(1, 2), None), "phrases-words")
    share = materialize(shares(counts, rows), "phrases-shares")
    candidates: list[Bitmap] = []
    grow: Bitmap | None = None
    for sizes in (range(1, 2), range(2, 3), range(3, longest + 1)):
        if grow is not None:
            counts = local_counts(rows, sizes, grow)
        left = materialize(left_over(counts, share, support), "phrases-local")
        grow = bitmap_of(left.filter("enough").select("g"))
        if grow is None:
            break
        candidates += [bitmap_of(left.select("g"))] * len(sizes)
    exact = global_counts(rows, candidates).filter(F.col("n") >= support)
    totals = share.select("lang", "total").distinct()
    return materialize(exact, "phrases-frequent"), materialize(totals, "phrases-langs")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two words or more, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    several = phrases.filter("size > 1").select("lang", "phrase", F.col("n").alias("a"), words.alias("words"), "size")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cut = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns(
        {
            "first": F.array_join(F.slice("words", F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " "),
        }
    ).select("lang", "phrase", "a", "k", "first", "rest")
    left = part.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    met = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals.withColumnRenamed("total", "n"), "lang")
    top = F.col("a").cast("decimal(15,0)") * F.col("n").cast("decimal(18,0)") * F.lit(1000).cast("decimal(4,0)")
    met = met.withColumns({"top": top, "bottom": F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")})
    met = met.withColumn("score", F.expr("top div bottom"))
    row = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("row")
    return met.groupBy("lang", "phrase").agg(row).select("lang", "phrase", "row.a", "row.l", "row.r", "row.n", "row.score")


def contained(phrases: DataFrame) -> DataFrame:
    """(lang, phrase): phrases that lie inside a longer one of the same count, at any place."""
    words = F.split("phrase", " ")
    longer = phrases.filter("size > 2").select("lang", "n", "size", words.alias("words"))
    sized = longer.withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    placed = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
    inner = F.array_join(F.slice("words", F.col("at"), F.col("k")), " ")
    most = placed.select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    own = phrases.filter("size > 1").select("lang", "phrase", "n")
    return own.join(most, ["lang", "phrase"]).filter("most >= n").select("lang", "phrase")


def collocations(docs: DataFrame, support: int = 100, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's best phrases."""
    phrases, totals = frequent_phrases(docs, support)
    kept = scored(phrases, totals).join(contained(phrases), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
