"""Language-model scores from class-based n-grams.

Words are put into classes by exchange clustering: starting from classes by frequency,
each word moves to the class that raises the likelihood of the class bigrams most, until
a sweep moves nothing.  A text's probability is the product, over its tokens, of the
class-transition probability (smoothed by the class's own frequency) and the word's
emission probability in its class.

The most frequent words seed the classes: they are clustered one by one, all others at first
by their last three bytes.  Then every other word of the training corpus chooses its own
class: the classes before and after its occurrences are counted in shuffles, and it moves
to where the likelihood gains most, the classes held fixed meanwhile; class totals are
summed anew after it.  Only words unseen in training have the class of their last three
bytes.  Inside a class a word's probability is its add-one share, with one share for the
unseen.  Counts cover the whole training corpus: the vocabulary is counted, and looked up
for scoring, in shuffles keyed by the word.  Texts are taken apart twice: for the vocabulary,
and to write every row as 16-bit codes of its common words beside its rare ones, which all
later passes read.  Only words below a fixed rank are looked up in shuffles (each is then a
small share of all tokens); counts and classes of the more frequent ones, whose number is
bounded, are sent to every task.

Null and empty texts consist of the end token alone.  Without training rows the counts
are zero: N and V are 0 and every token has probability 1 / 1.  Repeated rows count and
are scored one by one.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import bounded_batches, gather_rows, in_fold, map_rows, read
from evergreen.session import materialize

END = b""
MARK = 65_535  # the code of all words that are not common
COMMON = MARK - 1  # words that every task knows, the end token aside
UNITS = 1024  # words whose classes are exchanged one by one, as seeds for the others
SUFFIXES = 1023  # suffix units; one more for all other suffixes
CLASSES = 64
HELD = 300_000  # distinct words that a task counts before it hands them on
HELD_CELLS = 2_000_000  # and distinct cells of their contexts
CELLS = 2 * CLASSES + 1  # a word's counts: classes before it, classes after it, itself after itself
TABLED = 8  # counts up to which gains are looked up


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII blanks with A-Z lower-cased, then the end token."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


def count_words(docs: DataFrame) -> DataFrame:
    """(token, n_all, n_train) over (text, train) rows; each task adds up before the shuffle."""

    def make():
        others, learned = Counter(), Counter()

        def add(texts, train):
            for t, y in zip(texts, train):
                (learned if y else others).update(tokens(t))
            return len(others) + len(learned) > HELD

        def take():
            keys = list(others.keys() | learned.keys())
            out = [keys, [others[k] + learned[k] for k in keys], [learned[k] for k in keys]]
            others.clear()
            learned.clear()
            return out

        return add, take

    fields = [("token", "binary"), ("n_all", "long"), ("n_train", "long")]
    return (
        gather_rows(docs.select("text", "train"), make, fields)
        .groupBy("token")
        .agg(F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train"))
    )


def common_words(vocabulary: DataFrame, most: int = COMMON) -> DataFrame:
    """The most frequent words, at most ``most``: those in the upper bins of a histogram over log counts."""
    level = F.floor(8 * F.log2("n_all")).cast("int")
    bins = {r["b"]: r["count"] for r in vocabulary.select(level.alias("b")).groupBy("b").count().collect()}
    kept, cut = 0, max(bins, default=0) + 1
    for b in sorted(bins, reverse=True):
        if kept + bins[b] > most:
            break
        kept, cut = kept + bins[b], b
    return vocabulary.filter(level >= cut)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = 12) -> np.ndarray:
    """Class of every unit, from the matrix of unit bigram counts, by exchange clustering.

    The likelihood of class bigrams is sum n(g,h) log n(g,h) - sum left(g) log left(g) -
    sum right(h) log right(h); moving a unit changes two rows and columns of n only.
    """
    units = len(pairs)
    left, right = pairs.sum(1), pairs.sum(0)
    order = np.argsort(-left, kind="stable")
    owner = np.empty(units, dtype=int)
    owner[order] = np.arange(units) % classes
    hot = np.eye(classes)[owner]
    rows = hot.T @ pairs @ hot
    lefts, rights = hot.T @ left, hot.T @ right
    f = lambda v: np.where(v > 0, v * np.log(np.maximum(v, 1e-300)), 0.0)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not left[u] and not right[u]:
                continue
            a = owner[u]
            # The unit's counts with every class, itself aside.
            out_to = np.bincount(owner, pairs[u], classes)
            in_from = np.bincount(owner, pairs[:, u], classes)
            own = pairs[u, u]
            out_to[a] -= own
            in_from[a] -= own
            # Take the unit out of its class.
            rows[a] -= out_to
            rows[:, a] -= in_from
            rows[a, a] -= own
            lefts[a] -= left[u]
            rights[a] -= right[u]
            # Gain of putting it into each class.
            gain_rows = f(rows + out_to[None, :]) - f(rows)
            gain_cols = f(rows + in_from[:, None]) - f(rows)
            diagonal = np.diag(rows)
            gain = gain_rows.sum(1) + gain_cols.sum(0)
            gain -= np.diag(gain_rows) + np.diag(gain_cols)
            gain += f(diagonal + out_to + in_from + own) - f(diagonal)
            gain -= f(lefts + left[u]) - f(lefts) + f(rights + right[u]) - f(rights)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            rows[b] += out_to
            rows[:, b] += in_from
            rows[b, b] += own
            lefts[b] += left[u]
            rights[b] += right[u]
            moved += b != a
            owner[u] = b
        if not moved:
            break
    return owner


def times_log(v):
    return np.where(v > 0, v * np.log(np.maximum(v, 1e-300)), 0.0)


class Gains:
    """What adding a count to a class bigram or a class total gains: tables for small counts, logarithms for others."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.classes = rows, len(rows)
        small = np.arange(TABLED + 1)[:, None, None]
        self.tables = {}
        for name, table in (("after", rows.T), ("before", rows), ("left", rows.sum(1)[None]), ("right", rows.sum(0)[None])):
            self.tables[name] = table, times_log(table + small) - times_log(table)

    def add(self, name: str, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Gains of every class, by table row and count."""
        table, tabled = self.tables[name]
        out = tabled[np.minimum(n, TABLED).astype(int), at]
        large = np.flatnonzero(n > TABLED)
        if len(large):
            base = table[at[large]]
            out[large] = times_log(base + n[large, None]) - times_log(base)
        return out


def best_moves(at: np.ndarray, cell: np.ndarray, n: np.ndarray, before: np.ndarray, gains: Gains) -> np.ndarray:
    """Class of every word by the gain of ``exchange``, from its counts and its class so far, given the class bigrams.

    Word ``at[i]`` has the count ``n[i]`` in ``cell[i]``; ``at`` ascends.  Only terms with a
    count of the word change, so the work goes with the counted cells.
    Words move at once, so an empty class, which would take words of every kind, takes none.
    """
    rows, classes, words, a = gains.rows, gains.classes, len(before), before
    dense = np.zeros((words, 2 * classes + 1))
    dense[at, cell] = n
    in_from, out_to, own = dense[:, :classes], dense[:, classes : 2 * classes], dense[:, -1]
    each = np.arange(words)
    gain = np.zeros((words, classes))
    for name, first, other in (("after", classes, in_from), ("before", 0, out_to)):
        some = np.flatnonzero((cell >= first) & (cell < first + classes))
        if not len(some):
            continue
        w, h, k = at[some], cell[some] - first, n[some]
        part = gains.add(name, h, k)
        # The word is taken out of its own class first.
        i, mine = np.arange(len(some)), a[w]
        table = gains.tables[name][0]
        left = table[h, mine] - k
        part[i, mine] = times_log(left + k) - times_log(left)
        same = np.flatnonzero(h == mine)
        left = table[h[same]] - other[w[same]]
        part[same] = times_log(left + k[same, None]) - times_log(left)
        part[i, h] = 0.0  # the diagonal follows
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[starts]] += np.add.reduceat(part, starts)
    own_bigrams = in_from + out_to + own[:, None]
    w, h = np.nonzero(own_bigrams)
    k = own_bigrams[w, h]
    left = rows[h, h] - np.where(h == a[w], k, 0.0)
    gain[w, h] += times_log(left + k) - times_log(left)
    for name, size in (("left", out_to.sum(1) + own), ("right", in_from.sum(1) + own)):
        totals = gains.tables[name][0][0]
        part = gains.add(name, np.zeros(words, dtype=int), size)
        part[each, a] = times_log(totals[a]) - times_log(totals[a] - size)
        gain -= part
    gain[:, rows.sum(0) + rows.sum(1) == 0] = -np.inf
    best = gain.argmax(1)
    return np.where(gain[each, best] <= gain[each, a] + 1e-9, a, best)


def best_classes(cells: list[np.ndarray], counts: list[np.ndarray], before: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``best_moves`` for cells and counts by word."""
    at = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    return best_moves(at, np.concatenate(cells), np.concatenate(counts).astype(float), before, Gains(rows))


@dataclass
class Seeds:
    """Classes of the most frequent words and of the suffix units."""

    unit_of: dict[bytes, int]  # the most frequent words
    suffix_of: dict[bytes, int]
    other: int
    owner: np.ndarray  # class by unit

    def unit(self, token: bytes) -> int:
        u = self.unit_of.get(token)
        return u if u is not None else self.suffix_of.get(token[-3:], self.other)


@dataclass
class BrownModel(Seeds):
    total: int  # N
    distinct: int  # V
    transition: np.ndarray  # log10 p(class | class before)
    divisors: np.ndarray  # log10 of what the shares in a class are divided by
    emission: np.ndarray  # by unit: log10 of a seed's count plus one; 0 where the word's own count is to be added
    inside: np.ndarray  # divisors by unit


class Codes(dict):
    """Codes of the common words; all others have the mark."""

    def __missing__(self, word: bytes) -> int:
        return MARK


def coded(docs: DataFrame, common: dict[bytes, int]) -> DataFrame:
    """(row, doc_id, held_out, train, codes, places, rare): every row's words as codes, written once.

    ``rare`` are a row's distinct words that are not common, ``places`` says which of them
    stands at each mark among the codes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(list(common))

    def make():
        code = Codes(zip(sent.value, range(MARK))).__getitem__

        def one(text):
            words = tokens(text)
            codes = np.fromiter(map(code, words), np.uint16, len(words))
            at: dict[bytes, int] = {}
            places = [at.setdefault(words[i], len(at)) for i in np.flatnonzero(codes == MARK).tolist()]
            return codes.tobytes(), np.array(places, dtype=np.int32).tobytes(), list(at)

        def work(ids, texts, held, train):
            rows = [one(t) for t in texts]
            return [ids, held, train, *([r[i] for r in rows] for i in range(3))]

        return work

    fields = [
        ("doc_id", "long"), ("held_out", "boolean"), ("train", "boolean"),
        ("codes", "binary"), ("places", "binary"), ("rare", "array<binary>"),
    ]
    rows = map_rows(docs.select(F.col("doc_id").cast("long"), "text", "held_out", "train"), make, fields)
    # The row number is fixed by writing it: a task that is run again later reads the same one.
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "brown-rows")


def batch_words(codes: list[bytes], places: list[bytes], rare: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Codes of a batch's rows in a row, which of the rare words stands at each mark, and these words."""
    at = np.frombuffer(b"".join(places), dtype=np.int32).astype(np.int64)
    sizes = [len(p) // 4 for p in places]
    starts = np.cumsum([0, *map(len, rare)])[:-1]
    names = [w for r in rare for w in r]
    return np.frombuffer(b"".join(codes), dtype=np.uint16).astype(np.int64), at + np.repeat(starts, sizes), names


def seed_classes(rows: DataFrame, known: DataFrame, common: dict[bytes, int]) -> tuple[Seeds, np.ndarray]:
    """Seeds from coded rows and the training vocabulary, and the class bigrams."""
    ranked = sorted((w for w in common if common[w]), key=lambda w: (-common[w], w))[:UNITS]
    if END in common and common[END] and END not in ranked:
        ranked[-1] = END
    unit_of = {w: i for i, w in enumerate(ranked)}
    rest = known.filter(~F.col("token").isin([bytearray(w) for w in ranked])) if ranked else known
    ends = F.expr("substring(token, greatest(length(token) - 2, 1), 3)")
    by_end = rest.groupBy(ends.alias("e")).agg(F.sum("n_train").alias("n"))
    top = by_end.orderBy(F.desc("n"), "e").limit(SUFFIXES).collect()
    suffix_of = {bytes(r["e"]): len(ranked) + i for i, r in enumerate(top)}
    other = len(ranked) + len(suffix_of)
    units = other + 1
    seeds = Seeds(unit_of, suffix_of, other, np.zeros(units, dtype=int))
    unit_by_code = np.array([seeds.unit(w) for w in common], dtype=np.int64)
    end = seeds.unit(END)
    sent = rows.sparkSession.sparkContext.broadcast((seeds, np.append(unit_by_code, np.zeros(MARK + 1 - len(common), dtype=np.int64))))

    def make():
        seeds, by_code = sent.value
        found = np.zeros(units * units, dtype=np.int64)

        def add(codes, places, rare):
            k, at, names = batch_words(codes, places, rare)
            u = by_code[k]
            u[k == MARK] = np.array([seeds.unit(w) for w in names], dtype=np.int64)[at]
            u = np.r_[end, u]
            np.add.at(found, u[:-1] * units + u[1:], 1)
            return False

        def take():
            at = np.flatnonzero(found)
            return [at, found[at]]

        return add, take

    cells = gather_rows(rows.filter("train").select("codes", "places", "rare"), make, [("cell", "long"), ("n", "long")])
    pairs = np.zeros(units * units)
    # At most units * units rows, a fixed number.
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        pairs[r.column("cell").to_numpy()] = r.column("n").to_numpy()
    pairs = pairs.reshape(units, units)
    seeds.owner = exchange(pairs)
    hot = np.eye(CLASSES)[seeds.owner]
    return seeds, hot.T @ pairs @ hot


def word_classes(rows: DataFrame, seeds: Seeds, bigrams: np.ndarray, common: dict[bytes, int]) -> DataFrame:
    """(token, class, n_train, common) of all training words but the seeds, each by its own contexts.

    Contexts are counted under a word, or for a common one under its code, which is -1 for all others.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((seeds, list(common)))
    first = len(seeds.unit_of)

    def count():
        seeds, words = sent.value
        by_code = np.zeros(MARK + 1, dtype=np.int64)
        by_code[: len(words)] = [seeds.unit(w) for w in words]
        end, end_unit = words.index(END), seeds.unit(END)
        numbers: dict[bytes, int] = {}  # after the codes
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def fold():
            nonlocal size
            keys, where = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            held[:] = [(keys, np.bincount(where, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64))]
            size = len(keys)

        def add(codes, places, rare):
            nonlocal size
            w, at, names = batch_words(codes, places, rare)
            u, marked = by_code[w], w == MARK
            u[marked] = np.array([seeds.unit(x) for x in names], dtype=np.int64)[at]
            w[marked] = np.array([numbers.setdefault(x, len(numbers)) for x in names], dtype=np.int64)[at] + MARK + 1
            w, u = np.r_[end, w], np.r_[end_unit, u]
            k, free = seeds.owner[u], u >= first
            a, b, same = w[:-1], w[1:], w[:-1] == w[1:]
            after, ahead = free[:-1] & ~same, free[1:] & ~same
            keys = [a[after] * CELLS + CLASSES + k[1:][after], b[ahead] * CELLS + k[:-1][ahead]]
            keys.append(a[free[:-1] & same] * CELLS + CELLS - 1)
            held.append(np.unique(np.concatenate(keys), return_counts=True))
            size += len(held[-1][0])
            if size > 2 * HELD_CELLS:
                fold()
            return len(numbers) > HELD or size > HELD_CELLS and len(held) == 1

        def take():
            nonlocal size
            if not held:
                return [[], [], [], []]
            fold()
            (keys, n), = held
            word, cell = keys // CELLS, keys % CELLS
            names = pa.array([b"", *numbers], pa.binary())
            found = names.take(pa.array(np.maximum(word - MARK, 0)))
            held.clear()
            numbers.clear()
            size = 0
            return [found, np.where(word < MARK, word, -1).astype(np.int32), cell.astype(np.int32), n]

        return add, take

    gains = Gains(bigrams)

    def choose(batches):
        seeds, words = sent.value
        for batch in batches:
            codes = batch.column("code").to_numpy()
            names = [words[c] if c >= 0 else t for c, t in zip(codes.tolist(), batch.column("token").to_pylist())]
            lengths = pc.list_value_length(batch.column("cells")).to_numpy().astype(np.int64)
            cells = batch.column("cells").flatten().to_numpy().astype(np.int64)
            counts = batch.column("counts").flatten().to_numpy().astype(float)
            before = seeds.owner[np.array([seeds.unit(w) for w in names], dtype=np.int64)]
            ends = np.cumsum(lengths)
            best, sizes = [], []
            for i in range(0, len(names), 2048):
                n = lengths[i : i + 2048]
                here = slice(ends[i] - n[0], ends[i + len(n) - 1])
                at = np.repeat(np.arange(len(n)), n)
                best.append(best_moves(at, cells[here], counts[here], before[i : i + 2048], gains))
                nexts = cells[here] >= CLASSES  # a word has a next one each time
                sizes.append(np.bincount(at[nexts], counts[here][nexts], len(n)).astype(np.int64))
            if names:
                columns = [pa.array(names, pa.binary()), np.concatenate(best).astype(np.int32), np.concatenate(sizes), codes >= 0]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "class", "n_train", "common"])

    fields = [("token", "binary"), ("code", "int"), ("cell", "int"), ("n", "long")]
    found = gather_rows(rows.filter("train").select("codes", "places", "rare"), count, fields)
    # Tasks have added up already: all cells of a word meet in one shuffle, at most CELLS rows of it from what a task holds.
    found = found.repartition("token", "code").groupBy("token", "code", "cell").agg(F.sum("n").alias("n"))
    # At most CELLS rows a word.
    found = found.groupBy("token", "code").agg(F.collect_list(F.struct("cell", "n")).alias("c"))
    found = found.select("token", "code", F.col("c.cell").alias("cells"), F.col("c.n").alias("counts"))
    chosen = bounded_batches(found).mapInArrow(choose, "token binary, class int, n_train long, common boolean")
    return materialize(chosen, "brown-classes")


def classed(first: DataFrame, seeds: Seeds, classes: DataFrame, common: dict[bytes, int]) -> DataFrame:
    """(doc_id, held_out, train, n_tokens, n_known, shares, classes): the class bytes of every coded row's words.

    Rare words meet their classes and counts in one shuffle, words unseen in training take
    the class of their last three bytes.  ``shares`` sums log10 of the words' counts plus one.
    """
    class_of = {bytes(r["token"]): r["class"] for r in classes.filter("common").select("token", "class").collect()}
    owner = seeds.owner.astype(np.uint8)
    class_by_code = np.zeros(MARK + 1, dtype=np.uint8)
    class_by_code[: len(common)] = [class_of[w] if w in class_of else owner[seeds.unit(w)] for w in common]
    count_by_code = np.zeros(MARK + 1, dtype=np.int64)
    count_by_code[: len(common)] = list(common.values())
    sent = first.sparkSession.sparkContext.broadcast((seeds, class_by_code, count_by_code))

    rare = first.select("row", F.posexplode("rare").alias("i", "token"))
    ends = F.expr("CASE WHEN class IS NULL THEN substring(token, greatest(length(token) - 2, 1), 3) END").alias("e")
    later = (
        rare.join(classes.select("token", "class", "n_train"), "token", "left")
        .select("row", "i", F.coalesce("class", F.lit(-1)).alias("class"), F.coalesce("n_train", F.lit(0)).alias("n"), ends)
        .groupBy("row")
        .agg(F.collect_list(F.struct("i", "class", "n", "e")).alias("f"))
        .select("row", *(F.col(f"f.{c}").alias(c) for c in ("i", "class", "n", "e")))
    )

    def fill():
        seeds, class_by_code, count_by_code = sent.value
        share_by_code = np.log10(count_by_code + 1)

        def one(codes, places, i, found, n, e):
            w = np.frombuffer(codes, dtype=np.uint16)
            k = class_by_code[w]
            met, shares = int((count_by_code[w] > 0).sum()), float(share_by_code[w].sum())
            if i:
                at = np.frombuffer(places, dtype=np.int32)
                if -1 in found:
                    found = [owner[seeds.suffix_of.get(x, seeds.other)] if c < 0 else c for c, x in zip(found, e)]
                counts, own = np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.uint8)
                counts[i], own[i] = n, found
                k[w == MARK] = own[at]
                met += int((counts > 0)[at].sum())
                shares += float(np.log10(counts + 1)[at].sum())
            return len(w), met, shares, k.tobytes()

        def work(ids, held, train, *columns):
            rows = [one(*r) for r in zip(*columns)]
            return [ids, held, train, *([r[i] for r in rows] for i in range(4))]

        return work

    kept = [("doc_id", "long"), ("held_out", "boolean"), ("train", "boolean")]
    sums = [("n_tokens", "long"), ("n_known", "long"), ("shares", "double"), ("classes", "binary")]
    joined = first.drop("rare").join(later, "row", "left")
    joined = joined.select("doc_id", "held_out", "train", "codes", "places", "i", "class", "n", "e")
    return materialize(map_rows(joined, fill, [*kept, *sums]), "brown-coded")


def learn(rows: DataFrame, seeds: Seeds, known: DataFrame, classes: DataFrame, common: dict[bytes, int]) -> BrownModel:
    """Probabilities from coded rows."""
    size = known.agg(F.sum("n_train"), F.count(F.lit(1))).first()
    end = int(seeds.owner[seeds.unit(END)])

    def make():
        found = np.zeros(CLASSES * CLASSES, dtype=np.int64)

        def add(texts):
            k = np.frombuffer(bytes([end]) + b"".join(texts), dtype=np.uint8).astype(np.int64)
            found[:] += np.bincount(k[:-1] * CLASSES + k[1:], minlength=CLASSES * CLASSES)
            return False

        return add, lambda: [np.arange(CLASSES * CLASSES), found]

    moves = np.zeros(CLASSES * CLASSES)
    cells = gather_rows(rows.filter("train").select("classes"), make, [("cell", "long"), ("n", "long")])
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        moves[r["cell"]] = r["n"]
    moves = moves.reshape(CLASSES, CLASSES)
    members = np.bincount(seeds.owner[: len(seeds.unit_of)], minlength=CLASSES).astype(float)
    for r in classes.groupBy("class").count().collect():
        members[r["class"]] += r["count"]
    arrivals = moves.sum(0)
    own = (arrivals + 1) / (arrivals.sum() + CLASSES)
    weight = 10.0
    transition = np.log10((moves + weight * own) / (moves.sum(1, keepdims=True) + weight))
    divisors = np.log10(arrivals + members + 1)
    emission = np.zeros(len(seeds.owner))
    emission[: len(seeds.unit_of)] = [math.log10(common[w] + 1) for w in seeds.unit_of]
    return BrownModel(
        **vars(seeds), total=size[0] or 0, distinct=size[1], transition=transition, divisors=divisors,
        emission=emission, inside=divisors[seeds.owner],
    )


def fit_rows(docs: DataFrame, vocabulary: DataFrame, common: dict[bytes, int]) -> tuple[BrownModel, DataFrame]:
    """Classes and probabilities from (doc_id, text, held_out, train) rows and their written vocabulary; the coded rows."""
    known = vocabulary.filter("n_train > 0")
    common = {END: 0} | common
    first = coded(docs, common)
    seeds, bigrams = seed_classes(first, known, common)
    classes = word_classes(first, seeds, bigrams, common)
    rows = classed(first, seeds, classes, common)
    return learn(rows, seeds, known, classes, common), rows


def fit(docs: DataFrame, vocabulary: DataFrame, common: dict[bytes, int]) -> BrownModel:
    """Classes and probabilities from (text, train) rows and their written vocabulary."""
    docs = docs.select(F.lit(None).alias("doc_id"), "text", (~F.col("train")).alias("held_out"), "train")
    return fit_rows(docs, vocabulary, common)[0]


def score(rows: DataFrame, model: BrownModel) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for coded rows."""
    end = bytes([int(model.owner[model.unit(END)])])
    divisor = math.log10(model.total + model.distinct + 1)
    transition, divisors = model.transition, model.divisors

    def make():
        def one(k):
            k = np.frombuffer(end + k, dtype=np.uint8)
            return float(transition[k[:-1], k[1:]].sum() - divisors[k[1:]].sum())

        def work(ids, held, size, known, shares, classes):
            base = [s - divisor * n for s, n in zip(shares, size)]
            total = [model_total] * len(ids)
            return [ids, held, size, known, total, base, [s + one(k) for s, k in zip(shares, classes)]]

        return work

    model_total = int(model.total)
    fields = [
        ("doc_id", "long"), ("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"),
        ("train_tokens", "long"), ("base_score", "double"), ("score", "double"),
    ]
    return map_rows(rows.select("doc_id", "held_out", "n_tokens", "n_known", "shares", "classes"), make, fields)


def score_corpus(docs: DataFrame, held_out) -> DataFrame:
    """Count, cluster and score the documents, learning from all rows that are not held out."""
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    docs = docs.withColumn("train", ~F.col("held_out"))
    vocabulary = materialize(count_words(docs), "brown-vocabulary")
    often = common_words(vocabulary).union(vocabulary.filter(F.length("token") == 0)).select("token", "n_train")
    common = {bytes(r["token"]): r["n_train"] for r in often.collect()}
    model, rows = fit_rows(docs, vocabulary, common)
    return score(rows, model)


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_corpus(read(spark, sf_dir, "documents"), in_fold(7, 2))
