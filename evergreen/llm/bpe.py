"""Byte-level BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that occur next to each other inside no vocabulary entry can
never end up inside one token, whatever the merges do, so the text is certainly cut
there.  Pre-tokens are cut at such pairs first; each fragment is merged on its own
(and remembered, as fragments recur), and the ids are strung together.

Control strings of the vocabulary file are found first and stand for one id each, as
the file's own library treats them.  Null texts count as empty: no ids, an empty
decoded text.  The path of the vocabulary file is a parameter; every task reads it.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import map_rows, read

# Fixed value: how this family of tokenizers splits text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 250_000
FARTHEST = 1 << 40


def printable_bytes() -> dict[str, int]:
    """The file's alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = printable_bytes()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.tokens = {i: t for t, i in vocab.items()}
        self.byte_id = [vocab.get(bytes([b]), -1) for b in range(256)]
        # Rank of a pair of ids (one number), and the id that each rank makes.
        self.rank_of: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank_of[vocab[left] << 20 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.control = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for text, i in self.control.items():
            self.tokens[i] = text.encode()
        ordered = sorted(self.control, key=len, reverse=True)
        self.control_at = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.joined = bytearray(1 << 16)  # by the number of the pair
        for t in vocab:
            for a, b in zip(t, t[1:]):
                self.joined[a << 8 | b] = 1
        # Pre-tokens met lately, in two generations: the older one goes when the newer one is full.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def fragments(self, piece: bytes) -> list[bytes]:
        """Cut where two neighbouring bytes share no vocabulary entry."""
        joined = self.joined
        cuts = [i for i, (a, b) in enumerate(zip(piece, piece[1:]), 1) if not joined[a << 8 | b]]
        if not cuts:
            return [piece]
        return [piece[i:j] for i, j in zip([0, *cuts], [*cuts, len(piece)])]

    def merge(self, fragment: bytes) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none applies."""
        ids = [self.byte_id[b] for b in fragment]
        if len(ids) > 64:
            return self._merge_long(ids)
        rank_of, none = self.rank_of.get, FARTHEST
        ranks = [rank_of(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == none:
                break
            at = ranks.index(lowest)
            new = ids[at] = self.made[lowest]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(new << 20 | ids[at + 1], none)
            if at:
                ranks[at - 1] = rank_of(ids[at - 1] << 20 | new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long fragments: a heap of merges over a linked list, n log n steps."""
        import heapq

        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.rank_of.get(ids[i] << 20 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def _learn(self, piece: str) -> tuple[int, ...]:
        got = self.older.get(piece)
        if got is None:
            got = tuple(i for f in self.fragments(piece.encode("utf-8")) for i in self.merge(f))
        if len(piece) <= 64:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[piece] = got
        return got

    def encode(self, text: str) -> array:
        ids = array("I")
        parts = self.control_at.split(text) if self.control_at and self.control_at.search(text) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.control[part])
                continue
            known = self.known
            for piece in self.pre_tokens.findall(part):
                ids.extend(known.get(piece) or self._learn(piece))
        return ids

    def decode(self, ids: array) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def tokenizer(path: str) -> ForcedBoundaryBPE:
    """One per Python worker, so that what it remembers serves the worker's later tasks too."""
    return ForcedBoundaryBPE(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, the ids of every row."""

    def make():
        bpe = tokenizer(path or vocabulary_path())

        def work(doc_ids, texts):
            ids = [bpe.encode(t or "") for t in texts]
            digests = [hashlib.sha256(_little_endian(x)).hexdigest() for x in ids]
            decoded = [hashlib.sha256(bpe.decode(x).encode("utf-8", "replace")).hexdigest() for x in ids]
            return [doc_ids, [len(x) for x in ids], digests, decoded] + ([[x.tolist() for x in ids]] if with_ids else [])

        return work

    fields = [("doc_id", "long"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    if with_ids:
        fields.append(("ids", "array<long>"))
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, fields)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"))
