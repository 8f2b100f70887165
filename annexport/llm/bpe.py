"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is parted into pre-tokens. A pre-token that is a vocabulary entry as a whole is resolved by a
minimal perfect hash (levels of bit arrays: a key's place is the rank of its bit; the entry's bytes
are compared, so no other key passes). Every other pre-token is merged over a doubly linked list of
bytes, with a heap of candidate pairs ordered by rank and place. Results are kept by pre-token in a
cache of bounded size per Python worker.

Pre-tokens are those of the pattern ``PATTERN`` of the public tokenizers. They are found by classes
of code points in whole-array steps; the pattern itself is the reference in the tests.

The vocabulary is a file named by a parameter, read once on the driver; its broadcast is bounded by
the vocabulary's size.

Edge cases: NULL and empty texts have no tokens and decode to the empty text. Texts of any length are
encoded whole. Repeated rows get equal results. Extra columns pass through; a column named like the
result is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import blocks, give_back, in_batches, utf8, worker_cache

# Classes of code points.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The contractions of the pattern, and the code points of \s outside category Z.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACES = (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x20, 0x85)
CACHE = 96 << 20  # bytes of pre-tokens and their ids kept per worker, about
ENTRY = 230  # bytes an entry takes besides them
BATCH = 1 << 20  # bytes of text whose pre-tokens are resolved together
SLICE = 1 << 20  # code points parted at a time, about


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
        elif kind == "Z":
            table[c] = SPACE
    table[[c for c in SPACES if not 0x1C <= c <= 0x1F]] = SPACE
    return table


def cuts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of one text begin, and its end."""
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    begin = np.ones(n + 1, bool)
    begin[1:n] = kinds[1:] != kinds[:-1]
    space = kinds == SPACE
    # Of white space before anything else, the last point is parted off; a blank goes with what follows.
    last = np.flatnonzero(space[:-1] & ~space[1:])
    begin[last] = True
    blank = last[points[last] == 0x20]
    begin[blank + 1] = False
    # A contraction needs its apostrophe at the begin of a pre-token.
    quotes = np.flatnonzero((points == 0x27) & begin[:n])
    for q in quotes.tolist():
        for tail in CONTRACTIONS:
            end = q + 1 + len(tail)
            if end <= n and all(points[q + 1 + i] == ord(c) for i, c in enumerate(tail)):
                begin[q + 1 : end] = False
                begin[end] = True
                break
    return np.flatnonzero(begin)


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, in order."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = cuts(points, classes()[points]).tolist()
    return [text[a:b] for a, b in zip(at, at[1:])]


class PerfectHash:
    """Minimal perfect hash over byte strings: key -> place in 0..n-1, or -1 for other keys.

    Level by level, keys that are alone at their bit stay there, and the rest go on.
    """

    def __init__(self, keys: list[bytes], gamma: float = 2.0) -> None:
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("keys must be distinct")
        self.levels: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        left, base = hashes, 0
        while len(left):
            size = max(64, int(gamma * len(left)))
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.ranks.append(base + np.cumsum(alone) - 1)
            base += int(alone.sum())
            left = left[~alone[at]]
        places = self.places(hashes)
        self.entries = [b""] * len(keys)
        for key, place in zip(keys, places.tolist()):
            self.entries[place] = key

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = (hashes ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return (mixed * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(20)).astype(np.int64) % size

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The only place each hash can have, or -1."""
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (alone, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            at = self._place(hashes[open_], level, len(alone))
            here = alone[at]
            found[open_[here]] = ranks[at[here]]
            open_ = open_[~here]
        return found

    def lookup(self, keys: list[bytes]) -> list[int]:
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        return [p if p >= 0 and self.entries[p] == k else -1 for k, p in zip(keys, self.places(hashes).tolist())]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines: base64 of the bytes, a blank, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Pre-tokens to ids and back."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE) -> None:
        self.ranks, self.cache = ranks, cache
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        self.ids = [ranks[k] for k in self.hash.entries]
        self.bytes_of = {i: k for k, i in ranks.items()}
        self.decimals = {i: f",{i}" for i in self.bytes_of}
        self.ids_of: dict[str, bytes] = {}
        self.decimals_of: dict[str, str] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece, by merging the pair of least rank (leftmost of equals) until none is left.

        ``after`` and ``before`` link the begins of the pieces that remain; ``pair`` is the rank
        of a piece and its successor. A heap entry is rank and begin in one number; it is stale
        unless it equals the begin's present rank.
        """
        rank, n = self.ranks.get, len(piece)
        none, bits = 1 << 40, n.bit_length()
        low = (1 << bits) - 1
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [rank(piece[i : i + 2], none) for i in range(n - 1)]
        pair.append(none)
        heap = [r << bits | i for i, r in enumerate(pair) if r != none]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            a = entry & low
            if pair[a] != entry >> bits:
                continue
            b = after[a]
            c = after[a] = after[b]
            pair[b] = none
            if c < n:
                before[c] = a
                r = pair[a] = rank(piece[a : after[c]], none)
                if r != none:
                    push(heap, r << bits | a)
            else:
                pair[a] = none
            p = before[a]
            if p >= 0:
                r = pair[p] = rank(piece[p:c], none)
                if r != none:
                    push(heap, r << bits | p)
        out, a = [], 0
        while a < n:
            b = after[a]
            out.append(self.ranks[piece[a:b]])
            a = b
        return out

    def resolve(self, pieces: set[str]) -> None:
        """Puts the ids of all ``pieces`` in the cache: as 4-byte numbers, and in decimal."""
        if self.held > self.cache:
            self.ids_of.clear()
            self.decimals_of.clear()
            self.held = 0
        new = list(pieces.difference(self.ids_of))
        keys = [p.encode() for p in new]
        pack, text = struct.pack, self.decimals
        for piece, key, place in zip(new, keys, self.hash.lookup(keys)):
            ids = (self.ids[place],) if place >= 0 else self.merge(key)
            self.ids_of[piece] = pack(f"<{len(ids)}I", *ids)
            self.decimals_of[piece] = "".join([text[i] for i in ids])
            self.held += ENTRY + len(key) + 8 * len(ids)

    def encode(self, text: str) -> np.ndarray:
        pieces = pre_tokens(text)
        self.resolve(set(pieces))
        return np.frombuffer(b"".join(map(self.ids_of.__getitem__, pieces)), "<u4")

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def stretches(text: str, size: int = SLICE) -> Iterator[str]:
    """A long text in stretches that can be encoded one by one: cut before a blank that follows a
    letter and precedes one, where every pre-token begins anew."""
    kinds = classes()
    start = 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) - 1 and not (
            text[at] == " " and kinds[ord(text[at - 1])] == LETTER and kinds[ord(text[at + 1])] == LETTER
        ):
            at += 1
        if at >= len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def worker_encoder(key: str, shared, cache: int = CACHE) -> Encoder:
    """The worker's encoder of a broadcast vocabulary; its cache is kept from task to task."""
    return worker_cache(f"bpe {cache} {key}", lambda: Encoder(shared.value, cache))


def vocabulary_key(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()


ENCODED = "struct<ids:binary,n_tokens:long,ids_sha256:string,decoded_sha256:string>"
_KIND = pa.struct([
    ("ids", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
])


def encode_batch(texts: list[str], encoder: Encoder, keep_ids: bool) -> list[dict]:
    """Encodes texts and decodes their ids, a stretch at a time; new pre-tokens are resolved together."""
    parted = [[pre_tokens(part) for part in stretches(text)] for text in texts]
    encoder.resolve(set().union(*(pieces for parts in parted for pieces in parts)))
    rows = []
    for parts in parted:
        of_ids, of_bytes, kept, n = hashlib.sha256(), hashlib.sha256(), [], 0
        for pieces in parts:
            ids = b"".join(map(encoder.ids_of.__getitem__, pieces))
            decimals = "".join(map(encoder.decimals_of.__getitem__, pieces))
            of_ids.update(decimals.encode() if n else decimals[1:].encode())
            of_bytes.update(encoder.decode(np.frombuffer(ids, "<u4").tolist()))
            n += len(ids) // 4
            if keep_ids:
                kept.append(ids)
        rows.append({
            "ids": b"".join(kept) if keep_ids else None, "n_tokens": n,
            "ids_sha256": of_ids.hexdigest(), "decoded_sha256": of_bytes.hexdigest(),
        })
    return rows


def encoded(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", into: str = "encoded", keep_ids: bool = True, cache: int = CACHE) -> DataFrame:
    """``docs`` with a struct ``into``: ids (4-byte little-endian), n_tokens and the two digests."""
    key, shared = vocabulary_key(ranks), docs.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf(ENCODED)
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(key, shared, cache)
        for batch in texts:
            rows = []
            for part in blocks(utf8(batch), len, BATCH):
                rows += encode_batch([t.decode() for t in part], encoder, keep_ids)
            yield pa.array(rows, _KIND)
            del rows
            give_back()

    return in_batches(docs).withColumn(into, of(F.col(text)))
