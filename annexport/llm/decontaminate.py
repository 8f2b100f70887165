"""Benchmark decontamination by suffix arrays over the training documents.

Every batch of documents is a shard with its own suffix array: the places of its words, sorted by
the words that follow. Each distinct window of each benchmark item (``window`` consecutive words, or a whole
shorter item) is binary-searched in it, which gives all places where it occurs; a longer verbatim match is the
union of its windows, and shorter matches are not looked for. The array is sparse: it holds the places
whose first two words begin some benchmark window (or the first word, where a one-word item equals
it), since no other place can match two words of an item; and it is sorted to the depth of the
longest window, since no match is longer. Work in a shard grows with its own words and matches.

The benchmark is a stated query set. It is cut into blocks of at most ``BLOCK`` bytes; each block is
broadcast and searched over all documents in turn, so neither driver nor task holds more than one
block, whatever the benchmark's size.

Edge cases: NULL and empty texts and items have no words and match nothing. A NULL item id is
reported as the empty text. Repeated items are reported once. Items and documents of any length are
searched whole. Repeated rows get equal results. Extra columns pass through; a column named like the
result is replaced. An empty benchmark leaves everything clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import blocks, give_back, utf8
from annexport.session import staged

WINDOW = 10
BLOCK = 8 << 20  # bytes of benchmark text searched at a time
SHARD = 2_000_000  # words of a shard's suffix array, about

# Bytes that are part of a word stay, A-Z lower-cased; all others part words.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class Benchmark:
    """The suffixes of a block of items, as arrays of word numbers (0: a word of no item)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.numbers = _Numbers()
        self.items = [i for i, _ in items]
        runs = []
        for _, text in items:
            runs.append([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)])
        self.depth = max(map(len, runs), default=0)
        # Each distinct window once, with the items and places that have it.
        windows: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for item, run in enumerate(runs):
            width = min(window, len(run))
            for k in range(len(run) - width + 1 if run else 0):
                windows[tuple(run[k : k + width])].append((item, k))
        self.windows = windows
        self.base = len(self.numbers) + 2
        singles = sorted({w[0] for w in windows if len(w) == 1})
        self.single = np.zeros(self.base, bool)
        self.single[singles] = True
        self.pairs = np.array(sorted({
            w[k] * self.base + w[k + 1] for w in windows for k in range(len(w) - 1)
        }), np.int64)


def suffix_array(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` words from each on; ``words`` ends with ``depth`` zeros.

    Sorted one word further at a time, and only within runs whose words are equal so far and are
    all words of the benchmark: nothing matches beyond a zero, so its place needs no more order.
    """
    order = places[np.argsort(words[places], kind="stable")]
    if not len(order):
        return order
    group = np.concatenate(([0], np.cumsum(np.diff(words[order]) != 0)))
    at = np.arange(len(order))
    for k in range(1, depth):
        at = at[(np.bincount(group)[group[at]] > 1) & (words[order[at] + k - 1] != 0)]
        if not len(at):
            break
        key = words[order[at] + k]
        sub = np.lexsort((key, group[at]))
        order[at], key, own = order[at][sub], key[sub], group[at]
        new = np.zeros(len(order), bool)
        new[at[1:]] = (own[1:] == own[:-1]) & (key[1:] != key[:-1])
        # Members that ended at a zero come first in their run and keep their group number.
        new[at[0]] |= at[0] > 0 and group[at[0]] == group[at[0] - 1]
        begins = np.flatnonzero((own[1:] != own[:-1])) + 1
        new[at[begins]] |= group[at[begins]] == group[at[begins] - 1]
        group = group + np.cumsum(new)
    return order


def search(words: np.ndarray, array: np.ndarray, query: np.ndarray) -> tuple[int, int, int]:
    """(first, last + 1, length): where the longest prefix of ``query`` found in the array occurs."""
    low, high, length = 0, len(array), 0
    for k, word in enumerate(query):
        column = words[array[low:high] + k] if high - low <= 64 else None
        if column is not None:
            a, b = np.searchsorted(column, word, "left"), np.searchsorted(column, word, "right")
            a, b = low + int(a), low + int(b)
        else:
            a, b = _bound(words, array, low, high, k, word, False), _bound(words, array, low, high, k, word, True)
        if a == b:
            break
        low, high, length = a, b, k + 1
    return low, high, length


def _bound(words, array, low: int, high: int, k: int, word: int, right: bool) -> int:
    while low < high:
        mid = (low + high) // 2
        value = words[array[mid] + k]
        if value < word or (right and value == word):
            low = mid + 1
        else:
            high = mid
    return low


def search_shard(texts: list[bytes], bench: Benchmark) -> tuple[list[int], dict[int, list[tuple[int, int, int, int]]]]:
    """Words per text, and by text its longest verbatim matches (start, length, item, item_start).

    Every suffix's window is searched once. Occurrences of an item's successive windows at
    successive places are one match; it cannot be longer on either side.
    """
    number, counts, parts = bench.numbers.__getitem__, [], []
    for text in texts:
        found = words_of(text)
        counts.append(len(found))
        parts += [np.fromiter(map(number, found), np.int64, len(found)), np.zeros(1, np.int64)]
    words = np.concatenate([*parts, np.zeros(bench.depth + 1, np.int64)])  # no match spans two texts
    starts = bench.single[words[:-1]]
    if len(bench.pairs):
        pair = words[:-1] * bench.base + words[1:]
        at = np.minimum(np.searchsorted(bench.pairs, pair), len(bench.pairs) - 1)
        starts |= bench.pairs[at] == pair
    array = suffix_array(words, np.flatnonzero(starts), bench.depth)
    place, item, start, width = [], [], [], []
    for window, holders in bench.windows.items():
        low, high, length = search(words, array, window)
        if length < len(window) or low == high:
            continue
        for i, k in holders:
            place.append(array[low:high])
            item.append(np.full(high - low, i))
            start.append(np.full(high - low, k))
            width.append(np.full(high - low, len(window)))
    matches: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    if place:
        p, i, k, w = map(np.concatenate, (place, item, start, width))
        order = np.lexsort((p, p - k, i))
        p, i, k, w = p[order], i[order], k[order], w[order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 0) | (np.diff(p - k) != 0) | (np.diff(p) != 1))))
        ends = np.append(new[1:], len(p)) - 1
        first = np.cumsum([0] + [n + 1 for n in counts])
        text = np.searchsorted(first, p[new], "right") - 1
        length = p[ends] - p[new] + w[new]
        for t, s, n, x, y in zip(text.tolist(), (p[new] - first[text]).tolist(), length.tolist(), i[new].tolist(), k[new].tolist()):
            matches[t].append((s, n, x, y))
    return counts, matches


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block: int = BLOCK, into: str = "matches",
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, items (sorted as strings), contaminated, and
    spans (start, length in words) of the hit words, merged."""
    rows = docs.withColumn(into, F.lit(None).cast("struct<n_words:long,spans:array<struct<start:long,length:long>>,items:array<string>>"))
    source = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    items = ((r.i, r.t.encode()) for r in source.toLocalIterator())
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ])
    first = True
    for part in blocks(items, lambda r: len(r[1]) + 16, block):
        if not first:
            rows = staged(rows, "searched")
        rows = _search_block(rows, part, text, into, window, kind)
        first = False
    if first:
        rows = _search_block(rows, [], text, into, window, kind)
    m = F.col(into)
    n_hit = F.aggregate(m["spans"], F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return rows.withColumn(into, F.struct(
        m["n_words"].alias("n_words"), n_hit.alias("n_hit"), m["items"].alias("items"),
        (n_hit > 0).alias("contaminated"), m["spans"].alias("spans"),
    ))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of (start, length) intervals, as disjoint intervals in order."""
    out: list[list[int]] = []
    for start, length in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + length)
        else:
            out.append([start, start + length])
    return [(a, b - a) for a, b in out]


def _search_block(rows: DataFrame, items: list, text: str, into: str, window: int, kind: pa.DataType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(items)

    @F.arrow_udf("struct<n_words:long,spans:array<struct<start:long,length:long>>,items:array<string>>")
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        bench = Benchmark(shared.value, window)
        for texts, before in batches:
            found = []
            for shard in blocks(utf8(texts), lambda t: len(t) // 6 + 1, SHARD):
                counts, matches = search_shard(shard, bench)
                found += [(n, matches.get(t, [])) for t, n in enumerate(counts)]
            out = []
            for (n, matches), old in zip(found, before):
                old = old.as_py() or {"spans": [], "items": []}
                spans = [(s["start"], s["length"]) for s in old["spans"]]
                ids = set(old["items"]) | {bench.items[m[2]] for m in matches}
                spans = merged(spans + [(m[0], m[1]) for m in matches])
                out.append({"n_words": n, "spans": [{"start": a, "length": b} for a, b in spans], "items": sorted(ids)})
            yield pa.array(out, kind)
            del found, out
            give_back()

    return rows.withColumn(into, of(F.col(text), F.col(into)))
