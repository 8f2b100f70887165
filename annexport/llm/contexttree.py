"""LM scoring by context-tree weighting over bytes.

A text is its lower-cased bytes and an end mark; each byte is eight binary decisions. For every
decision (the bits of the byte so far) there is a tree of contexts, the last 0 to ``DEPTH`` bytes.
A node's estimate is Krichevsky and Trofimov's for its counts; its weighted probability is half
that and half the product of its children's. Counts alone fix all of it, so training is counting.
The probability of a bit mixes the estimates of all depths with the weights along the path.

Nothing of the model is broadcast but the two shallowest levels, which are of fixed size. Texts are
packed into blocks of about ``BLOCK`` bytes. A block names its distinct grams (context and byte,
exact, in one 64-bit number) with their training counts. Grams are merged by hash bucket, regrouped
by their last two context bytes, which hold whole subtrees, evaluated there, and answered to the
blocks that named them, bucket by bucket; a block then sums up its texts. So what moves is distinct
grams per block, packed in arrays, and the model grows with the corpus. Words of the unigram base go the same way. The rows moved
are the product of blocks and buckets; larger blocks (a parameter) take more of a worker's memory and make fewer of them.

Edge cases: a NULL text is empty, which is scored as its end mark. A NULL id counts as the empty
text for the held-out remainder and is returned as NULL. Repeated rows are trained on and scored as
often as they occur. Texts of any length are whole within one block. Only the id and text columns are read, so
others cannot clash. An empty table gives an empty result; without training rows every bit has
probability 1/2.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import give_back
from annexport.session import staged

DEPTH = 5
BLOCK = 9 << 19  # bytes of text
BLOCK_TEXTS = 1 << 16  # texts of a block at most: their numbers share a word with a gram
SLICE = 1 << 19  # places whose grams are made at a time
PORTION = 50_000  # grams whose subtrees are built at a time
MARK = 0xFF  # begin and end of a text: no byte of UTF-8
TOP = 2  # depths kept whole on the driver: 1 + 256 contexts
U8 = np.uint64(8)


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def hashed(grams: np.ndarray) -> np.ndarray:
    mixed = (grams ^ grams >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def giving_back(of_group: Callable) -> Callable:
    """``of_group`` that gives its memory back when it is done. Spark counts its parameters: one or two."""

    def one(group):
        try:
            return of_group(group)
        finally:
            give_back()

    def two(first, second):
        try:
            return of_group(first, second)
        finally:
            give_back()

    return two if of_group.__code__.co_argcount == 2 else one


# --- grams of a block


def placed_grams(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram, number of its text) for every predicted place, a slice of places at a time."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin, end = bytes([MARK]) * depth, bytes([MARK])
    whole = np.frombuffer(b"".join([x for t in texts for x in (begin, t, end)]), np.uint8)
    of = np.repeat(np.arange(len(texts)), sizes + depth + 1).astype(np.int32)
    starts = np.concatenate(([0], np.cumsum(sizes + depth + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    for d in range(depth):
        of[starts + d] = -1
    for a in range(depth, len(whole), SLICE):
        b = min(a + SLICE, len(whole))
        grams = np.zeros(b - a, np.uint64)
        for i in range(depth, -1, -1):
            grams = (grams << U8) | whole[a - i : b - i]
        own = of[a:b]
        yield grams[own >= 0], own[own >= 0].astype(np.uint64)


def block_grams(texts: list[bytes], training: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct grams, sorted, and how often each occurs in its training texts."""
    grams, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for found, own in placed_grams(texts, depth):
        marked = np.sort(found << np.uint64(1) | training[own.astype(np.int64)].astype(np.uint64))
        new = np.flatnonzero(np.concatenate(([True], marked[1:] != marked[:-1])))
        times = np.diff(np.append(new, len(marked)))
        marked = marked[new]
        grams.append(marked >> np.uint64(1))
        counts.append(times * (marked & np.uint64(1)).astype(np.int64))
    return merge(grams, counts)


def merge(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, times = np.concatenate(grams), np.concatenate(counts)
    if not len(every):
        return every, times
    order = np.argsort(every)
    every = every[order]
    new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[new], np.add.reduceat(times[order], new)


def sorted_places(texts: list[bytes], depth: int) -> list[np.ndarray]:
    """Every predicted place as gram and number of its text in one number, sorted by slices."""
    return [np.sort(found << np.uint64(16) | own) for found, own in placed_grams(texts, depth)]


def _runs(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a sorted slice, and at which places they begin."""
    gram = both >> np.uint64(16)
    new = np.concatenate(([True], gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, bool)
    return gram[new], new


def distinct_grams(places: list[np.ndarray]) -> np.ndarray:
    """All grams of sorted places, each once and sorted: those of ``block_grams``."""
    every = np.sort(np.concatenate([np.zeros(0, np.uint64), *(_runs(both)[0] for both in places)]))
    return every[np.concatenate(([True], every[1:] != every[:-1]))] if len(every) else every


def text_sums(places: list[np.ndarray], n: int, grams: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each of ``n`` texts the sum of the values of its grams. ``grams`` is sorted and has all of them."""
    sums = np.zeros(n)
    for both in places:
        own, new = _runs(both)
        each = values[np.searchsorted(grams, own)][np.cumsum(new) - 1]
        sums += np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), weights=each, minlength=n)
    return sums


# --- the tree


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for positive x: Stirling's series above 8, recurrence below."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - np.log(np.pi)


def weighted(zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the node's own estimate)."""
    own = log_kt(zeros, ones)
    log_pw = np.logaddexp(own, children) - np.log(2)
    return log_pw, np.exp(own - np.log(2) - log_pw)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place of each key among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    places = np.empty(len(keys), np.int64)
    places[order] = np.cumsum(new) - 1
    return keys[new], places


class Subtrees:
    """All nodes of depth ``TOP`` and more under the grams given (whole subtrees)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int) -> None:
        byte = grams & np.uint64(0xFF)
        context = grams >> U8
        steps = np.arange(8, dtype=np.uint64)[:, None]
        node = (np.uint64(1) << steps) | (byte >> (U8 - steps))
        self.bit = ((byte >> (np.uint64(7) - steps)) & np.uint64(1)).astype(np.int64).ravel()
        times = np.tile(counts, 8)
        keys, self.leaf = numbered((context << U8 | node).ravel())
        n = len(keys)
        ones = np.bincount(self.leaf, weights=times * self.bit, minlength=n)
        zeros = np.bincount(self.leaf, weights=times * (1 - self.bit), minlength=n)
        log_pw = log_kt(zeros, ones)
        self.one = (ones + 0.5) / (zeros + ones + 1)  # of the leaves
        self.levels = []
        at = np.arange(n)
        for d in range(depth - 1, TOP - 1, -1):
            mask = np.uint64((1 << 8 * d) - 1)
            keys, up = numbered((keys >> U8 & mask) << U8 | keys & np.uint64(0xFF))
            n = len(keys)
            zeros, ones, children = (np.bincount(up, weights=x, minlength=n) for x in (zeros, ones, log_pw))
            log_pw, weight = weighted(zeros, ones, children)
            at = up[at]
            self.levels.append((at, weight, (ones + 0.5) / (zeros + ones + 1)))
        # Under its last context byte: what the levels above sum up.
        top = (keys & np.uint64(0xFFFF)).astype(np.int64)
        self.top_of_leaf = top[at]
        self.top, up = np.unique(top, return_inverse=True)
        self.sums = [np.bincount(up, weights=x, minlength=len(self.top)) for x in (zeros, ones, log_pw)]

    def log10(self, top: np.ndarray) -> np.ndarray:
        """log10 of each gram's probability; ``top`` has (estimate, remainder) by key."""
        p = self.one
        for at, weight, one in self.levels:
            w = weight[at]
            p = w * one[at] + (1 - w) * p
        p = top[self.top_of_leaf, 0] + top[self.top_of_leaf, 1] * p
        p = p[self.leaf]
        return np.log10(np.where(self.bit == 1, p, 1 - p)).reshape(8, -1).sum(axis=0)


def whole_subtrees(grams: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the grams in portions of whole subtrees: about ``PORTION``, or one larger subtree."""
    under = (grams >> U8 & np.uint64(0xFFFF)).astype(np.int64)
    order = np.argsort(under, kind="stable")
    ends = np.flatnonzero(np.append(np.diff(under[order]) != 0, True)) + 1 if len(grams) else []
    start = last = 0
    for end in [*ends]:
        if end - start > PORTION and last > start:
            yield order[start:last]
            start = last
        last = end
    if last > start:
        yield order[start:last]


def top_mixture(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> np.ndarray:
    """By (last byte, bits): the part of P(1) that depths 0 and 1 give, and what is left for the rest."""
    table = np.zeros((1 << 16, 2))
    table[:, 1] = 1.0
    if not len(keys):
        return table
    log_pw, weight = weighted(zeros, ones, children)
    one = (ones + 0.5) / (zeros + ones + 1)
    nodes, up = np.unique(keys & 0xFF, return_inverse=True)
    z0, o0, c0 = (np.bincount(up, weights=x, minlength=len(nodes)) for x in (zeros, ones, log_pw))
    _, w0 = weighted(z0, o0, c0)
    one0 = (o0 + 0.5) / (z0 + o0 + 1)
    table[keys, 0] = w0[up] * one0[up] + (1 - w0[up]) * weight * one
    table[keys, 1] = (1 - w0[up]) * (1 - weight)
    return table


# --- the jobs


def words_in(text: bytes) -> list[bytes]:
    return text.split()


def word_buckets(words: list[bytes], buckets: int) -> dict[int, list[bytes]]:
    """Distinct words by bucket, sorted: the same order wherever a block's words are named."""
    found: dict[int, list[bytes]] = {}
    for w in sorted(words):
        found.setdefault(xxhash.xxh32_intdigest(w) % buckets, []).append(w)
    return found


def _packed_blocks(depth: int, buckets: int, block: int, id_type: pa.DataType, schema: pa.Schema):
    def rows_of(number: str, ids: list, held: list[bool], texts: list[bytes]) -> pa.RecordBatch:
        training = ~np.array(held, bool)
        out: list[tuple] = []
        sizes = [len(t) for t in texts]
        body = b"".join(texts)
        out.append(("text", number, None, pa.compress(body, "zstd", asbytes=True) if body else b"", None, len(body), ids, held, sizes))
        grams, counts = block_grams(texts, training, depth)
        at = (hashed(grams) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(np.bincount(at, minlength=buckets))
        for b in range(buckets):
            own = order[ends[b - 1] if b else 0 : ends[b]]
            if len(own):
                out.append(("gram", number, b, pack_sorted(grams[own]), pack(counts[own]), len(own), None, None, None))
        times: Counter[bytes] = Counter()
        every: set[bytes] = set()
        for t, h in zip(texts, held):
            words = words_in(t)
            every.update(words) if h else times.update(words)
        for b, words in word_buckets([*every.union(times)], buckets).items():
            joined = b"\n".join(words)
            out.append((
                "word", number, b, pa.compress(joined, "zstd", asbytes=True),
                pack(np.array([times[w] for w in words], np.int64)), len(words), None, None, [len(joined)],
            ))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        ids, held, texts, total = [], [], [], 0
        for batch in batches:
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                body = (t.as_py() or b"").lower()
                if texts and (total + len(body) > block or len(texts) == BLOCK_TEXTS):
                    yield rows_of(uuid.uuid4().hex, ids, held, texts)
                    ids, held, texts, total = [], [], [], 0
                    give_back()
                ids.append(i)
                held.append(h)
                texts.append(body)
                total += len(body)
        if texts:
            yield rows_of(uuid.uuid4().hex, ids, held, texts)
        ids, held, texts = [], [], []
        give_back()

    return run


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _merged_buckets(suffixes: int):
    """A bucket's distinct grams with their counts, dealt out by their last two context bytes."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held_g, held_c, waiting = [grams], [counts], 0
        for n, k, c in zip(*(_column(table, x) for x in ("n", "keys", "counts"))):
            held_g.append(unpack_sorted(k, n))
            held_c.append(unpack(c, n, np.int64))
            waiting += n
            if waiting > 1 << 20:
                grams, counts = merge(held_g, held_c)
                held_g, held_c, waiting = [grams], [counts], 0
        grams, counts = merge(held_g, held_c)
        at = (hashed(grams >> U8 & np.uint64(0xFFFF)) % np.uint64(suffixes)).astype(np.int64)
        rows = []
        for s in np.unique(at).tolist():
            own = at == s
            rows.append((s, key[0].as_py(), pack_sorted(grams[own]), pack(counts[own]), int(own.sum())))
        return pa.table(dict(zip(("suffix", "bucket", "keys", "counts", "n"), map(list, zip(*rows)))), schema=_DISTINCT)

    return run


_DISTINCT = pa.schema([("suffix", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])
_TOP = pa.schema([("key", pa.int32()), ("zeros", pa.float64()), ("ones", pa.float64()), ("log_pw", pa.float64())])
_MODEL = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary()), ("n", pa.int64())])
_ANSWER = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("kind", pa.string()), ("vals", pa.binary()), ("n", pa.int64())])
_WORDS = pa.schema([*_ANSWER, ("types", pa.int64()), ("total", pa.int64())])


def _group(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    sizes = _column(table, "n")
    grams = np.concatenate([unpack_sorted(k, n) for k, n in zip(_column(table, "keys"), sizes)])
    counts = np.concatenate([unpack(c, n, np.int64) for c, n in zip(_column(table, "counts"), sizes)])
    return grams, counts, np.array(_column(table, "bucket")), sizes


def _subtree_sums(depth: int):
    def run(table: pa.Table) -> pa.Table:
        grams, counts, _, _ = _group(table)
        parts = []
        for own in whole_subtrees(grams):
            tree = Subtrees(grams[own], counts[own], depth)
            parts.append(pa.table([tree.top.astype(np.int32), *tree.sums], schema=_TOP))
        return pa.concat_tables(parts)

    return run


def _evaluated(depth: int, shared):
    def run(table: pa.Table) -> pa.Table:
        grams, counts, buckets, sizes = _group(table)
        values = np.zeros(len(grams), np.float32)
        for own in whole_subtrees(grams):
            values[own] = Subtrees(grams[own], counts[own], depth).log10(shared.value)
        ends = np.cumsum(sizes)
        parts = [pack(values[e - n : e]) for e, n in zip(ends.tolist(), sizes)]
        return pa.table([pa.array(buckets, pa.int32()), table.column("keys"), pa.array(parts, pa.binary()), table.column("n")], schema=_MODEL)

    return run


def _answered(requests: pa.Table, model: pa.Table) -> pa.Table:
    """A bucket's values, in the order in which each block named its grams."""
    sizes = _column(model, "n")
    grams = np.concatenate([np.zeros(0, np.uint64), *[unpack_sorted(k, n) for k, n in zip(_column(model, "keys"), sizes)]])
    values = np.concatenate([np.zeros(0, np.float32), *[unpack(v, n, np.float32) for v, n in zip(_column(model, "vals"), sizes)]])
    order = np.argsort(grams)
    grams, values = grams[order], values[order]
    ns = _column(requests, "n")
    out = [pack(values[np.searchsorted(grams, unpack_sorted(k, n))]) for k, n in zip(_column(requests, "keys"), ns)]
    return pa.table({
        "block": requests.column("block"), "bucket": requests.column("bucket"),
        "kind": pa.array(["gram"] * len(ns), pa.string()), "vals": pa.array(out, pa.binary()), "n": requests.column("n"),
    }, schema=_ANSWER)


def _word_counts(table: pa.Table) -> pa.Table:
    """A bucket's training counts, answered to each block; and the bucket's types and total."""
    totals: Counter[bytes] = Counter()
    columns = [*zip(*(_column(table, x) for x in ("block", "bucket", "keys", "counts", "n", "sizes")))]
    named = lambda k, s: pa.decompress(k, s[0], "zstd", asbytes=True).split(b"\n")
    for _, _, k, c, n, s in columns:
        for w, times in zip(named(k, s), unpack(c, n, np.int64).tolist()):
            if times:
                totals[w] += times
    rows = [(None, columns[0][1], "sum", None, 0, len(totals), sum(totals.values()))]
    for block, bucket, k, _, n, s in columns:
        counts = np.fromiter(map(totals.__getitem__, named(k, s)), np.int64, n)
        rows.append((block, bucket, "word", pack(counts), n, None, None))
    return pa.table(dict(zip(_WORDS.names, map(list, zip(*rows)))), schema=_WORDS)


def _scored(depth: int, buckets: int, tokens: int, types: int, ends: int, schema: pa.Schema):
    scale = np.log10(tokens + types + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        got = {(k, b): (v, n) for k, b, v, n in zip(*(_column(answers, x) for x in ("kind", "bucket", "vals", "n")))}
        parts = []
        for body, n, ids, held, sizes in zip(*(_column(texts, x) for x in ("keys", "n", "ids", "held", "sizes"))):
            whole = pa.decompress(body, n, "zstd", asbytes=True) if n else b""
            cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
            own = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
            places = sorted_places(own, depth)
            grams = distinct_grams(places)
            at = (hashed(grams) % np.uint64(buckets)).astype(np.int64)
            values = np.zeros(len(grams))
            order = np.argsort(at, kind="stable")
            stops = np.cumsum(np.bincount(at, minlength=buckets))
            for b in range(buckets):
                here = order[stops[b - 1] if b else 0 : stops[b]]
                if len(here):
                    v, m = got["gram", b]
                    values[here] = unpack(v, m, np.float32)
            scores = text_sums(places, len(own), grams, values)
            del places, grams, values
            split = [words_in(t) for t in own]
            place: dict[bytes, int] = {}
            counts = [np.zeros(0, np.int64)]
            for b, words in word_buckets([*set().union(*split)], buckets).items():
                for w in words:
                    place[w] = len(place)
                v, m = got["word", b]
                counts.append(unpack(v, m, np.int64))
            known = np.concatenate(counts)
            logs = np.log10(known + 1) - scale
            end = np.log10(ends + 1) - scale
            found = [np.fromiter(map(place.__getitem__, words), np.int64, len(words)) for words in split]
            parts.append(pa.table([
                pa.array(ids, schema.types[0]), pa.array(held, pa.bool_()),
                pa.array([len(f) + 1 for f in found], pa.int64()),
                pa.array([int((known[f] > 0).sum()) + (ends > 0) for f in found], pa.int64()),
                pa.array([tokens] * len(own), pa.int64()),
                pa.array([float(logs[f].sum()) + end for f in found], pa.float64()),
                pa.array(scores, pa.float64()),
            ], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return run


def scored(
    docs: DataFrame, held_out: Column, identifier: str = "doc_id", text: str = "text",
    depth: int = DEPTH, block: int = BLOCK, buckets: int | None = None,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Rows for which ``held_out`` is true are not learnt from. ``buckets`` defaults to the session's
    shuffle partitions, which are sized to the data.
    """
    if not TOP <= depth <= 5:
        raise ValueError("a gram and the number of its text share 64 bits, so the depth is 2 to 5")
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(identifier).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).cast("binary").alias("body"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    arrow_id = source.limit(0).toArrow().schema.field("doc_id").type
    schema = pa.schema([
        ("kind", pa.string()), ("block", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
        ("n", pa.int64()), ("ids", pa.list_(arrow_id)), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())),
    ])
    packed = staged(source.mapInArrow(
        _packed_blocks(depth, buckets, block, arrow_id, schema),
        f"kind string, block string, bucket int, keys binary, counts binary, n long, ids array<{id_type}>, held array<boolean>, sizes array<long>",
    ), "blocks")
    requests = packed.where("kind = 'gram'").select("block", "bucket", "keys", "counts", "n")
    distinct = staged(requests.groupBy("bucket").applyInArrow(
        giving_back(_merged_buckets(buckets)), "suffix int, bucket int, keys binary, counts binary, n long"
    ), "grams")
    # At most 255 * 256 rows reach the driver.
    top = distinct.groupBy("suffix").applyInArrow(giving_back(_subtree_sums(depth)), "key int, zeros double, ones double, log_pw double")
    top = top.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log_pw")]).toPandas()
    mixture = top_mixture(top["key"].to_numpy(np.int64), *[top[c].to_numpy(float) for c in ("zeros", "ones", "log_pw")])
    shared = spark.sparkContext.broadcast(mixture)
    model = distinct.groupBy("suffix").applyInArrow(giving_back(_evaluated(depth, shared)), "bucket int, keys binary, vals binary, n long")
    answer = "block string, bucket int, kind string, vals binary, n long"
    answers = requests.drop("counts").groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(giving_back(_answered), answer)
    words = staged(packed.where("kind = 'word'").select("block", "bucket", "keys", "counts", "n", "sizes").groupBy("bucket").applyInArrow(
        giving_back(_word_counts), answer + ", types long, total long"
    ), "words")
    sums = words.where("kind = 'sum'").agg(F.sum("types"), F.sum("total")).first()
    ends = packed.where("kind = 'text'").agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    tokens, types = (sums[1] or 0) + ends, (sums[0] or 0) + (ends > 0)
    out = pa.schema([
        ("doc_id", arrow_id), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ])
    answers = answers.unionByName(words.where("kind = 'word'").select("block", "bucket", "kind", "vals", "n"))
    texts = packed.where("kind = 'text'").select("block", "keys", "n", "ids", "held", "sizes")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        giving_back(_scored(depth, buckets, tokens, types, ends, out)),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
