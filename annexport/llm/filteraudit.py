"""Filter interaction audit: how five document filters overlap, in every order they can be applied in.

A document's mask holds the filters it fails, a bit each in the order of ``FILTERS``. A to D look at the text
alone. E fails documents whose text a smaller id has, anywhere in the table; it is found with
radix tries. Everything the audit reports follows from the numbers of documents by part and mask.

Tries. A task inserts the texts of a block into a compressed trie, whose terminals hold the least id
and one number (``origin``) for all rows of the text in the block; only the first of them carries the
text on. The texts are then parted by ranges of adaptive prefixes: from a bounded sample
(``SAMPLE`` rows, at most ``PREFIX`` bytes of each) ranges of about equal weight are cut, each by the shortest prefix that tells
its first text from the one before; a range whose texts share more than ``PREFIX`` bytes is parted further by the hash of
the whole text. The sample decides where a text is looked at, never what is found: equal texts always
meet. Each range inserts its whole texts into one trie with the least ids at its terminals and
walks it for the origins that have a smaller id elsewhere. Rows are joined to that by
origin, so no text travels more than once a block, and a text that a third of all rows share is
one row a block.

Edge cases: ids are whole numbers. A NULL text counts as empty. NULL and empty parts are one part, the empty string. A NULL id is
smaller than none, and none is smaller than it. Rows that repeat an id and its text do not
fail E by each other. A label counts for every row of its id; of several labels of an id any 1 counts; labels of unknown
documents count nowhere. An empty table gives an empty report. Extra columns of any name are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby, permutations

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import blocks, give_back, in_batches
from annexport.session import staged

FILTERS = "ABCDE"
DUPLICATE = 16  # the bit of E
MIN_WORDS = 100
DISTINCT = 80  # per cent of the words
CAPITALS = 10  # per cent of the code points
UPPER = bytes(range(0x41, 0x5B))
SYMBOLS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point

BLOCK = 16 << 20  # bytes of text in a task's trie
RANGE = 32 << 20  # bytes of text in a range's trie, about
SAMPLE = 50_000  # rows whose prefixes reach the driver, about
PREFIX = 256


class Trie:
    """Compressed radix trie over byte strings. A node is [label, children by first byte, value]."""

    def __init__(self) -> None:
        self.root: list = [b"", None, None]

    def place(self, text: bytes) -> list:
        """The node of ``text``, made where there is none; its value is the caller's."""
        node, at = self.root, 0
        while at < len(text):
            children = node[1]
            if children is None:
                children = node[1] = {}
            first = text[at]
            below = children.get(first)
            if below is None:
                leaf = children[first] = [text[at:], None, None]
                return leaf
            label = below[0]
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            k = shared_length(label, text, at)
            middle = children[first] = [label[:k], {label[k]: below}, None]
            below[0] = label[k:]
            node, at = middle, at + k
        return node

    def values(self) -> Iterator:
        """The values of all nodes that have one."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                yield node[2]
            if node[1]:
                stack.extend(node[1].values())


def shared_length(label: bytes, text: bytes, at: int) -> int:
    """How many bytes ``label`` shares with ``text`` from ``at``; not all of them."""
    same, step = 0, 16
    while label[same : same + step] == text[at + same : at + same + step] and same + step < len(label):
        same, step = same + step, 2 * step
    while step > 1:
        step //= 2
        if label[same : same + step] == text[at + same : at + same + step]:
            same += step
    return same


def text_mask(text: bytes) -> int:
    """The bits of A to D."""
    words = text.split()
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT * len(words)) << 1
        | (100 * capitals > CAPITALS * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


class Ranges:
    """Which range a text lies in: splitting prefixes, and by how much each range is parted by hash."""

    def __init__(self, sample: list[tuple[bytes, int]], weight: float) -> None:
        """``sample``: prefixes and lengths of texts; ``weight``: what a range is to hold of their lengths."""
        self.splitters: list[bytes] = []
        parts, held, before = [], 0.0, None
        for prefix, rows in groupby(sorted(sample), key=lambda row: row[0]):
            own = sum(length + 1 for _, length in rows)
            if before is not None and (held >= weight or own >= weight):
                k = next((i for i, (a, b) in enumerate(zip(prefix, before)) if a != b), len(before))
                self.splitters.append(prefix[: k + 1])
                parts.append(held)
                held = 0.0
            held += own
            before = prefix
        # A range that no prefix could cut in time is parted by hash.
        self.parts = [max(1, round(x / weight)) for x in [*parts, held]]
        self.first = [sum(self.parts[:k]) for k in range(len(self.parts))]

    def of(self, text: bytes) -> int:
        k = bisect_right(self.splitters, text)
        n = self.parts[k]
        return self.first[k] + (xxhash.xxh64_intdigest(text) % n if n > 1 else 0)


def adaptive_ranges(docs: DataFrame, text: str, bytes_each: int = RANGE, sample: int = SAMPLE) -> Ranges:
    """Ranges of about ``bytes_each``, and smaller ones where the tasks of a shuffle would be left idle."""
    spark = docs.sparkSession
    body = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    n = docs.count()
    share = min(1.0, sample / max(n, 1))
    rows = docs.select(F.substring(body, 1, PREFIX).alias("p"), F.octet_length(body).alias("n"))
    rows = (rows.sample(share, 1) if share < 1 else rows).toArrow()
    picked = list(zip(rows.column("p").to_pylist(), rows.column("n").to_pylist()))
    total = sum(x[1] + 1 for x in picked) / share
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Ranges(picked, share * max(1 << 20, min(bytes_each, total / (4 * tasks))))


_BLOCK = pa.schema([
    ("origin", pa.int64()), ("cell", pa.int64()), ("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
    ("least", pa.int64()), ("body", pa.binary()),
])
BLOCK_ROWS = "origin long, cell long, id long, part string, mask int, least long, body binary"


def _block_rows(ranges, block: int) -> Callable:
    """Rows of a block: id, part, mask and origin of each; range, least id and text with the first of an origin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, origin = ranges.value, TaskContext.get().partitionId() << 40

        def texts() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                    (t.as_py() or b"" for t in batch.column(2).cast(pa.binary())),
                )

        for rows in blocks(texts(), lambda row: len(row[2]) + 64, block):
            trie, out = Trie(), {name: [] for name in _BLOCK.names}
            firsts = []
            for identifier, part, text in rows:
                node = trie.place(text)
                value = node[2]
                if value is None:
                    value = node[2] = [origin, None, text_mask(text), len(out["origin"])]
                    firsts.append(value)
                    origin += 1
                    out["cell"].append(own.of(text))
                    out["body"].append(text)
                else:
                    out["cell"].append(None)
                    out["body"].append(None)
                if identifier is not None and (value[1] is None or identifier < value[1]):
                    value[1] = identifier
                out["origin"].append(value[0])
                out["id"].append(identifier)
                out["part"].append(part)
                out["mask"].append(value[2])
            by_origin = {value[0]: value[1] for value in firsts}
            out["least"] = [by_origin[o] for o in out["origin"]]
            yield pa.RecordBatch.from_pydict(out, schema=_BLOCK)
            del rows, trie, out, firsts
            give_back()

    return run


_FOUND = pa.schema([("origin", pa.int64()), ("smaller", pa.int64())])


def _smaller_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range's texts, the origins whose text has a smaller id than their own least one."""
    trie = Trie()
    for batch in batches:
        for origin, least, text in zip(batch.column("origin").to_pylist(), batch.column("least").to_pylist(), batch.column("body")):
            node = trie.place(text.as_py())
            value = node[2]
            if value is None:
                value = node[2] = [least, []]
            elif least is not None and (value[0] is None or least < value[0]):
                value[0] = least
            value[1].append((origin, least))
    origins, smaller = [], []
    for least, rows in trie.values():
        if least is not None and len(rows) > 1:
            for origin, own in rows:
                if own is None or own > least:
                    origins.append(origin)
                    smaller.append(least)
    del trie
    yield pa.RecordBatch.from_arrays([pa.array(origins, pa.int64()), pa.array(smaller, pa.int64())], schema=_FOUND)
    give_back()


def filter_masks(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text", part: str = "lang",
    block: int = BLOCK, bytes_each: int = RANGE,
) -> DataFrame:
    """(doc_id, part, mask) of every row; the bits of ``mask`` are the filters of ``FILTERS`` that the row fails."""
    source = in_batches(docs).select(
        F.col(identifier).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    )
    ranges = docs.sparkSession.sparkContext.broadcast(adaptive_ranges(source, "body", bytes_each))
    rows = staged(source.mapInArrow(_block_rows(ranges, block), BLOCK_ROWS), "trie_blocks")
    texts = rows.where("body is not null").select("cell", "origin", "least", "body")
    found = texts.groupBy("cell").applyInArrow(_smaller_ids, "origin long, smaller long")
    joined = rows.select("origin", "id", "part", "mask", "least").join(found, "origin", "left")
    duplicate = F.coalesce(F.col("id") > F.coalesce("smaller", "least"), F.lit(False))
    return joined.select(
        F.col("id").alias("doc_id"), "part",
        F.col("mask").bitwiseOR(F.when(duplicate, F.lit(DUPLICATE)).otherwise(F.lit(0))).alias("mask"),
    )


ORDERS = tuple("".join(p) for p in permutations(FILTERS))


def audit(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from rows of ``filter_masks`` and ``labels`` (doc_id, quality, toxic).

    A document is removed by a filter at its step if it fails it and none before. In how many of all
    orders that is so depends on the number of filters it fails alone, which gives the sums over all orders.
    """
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        one("quality").alias("good"), one("toxic").alias("toxic")
    )
    counts = masks.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    # At most 32 masks a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = parts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
    rows = rows.withColumn("step", F.explode(F.array(*[F.lit(k + 1) for k in range(len(FILTERS))])))

    def bit(step: Column) -> Column:
        letter = F.substring(F.col("filter_order"), step, F.lit(1))
        return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)

    rows = rows.withColumns({
        "own": bit(F.col("step")),
        "before": F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0), lambda a, s: a + bit(s)) - bit(F.col("step")),
    })
    fails = lambda m: m["mask"].bitwiseAND(F.col("own")) != 0
    earlier = lambda m: m["mask"].bitwiseAND(F.col("before")) != 0

    def total(chosen: Callable[[Column], Column], value: Callable[[Column], Column] = lambda m: m["n"]) -> Column:
        return F.aggregate(F.filter("masks", lambda m: chosen(m)), F.lit(0).cast("long"), lambda a, m: a + value(m).cast("long"))

    removed = lambda m: fails(m) & ~earlier(m)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & earlier(m)).alias("redundant"),
        total(lambda m: m["mask"] == F.col("own")).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(fails, lambda m: F.call_function("div", F.lit(len(ORDERS)), F.bit_count(m["mask"])) * m["n"]).alias("shapley"),
    )
