"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Every sequence has an ordinal below U, made of its data alone: its text's id, its number in the text, and some bits of
a hash of its tokens, which spread the sequences of a repeated id. A keyed
Feistel network permutes the smallest square power of two that holds U; a value of U or more is put
through it again (cycle walking) until it falls below U. Numbers that meet (of repeated rows) are told apart
by id, number in the text and tokens. So data and key alone fix a random order, however rows are dealt out,
and no table of the order is needed. U comes from the least and greatest id and the longest text, one row of an aggregation.

Shards are equal ranges of permuted numbers: one partition each, sorted, and written as one file of
records of equal length. A sequence's global slot is its rank: the rows of the shards before its
own, from the list of shards, and its place in the shard. So slots are 0..N-1 without gaps, and the
record of a slot is found by arithmetic: reading is sequential from any slot. (Ordinals without gaps
would need N first, and so a second copy of all tokens or a second tokenisation.) A shard is written under a name of its
attempt; only the list of shards says which attempt counts, so a task that is killed or repeated takes nothing away.

A record: id (int64; a 64-bit hash of ids that are no whole numbers), flags (uint16, 1: the id is not NULL), tokens (uint16), number of the sequence in
its text (uint32), then ``length`` ids, padded with zeros; all little-endian.

Edge cases: NULL and empty texts have no sequence and no slot. A NULL id is flagged. Repeated rows
have sequences of their own, which are equal, so their order is no one's. Long texts have as many sequences as they need. An empty table gives
no shard. Only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from annexport.llm.bpe import stretches
from annexport.llm.common import give_back, in_batches, utf8
from annexport.llm.warc import filesystem
from annexport.session import scratch_path, staged

LENGTH = 256  # tokens of a sequence
KEY = 0x5EED
ROUNDS = 4
HEAD = struct.Struct("<qHHI")
FIXED = struct.Struct("<QQI2s")
MAGIC = b"SLOTS\x01"


# --- the permutation


def half_bits(n: int) -> int:
    """Bits of each half of the network's domain, the smallest that holds 0..n-1."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def round_keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little") for r in range(ROUNDS)]


def feistel(values: np.ndarray, key: int, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = values >> np.uint64(bits), values & mask
    for k in round_keys(key):
        mixed = (right ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(24)
        left, right = right, left ^ (mixed & mask)
    return left << np.uint64(bits) | right


def permuted(ordinals: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each ordinal: a permutation of 0..n-1."""
    bits = half_bits(n)
    slots = feistel(ordinals.astype(np.uint64), key, bits)
    while (out := np.flatnonzero(slots >= np.uint64(n))).size:
        slots[out] = feistel(slots[out], key, bits)
    return slots.astype(np.int64)


def slot_of(ordinal: Column, n: int, key: int) -> Column:
    @F.arrow_udf("long")
    def of(ordinals: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in ordinals:
            yield pa.array(permuted(batch.to_numpy(zero_copy_only=False), n, key))

    return of(ordinal)


# --- sequences


def sequences(docs: DataFrame, ranks: dict[bytes, int], identifier: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, seq, ids): the texts' tokens in runs of ``length``, the last of a text shorter.

    ``ids`` are little-endian numbers of 2 bytes, or 4 where the vocabulary needs them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = id_type(ranks)

    @F.arrow_udf("array<binary>")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=shared.value, special_tokens={}
        )
        for batch in texts:
            rows = []
            for body in utf8(batch):
                parts = [encoding.encode_ordinary(part) for part in stretches(body.decode())]
                ids = np.concatenate([np.array(p, kind) for p in parts])
                rows.append([ids[k : k + length].tobytes() for k in range(0, len(ids), length)])
            yield pa.array(rows, pa.list_(pa.binary()))
            del rows
            give_back()

    return docs.select(whole_id(docs, identifier).alias("doc_id"), F.posexplode(of(F.col(text))).alias("seq", "ids"))


def whole_id(docs: DataFrame, identifier: str) -> Column:
    """The id as a whole number: itself, or a hash of one that is none."""
    own = F.col(identifier)
    if isinstance(docs.schema[identifier].dataType, IntegralType):
        return own.cast("long")
    return F.when(own.isNotNull(), F.xxhash64(own.cast("string")))


@dataclass(frozen=True)
class Ordinals:
    """Numbers below ``domain`` for (doc_id, seq, ids): from the data alone, so the same on any cluster."""

    low: int  # the least id
    ids: int  # ids from it to the greatest, and one for NULL
    most: int  # sequences of a text at most
    hashed: bool  # ids are too far apart to be counted from the least

    @classmethod
    def of(cls, docs: DataFrame, identifier: str, text: str, length: int) -> Ordinals:
        own = whole_id(docs, identifier)
        row = docs.agg(F.min(own), F.max(own), F.max(F.octet_length(F.col(text)))).first()
        low, high, longest = (0 if x is None else int(x) for x in row)
        most = max(1, -(-longest // length))  # no token is shorter than a byte
        ids = high - low + 2
        return cls(low, ids, most, ids * most > 1 << 60)

    @property
    def bits(self) -> int:
        """Bits of the tokens' hash that there is room for."""
        return 62 if self.hashed else max(0, 62 - (self.ids * self.most).bit_length())

    @property
    def domain(self) -> int:
        return 1 << 62 if self.hashed else (self.ids * self.most) << self.bits

    def column(self) -> Column:
        if self.hashed:
            return F.shiftrightunsigned(F.xxhash64("doc_id", "seq", "ids"), 2)
        own = F.coalesce(F.col("doc_id") - F.lit(self.low) + 1, F.lit(0).cast("long"))
        tokens = F.xxhash64("ids").bitwiseAND((1 << self.bits) - 1)
        return F.shiftleft(own * self.most + F.col("seq"), self.bits).bitwiseOR(tokens)


def id_type(ranks: dict[bytes, int]) -> str:
    return "<u2" if max(ranks.values()) < 1 << 16 else "<u4"


# --- shards


def stride(length: int, kind: str) -> int:
    return HEAD.size + length * np.dtype(kind).itemsize


def header(shard: int, length: int, kind: str, key: int) -> bytes:
    """A record's length of header: what a reader needs to know of the shard."""
    return (MAGIC + FIXED.pack(shard, key, length, kind[1:].encode())).ljust(stride(length, kind), b"\0")


def record(doc: int | None, seq: int, body: bytes, length: int, kind: str) -> bytes:
    head = HEAD.pack(doc or 0, doc is not None, len(body) // np.dtype(kind).itemsize, seq)
    return (head + body).ljust(stride(length, kind), b"\0")


def write_shards(
    rows: DataFrame, ordinals: Ordinals, folder: str, kind: str, shards: int, length: int = LENGTH, key: int = KEY
) -> DataFrame:
    """Writes sequences (doc_id, seq, ids); returns the list (shard, path, rows, first slot)."""
    if stride(length, kind) < len(MAGIC) + FIXED.size:
        raise ValueError("a record must be long enough for the header")
    domain = ordinals.domain

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)
        out, shard, count, path = None, -1, 0, ""
        done: list[tuple[int, str, int]] = []

        def close() -> None:
            out.close()
            done.append((shard, path, count))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(3)]
            for own, doc, seq, tokens in zip(*columns, batch.column(3)):
                if own != shard:
                    if out is not None:
                        close()
                    shard, count, path = own, 0, f"{root}/shard-{own:08d}-{uuid.uuid4().hex}.bin"
                    out = system.open_output_stream(path)
                    out.write(header(shard, length, kind, key))
                out.write(record(doc, seq, tokens.as_py(), length, kind))
                count += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([
            pa.array([s for s, _, _ in done], pa.int64()), pa.array([p for _, p, _ in done], pa.string()),
            pa.array([c for _, _, c in done], pa.int64()),
        ], names=["shard", "path", "rows"])

    slotted = rows.withColumn("permuted", slot_of(ordinals.column(), domain, key))
    each = F.lit(-(-domain // shards)).cast("long")
    slotted = slotted.withColumn("shard", F.call_function("div", F.col("permuted"), each).cast("int"))
    ranged = slotted.repartitionById(shards, "shard").sortWithinPartitions("permuted", "doc_id", "seq", "ids")
    listed = staged(ranged.select("shard", "doc_id", "seq", "ids").mapInArrow(write, "shard long, path string, rows long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    return listed.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def read_records(system: fs.FileSystem, path: str, skip: int = 0) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(place, doc_id, seq, ids) of a shard, from the place ``skip`` on: one seek, then in order."""
    size = system.get_file_info(path).size
    with system.open_input_file(path) as file:
        fixed = file.read(len(MAGIC) + FIXED.size)
        if fixed[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is not a shard")
        _, _, length, kind = FIXED.unpack(fixed[len(MAGIC) :])
        kind = "<" + kind.decode()
        step = stride(length, kind)
        if size % step:
            raise ValueError(f"{path} is cut off")
        at, rows = skip, size // step - 1
        file.seek((at + 1) * step)
        while at < rows:
            chunk = file.read(step * min(1024, rows - at))
            for k in range(0, len(chunk), step):
                doc, flags, n, seq = HEAD.unpack_from(chunk, k)
                yield at, doc if flags else None, seq, np.frombuffer(chunk, kind, n, k + HEAD.size)
                at += 1


def read_shards(shards: DataFrame, folder: str, from_slot: int = 0) -> DataFrame:
    """(slot, doc_id, seq, shard, n_tokens, ids_crc32) of the listed shards' records from a slot on."""
    names = ["slot", "doc_id", "seq", "shard", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(folder)
        for batch in batches:
            for shard, path, first in zip(*(batch.column(c).to_pylist() for c in range(3))):
                rows: list[tuple] = []
                for at, doc, seq, ids in read_records(system, path, max(0, from_slot - first)):
                    rows.append((first + at, doc, seq, shard, len(ids), zlib.crc32(ids.tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    left = shards.where(F.col("first") + F.col("rows") > from_slot).select("shard", "path", "first")
    return left.repartition(max(1, shards.count()), "shard").mapInArrow(
        read, "slot long, doc_id long, seq long, shard long, n_tokens long, ids_crc32 long"
    )


def materialised(docs: DataFrame, ranks: dict[bytes, int], folder: str, key: int = KEY, length: int = LENGTH, shards: int | None = None) -> DataFrame:
    """Writes the shards of all texts, by default as many as ``docs`` has partitions; returns their list."""
    rows = sequences(in_batches(docs), ranks, length=length)
    ordinals = Ordinals.of(docs, "doc_id", "text", length)
    return write_shards(rows, ordinals, folder, id_type(ranks), shards or max(1, docs.rdd.getNumPartitions()), length, key)


def shard_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "training-order")
