"""The training order against plain arithmetic, near duplicates through the tree, letters of newer Unicode."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annexport.llm import bpe, queries, simhash, tokencount, trainingorder

SF = "/root/testdata/sf0.001"


# --- 1


def plain_slots(rows, length, key):
    """Rows (doc_id, seq, ids) in the order of their permuted ordinals, in whole numbers."""
    texts = {}
    for doc, seq, ids, size in rows:
        texts[doc] = max(texts.get(doc, 0), size)
    known = [d for d in texts if d is not None]
    low, high = min(known), max(known)
    most = max(1, -(-max(texts.values()) // length))
    bits = 62 - ((high - low + 2) * most).bit_length()
    domain = (high - low + 2) * most << bits
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    keys = [int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little") for r in range(4)]
    full = (1 << 64) - 1

    def walked(x):
        while True:
            left, right = x >> half, x & ((1 << half) - 1)
            for k in keys:
                m = (right ^ k) * 0x9E3779B97F4A7C15 & full
                m ^= m >> 32
                m = (m * 0xD6E8FEB86659FD93 & full) >> 24
                left, right = right, left ^ (m & ((1 << half) - 1))
            x = left << half | right
            if x < domain:
                return x

    def place(row):
        doc, seq, ids, _ = row
        own = 0 if doc is None else doc - low + 1
        tokens = xxhash.xxh64_intdigest(ids, 42) & ((1 << bits) - 1)
        return walked((own * most + seq) << bits | tokens), doc is not None, doc or 0, seq, ids

    return [(doc, seq, ids) for doc, seq, ids, _ in sorted(rows, key=place)]


def test_order_follows_from_data_and_key_alone(spark, tmp_path):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_VOCABULARY))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, "no id at all " * 90), (3, "another text of an id " * 50), (7, "x"), (7, "x"), (8, None)], "doc_id long, text string")
    docs = docs.unionByName(extra)
    length, orders = 64, []
    for n in (2, 3, 7):
        folder = f"file://{tmp_path}/{n}"
        shards = trainingorder.materialised(docs.repartition(n, F.rand(n)), ranks, folder, length=length, shards=n + 1)
        rows = trainingorder.read_shards(shards, folder).orderBy("slot").collect()
        assert [r.slot for r in rows] == list(range(len(rows)))
        orders.append([(r.doc_id, r.seq, r.ids_crc32) for r in rows])
    assert orders[0] == orders[1] == orders[2] and len(orders[0]) > 500
    import zlib

    sizes = docs.select("doc_id", F.octet_length("text").alias("size"), "text")
    plain = [
        (r.doc_id, r.seq, bytes(r.ids), 0) for r in trainingorder.sequences(docs, ranks, length=length).collect()
    ] + [(r.doc_id, -1, b"", r["size"] or 0) for r in sizes.collect()]
    want = [(d, s, zlib.crc32(i)) for d, s, i in plain_slots(plain, length, trainingorder.KEY) if s >= 0]
    assert orders[0] == want
    shuffled = trainingorder.materialised(docs, ranks, f"file://{tmp_path}/key", length=length, shards=2, key=9)
    other = trainingorder.read_shards(shuffled, f"file://{tmp_path}/key").orderBy("slot").collect()
    assert [(r.doc_id, r.seq, r.ids_crc32) for r in other] != orders[0]


def test_an_attempt_takes_no_shard_of_another_away(spark, tmp_path):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_VOCABULARY))
    docs = spark.createDataFrame([(k, f"text number {k} " * 30) for k in range(20)], "doc_id long, text string")
    folder = f"file://{tmp_path}"
    first = trainingorder.materialised(docs, ranks, folder, shards=2)
    rows = trainingorder.read_shards(first, folder).collect()
    second = trainingorder.materialised(docs, ranks, folder, shards=2)  # the same folder, as a repeated task would
    assert not {r.path for r in first.collect()} & {r.path for r in second.collect()}
    assert sorted(trainingorder.read_shards(first, folder).collect()) == sorted(rows)


@pytest.mark.parametrize("ids,kind", [(["b", "a", None], "string"), ([1.5, 2.5, None], "double"), ([-(2**62), 2**62, None], "long")])
def test_ids_that_cannot_be_counted(spark, tmp_path, ids, kind):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_VOCABULARY))
    docs = spark.createDataFrame([(i, f"some words for {i} " * 40) for i in ids], f"doc_id {kind}, text string")
    shards = trainingorder.materialised(docs, ranks, f"file://{tmp_path}", length=64, shards=2)
    rows = trainingorder.read_shards(shards, f"file://{tmp_path}").collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert len({r.doc_id for r in rows}) == 3 and None in {r.doc_id for r in rows}
    if kind == "long":
        assert {r.doc_id for r in rows} == set(ids)


# --- 7


def test_every_letter_is_lowered_as_the_library_does(spark):
    """All code points, a stretch of them at a time, as texts of their own words."""
    path = public_tokenizers.path(queries.WORD_VOCABULARY)
    own = Tokenizer.from_file(path)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    letters = [c for c in points if chr(c).isalpha() and chr(c).lower() != chr(c) or c in (0xA7CB, 0xA7DA, 0xA7DC)]
    assert {0xA7CB, 0xA7DC} <= set(letters)
    for c in letters:
        assert tokencount.normalised(f"a{chr(c)}b") == own.normalizer.normalize_str(f"a{chr(c)}b"), hex(c)
    texts = [" ".join(f"a{chr(c)}b {chr(c)}" for c in letters[k : k + 50]) for k in range(0, len(letters), 50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs, path).collect()}
    assert found == {k: len(own.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}


# --- 8


def brute_roots(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(values))]


def clustered(rng, n, band=None):
    """Fingerprints around a few centres, and others; with one band of 16 bits in common if asked."""
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
    values = set()
    while len(values) < n:
        v = rng.choice(centres) if rng.random() < 0.5 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        values.add(v if band is None else v & ~(0xFFFF << 16 * band) | 0xABCD << 16 * band)
    return sorted(values)


def test_tree_links_what_brute_force_links_with_fewer_comparisons():
    rng = random.Random(8)
    for n in (2, 3, 50, 900):
        values = clustered(rng, n)
        links = simhash.Links(n)
        places = np.arange(n)
        visits = simhash.link_by_tree(np.array(values, np.uint64), places, places, links, 3)
        assert links.roots(places).tolist() == brute_roots(values, 3)
    assert visits < 0.9 * n * n  # edges beyond the radius are not followed


@pytest.mark.parametrize("shard", [simhash.SHARD, 100])
def test_large_shards_go_through_the_tree(spark, monkeypatch, shard):
    """Fingerprints that share a band are one shard; the links are those of the tree alone."""
    values = clustered(random.Random(5), 600, band=2)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fp long")
    edges = simhash.local_edges(distinct, shard=shard).collect()
    place = {v[0]: k for k, v in enumerate(signed)}
    links = simhash.Links(len(values))
    for e in edges:
        links.unite(np.array([place[e.a]]), np.array([place[e.b]]))
    assert links.roots(np.arange(len(values))).tolist() == brute_roots(values, 3)
    # Without the tree there is no link at all.
    monkeypatch.setattr(simhash, "link_by_tree", lambda *a: 0)
    own = np.array(values, np.uint64)
    assert not len(simhash._link_group(own, np.ones(600, bool), np.ones(600, bool), 3)[0])
