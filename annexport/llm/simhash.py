"""SimHash near-dedup with BK-trees.

Fingerprints: a bit of 64 is set if more than half of a text's shingle hashes set it. Equal
fingerprints are merged first, so a group of copies is one row from then on. Two fingerprints that
differ in at most ``radius`` bits agree on at least one of four bands of 16 bits (radius 3: three
bands can differ), so every link lies inside a shard keyed by a band. Each
shard is a BK-tree: the children of a node are keyed by their integer Hamming
distance to it, and a search follows only edges within the radius. Trees stay in the task that
builds them, because a tree of all fingerprints has no size bound that would allow a broadcast.
A bucket over ``SHARD`` members is cut into shards; every pair of its shards is a task of its own,
so no link is lost and no task outgrows its memory. A task sends on one edge per member, to the
least fingerprint of its local component, never all pairs.

Components: large-star and small-star steps over staged edges until the edges no longer change.

Edge cases: NULL, empty and blank texts have fingerprint zero and link like others. A NULL id takes
no part in the minimum; a component of NULL ids alone has a NULL component id. Repeated rows are
rows of one class. Only the id and text columns are read, so other columns cannot clash. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import fresh, give_back, in_batches, utf8
from annexport.session import staged

RADIUS = 3
SHINGLE = 3
SEED = 42
SHARD = 4096  # members of a bucket that one tree may hold
SLICE = 1 << 16  # hashes whose bytes are counted at a time
PLACES = (np.arange(8) * 256).astype(np.int64)  # a count for each place and value of a byte
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BANDS = 4  # runs of 16 bits


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, repeats included; fewer words: the whole sequence."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]
    values = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    seen = np.zeros(2048, np.int64)
    for k in range(0, len(values), SLICE):
        seen += np.bincount((values[k : k + SLICE] + PLACES).ravel(), minlength=2048)
    ones = seen.reshape(8, 256) @ BITS
    return int(np.packbits(2 * ones.ravel() > len(values), bitorder="little").view("<u8")[0])


def fingerprints(text: Column) -> Column:
    """The fingerprint as a signed long (the same 64 bits)."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = np.array([fingerprint(t) for t in utf8(batch)], np.uint64)
            yield pa.array(found.view(np.int64))
            give_back()

    return of(text)


class Links:
    """Union-find over places 0..n-1 in which the least place is the root."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                return found
            found = above

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.roots(a), self.roots(b)
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        pairs = set(zip(low[apart].tolist(), high[apart].tolist()))
        for x, y in pairs:
            x, y = int(self.roots(np.array([x]))[0]), int(self.roots(np.array([y]))[0])
            if x != y:
                self.parent[max(x, y)] = min(x, y)
        self.parent[a] = self.roots(a)
        self.parent[b] = self.roots(b)


def distances(values: np.ndarray, places: np.ndarray, node: int) -> np.ndarray:
    """Hamming distances of the fingerprints at ``places`` to that at ``node``: numbers, or rows of numbers."""
    found = np.bitwise_count(values[places] ^ values[node])
    return found.astype(np.int64) if found.ndim == 1 else found.sum(axis=1, dtype=np.int64)


def link_by_tree(values: np.ndarray, members: np.ndarray, queries: np.ndarray, links: Links, radius: int) -> int:
    """Links every query to the tree members within the radius. Returns the comparisons made, of a query and a node.

    The tree and the search advance together: the first member is the node; the others go to the
    child keyed by their distance to it; a query follows the children whose key is within the
    radius of its own distance.
    """
    stack, visits = [(members, queries)], 0
    while stack:
        members, queries = stack.pop()
        node, rest = members[0], members[1:]
        to_queries = distances(values, queries, node)
        visits += len(queries)
        near = queries[(to_queries <= radius) & (queries != node)]
        if len(near):
            links.unite(near, np.full(len(near), node))
        if not len(rest):
            continue
        keys = distances(values, rest, node)
        for key in [keys[0]] if len(rest) == 1 else np.unique(keys):
            onward = queries[np.abs(to_queries - key) <= radius]
            if len(onward):
                stack.append((rest[keys == key], onward))
    return visits


def _link_group(values: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, least member of its local component) of one bucket, or pair of shards."""
    order = np.argsort(values)
    values, tree, query = values[order], tree[order], query[order]
    links = Links(len(values))
    if tree.any() and query.any():
        link_by_tree(values, np.flatnonzero(tree), np.flatnonzero(query), links, radius)
    places = np.arange(len(values))
    roots = links.roots(places)
    moved = roots != places
    return values[moved], values[roots[moved]]


def _local_edges(radius: int):
    """Over batches sorted by (bucket, i, j): each group's edges; a group may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(rows: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s == 1:
                    continue
                v = rows["fp"][s:e].view(np.uint64)
                x, y = _link_group(v, rows["tree"][s:e], rows["query"][s:e], radius)
                a.append(x)
                b.append(y)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            if rest is not None:
                rows = {n: np.concatenate((rest[n], rows[n])) for n in rows}
            if not len(rows["fp"]):
                continue
            group = np.stack([rows["bucket"], rows["i"], rows["j"]])
            starts = np.concatenate(([0], 1 + np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0))))
            if len(starts) > 1:
                yield edges(rows, starts[:-1], starts[1:])
            rest = {n: v[starts[-1] :] for n, v in rows.items()}
        if rest is not None:
            yield edges(rest, np.array([0]), np.array([len(rest["fp"])]))

    return run


def _bucket_keys(fp: Column) -> Column:
    return F.array(*[
        F.shiftrightunsigned(fp, 16 * k).bitwiseAND(0xFFFF) + F.lit(k << 16).cast("long") for k in range(BANDS)
    ])


def local_edges(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Edges (a, b), a > b as unsigned numbers, that connect all links among ``fp`` of ``distinct``."""
    if radius > 3:
        raise ValueError("four bands hold every link up to a radius of 3")
    keyed = distinct.select("fp", F.explode(_bucket_keys(F.col("fp"))).alias("bucket"))
    sizes = staged(keyed.groupBy("bucket").count().where("count > 1"), "buckets")
    keyed = keyed.join(sizes, "bucket")  # buckets of one member hold no link
    shards = F.ceil(F.col("count") / shard).cast("int")
    own = F.pmod(F.xxhash64("fp"), shards).cast("int")
    rows = keyed.select("bucket", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), shards - 1)).alias("other"))
    rows = rows.select(
        "bucket", "fp",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("tree"), (F.col("own") >= F.col("other")).alias("query"),
    )
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(
        _local_edges(radius), "a long, b long"
    ).distinct()


def _rank(x: Column) -> Column:
    """Orders signed longs as the unsigned numbers they stand for."""
    return x.bitwiseXOR(F.lit(-(2**63)))


def _unrank(x: Column) -> Column:
    return x.bitwiseXOR(F.lit(-(2**63)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for all nodes with an edge.

    ``edges`` (a, b) are of longs. Every round joins each node's neighbours to its least
    neighbour (large star: the larger ones; small star: the others). The least neighbours are
    staged, so the join's sides are plain shuffles whose skewed partitions Spark can split.
    """
    rows = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    rows = staged(rows.distinct(), "edges")
    last = None
    while True:
        both = rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), "large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        rows = staged(small.distinct(), "edges")
        now = tuple(rows.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(a % 65537 + b % 65521)")).first())
        if now == last:
            return rows.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                rows.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        last = now


def near_duplicates(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text", radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """(doc_id, fp, component_id) per row: the least id among the rows reachable over links."""
    marked = staged(in_batches(docs).select(F.col(identifier).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "fingerprints")
    classes = classes_of(marked, radius, shard)
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def classes_of(marked: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(fp, component_id, keeper) for the distinct fingerprints of staged rows (doc_id, fp)."""
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    return linked_classes(distinct, local_edges(distinct.select("fp"), radius, shard))


def linked_classes(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, component_id, keeper) for staged (fp, least id) under edges (a, b) of fingerprints.

    ``keeper`` is true for one fingerprint of each component: that of the least id, then the least
    one; a NULL id comes last.
    """
    roots = components(
        edges.select(_rank(F.col("a")).alias("a"), _rank(F.col("b")).alias("b"))
    ).select(_unrank(F.col("node")).alias("fp"), F.col("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", _rank(F.col("fp"))))
    rooted = staged(rooted, "rooted")
    order = F.struct(F.col("least").isNull(), F.col("least"), _rank(F.col("fp")).alias("fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min(order)["fp"].alias("first"))
    joined = rooted.join(staged(least, "components"), "root")
    return staged(joined.select("fp", "component_id", (_rank(F.col("fp")) == F.col("first")).alias("keeper")), "classes")


def keep_one(docs: DataFrame, identifier: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id, then the least fingerprint."""
    marked = staged(docs.select(F.col(identifier).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "fingerprints")
    return kept_rows(docs, marked, classes_of(marked, radius), fingerprints(F.col(text)), identifier)


def kept_rows(docs: DataFrame, marked: DataFrame, classes: DataFrame, fp: Column, identifier: str) -> DataFrame:
    """The rows of ``docs`` with the fingerprint and id of their component's keeper; of repeated rows, one.

    A component of NULL ids alone keeps a row with a NULL id. The fingerprint is computed in the row
    again (``fp``) rather than carried: texts are read twice and written never.
    """
    joined = marked.join(classes.where("keeper"), "fp")
    kept = staged(joined.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fp").count(), "kept")
    key, count = fresh(docs, "_fp"), fresh(docs, "_count")
    # Ids repeat rarely: only those rows are made distinct.
    keepers = kept.select(F.col("doc_id").alias(identifier), F.col("fp").alias(key), F.col("count").alias(count))
    rows = docs.withColumn(key, fp)
    same = rows[identifier].eqNullSafe(keepers[identifier]) & (rows[key] == keepers[key])
    rows = rows.join(keepers, same).select(rows["*"], keepers[count])
    single = rows.where(F.col(count) == 1)
    repeated = rows.where(F.col(count) > 1).dropDuplicates([identifier, key])
    return single.unionByName(repeated).select(docs.columns)
