"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL updates.

Features are word n-grams (1 and 2 words) and n-grams (1 to 3) of word shapes: case, digits, signs, a
length class, and whether a word repeats the one before. All are hashed to 2**18 weights. A text's
vector holds the share of its words at which each n-gram ends. Training goes over a bounded
sample (at most ``SAMPLE`` labelled rows, those with the least hash of id and label, and of these
as many as have ``SAMPLE_BYTES`` of text together, whole texts) in
hash order, with one follow-the-regularised-leader update a row; the model is one fixed-size array of
weights, so its broadcast has a bound. Scoring is a sparse dot product over the whole text.

Edge cases: a NULL or empty text has no feature and is scored by the bias alone. NULL
labels and ids without a document are not learnt from; repeated labels count once; an id with both
labels trains both; of rows that share an id, the least text is learnt from. Without any training row the score is 0.5 everywhere. Repeated rows get equal scores.
Extra columns pass through; a column named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annexport.llm.common import give_back, in_batches, utf8, worker_cache
from annexport.session import staged

BITS = 18
SIZE = 1 << BITS
SAMPLE = 6_000  # labelled rows at most
SAMPLE_BYTES = 32 << 20  # of their texts at most; with it a bound of what reaches the driver
PASSES = 3
THRESHOLD = 0.7
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SCALE = 3.0
KINDS = 5  # n-gram kinds that end at each word
SLICE = 1 << 20  # words whose n-grams are hashed at a time

def _shape(word: bytes) -> int:
    """Case, digits, signs at either end and a length class, as a number."""
    t = word.decode("utf-8", "replace")
    first, last = t[:1] or " ", t[-1:] or " "
    bits = (
        t.isupper() | t.islower() << 1 | first.isupper() << 2 | t.isalpha() << 3 | t.isalnum() << 4
        | t.isdigit() << 5 | first.isalnum() << 6 | last.isalnum() << 7
    )
    sign = 0 if last.isalnum() else ord(last)
    return ((sign << 12 | bits << 3 | min(len(t), 20) // 4) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


class _Words(dict):
    """Places of words in two arrays of hashes, of the lower-cased word and of its shape.

    Emptied before a text when it has grown large.
    """

    def __init__(self) -> None:
        super().__init__()
        self.word, self.shape = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        if place == len(self.word):
            self.word, self.shape = np.resize(self.word, 2 * place), np.resize(self.shape, 2 * place)
        self.word[place], self.shape[place] = xxhash.xxh64_intdigest(word.lower(), 0), _shape(word)
        return place

    def hashes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > 200_000:
            self.clear()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.word[places], self.shape[places]


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes + np.uint64(kind)) * MULTIPLIER >> np.uint64(64 - BITS)).astype(np.int64)


def ngram_slots(text: bytes) -> Iterator[np.ndarray]:
    """The slots of all n-grams of a text, a stretch of words at a time."""
    known = worker_cache("quality words", _Words)
    words, before = text.split(), [b"", b""]
    for k in range(0, len(words), SLICE):
        own = before + words[k : k + SLICE]
        before = own[-2:]
        word, shape = known.hashes(own)
        again = word[1:] == word[:-1]
        shape[1:] += again
        shape[2:] += np.uint64(2) * (word[2:] == word[:-2])
        mixed = word * np.uint64(3) ^ (word >> np.uint64(29))
        shaped = shape * np.uint64(7) ^ (shape >> np.uint64(31))
        yield _slots(word[2:], 11)
        yield _slots(mixed[1:-1] + word[2:], 23)
        yield _slots(shape[2:], 37)
        yield _slots(shaped[1:-1] + shape[2:], 41)
        yield _slots((shaped[:-2] * np.uint64(5) + shaped[1:-1]) * np.uint64(9) + shape[2:], 53)


def feature_vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: ``SCALE`` times the share of its words at which an n-gram ends."""
    parts = list(ngram_slots(text))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    slots, counts = np.unique(np.concatenate(parts), return_counts=True)
    return slots, counts * (SCALE * KINDS / counts.sum())


@dataclass(frozen=True)
class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates, for logistic loss."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = PASSES) -> np.ndarray:
        """Weights of ``SIZE`` slots and, last, the bias."""
        z, n, w = np.zeros(SIZE + 1), np.zeros(SIZE + 1), np.zeros(SIZE + 1)
        for _ in range(passes):
            for slots, values, label in rows:
                i, x = np.append(slots, SIZE).astype(np.int64), np.append(values.astype(np.float64), 1.0)
                p = 1 / (1 + np.exp(-np.clip(w[i] @ x, -35, 35)))
                g = (p - label) * x
                square = g * g
                rate = (np.sqrt(n[i] + square) - np.sqrt(n[i])) / self.alpha
                z[i] += g - rate * w[i]
                n[i] += square
                active = np.maximum(np.abs(z[i]) - self.l1, 0)
                w[i] = -np.sign(z[i]) * active / ((self.beta + np.sqrt(n[i])) / self.alpha + self.l2)
        return w


def score(text: bytes, weights: np.ndarray) -> float:
    """The same dot product, summed n-gram by n-gram."""
    total, n = 0.0, 0
    for slots in ngram_slots(text):
        total += weights[slots].sum()
        n += len(slots)
    margin = weights[SIZE] + (SCALE * KINDS * total / n if n else 0.0)
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def _vectors(text: Column) -> Column:
    @F.arrow_udf("struct<slots:array<int>,values:array<float>>")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            slots, values = [], []
            for t in utf8(batch):
                own = feature_vector(t)
                slots.append(own[0].astype(np.int32))
                values.append(own[1].astype(np.float32))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in slots]))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate(x)) if x else pa.array([], pa.list_(kind))
                     for x, kind in ((slots, pa.int32()), (values, pa.float32()))]
            yield pa.StructArray.from_arrays(lists, names=["slots", "values"])
            del slots, values, lists
            give_back()

    return of(text)


def train(
    docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE, passes: int = PASSES,
) -> np.ndarray:
    """Weights from at most ``sample`` labelled rows. Only their hashed vectors reach the driver."""
    known = labels.select(F.col(identifier).alias("id"), F.col(label).alias("label")).where("label is not null")
    rows = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text"))
    # Ids are joined without their texts and the sample is cut there: it is a few numbers a row and
    # ``sample`` rows at most, which bounds the broadcast.
    chosen = known.distinct().join(rows.select("id").distinct(), "id")
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("id", "label"), "id", "label").limit(sample))
    sampled = staged(rows.join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).withColumn(
        "o", F.xxhash64("id", "label")
    ), "sample")
    # The running sum is over ids and lengths of the sample alone.
    upto = Window.orderBy("o", "id", "label").rowsBetween(Window.unboundedPreceding, 0)
    sums = sampled.select("o", "id", "label", F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(upto).alias("bytes"))
    sampled = sampled.join(F.broadcast(sums.where(F.col("bytes") <= SAMPLE_BYTES).drop("bytes")), ["o", "id", "label"])
    vectors = in_batches(sampled).select(
        "o", "id", "label", _vectors(F.col("text")).alias("v")
    ).toArrow().sort_by([("o", "ascending"), ("id", "ascending"), ("label", "ascending")])
    labels_of = vectors.column("label").to_pylist()
    vectors = vectors.column("v").combine_chunks()
    # Views of the one copy that came to the driver; a row is widened when its turn comes.
    lists = [vectors.field(name) for name in ("slots", "values")] if len(vectors) else []
    ends = [x.offsets.to_numpy() for x in lists]
    flat = [x.values.to_numpy() for x in lists]
    weights = Ftrl().fit([
        (*(x[e[k] : e[k + 1]] for x, e in zip(flat, ends)), y) for k, y in enumerate(labels_of)
    ], passes)
    del vectors, lists, flat
    give_back()
    return weights


def quality_score(docs: DataFrame, weights: np.ndarray, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text in column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value.astype(np.float64)
        for batch in texts:
            yield pa.array([score(t, own) for t in utf8(batch)], pa.float64())
            give_back()

    return in_batches(docs).withColumn(into, of(F.col(text)))
