"""The classifier against a plain replica, operators on empty tables, and pipeline stages against plain versions."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from annexport.llm import bpe, pii, quality, queries, tokencount, urlfilter

SF = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string, url string"


# --- 6


def plain_ftrl(rows, passes, alpha=0.5, beta=1.0, l1=0.02, l2=0.1):
    """Weights by slot, one number at a time."""
    z, n, w = defaultdict(float), defaultdict(float), defaultdict(float)
    for _ in range(passes):
        for features, label in rows:
            x = {**features, quality.SIZE: 1.0}
            margin = sum(w[i] * v for i, v in x.items())
            p = 1 / (1 + math.exp(-max(-35, min(35, margin))))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
                w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)
    return w


def plain_features(text):
    """Shares of the n-grams of a text by slot, as counted one by one."""
    counts = Counter(int(s) for part in quality.ngram_slots(text) for s in part)
    total = sum(counts.values())
    return {s: float(np.float32(c * (quality.SCALE * quality.KINDS / total))) for s, c in counts.items()}


def test_training_equals_a_plain_replica(spark):
    """The whole operator: sample, order, features, updates and scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(60)
    labels = spark.createDataFrame(labels.collect(), labels.schema)
    weights = quality.train(docs, labels, passes=2)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    order = labels.select("doc_id", "quality", F.xxhash64("doc_id", F.col("quality")).alias("o")).orderBy("o").collect()
    rows = [(plain_features(texts[r.doc_id]), r.quality) for r in order if r.doc_id in texts]
    assert len(rows) > 40
    want = plain_ftrl(rows, 2)
    assert {int(i) for i in np.flatnonzero(weights)} == {i for i, v in want.items() if v}
    assert all(abs(weights[i] - v) < 1e-9 for i, v in want.items())
    scored = quality.quality_score(docs, weights).select("doc_id", "score").collect()
    for r in scored:
        margin = sum(want[s] * v for s, v in plain_features(texts[r.doc_id]).items()) + want[quality.SIZE]
        assert abs(r.score - 1 / (1 + math.exp(-margin))) < 1e-5


def test_the_sample_is_bounded_by_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"word{k} " * 100) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    fitted = []
    monkeypatch.setattr(quality.Ftrl, "fit", lambda self, rows, passes: fitted.append(len(rows)) or np.zeros(quality.SIZE + 1))
    quality.train(docs, labels)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 5000)
    quality.train(docs, labels)
    assert fitted[0] == 40 and 5 <= fitted[1] <= 8


# --- empty tables


def test_empty_tables(spark):
    docs = spark.createDataFrame([], EMPTY)
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_VOCABULARY))
    assert bpe.encoded(docs, ranks).count() == 0
    assert tokencount.token_counts(docs, public_tokenizers.path(queries.WORD_VOCABULARY)).count() == 0
    assert urlfilter.judged(docs, queries.RULES).count() == 0
    weights = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.quality_score(docs, weights).count() == 0 and not weights.any()
    assert pii.personal_data(docs).count() == 0


def test_repeated_urls(spark):
    pages = spark.createDataFrame([("http://a.net/x",)] * 3 + [(None,)] * 2, "url string")
    rows = urlfilter.judged(pages, queries.RULES).collect()
    assert Counter(r.judged.verdict for r in rows) == {"block": 3, "allow": 2}


# --- stages


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, corpus_pipeline.quality_rules(spark, docs, "/root/testdata/sf0.01")


def test_stage_classifier_keeps_what_a_plain_score_keeps(spark, judged):
    docs, _ = judged
    sf_dir = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, sf_dir).select("doc_id").collect()}
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).astype(np.float32)
    for r in docs.collect():
        margin = sum(float(weights[s]) * v for s, v in plain_features((r.text or "").encode()).items()) + float(weights[quality.SIZE])
        score = 1 / (1 + math.exp(-margin))
        assert abs(score - quality.THRESHOLD) < 1e-4 or (score >= quality.THRESHOLD) == (r.doc_id in kept)


def test_stage_encoding_digests(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ranks = bpe.read_ranks(public_tokenizers.path(queries.BPE_VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = corpus_pipeline.encoding(spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
