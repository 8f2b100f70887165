"""Documents whose columns have the names of statistics and results pass the pipeline's stages unchanged."""

import corpus_pipeline
from annexport.llm import outliers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "distance", "kept",
    "group_key", "_group", "doc", "score", "matches", "own", "fp", "least", "_fp", "component_id", "x0", "bin", "j",
)


def test_clashing_names_pass_every_stage(spark):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    docs = plain.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = stage(spark, docs, SF), stage(spark, plain, SF)
        assert docs.columns == [*plain.columns, *NAMES]
        rows = {r.doc_id: r for r in docs.collect()}
        assert set(rows) == {r.doc_id for r in plain.select("doc_id").collect()} and rows, name
        assert all(r[n] == f"{n} {i}" for i, r in rows.items() for n in NAMES)


def test_group_key_of_the_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = {r.doc_id: r.kept for r in outliers.outlier_verdicts(outliers.with_statistics(docs)).collect()}
    named = docs.withColumns({"group_key": F.lit("g"), "_group": F.lit(1), "_estimate": F.lit(2), "_y0": F.lit(3)})
    rows = outliers.outlier_verdicts(outliers.with_statistics(named)).collect()
    assert {r.doc_id: r.kept for r in rows} == plain
    assert {(r.group_key, r["_group"], r["_estimate"], r["_y0"]) for r in rows} == {("g", 1, 2, 3)}
