"""The pipeline's stages, each on its own input."""

import pytest

pytest.importorskip("brindle.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**9, "12345 !!", "en", "s", 8), (10**9 + 1, None, None, None, None), (10**9 + 2, 'clean words here with token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" inside', "en", "s", 80)], docs.schema)
    docs = docs.unionByName(extra).withColumn("lang_pred", F.lit("clash"))
    docs.write.mode("overwrite").parquet(f"{corpus_pipeline.written(docs.limit(1), 'x').inputFiles()[0].rpartition('/')[0]}-docs")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r[0] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.written(stage(spark, docs, SF), "stage")
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r[0] for r in docs.select("doc_id").collect()}
        assert after <= before
        if name == "language ID":
            assert before - after == {10**9, 10**9 + 1}
        if name == "secret scans":
            assert after == before and docs.where(f"doc_id = {10**9 + 2}").first().text == 'clean words here with token = "[SECRET]" inside'
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == after


def test_near_duplicate_stage_keeps_one(spark):
    t = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(3, t), (1, t), (1, t), (2, t + " more"), (5, "other text entirely made here"), (None, "no key")], "doc_id long, text string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()
    assert sorted((r.doc_id or -1) for r in got) == [-1, 1, 5]


def test_texts_that_share_an_id(spark):
    """Different texts under one doc_id are documents of their own; a copy of a smaller id's text goes, its namesake stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, c), (3, b + " more"), (None, a)], "doc_id long, text string").withColumn("_row", F.lit(1))
    got = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    assert got == {(1, a), (2, b), (3, c), (None, a)}


def test_near_duplicate_stage_against_plain_components(spark):
    from test_exact import plain_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {i for i, (_, root) in plain_components([(r.doc_id, r.text) for r in docs.collect()]).items() if i == root}
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()} == want


def test_empty_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage in (f for _, f in corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0
    few = docs.orderBy("doc_id").limit(20)
    twice = few.unionAll(few)
    assert {r.doc_id for r in corpus_pipeline.language_stage(spark, twice.withColumn("lang", F.lit(None).cast("string")), SF).collect()} == {r.doc_id for r in few.where(F.col("text").rlike(r"\p{L}")).collect()}
    once = corpus_pipeline.near_duplicate_stage(spark, twice, SF)
    ids = [r.doc_id for r in once.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, few, SF).collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
