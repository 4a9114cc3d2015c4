"""A training-data pipeline over ``documents``: five stages, each working on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import jaccard, language, packing, secrets, toxicity
from brindle.llm.common import fold, table, written
from brindle.llm.queries import toxicity_model


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the table has them already."""
    out = []
    for name in names:
        while name in df.columns:
            name += "_"
        out.append(name)
    return out


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and texts without a letter, also where no row has a language to learn from."""
    pred, score = _fresh(docs, "lang_pred", "lang_score")
    model = language.train(language.training_windows(docs.where(fold("doc_id", 4) != 2), "text", "lang", "doc_id"))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.identify(docs, model, "text", pred, score).where(F.col(pred) != language.UNDETERMINED).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier predicts to be toxic."""
    score, predicted = _fresh(docs, "tox_score", "tox_predicted")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, "text", score, predicted).where(F.col(predicted) == 0).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document with the smallest doc_id (of texts that share it, the one with the smaller hash); rows that repeat it once.

    Texts that share a doc_id but no component stay. Rows without doc_id stay.
    """
    row, times = _fresh(docs, "_row", "_times")
    named = docs.where("doc_id is not null").withColumn(row, F.struct(F.col("doc_id").alias("k"), F.xxhash64("text").alias("h")))
    groups = jaccard.near_duplicates(named.select(row, "text"), row)
    first = written(groups.where(F.col("component_id") == F.col(row)).groupBy(row).agg(F.count(F.lit(1)).alias(times)), "firsts")
    kept = named.join(first.select(row), row, "left_semi")
    if not first.where(F.col(times) > 1).isEmpty():
        again = first.where(F.col(times) > 1).select(row)
        kept = kept.join(again, row, "left_anti").select(*docs.columns, row).unionByName(kept.join(again, row, "left_semi").select(*docs.columns, row).dropDuplicates([row]))
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces accepted secrets in the texts; keeps every document."""
    return secrets.redact(docs, secrets.train(spark))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None  # classifiers and greedy packing are beyond SQL; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
