"""Classifiers: held-out accuracy, defined results for odd rows."""

import pytest

pytest.importorskip("brindle.llm")
from pyspark.sql import functions as F

from brindle.llm import language, queries, toxicity
from brindle.llm.common import fold

SF = "/root/testdata/sf0.01"


def odd(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "x"), (3, "123 !!!", "x"), (4, "der und die " * 20000, "x"), (None, "the of and", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_language_held_out(spark):
    got = queries.op1_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("ok"), "score").collect()
    assert sum(r.ok for r in rows) / len(rows) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_learns_nothing_from_the_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    other = docs.withColumn("lang", F.when(fold("doc_id", 4) == 2, F.lit("zz")).otherwise(F.col("lang")))
    a, b = (language.training_windows(d.where(fold("doc_id", 4) != 2), "text", "lang", "doc_id") for d in (docs, other))
    assert a == b and a


def test_language_odd_rows(spark):
    model = language.train([("de", b"der und die das ist nicht") for _ in range(9)] + [("en", b"the of and to is not was") for _ in range(9)], 60)
    got = [(r.doc_id, r.lang_pred) for r in language.identify(odd(spark), model).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (1, "und"), (2, "und"), (3, "und"), (4, "de"), (None, "en")], key=str)
    assert language.identify(odd(spark).limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(odd(spark), None).collect()} == {"und"}


def test_only_letters_have_a_language(spark):
    model = language.train([("de", b"der und die das ist nicht") for _ in range(9)] + [("en", b"the of and to is not was") for _ in range(9)], 60)
    rows = spark.createDataFrame([(1, "\u00bd"), (2, "\u00b2 \u00b3"), (3, "\u0663\u0664"), (4, "_ \u2167"), (5, "\u00e9"), (6, "\u65e5"), (7, "1a")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in language.identify(rows, model).collect()} == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: False}


def test_toxicity_empty_table_and_clashing_names(spark):
    import numpy as np

    docs = spark.createDataFrame([(i, "bad moron" if i % 2 else "good day", "en", "s", 1.5, "p") for i in range(40)], "doc_id long, text string, lang string, source string, score double, predicted string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (None, 1), (999, 0), (4, 7), (5, None)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels, "text", "doc_id", "toxic", "lang")
    assert len(got[0]) == 40 and got[1].tolist().count(1) == 20
    model = toxicity.train(*got)
    out = toxicity.score_toxicity(docs, model)
    assert out.columns.count("score") == 1 == out.columns.count("predicted") and dict(out.dtypes)["predicted"] == "int" and out.count() == 40
    assert {(r.doc_id % 2, r.predicted) for r in out.collect()} == {(0, 0), (1, 1)}
    empty = toxicity.training_rows(docs.limit(0), labels.limit(0), "text", "doc_id", "toxic", "lang")
    assert toxicity.train(*empty) is None and toxicity.score_toxicity(docs.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}
    assert not len(np.concatenate([empty[1]]))


def test_tables_equal_plain_convolution():
    import numpy as np

    net = language.ByteConvNet(["a", "b"])
    x = np.random.default_rng(1).integers(0, language.CLASSES, (3 * language.WINDOW + 3,)).astype(np.uint8)
    wide = np.stack([x[i * language.WINDOW : (i + 1) * language.WINDOW + 3] for i in range(3)])
    z, _ = net._pool(wide)
    assert np.allclose(net.window_logits(x), np.maximum(z, 0) @ net.d + net.c, atol=1e-4)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    c = got.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in c}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.85


def test_toxicity_odd_rows(spark):
    import numpy as np

    words = [["good", "day", "nice"], ["good", "moron", "bad"]]
    texts = [" ".join(np.random.default_rng(i).choice(words[i % 2], 6)) + (" moron" if i % 2 else "") for i in range(120)]
    from brindle.llm.common import text_bytes
    import pyarrow as pa

    raw, at = text_bytes(pa.array(texts))
    ids, offsets = toxicity.word_ids(raw, at)
    docs = [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
    model = toxicity.train(docs, np.array([i % 2 for i in range(120)]), ["en"] * 120)
    rows = [(1, None), (2, ""), (3, "nice good day"), (4, "good moron"), (4, "good moron"), (5, "nice " * 100000 + "moron")]
    got = [(r.doc_id, r.predicted) for r in toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert sorted(got) == [(1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 1)]
    assert toxicity.train([], np.zeros(0, int), []) is None


def test_toxicity_alone_equals_batched():
    import numpy as np
    import pyarrow as pa

    from brindle.llm.common import text_bytes

    texts = ["a b c d", "", "x", "long " * 300 + "end", "p q"]
    model = toxicity.WordConvNet()
    raw, at = text_bytes(pa.array(texts))
    ids, off = toxicity.word_ids(raw, at)
    whole = model.pooled(ids, off, block=64)
    for i in range(len(texts)):
        assert np.allclose(whole[i], model.pooled(ids[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]])), atol=1e-5)
