"""Queries over whole tables against plain versions."""

import collections
import unicodedata

import duckdb
from pyspark.sql import functions as F

from brindle.operators import catalog
from brindle.plans import queries

SF = "/root/testdata/sf0.001"


def rows(spark, table, *columns):
    return spark.read.parquet(f"{SF}/{table}.parquet").select(*columns).collect()


def words(text):
    """Distinct words: lower case, punctuation and symbols as spaces."""
    return {w for w in "".join(" " if unicodedata.category(c)[0] in "PS" else c for c in (text or "").lower()).split()}


def test_structured_match(spark):
    parts = rows(spark, "part", "p_partkey", "p_name", "p_brand", "p_type")
    want = {(a[0], b[0]) for a in parts for b in parts if a[0] != b[0] and a[1] == b[1] and (a[2] == b[2] or b[3] == "ECONOMY")}
    got = [tuple(r) for r in queries.QUERIES["structured_match"](spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want


def test_structured_match_of_large_groups(spark, tmp_path):
    """One name spreads over many tasks, and a part without a name or brand matches as in SQL."""
    brands, types = ["a", "b", "c", None], ["ECONOMY", "SMALL", None]
    parts = [(i, None if i % 50 == 0 else "Blue Ring" if i % 10 else "old bolt", brands[i % 4], types[i % 3]) for i in range(600)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    assert sorted(map(tuple, queries.QUERIES["structured_match"](spark, str(tmp_path)).collect())) == sorted(con.sql(queries.ORACLES["structured_match"]).fetchall())
    one = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("l"))
    made = catalog.pairs_in_blocks(one, one.withColumnRenamed("l", "r"), ["k"], "r", block=100, pairs=50_000).withColumn("_part", F.spark_partition_id()).groupBy("_part").count().collect()
    assert sum(r["count"] for r in made) == 1_000_000 and max(r["count"] for r in made) < 300_000
    assert catalog.pairs_in_blocks(one.where("l < 0"), one.withColumnRenamed("l", "r"), ["k"], "r").count() == 0


def test_row_fingerprint_of_late_and_odd_parts(spark, tmp_path):
    keys = [0, 9998, 9999, 10000, 99_998, 99_999, 123_456, 999_998, 999_999, 1_234_567, -1, -5, None]
    parts = [(k, "n", "b", 5) for k in keys] + [(1, None, "b", 5), (2, "n", None, 5), (3, "n", "b", None), (4, "", "", 0), (5, "n", "b", 10_000_000), (6, "ü", "日本", -2_147_483_648)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    got = {tuple(r) for r in queries.QUERIES["row_fingerprint"](spark, str(tmp_path)).collect()}
    assert got == set(con.sql(queries.ORACLES["row_fingerprint"]).fetchall()) and len(got) == len(parts)


def test_similar_documents_top3(spark):
    docs = [(r.doc_id, r.source, words(r.text)) for r in rows(spark, "documents", "doc_id", "source", "text")]
    want = set()
    for item in rows(spark, "benchmark", "item_id", "text"):
        need, best = words(item.text), {}
        for doc, source, have in docs:
            score = len(need & have) / len(need)
            if score >= 0.6:
                best[source] = min(best.get(source, (0, 0)), (-score, doc))
        top = sorted((s, doc, source) for source, (s, doc) in best.items())[:3]
        want |= {(item.item_id, doc, source, round(-s, 6), k) for k, (s, doc, source) in enumerate(top, 1)}
    got = [(r.id, r.rec, r.owner, r.score, r["rank"]) for r in queries.QUERIES["similar_documents_top3"](spark, SF).collect()]
    assert want and len(got) == len(want) and set(got) == want


def test_observed_rollup(spark):
    lines = collections.defaultdict(list)
    for r in rows(spark, "lineitem", "l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_suppkey"):
        lines[r[0]].append((r[1] * 10 + r[2], r[3], int(r[4]), r[5]))
    want = {(k, min(v)[1], ",".join(map(str, sorted({x[2] for x in v}))), len({x[3] for x in v})) for k, v in lines.items()}
    got = [tuple(r) for r in queries.QUERIES["observed_rollup"](spark, SF).select("l_partkey", "first_flag", "vals", "owners").collect()]
    assert len(got) == len(want) and set(got) == want


def test_union_dedupe_last(spark):
    last = {}
    for r in rows(spark, "events", "user_id", "event_id", "event_type"):
        last[r[0]] = max(last.get(r[0], (-1, "")), (r[1], r[2]))
    got = [(r.user_id, (r.event_id, r.event_type)) for r in queries.QUERIES["union_dedupe_last"](spark, SF).collect()]
    assert len(got) == len(last) and dict(got) == last and any(e % 5 == 4 for e, _ in last.values())


def test_similar_candidates_top3(spark):
    parts = [(r.p_partkey, r.p_brand, words(f"{r.p_name} {r.p_type}")) for r in rows(spark, "part", "p_partkey", "p_brand", "p_name", "p_type")]
    want = set()
    for key, _, need in parts:
        best = {}
        for rec, brand, have in parts:
            score = len(need & have) / len(need)
            if rec != key and score >= 0.9:
                best[brand] = min(best.get(brand, (0, 0)), (-score, rec))
        top = sorted((s, rec, brand) for brand, (s, rec) in best.items())[:3]
        want |= {(key, rec, brand, round(-s, 6), k) for k, (s, rec, brand) in enumerate(top, 1)}
    got = [(r.id, r.rec, r.owner, r.score, r["rank"]) for r in queries.QUERIES["similar_candidates_top3"](spark, SF).collect()]
    assert want and len(got) == len(want) and set(got) == want


def test_alignment_is_an_ordered_subsequence(spark):
    from brindle.operators import alignment

    snap = spark.createDataFrame([("c", "a", 1, "s1"), ("c", "b", 2, "s2"), ("c", "a", 3, "s3"), ("d", "x", 1, "t1"), ("d", None, 2, "t2")], "cat string, k string, o int, id string")
    cur = spark.createDataFrame([("c", "b", 1), ("c", "a", 2), ("c", "b", 3), ("c", "a", 4), ("d", None, 1)], "cat string, k string, o int")
    got = {(r.cat, r.o): r.id for r in alignment.align(cur, snap, ["cat"], ["k"], "o", "id").collect()}
    assert got == {("c", 1): "s2", ("c", 2): "s3", ("c", 3): None, ("c", 4): None, ("d", 1): "t2"}
