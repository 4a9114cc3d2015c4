"""The audit's checks and stages on small tables."""

import pytest
from pyspark.sql import functions as F

from brindle.operators import audit_checks, catalog, research, validate
from brindle.plans.stages import Stages
from brindle.sources import readers

EVIDENCE = "array<struct<evidence_type:string,url:string,response_sha256:string,branch:string,source_owner:string>>"
LEDGER = f"input_id string, match_status string, existence_status string, sale_status string, strength_status string, decision string, reason_code string, evidence {EVIDENCE}, changes array<struct<action:string,field:string,to:double>>, calculated double, observed double, research_status string, active_search_seconds double, terminal_reason string"


def tables(spark, change=None, ledger=None, research_=None, reviewed=("i2",), catalog_=None):
    proof = [("page", "http://a/", "d", "manufacturer", "o")]
    clash = [("internal_strength_conflict", None, None, "retailer", "o")]
    rows = ledger or [
        ("i1", "exact_id", "confirmed", "unknown", "verified", "keep", "r", proof, [("change", "mg", 5.0)], None, 5.0, "verified", 10.0, "verified"),
        ("i2", "no_match", "ambiguous", "unknown", "unverified", "review", "r", clash, [], None, None, "exhausted_10m/unverified", 700.0, "exhausted_10m"),
    ]
    snap = spark.createDataFrame([("i1", 1), ("i2", 2)], "input_id string, original_index int")
    found = research_ or [("i1", "verified", "verified", 10.0, proof, "x"), ("i2", "exhausted_10m", "exhausted_10m/unverified", 700.0, None, "x"), ("i9", "running", None, 1.0, None, None)]
    book = spark.createDataFrame(catalog_ or [("b", "n", 5.0, 1), ("b", "m", 4.0, 2)], "b string, n string, mg double, original_index int")
    want = spark.createDataFrame([("b", "n", 5.0, 1), ("b", "m", 4.0, 2)], "b string, n string, mg double, original_index int")
    got = audit_checks.audit(
        snap, spark.createDataFrame(rows, LEDGER), snap.select("input_id"), spark.createDataFrame(found, f"input_id string, terminal_reason string, research_status string, active_search_seconds double, evidence {EVIDENCE}, queries string"),
        spark.createDataFrame([(r,) for r in reviewed], "input_id string"), book, want, ["queries"],
    )
    return {r.check_name: r.failing for r in got.collect() if r.failing}


def test_a_good_audit_fails_nothing(spark):
    assert tables(spark) == {}


def test_audit_finds_what_is_wrong(spark):
    weak = [("page", "http://a/", None, "retailer", "o"), ("page", "http://b/", "d", "retailer", "p")]
    bad = [
        ("i1", "maybe", None, "unknown", "verified", "keep", "", weak, [("change", "mg", 5.0)], 5.1, 5.0, "verified", 10.0, "verified"),
        ("i1", "exact_id", "confirmed", "unknown", "verified", "remove", "r", None, [], None, None, "verified", 10.0, "exhausted_10m"),
        ("i7", "exact_id", "confirmed", "unknown", "verified", "keep", "r", [("internal_strength_conflict", None, None, None, None)], None, 5.0, 5.0, None, None, None),
    ]
    found = [("i1", "exhausted_10m", "exhausted_10m/unverified", 20.0, weak, None), ("i1", "verified", "conflicted", 1.0, None, "x")]
    got = tables(spark, ledger=bad, research_=found, catalog_=[("b", "n", 5.0, 1), ("b", "n", 5.0, 2), (" ", "x", -1.0, 3)])
    assert got == {
        "ledger_repeated": 1, "ledger_missing": 1, "ledger_unexpected": 1, "research_repeated": 1, "research_missing": 1, "invalid_match_status": 1, "invalid_existence_status": 1, "missing_reason": 1, "evidence_without_digest": 1,
        "decision_without_evidence": 1, "change_without_evidence": 1, "calculation_differs": 1, "ledger_exhausted_early": 1, "ledger_exhausted_status": 1, "change_without_independent_evidence": 1, "research_exhausted_early": 1,
        "research_status_differs": 1, "research_field_missing": 1, "research_evidence_without_digest": 1, "conflict_not_in_review": 1, "catalog_invalid": 1, "catalog_repeated": 1, "catalog_sequence_differs": 1,
    }


def test_stages(spark, tmp_path):
    s = Stages(spark, str(tmp_path / "audit"))
    rows = spark.createDataFrame([("a", "X", 1.0), ("b", "X", 2.0), ("c", "Y", 3.0)], "input_id string, brand string, mg double")
    with pytest.raises(ValueError, match="not there"):
        s.table("snapshot")
    assert s.freeze(rows).count() == 3 == s.freeze(rows).count()
    with pytest.raises(ValueError, match="differ"):
        s.freeze(rows.withColumn("mg", F.col("mg") + 1))
    assert s.pilot("brand", "X", 2).count() == 2
    with pytest.raises(ValueError, match="expected"):
        s.pilot("brand", "X", 5)
    events = spark.createDataFrame([("l", 1, True), ("l", 2, False), ("l", 3, True)], "log string, o int, ok boolean")
    readers.stored(events, s.path("events"))
    assert [r.o for r in s.repair("log", "o", F.col("ok")).collect()] == [1] and s.table("events").count() == 3 and s.table("events_manifest").first().total == 3
    with pytest.raises(ValueError, match="1 failures"):
        s.validate(spark.createDataFrame([("x", 1)], "check_name string, failing long"))
    s.check(rows, rows, ["mg"])
    decisions = spark.createDataFrame([("a", "keep", 1.5), ("c", "remove", None)], "input_id string, decision string, to double")
    with pytest.raises(ValueError):
        s.apply(decisions, "mg")
    s.approve(rows)
    applied, changes = s.apply(decisions, "mg")
    assert sorted((r.input_id, r.mg) for r in applied.collect()) == [("a", 1.5), ("b", 2.0)]
    assert sorted(tuple(r) for r in changes.collect()) == [("a", "change", 1.0, 1.5), ("c", "remove", 3.0, None)]


def test_unapproved_results_stop(spark, tmp_path):
    s = Stages(spark, str(tmp_path / "audit"))
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "input_id string, mg double")
    s.freeze(rows)
    s.check(rows, rows.withColumn("mg", F.col("mg") * 2), ["mg"])
    with pytest.raises(ValueError, match="approval"):
        s.approve(rows)
    with pytest.raises(ValueError, match="approval"):
        s.apply(rows.selectExpr("input_id", "'keep' decision", "mg to"), "mg")


def test_broken_files_go_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1,\n "y": "q"}')
    (tmp_path / "b.json").write_text('{"x": 2, "y": ')
    (tmp_path / "c.txt").write_text('{"x": 3}')
    assert [tuple(r) for r in readers.cached_json(spark, str(tmp_path), "*.json", "x int, y string").collect()] == [(1, "q")]


def test_keys_not_values(spark):
    rows = spark.createDataFrame([(1, '{"a": {"Owner_Group": 1}}'), (2, '{"a": "\\"ownergroup\\": 1"}'), (3, '[{"b": [{"owner-group": 0}]}]'), (4, None), (5, "owner group: {"), (6, '{"owner\\u0067roup": 1}')], "k int, j string")
    assert {r.k for r in rows.where(validate.forbidden_keys(F.col("j"), ["ownergroup"])).collect()} == {1, 3, 6}


def test_unique_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert catalog.require_unique(df, "k").count() == 2
    with pytest.raises(ValueError, match="repeats"):
        catalog.require_unique(df.unionAll(df), "k")
    assert {r.check_name: r.failing for r in research.coverage(df, df, df.withColumn("passed", F.lit(True)), "k").collect()} == {"no_result": 0, "repeated": 0, "unchecked": 0, "failed": 0}
