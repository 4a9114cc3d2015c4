"""Stores: user snapshots, artefacts in one pass, two-step publishing, fail-fast joins, evidence with its calculation."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brindle.operators import catalog, evidence, history
from brindle.sources import sinks


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_user_snapshots(spark, tmp_path):
    path, rows = str(tmp_path / "t"), [(u, i, f"x{i}") for u in ("a", "b", "c") for i in range(3)]
    df = spark.createDataFrame(rows, "user string, i int, x string")
    users = lambda *names: spark.createDataFrame([(n,) for n in names], "user string")
    stored = lambda: sorted(map(tuple, history.stored_users(spark, path, df.schema).collect()))
    history.replace_users(df, users("a", "b", "c"), path, "user")
    assert stored() == sorted(rows)
    before = files(path)
    history.replace_users(df.where("user = 'b' and i = 1").withColumn("x", F.lit("new")), users("a", "b"), path, "user")
    assert stored() == [("b", 1, "new"), ("c", 0, "x0"), ("c", 1, "x1"), ("c", 2, "x2")]
    after = files(path)
    assert {p: t for p, t in before.items() if "user=c" in p} == {p: t for p, t in after.items() if "user=c" in p}
    history.replace_users(df.where("user = 'a'"), users("a"), path, "user")
    assert len(stored()) == 7
    history.replace_users(df.where("false"), users("a", "b", "c", "d"), path, "user")
    assert stored() == []


def test_snapshots_of_many_users(spark, tmp_path):
    """Files grow with calls, not with users; none is touched again until the table is compacted; a call that did not finish is not read."""
    path, df = str(tmp_path / "t"), spark.range(3000).select((F.col("id") % 300).alias("user"), F.col("id").alias("x"))
    stored = lambda: sorted(map(tuple, history.stored_users(spark, path, df.schema).collect()))
    everyone, want = df.select("user"), sorted(map(tuple, df.collect()))
    assert stored() == []
    history.replace_users(df, everyone, path, "user")
    before = files(path)
    assert stored() == want and len(before) < 20
    history.replace_users(df.where("user = 7 and x < 1000"), everyone.where("user in (7, 8)").union(spark.sql("select null")), path, "user")
    want = [r for r in want if r[0] != 8 and (r[0] != 7 or r[1] < 1000)]
    assert stored() == want and before.items() <= files(path).items()
    history.replace_users(df.where("user = 9").withColumn("x", F.lit(-1).cast("long")), everyone.where("user = 9"), path, "user")
    (tmp_path / "t/named/_call=3/_SUCCESS").unlink()
    assert stored() == want
    history.replace_users(df.where("false"), everyone.where("user = 1"), path, "user")
    want = [r for r in want if r[0] != 1]
    history.compact_users(spark, path, df.schema)
    assert stored() == want and [p.name for p in (tmp_path / "t/rows").glob("_call=*")] == ["_call=5"]
    history.replace_users(df.where("user = 8"), everyone.where("user = 8"), path, "user")
    assert stored() == sorted(want + [tuple(r) for r in df.where("user = 8").collect()])


def test_artefacts_in_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(i, ["keep", "review", "remove", None][i % 4], f'n "{i}"') for i in range(40)]
    ledger = spark.createDataFrame(rows, "id int, decision string, name string").repartition(3)
    ledger = ledger.mapInArrow(count, ledger.schema)
    sources = spark.createDataFrame([("a", "ok"), ("b", "blocked"), ("c", None)], "source string, status string")
    got = sinks.write_audit(ledger, sources, str(tmp_path), {"kept": F.col("decision") == "keep", "removed": F.col("decision") == "remove"}, F.col("decision") == "review", sinks.csv_line(F.col("id").cast("string"), F.col("name")), F.col("status") == "ok")
    assert got == {"rows": 40, "for_review": 10, "kept": 10, "removed": 10, "sources": 3, "outages": 1} and seen.value == 40
    text = lambda name: "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
    assert sorted(json.loads(x)["id"] for x in text("ledger").splitlines()) == list(range(40)) and len(text("sources").splitlines()) == 3
    assert '1,"n ""1"""' in text("review").splitlines() and len(text("review").splitlines()) == 10
    assert text("summary") == "# Audit\n\n- rows: 40\n- kept: 10\n- removed: 10\n" and "- outages: 1" in text("progress")
    assert sinks.write_audit(spark.createDataFrame([], ledger.schema), sources.where("false"), str(tmp_path / "none"), {}, F.col("decision") == "review", F.lit(""), F.lit(True))["rows"] == 0


def test_publish_in_two_steps(spark, tmp_path):
    folder, df = str(tmp_path / "p"), spark.range(5).withColumn("v", F.col("id") * 2)
    read = lambda: sorted(map(tuple, sinks.published(spark, folder, df.schema).collect()))
    assert read() == []
    sinks.publish(df, folder)
    assert read() == [(i, 2 * i) for i in range(5)]
    version = sinks.stage(df.where("id < 2"), folder)
    assert read() == [(i, 2 * i) for i in range(5)], "a driver lost here leaves the old version"
    sinks.switch(spark, folder, version)
    assert read() == [(0, 0), (1, 2)]
    os.remove(Path(folder) / "versions" / (other := sinks.stage(df, folder)) / "_SUCCESS")
    with pytest.raises(ValueError, match="not finished"):
        sinks.switch(spark, folder, other)
    assert read() == [(0, 0), (1, 2)] and not [p for p in Path(folder).glob(".current-*") if p.suffix != ".crc"]


def test_staged_rows_are_checked(spark, tmp_path, monkeypatch):
    df, turn = spark.range(3), iter(range(9))
    monkeypatch.setattr(sinks, "_hash", lambda d: [F.count(F.lit(1)).alias("rows"), F.max(F.lit(next(turn))).alias("digest")])
    with pytest.raises(ValueError, match="not what went in"):
        sinks.publish(df, str(tmp_path / "p"))
    assert sinks.published(spark, str(tmp_path / "p"), df.schema).count() == 0


def test_snapshot_join(spark):
    rows = [(1, "A", 4.0), (2, "A", 4.0), (3, "B", None), (4, None, 1.0)]
    inputs = spark.createDataFrame([(*r, f"more{r[0]}") for r in rows], "id int, b string, mg double, more string")
    frame = lambda r: spark.createDataFrame(r, "id int, b string, mg double")
    join = lambda unresolved, current=rows: sorted(r["more"] for r in catalog.snapshot_join(frame(unresolved), inputs, frame(current).drop("id"), "id", ["b", "mg"]).collect())
    assert join(rows) == ["more1", "more2", "more3", "more4"] and join(rows[2:]) == ["more3", "more4"] and join([]) == []
    for unresolved, current, fault in (([(9, "A", 4.0)], rows, "id 9 is missing"), ([(1, "A", 5.0)], rows, "id 1 differs"), ([(3, "B", None)], rows[:2], "id 3 is no longer"), ([rows[0], rows[0]], rows, "id 1 repeats")):
        with pytest.raises(Exception, match=fault):
            join(unresolved, current)


def test_first_by_url(spark):
    df = spark.createDataFrame([("u", 1, 2, "b"), ("u", 2, 1, "a"), ("u", 2, 1, "a"), ("v", 1, 9, None)], "url string, id int, o int, r string")
    first, pairs = catalog.first_by_url(df, "url", ["o"], "id")
    assert sorted((r["url"], r["r"] or "", r["n_rows"]) for r in first.collect()) == [("u", "a", 2), ("v", "", 1)]
    assert sorted(map(tuple, pairs.collect())) == [("u", 1), ("u", 2), ("v", 1)]


def test_observed(spark):
    kinds = "k string, o int, direct double, per_g double, weight double, n double, owner string, url string"
    rows = [
        ("stated", 1, None, 20.0, 10.0, 20.0, "x", "u1"), ("stated", 2, 8.0, None, None, None, "y", "u2"), ("stated", 3, 9.0, None, None, None, "y", "u3"),
        ("reckoned", 1, None, 3.0, None, 20.0, "x", "u1"), ("reckoned", 2, None, 20.0, 10.0, 20.0, "y", "u2"), ("reckoned", 3, None, 40.0, 10.0, 20.0, "z", "u3"),
        ("zero", 1, None, 20.0, 10.0, 0.0, "x", "u1"), ("none", 1, float("nan"), None, None, None, None, None),
    ]
    got = {r["k"]: r for r in evidence.observed(spark.createDataFrame(rows, kinds), "k", "o", "direct", "per_g", "weight", "n", "owner", "url").collect()}
    assert (got["stated"]["observed"], got["stated"]["values"], got["stated"]["owners"], got["stated"]["per_g"], got["stated"]["calculation"]) == (8.0, [8.0, 9.0], ["y"], 20.0, None)
    assert (got["reckoned"]["observed"], got["reckoned"]["values"], got["reckoned"]["owners"], got["reckoned"]["per_g"]) == (10.0, [10.0], ["y"], 3.0)
    assert got["reckoned"]["calculation"].asDict() == {"per_g": 20.0, "weight": 10.0, "count": 20.0, "result": 10.0, "source": "u2"}
    assert (got["zero"]["observed"], got["zero"]["values"], got["zero"]["per_g"]) == (None, [], 20.0) and got["none"]["observed"] is None
