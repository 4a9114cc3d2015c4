"""A protocol that is stopped after any step ends with the cards of one that was not."""

import pytest
from pyspark.sql import functions as F

from brindle.plans.protocol import Protocol


class Stopped(Exception):
    pass


def steps_of(calls, stop=None):
    def step(name, make):
        def run(done):
            calls.append(name)
            if len(calls) == stop:
                raise Stopped
            return make(done)

        return name, run

    return [
        step("search", lambda d: d["rows"].select("id", F.explode(F.sequence(F.lit(0), F.col("id") % 3)).alias("k"))),
        step("open", lambda d: d["search"].withColumn("hit", (F.col("id") + F.col("k")) % 2 == 0)),
        step("decide", lambda d: d["rows"].join(d["open"].groupBy("id").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("n")), "id")),
    ]


def cards(df):
    return sorted((r["id"], r["hits"], r["n"]) for r in df.select("id", "hits", "n").collect())


def test_stopped_anywhere(spark, tmp_path):
    rows = spark.range(7).withColumn("o", -F.col("id"))
    whole = Protocol(spark, str(tmp_path / "whole"), "id", steps_of(all_calls := []))
    want = cards(whole.run(rows, "o", 3))
    assert [w[0] for w in want] == list(range(7)) and all_calls == ["search", "open", "decide"] * 3
    calls: list[str] = []
    for stop in range(1, 10):
        part = Protocol(spark, str(tmp_path / "part"), "id", steps_of(calls, len(calls) + (1 if stop % 2 else 2)))
        try:
            part.run(rows, "o", 3)
            break
        except Stopped:
            n = sum(r["n"] for r in part.progress(rows).collect())
            assert n == 7
    got = Protocol(spark, str(tmp_path / "part"), "id", steps_of(calls)).run(rows, "o", 3)
    assert cards(got) == want


def test_cut_short_writes_are_made_anew(spark, tmp_path):
    """A step's folder without its mark is as good as none."""
    rows = spark.range(4).withColumn("o", F.col("id"))
    p = Protocol(spark, str(tmp_path), "id", steps_of(calls := []))
    batch = p.begin(rows, "o", 4)
    (tmp_path / f"batch={batch}" / "search").mkdir()
    (tmp_path / f"batch={batch}" / "search" / "part-0.parquet").write_bytes(b"cut short")
    assert p.active() == batch and p.begin(rows, "o", 4) == batch
    assert len(cards(p.run(rows, "o", 4))) == 4 and calls == ["search", "open", "decide"] and p.active() is None
    assert {r["state"]: r["n"] for r in p.progress(spark.range(6)).collect()} == {"done": 4, "pending": 2}


def test_rows_without_cards(spark, tmp_path):
    lost = Protocol(spark, str(tmp_path / "lost"), "id", [("decide", lambda d: d["rows"].where("id < 2"))])
    with pytest.raises(ValueError, match="without a card"):
        lost.run(spark.range(3).withColumn("o", F.lit(0)), "o", 9)
    none = Protocol(spark, str(tmp_path / "none"), "id", steps_of([]))
    assert none.run(spark.range(0).withColumn("o", F.lit(0)), "o", 9) is None
    with pytest.raises(ValueError):
        Protocol(spark, str(tmp_path), "id", [])
