"""Alignment in blocks against the plain fold."""

import random

import numpy as np
import pytest

from brindle.operators import alignment, folds


def plain(current, snapshot):
    out, at, failed = [], 0, False
    for k in current:
        while not failed and at < len(snapshot) and snapshot[at][0] != k:
            at += 1
        if failed or at == len(snapshot):
            failed = True
            out.append(None)
        else:
            out.append(snapshot[at][1])
            at += 1
    return out


def test_step_functions_compose():
    """Going through all blocks' step functions ends where the fold ends."""
    r = random.Random(4)
    for _ in range(300):
        theirs = np.array([r.randint(0, 2) for _ in range(r.randint(1, 40))])
        mine = theirs[np.sort(np.array(r.sample(range(len(theirs)), r.randint(1, len(theirs))), int))] if r.random() < 0.8 else np.array([r.randint(0, 2) for _ in range(r.randint(1, len(theirs)))])
        slack, b = len(theirs) - len(mine), r.randint(1, 9)
        b = max(b, slack)
        d = 0
        for base in range(0, len(mine), b):
            ends, after = alignment.step_function(mine[base : base + b], theirs[base : base + b + slack], base, slack)
            assert len(ends) <= slack + 1 and (np.diff(ends) > 0).all()
            d = int(after[np.searchsorted(ends, d)]) if d >= 0 else -1
        want = plain(mine.tolist(), [(k, i) for i, k in enumerate(theirs.tolist())])
        assert d == (want[-1] + 1 - len(mine) if want[-1] is not None else -1)


@pytest.mark.parametrize("block,most_slack", [(3, 1 << 14), (4, 2), (4096, 1 << 14)])
def test_align_fuzz(spark, block, most_slack):
    r, cur, snap, want = random.Random(block + most_slack), [], [], {}
    for c in [*(f"c{i}" for i in range(12)), None]:
        theirs = [r.choice(["x", "y", None]) for _ in range(r.randint(0, 40))]
        keep = sorted(r.sample(range(len(theirs)), r.randint(0, len(theirs))))
        mine = [theirs[i] for i in keep] if r.random() < 0.7 else [r.choice(["x", "y", "z"]) for _ in range(r.randint(0, 45))]
        snap += [(c, k, i, f"{c}-{i}") for i, k in enumerate(theirs)]
        cur += [(c, k, i) for i, k in enumerate(mine)]
        want.update({(c, i): got for i, got in enumerate(plain(mine, [(k, f"{c}-{i}") for i, k in enumerate(theirs)]))})
    r.shuffle(cur), r.shuffle(snap)
    current = spark.createDataFrame(cur, "cat string, k string, o int").repartition(3)
    snapshot = spark.createDataFrame(snap, "cat string, k string, o int, id string").repartition(3)
    made = alignment.align(current, snapshot, ["cat"], ["k"], "o", "id", block, most_slack)
    assert {(x["cat"], x["o"]): x["id"] for x in made.collect()} == want
    ok = {x["cat"]: x["aligned"] for x in alignment.same_catalogs(made, ["cat"], "id").collect()}
    assert ok == {c: all(v is not None for (d, _), v in want.items() if d == c) for c in {c for c, _ in want}}


def test_align_empty(spark):
    none = spark.createDataFrame([], "cat string, k string, o int")
    some = spark.createDataFrame([("a", "x", 1, "i")], "cat string, k string, o int, id string")
    assert alignment.align(none, some, ["cat"], ["k"], "o", "id").count() == 0
    assert [r["id"] for r in alignment.align(some.drop("id"), some.where("false"), ["cat"], ["k"], "o", "id").collect()] == [None]


def test_numbers(spark):
    rows = [("a" if i % 3 else None, i * 7 % 101) for i in range(100)]
    got = folds.numbered(spark.createDataFrame(rows, "k string, o int").repartition(5), ["k"], ["o"], "n").collect()
    for k in ("a", None):
        assert [r["n"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["o"])] == list(range(sum(x == k for x, _ in rows)))
