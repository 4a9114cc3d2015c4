"""Ordered alignment: current rows as a subsequence of a snapshot's, catalog by catalog, in blocks.

In order, each current row takes the first snapshot row behind the one taken before that equals it. Where row i stands in the snapshot is i + d; d never falls, and where all rows find a place it
never exceeds the slack, the snapshot's surplus of rows. So a block of current rows needs no more of the snapshot than its own stretch and the slack, and what it does to d is a monotone
step function. Blocks make their functions apart from each other; a fold along the blocks of a catalog then looks up one step a block, which gives each block the d it begins with, and
blocks take their places apart from each other again.

Catalogs that do not align, and those whose slack is too wide for steps, are merged instead: the snapshot streams by and only a catalog's current digests are held.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brindle.operators import folds

_NEVER = 1 << 62


def _occurrences(keys: np.ndarray, base: int) -> dict[int, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(keys) else np.zeros(0, np.int64)
    return {int(keys[order[i]]): np.sort(order[i:j]) + base for i, j in zip(cuts, np.r_[cuts[1:], len(keys)])}


def step_function(rows: np.ndarray, window: np.ndarray, base: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """What a block does to d: the last d of each step and the d it becomes (-1: a row finds no place).

    ``rows``: digests of the block; ``window``: those of the snapshot from place ``base`` on, which is also the block's first row number.
    """
    places = _occurrences(window, base)
    ends, at = np.arange(slack + 1), base + np.arange(slack + 1)
    for k in rows.tolist():
        own = places.get(k, np.zeros(0, np.int64))
        i = np.searchsorted(own, at)
        at = np.where(i < len(own), np.append(own, _NEVER)[np.minimum(i, len(own))] + 1, _NEVER)
        last = np.r_[at[1:] != at[:-1], True]
        ends, at = ends[last], at[last]
        if len(at) == 1 and at[0] == _NEVER:
            break
    after = at - base - len(rows)
    return ends, np.where((at >= _NEVER) | (after > slack), -1, after)


def taken(rows: np.ndarray, window: np.ndarray, base: int, start: int) -> np.ndarray:
    """Places that the rows take from place ``start`` on; shorter where a row finds none."""
    places = {k: v.tolist() for k, v in _occurrences(window, base).items()}
    out, at = [], start
    for k in rows.tolist():
        own = places.get(k, [])
        i = bisect.bisect_left(own, at)
        if i == len(own):
            break
        out.append(own[i])
        at = own[i] + 1
    return np.array(out, np.int64)


def _block(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    mine = pdf[pdf["_side"] == 0].sort_values("_n")
    theirs = pdf[pdf["_side"] == 1].sort_values("_n")
    base = int(mine["_n"].iloc[0])
    return mine["_k"].to_numpy(), theirs["_k"].to_numpy(), base, int(pdf["_slack"].iloc[0])


def _merged(both: DataFrame, catalog: list[str]) -> DataFrame:
    """catalog, _n, _at by streaming each catalog's snapshot past its current digests."""
    dealt = both.select(*catalog, "_side", "_n", "_k").repartition(*catalog).sortWithinPartitions(*catalog, "_side", "_n")
    schema = StructType([*[both.schema[c] for c in catalog], *StructType.fromDDL("_n bigint, _at bigint").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, at, wanted = None, [], 0, np.zeros(0, np.int64)
        for b in batches:
            out: list[tuple] = []
            keys = list(zip(*[b.column(c).to_pylist() for c in catalog]))
            for own, side, n, k in zip(keys, b.column("_side").to_pylist(), b.column("_n").to_pylist(), b.column("_k").to_numpy()):
                if own != name:
                    name, held, at = own, [], 0
                if side == 0:
                    held.append(k)
                    wanted = None
                    continue
                if wanted is None:
                    wanted = np.array(held, np.int64)
                if at < len(held) and wanted[at] == k:
                    out.append((*own, at, n))
                    at += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def align(current: DataFrame, snapshot: DataFrame, catalog: list[str], same: list[str], order: str, row: str, block: int = 4096, most_slack: int = 1 << 14) -> DataFrame:
    """``current`` with the ``row`` of the snapshot row that each takes, by catalog (columns ``catalog``; null names one too).

    Rows are equal if their ``same`` columns are (nulls too; compared by digest). From the first row that finds none, the catalog is no subsequence: it and all later rows get null, and the caller may refuse the
    catalog. Rows of equal ``order`` may stand in any order. ``block`` and ``most_slack`` bound what a task holds and change no result.
    """
    digest = F.xxhash64(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias(c) for c in same])))
    mine = folds.numbered(current, catalog, [order], "_n")
    theirs = folds.numbered(snapshot.select(*catalog, order, F.col(row).alias("_id"), digest.alias("_k")), catalog, [order], "_n")
    left = mine.select(*catalog, "_n", digest.alias("_k"))
    right = theirs.select(*catalog, "_n", "_k")
    sizes = left.groupBy(*catalog).agg(F.count(F.lit(1)).alias("_m")).alias("l")
    rows = right.groupBy(*catalog).agg(F.count(F.lit(1)).alias("_s")).alias("r")
    on = lambda a, b: folds.equal(a, b, catalog)
    plan = sizes.join(rows, on("l", "r"), "left").select(*[F.col(f"l.`{c}`").alias(c) for c in catalog], F.col("l._m").alias("_m"), (F.coalesce("r._s", F.lit(0)) - F.col("l._m")).alias("_slack"))
    plan = folds.kept(plan.withColumn("_b", F.greatest(F.lit(block), "_slack")), "plan")
    fits = plan.where(F.col("_slack").between(0, most_slack))

    with_plan = lambda df: folds.joined(df, fits, catalog)
    own = with_plan(left).select(*catalog, F.floor(F.col("_n") / F.col("_b")).alias("_block"), F.lit(0).alias("_side"), "_n", "_k", "_slack")
    to = F.sequence(F.floor(F.greatest(F.col("_n") - F.col("_slack"), F.lit(0)) / F.col("_b")), F.least(F.floor(F.col("_n") / F.col("_b")), F.floor((F.col("_m") - 1) / F.col("_b"))))
    inside = F.floor(F.greatest(F.col("_n") - F.col("_slack"), F.lit(0)) / F.col("_b")) <= F.floor((F.col("_m") - 1) / F.col("_b"))
    stretch = with_plan(right).where(inside).select(*catalog, F.explode(to).alias("_block"), F.lit(1).alias("_side"), "_n", "_k", "_slack")
    # a block's window begins at its own first number
    blocks = folds.kept(own.unionByName(stretch), "blocks")

    fields = ", ".join(f"`{c}` {current.schema[c].dataType.simpleString()}" for c in catalog)

    def functions(pdf: pd.DataFrame) -> pd.DataFrame:
        ends, after = step_function(*_block(pdf))
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in catalog}, "_block": [pdf["_block"].iloc[0]], "_ends": [ends], "_after": [after]})

    steps = blocks.groupBy(*catalog, "_block").applyInPandas(functions, f"{fields}, _block bigint, _ends array<bigint>, _after array<bigint>")

    def step(d, ends, after):
        return (after[bisect.bisect_left(ends, d)] if d >= 0 else -1), (d, after[bisect.bisect_left(ends, d)] if d >= 0 else -1)

    entries = folds.kept(folds.running(steps, catalog, ["_block"], ["_ends", "_after"], "_enter bigint, _leave bigint", lambda *_: 0, step).select(*catalog, "_block", "_enter", "_leave"), "entries")
    failed = entries.where("_leave < 0").select(*catalog).distinct()

    def places(pdf: pd.DataFrame) -> pd.DataFrame:
        rows_, window, base, _ = _block(pdf)
        got = taken(rows_, window, base, base + int(pdf["_enter"].iloc[0]))
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] * len(got) for c in catalog}, "_n": base + np.arange(len(got)), "_at": got})

    ready = folds.joined(blocks, folds.joined(entries, failed, catalog, "left_anti").select(*catalog, "_block", "_enter"), [*catalog, "_block"])
    pairs = ready.groupBy(*catalog, "_block").applyInPandas(places, f"{fields}, _n bigint, _at bigint").select(*catalog, "_n", "_at")
    rest = plan.where(~F.col("_slack").between(0, most_slack)).select(*catalog).unionByName(failed)
    both = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))
    pairs = folds.kept(pairs.unionByName(_merged(folds.joined(both, rest, catalog, "left_semi"), catalog)), "pairs")
    ids = folds.joined(pairs, theirs.select(*catalog, F.col("_n").alias("_at"), F.col("_id").alias(row)), [*catalog, "_at"]).select(*catalog, "_n", row)
    return folds.joined(mine, ids, [*catalog, "_n"], "left").select(*current.columns, row)


def same_catalogs(aligned: DataFrame, catalog: list[str], row: str) -> DataFrame:
    """catalog, aligned: whether every row of a catalog found its place."""
    return aligned.groupBy(*catalog).agg((F.count(row) == F.count(F.lit(1))).alias("aligned"))
