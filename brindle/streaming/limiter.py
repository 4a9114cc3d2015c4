"""Attempt limiting with counters that start at their first event, in batch and as a stream.

An attempt is accepted if the counters of both its keys stay within their limits; a rejected attempt changes neither. The
two keys couple rows, so batch work splits by connected component of the graph of the keys' sessions, or by sessions alone where there is one key; both are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brindle.operators import folds, graph


def transition(counter: tuple[int, int] | None, now: int, window: int) -> tuple[int, int]:
    """(start, count) after one more attempt: a new window when there is none or it is over."""
    if counter is None or now - counter[0] >= window:
        return now, 1
    return counter[0], counter[1] + 1


def fold(rows: list[tuple[int, tuple]], rules: list[tuple[int, int]], state: dict | None = None) -> list[bool]:
    """Verdicts of (time, keys) rows in order; rules: (limit, window) of each key place."""
    state = {} if state is None else state
    out = []
    for now, keys in rows:
        new = [transition(state.get((i, k)), now, w) for i, (k, (_, w)) in enumerate(zip(keys, rules))]
        ok = all(n[1] <= limit for n, (limit, _) in zip(new, rules))
        if ok:
            state.update({(i, k): n for i, (k, n) in enumerate(zip(keys, new))})
        out.append(ok)
    return out


def sessions(df: DataFrame, key: str, ts_ms: str, order: str, gap_ms: int, out: str, span: int = 64) -> DataFrame:
    """Adds ``out``: the time at which the row's session began; a session of a key ends where it rests for ``gap_ms`` or longer.

    Time is cut into buckets of ``span`` gaps. Rows look back within their bucket; what a bucket needs of those before it are two numbers, so a
    hot key is as many tasks as it has buckets.
    """
    bucket = df.withColumn("_bucket", F.floor(F.col(ts_ms) / (span * gap_ms)))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = bucket.groupBy(key, "_bucket").agg(F.max(ts_ms).alias("_max")).withColumn("_last", F.max("_max").over(earlier)).drop("_max")
    same = lambda a, b: a.join(b.withColumnRenamed(key, "_key").withColumnRenamed("_bucket", "_place"), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_place"))).drop("_key", "_place")
    within = Window.partitionBy(key, "_bucket").orderBy(ts_ms, order)
    back = F.coalesce(F.lag(ts_ms).over(within), F.col("_last"))
    marked = same(bucket, last).withColumn("_new", F.when(back.isNull() | (F.col(ts_ms) - back >= gap_ms), F.col(ts_ms)))
    starts = marked.groupBy(key, "_bucket").agg(F.max("_new").alias("_start")).withColumn("_open", F.max("_start").over(earlier)).drop("_start")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = same(marked, starts).withColumn(out, F.coalesce(F.max("_new").over(upto), F.col("_open")))
    return placed.select(*df.columns, out)


def _limited(rules: list[tuple[int, int]]):
    """start and step of a fold over (time, keys...): counters that are over are forgotten now and then, so a state holds the live ones only."""

    def start(*_):
        return {}, 1024

    def step(state, now, *keys):
        counters, most = state
        new = [transition(counters.get((i, k)), now, w) for i, (k, (_, w)) in enumerate(zip(keys, rules))]
        ok = all(n[1] <= limit for n, (limit, _) in zip(new, rules))
        if ok:
            counters.update({(i, k): n for i, (k, n) in enumerate(zip(keys, new))})
            if len(counters) > most:
                counters = {(i, k): c for (i, k), c in counters.items() if now - c[0] < rules[i][1]}
                most = max(1024, 2 * len(counters))
        return (counters, most), (ok,)

    return start, step


def limit_by_key(df: DataFrame, key: str, ts_ms: str, order: str, limit: int, window_ms: int) -> DataFrame:
    """Adds accepted for one key. After a rest of a window the counter starts anew, so sessions are folded apart; rows stream through with one counter kept.

    ``order`` names the row; rows without key share one counter.
    """
    base = sessions(df.select(key, ts_ms, order), key, ts_ms, order, window_ms, "_session")
    start, step = _limited([(limit, window_ms)])
    made = folds.running(base, [key, "_session"], [ts_ms, order], [ts_ms, key], "accepted boolean", start, step)
    return df.join(made.select(order, "accepted"), order)


def limit_by_two(df: DataFrame, keys: tuple[str, str], ts_ms: str, order: str, rules: tuple[tuple[int, int], tuple[int, int]] = ((3, 900_000), (5, 86_400_000))) -> DataFrame:
    """Adds accepted under both keys' rules.

    A key that rests for its window has no live counter, so its sessions are keys of their own. Rows couple a session of each key; components of that graph share no live counter and
    are folded apart, each in order of time with its live counters kept. One busy component of keys is thus as many tasks as time cuts it into.
    """
    base = df.select(*keys, ts_ms, order)
    for i, (key, (_, window)) in enumerate(zip(keys, rules)):
        base = sessions(base, key, ts_ms, order, window, f"_s{i}")
    node = lambda i: F.to_json(F.struct(F.lit(i).alias("i"), F.coalesce(F.col(keys[i]).cast("string"), F.lit("\u0000")).alias("k"), F.col(f"_s{i}").alias("s")))
    coupled = base.withColumn("_a", node(0)).withColumn("_b", node(1))
    found = graph.components(coupled, "_a", "_b")
    start, step = _limited(list(rules))
    made = folds.running(coupled.join(found.withColumnRenamed("node", "_a"), "_a"), ["component"], [ts_ms, order], [ts_ms, *keys], "accepted boolean", start, step)
    return df.join(made.select(order, "accepted"), order)


def limit_stream(stream: DataFrame, key: str, ts_ms: str, order: str, limit: int, window_ms: int) -> DataFrame:
    """The streaming twin of ``limit_by_key``: the counter of each key is its state."""

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        counters = {(0, 0): tuple(state.get)} if state.exists else {}
        pdf = pd.concat(list(batches)).sort_values([ts_ms, order])
        ok = fold([(int(t), (0,)) for t in pdf[ts_ms]], [(limit, window_ms)], counters)
        if counters:
            state.update(counters[0, 0])
        yield pd.DataFrame({key: [k[0]] * len(pdf), order: pdf[order].to_numpy(), "accepted": ok})

    kinds = dict(stream.dtypes)
    return stream.groupBy(key).applyInPandasWithState(run, f"{key} {kinds[key]}, {order} {kinds[order]}, accepted boolean", "start bigint, count bigint", "append", GroupStateTimeout.NoTimeout)
