"""Append-only hash-chained event logs: building, verifying, repairing, accounting."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators import folds


def link_hash(previous: Column, payload: Column) -> Column:
    """The hash of an event: previous hash (empty at the start), NUL, payload."""
    return F.sha2(F.concat(F.coalesce(previous, F.lit("")), F.lit("\u0000"), payload), 256)


def append(df: DataFrame, log: str, order: str, payload: str, tails: DataFrame | None = None) -> DataFrame:
    """Adds sequence, previous_sha256 and event_sha256 along each log in order.

    ``tails`` (log, sequence, event_sha256: see ``log_tails``) are the stored ends that logs go on from; a log without one begins at 1. The chain is a fold by
    nature: logs run in parallel, and each streams through its task in order with nothing but the last hash kept. Events of equal ``order`` go by payload.
    """
    names = df.columns
    if tails is not None:
        df = df.join(tails.select(log, F.col("sequence").alias("_sequence"), F.col("event_sha256").alias("_last")), log, "left")
    else:
        df = df.withColumn("_sequence", F.lit(0).cast("long")).withColumn("_last", F.lit(None).cast("string"))

    def step(state, text, *_):
        sequence, previous = state
        own = hashlib.sha256(f"{previous or ''}\0{'' if text is None else text}".encode()).hexdigest()
        return (sequence + 1, own), (sequence + 1, previous, own)

    made = folds.running(df, [log], [order, payload], [payload, "_sequence", "_last", *names], "sequence bigint, previous_sha256 string, event_sha256 string", lambda _, sequence, last, *rest: (sequence or 0, last), step)
    return made.select(*names, "sequence", "previous_sha256", "event_sha256")


def log_tails(df: DataFrame, log: str) -> DataFrame:
    """log, sequence, event_sha256 of each log's last event: what ``append`` goes on from."""
    return df.groupBy(log).agg(F.max(F.struct("sequence", "event_sha256")).alias("_t")).select(log, "_t.sequence", "_t.event_sha256")


def verify_chain(df: DataFrame, log: str | None, event: str, payload: str, sequence: str = "sequence", previous: str = "previous_sha256", own: str = "event_sha256", tie: str | None = None) -> DataFrame:
    """Adds fault (null: good): each event needs its predecessor only, so logs check by window, not by fold.

    Without ``log`` the table is one log of any length: the predecessor is joined by its number, so no task holds the log; a number that is missing before an event, or that an earlier event has too,
    is a ``sequence`` fault there. With ``log`` a number must be the event's place, so after a gap all later ones are faults. Either way an event is held against its stored predecessor, whether that is
    sound or not; a log with any fault is refused as a whole by ``require_chain``. ``tie`` orders events of one number.
    """
    order = [sequence, *([tie] if tie else [])]
    if log:
        w = Window.partitionBy(log).orderBy(*order)
        placed = df.withColumn("_gap", F.col(sequence) != F.row_number().over(w)).withColumn("_before", F.lag(own).over(w))
    else:
        order_key = F.struct(*[F.col(c) for c in order])
        last = df.groupBy(F.col(sequence).alias("_s")).agg(F.min(order_key).alias("_first"), F.max_by(own, order_key).alias("_before"))
        first = last.select(F.col("_s").alias("_own"), "_first")
        placed = df.join(last.select((F.col("_s") + 1).alias("_next"), "_before"), F.col(sequence) == F.col("_next"), "left").join(first, F.col(sequence) == F.col("_own"))
        placed = placed.withColumn("_gap", (order_key != F.col("_first")) | (F.col("_next").isNull() & (F.col(sequence) != 1))).drop("_next", "_own", "_first")
    times = df.groupBy(*([log] if log else []), event).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    twice = placed.join(times, [*([log] if log else []), event], "left")
    fault = (
        F.when(F.col("_times") > 1, "duplicate_event_id")
        .when(F.col("_gap"), "sequence")
        .when(~F.col(previous).eqNullSafe(F.col("_before")), "previous_hash")
        .when(~F.col(own).eqNullSafe(link_hash(F.col(previous), F.col(payload))), "event_hash")
    )
    return twice.select(*df.columns, fault.alias("fault"))


def require_chain(df: DataFrame, log: str, event: str, payload: str, sequence: str = "sequence", previous: str = "previous_sha256", own: str = "event_sha256") -> DataFrame:
    """The same rows; a fault in any log ends the query that reads them, in the pass that reads them.

    One shuffle by log serves all checks: contiguous numbers from 1, one event per id, each event linked to the one before and its own hash right.
    """
    w = Window.partitionBy(log).orderBy(sequence)
    placed = df.repartition(log).withColumn("_n", F.row_number().over(w)).withColumn("_before", F.lag(own).over(w)).withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(log, event)))
    fault = (
        F.when(F.col("_times") > 1, "duplicate_event_id")
        .when(~F.col(sequence).eqNullSafe(F.col("_n")), "sequence")
        .when(~F.col(previous).eqNullSafe(F.col("_before")), "previous_hash")
        .when(~F.col(own).eqNullSafe(link_hash(F.col(previous), F.coalesce(payload, F.lit("")))), "event_hash")
    )
    message = F.concat(F.lit("invalid event chain: log "), F.coalesce(F.col(log).cast("string"), F.lit("null")), F.lit(", event "), F.coalesce(F.col(event).cast("string"), F.lit("null")), F.lit(", "), fault)
    return placed.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).select(*df.columns)


def valid_prefix(df: DataFrame, log: str, order: str, good: Column) -> DataFrame:
    """The rows of each log before its first bad one; the first bad order is a partial aggregate, joined back."""
    bad = df.where(~F.coalesce(good, F.lit(False))).groupBy(log).agg(F.min(order).alias("_bad"))
    return df.join(bad, log, "left").where(F.col("_bad").isNull() | (F.col(order) < F.col("_bad"))).drop("_bad")


def repair(df: DataFrame, log: str, order: str, good: Column) -> tuple[DataFrame, DataFrame]:
    """The valid prefix and a manifest: rows and kept rows of each log."""
    prefix = valid_prefix(df, log, order, good)
    kept = prefix.groupBy(log).agg(F.count(F.lit(1)).alias("kept"))
    total = df.groupBy(log).agg(F.count(F.lit(1)).alias("total"))
    return prefix, total.join(kept, log, "left").select(log, "total", F.coalesce("kept", F.lit(0)).alias("kept"))


def novelty(df: DataFrame, key: str, order: str, item: str) -> DataFrame:
    """key, order, is_new: does the event bring an item its key had not? The first order of each item decides."""
    first = df.groupBy(key, item).agg(F.min(order).alias(order)).select(key, order).distinct().withColumn("_new", F.lit(True))
    events = df.select(key, order).distinct()
    return events.join(first, [key, order], "left").select(key, order, F.col("_new").isNotNull().alias("is_new"))


def saturation(df: DataFrame, key: str, order: str, item: str, least: int = 2) -> DataFrame:
    """key, no_new, saturated: events without a new item, at least ``least``."""
    return novelty(df, key, order, item).groupBy(key).agg(F.count_if(~F.col("is_new")).alias("no_new")).withColumn("saturated", F.col("no_new") >= least)


def stop_order(df: DataFrame, key: str, order: str, item: str, run: int = 2, least: int = 4) -> DataFrame:
    """key, stop_at: the first order with ``run`` events in a row without a new item, ``least`` events in; null if none."""
    w = Window.partitionBy(key).orderBy(order)
    n = novelty(df, key, order, item).withColumn("_island", F.sum(F.col("is_new").cast("int")).over(w)).withColumn("_n", F.row_number().over(w))
    n = n.withColumn("_run", F.sum((~F.col("is_new")).cast("int")).over(Window.partitionBy(key, "_island").orderBy(order)))
    return n.groupBy(key).agg(F.min(F.when((F.col("_run") >= run) & (F.col("_n") >= least), F.col(order))).alias("stop_at"))


def last_event(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The last event's columns for each key."""
    got = df.groupBy(*keys).agg(F.max_by(F.struct(order, *columns), order).alias("_r"))
    return got.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in columns])


def candidate_accounting(candidates: DataFrame, opened: DataFrame, decided: DataFrame, keys: list[str], order: str, decision: str) -> DataFrame:
    """keys, opened, decided, decision: what became of each candidate; last events win."""
    o = opened.select(*keys).distinct().withColumn("opened", F.lit(True))
    d = last_event(decided, keys, order, [decision])
    got = candidates.select(*keys).distinct().join(o, keys, "left").join(d, keys, "left")
    return got.select(*keys, F.col("opened").isNotNull().alias("opened"), F.col(decision).isNotNull().alias("decided"), F.col(decision).alias("decision"))


def list_hash(df: DataFrame, key: str, order: str, item: str) -> DataFrame:
    """key, list_sha256: the hash of each key's items in order as one JSON list. ``item`` holds canonical JSON (``hashing.canonical_json``; null: ``null``).

    The list is hashed item by item as it streams by and is never put together, so it may be longer than any task's memory.
    """

    def step(state, text):
        digest, n = state
        digest.update(f"{',' if n else '['}{'null' if text is None else text}".encode())
        return digest, n + 1

    def end(state):
        state[0].update(b"]")
        return (state[0].hexdigest(),)

    return folds.folded(df, [key], [order, item], [item], "list_sha256 string", lambda: (hashlib.sha256(), 0), step, end)


def monotone_clock(base_ms: int, place: Column) -> Column:
    return F.timestamp_millis(F.lit(base_ms) + place)
