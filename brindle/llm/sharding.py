"""Sharding by k-d tree partitioning.

Units (groups of equal texts, so copies stay together) are points in a space of metadata: log size, source, language, key and a
hash of the text. Nodes split recursively at the weighted median, in bytes, of the dimension that is widest there (as a part of
its spread over all units), until each leaf is one shard. Medians come from distributed histograms that
zoom in on the bucket that holds the median, for all nodes of a level at once; only counts by bucket reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import shuffle_partitions, written

BUCKETS = 1024
_BIG = float(1 << 53)


@dataclass
class _Node:
    shards: int
    first: int
    axis: str = ""
    low: float = 0.0
    high: float = 0.0
    before: float = 0.0
    total: float = 0.0
    tie: float | None = None
    last: float | None = None
    cut: tuple[float, float] | None = None


def _bucket(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(F.floor((x - low) / (high - low) * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1)).cast("int")


def split(units: DataFrame, axes: list[str], shards: int, weight: str = "_bytes") -> DataFrame:
    """Adds ``shard`` to units with a weight and numeric axes; the last axis, in [0, 1], must tell units apart (a hash) and breaks ties.

    Axes and weight must not be null. No units give no rows; with fewer units than shards some shards stay empty. The driver gets a histogram of a bounded number of buckets a node and step.
    """
    nodes = {1: _Node(shards, 0)}
    leaves: dict[int, int] = {} if shards > 1 else {1: 0}
    node = F.lit(1)
    spread = None
    units = units.withColumn("_node", node)
    while nodes and shards > 1:
        cols = [f(a).alias(f"{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]
        stats = {r["_node"]: r for r in units.where(F.col("_node").isin(list(nodes))).groupBy("_node").agg(F.sum(weight).alias("w"), *cols).collect()}
        if spread is None and stats:
            r = stats[1]
            spread = {a: max(r[f"hi_{a}"] - r[f"lo_{a}"], 1e-12) for a in axes}
        for n, x in list(nodes.items()):
            r = stats.get(n)
            if r is None:
                leaves[n] = x.first
                del nodes[n]
                continue
            wide = {a: (r[f"hi_{a}"] - r[f"lo_{a}"]) / spread[a] for a in axes}
            x.axis = max(axes, key=lambda a: wide[a])
            x.low, x.high, x.total = float(r[f"lo_{x.axis}"]), float(r[f"hi_{x.axis}"]), float(r["w"])
        _medians(units, nodes, weight, axes[-1])
        step = F.col("_node")
        follow = {}
        for n, x in nodes.items():
            step = F.when(F.col("_node") == n, F.when((F.col(x.axis) < F.lit(x.cut[0])) | (F.col(x.axis) == F.lit(x.cut[0])) & (F.col(axes[-1]) <= F.lit(x.cut[1])), 2 * n).otherwise(2 * n + 1)).otherwise(step)
            left = (x.shards + 1) // 2
            for child, count, first in ((2 * n, left, x.first), (2 * n + 1, x.shards - left, x.first + left)):
                if count > 1:
                    follow[child] = _Node(count, first)
                else:
                    leaves[child] = first
        units = units.withColumn("_node", step)
        nodes = follow
    number = F.create_map(*[F.lit(v) for pair in leaves.items() for v in pair])
    return units.withColumn("shard", number[F.col("_node")].cast("int")).drop("_node")


def _medians(units: DataFrame, nodes: dict[int, _Node], weight: str, tie_axis: str) -> None:
    """Sets the cut of each node: a value of its axis and, among the units at that value, of the tie axis, such that
    the weight up to there is nearest to the left child's share."""
    while open_ := {n: x for n, x in nodes.items() if x.cut is None}:
        value, bucket = F.lit(None).cast("double"), F.lit(None).cast("int")
        for n, x in open_.items():
            at = F.col(x.axis if x.tie is None else tie_axis).cast("double")
            inside = (F.col("_node") == n) & (at >= F.lit(x.low)) & (at <= F.lit(x.high))
            if x.tie is not None:
                inside &= F.col(x.axis) == F.lit(x.tie)
            value = F.when(inside, at).otherwise(value)
            bucket = F.when(inside, _bucket(at, x.low, x.high) if x.high > x.low else F.lit(0)).otherwise(bucket)
        rows = units.select("_node", F.col(weight).alias("w"), value.alias("v"), bucket.alias("b")).where("b is not null")
        counts: dict[int, list] = {n: [] for n in open_}
        for r in rows.groupBy("_node", "b").agg(F.sum("w").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            counts[r["_node"]].append((r["b"], float(r["w"]), r["lo"], r["hi"]))
        for n, x in open_.items():
            goal = x.total * ((x.shards + 1) // 2) / x.shards
            so_far, last = x.before, x.last
            for _, w, low, high in sorted(counts[n]):
                if so_far + w >= goal:
                    x.before, x.last = so_far, last
                    if low < high:
                        x.low, x.high = low, high
                    elif x.tie is None and x.axis != tie_axis:
                        x.tie, x.low, x.high, x.last = low, 0.0, 1.0, None
                    else:
                        over, under = so_far + w - goal, goal - so_far
                        edge = low if over <= under else (last if last is not None else -1.0)
                        x.cut = (edge, 1.0) if x.tie is None else (x.tie, edge)
                    break
                so_far, last = so_far + w, high
            else:
                x.cut = (x.high, 1.0) if x.tie is None else (x.tie, 1.0)


def shard(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", dimensions: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard under the law ``bytes``.

    size: UTF-8 bytes of the text (null: none) and 1. Equal texts make one unit and share a shard; null is a text of its own.
    A unit lies at its smallest metadata. slot counts a shard's rows from 0 in order of a hash bucket and the key; rows with
    the same key and text are told apart by nothing but their number. A unit larger than a shard's share makes its shard larger.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    body = raw.cast("binary")
    n = shuffle_partitions(df.sparkSession)
    rows = df.select(
        F.col(key),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.sha2(F.concat(F.when(F.col(text).isNull(), F.lit("n")).otherwise(F.lit("t")), raw), 256).alias("_unit"),
        *[F.pmod(F.xxhash64(F.col(d).cast("string")), F.lit(1 << 20)).cast("double").alias(f"_d{i}") for i, d in enumerate(dimensions) if d in df.columns],
    ).withColumn("_unit", F.substring("_unit", 1, 32))
    rows = written(rows, "sizes")
    axes = [c for c in rows.columns if c.startswith("_d")]
    units = rows.groupBy("_unit").agg(F.sum("size").alias("_bytes"), F.log(F.sum("size").cast("double")).alias("_log"), F.coalesce(F.min(key).try_cast("double"), F.lit(0.0)).alias("_key"), *[F.min(a).alias(a) for a in axes])
    units = written(units.withColumn("_hash", (F.conv(F.substring("_unit", 1, 13), 16, 10).cast("double") / _BIG)), "units")
    placed = written(split(units, ["_log", *axes, "_key", "_hash"], shards).select("_unit", "shard"), "placed")
    joined = rows.join(placed, "_unit").withColumn("_bucket", F.pmod(F.xxhash64(key, "size", "text_crc32"), F.lit(4 * n)).cast("int"))
    joined = written(joined.drop(*axes), "dealt")
    counts = joined.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("shard", "_bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("n")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(F.col(key), "size", "text_crc32"))
    out = joined.withColumn("_place", place).join(F.broadcast(starts), ["shard", "_bucket"])
    return out.select(key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_start") + F.col("_place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
