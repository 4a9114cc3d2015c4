"""Plumbing that the operators of this subpackage share.

Everything here keeps three rules: inputs are reached through Spark's readers
only, intermediate tables go to the shared folder that ``spark.checkpoint.dir``
names, and what is brought to the driver has a bound that does not grow with
the number of rows.
"""

from __future__ import annotations

import json
import uuid
import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.session import settings, shared_folder

GUARD = "_guard"
CELL = "_cell"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with more columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items())])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_PATHS: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here and a lost executor costs nothing. Files of the shuffles that made it go as soon as it is written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, once all that reads them has been written itself."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the column's text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array and n + 1 offsets; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, most: int):
    """Runs of rows [i, j) of about ``most`` bytes; a longer text makes a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def placement_keys(spark: SparkSession, n: int) -> list[int]:
    """For each p < n a long that ``repartition(n, key)`` sends to partition p."""
    found: dict[int, int] = {}
    top = 16 * n + 64
    while len(found) < n:
        for key, part in spark.range(top).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).collect():
            found.setdefault(part, key)
        top *= 4
    return [found[p] for p in range(n)]


def _found(key: Column, bounds: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``bounds`` are at most ``key``: a binary search over one literal array, so the expression does not grow with ``n``."""
    steps = F.sequence(F.lit(1), F.lit(max(1, n.bit_length())))
    start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))

    def step(span: Column, _: Column) -> Column:
        mid = F.floor((span["low"] + span["high"]) / 2).cast("int")
        above = F.get(bounds, mid) > key
        done = span["low"] >= span["high"]
        return F.struct(F.when(done | above, span["low"]).otherwise(mid + 1).alias("low"), F.when(~done & above, mid).otherwise(span["high"]).alias("high"))

    return F.aggregate(steps, start, step, lambda span: span["low"])


def _literals(rows: list, schema: T.DataType) -> Column:
    """An array of (k, h) pairs as one folded literal."""
    kind = schema.simpleString()
    return F.from_json(F.lit(json.dumps([{"k": k, "h": h} for k, h in rows])), f"array<struct<k:{kind},h:bigint>>")


def in_order(df: DataFrame, key: str, ties: list[Column], partitions: int | None = None, before: bool = True, wrap: bool = False, weight: Column | None = None) -> DataFrame:
    """Rows dealt to contiguous ranges of (``key``, hash of ``ties``) and sorted there, each range with its neighbours' edge rows.

    ``key`` must not be null; it is a long or a string. Rows of one key may be in several ranges; only rows that agree in key and ties share one. Adds ``_cell``
    (rank of the range) and ``_guard``: 0 for a range's own rows, 1 for a row like the first that
    follows the range and, if ``before``, -1 for one like the last that precedes it. One shuffle
    of the rows. Fine ranges come from about 64 keys a partition drawn by rows, not by tasks; what each holds of ``weight`` (rows if none)
    is then summed exactly, and neighbouring ones are joined to ranges of even weight. A bounded number of fine ranges a partition comes to the driver.
    """
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    kind = df.schema[key].dataType
    at = F.struct(F.col(key).alias("k"), F.xxhash64(*ties).alias("h"))
    keys = df.select(at.alias("at"), (weight if weight is not None else F.lit(1)).cast("double").alias("w"))
    total, drawn = df.count(), keys.select("at")
    drawn = drawn if total <= 64 * n else drawn.where(F.rand(17) < 64 * n / total)
    sample = sorted((r["at"]["k"], r["at"]["h"]) for r in drawn.collect())
    bounds = sorted({sample[len(sample) * i // (8 * n)] for i in range(1, 8 * n)}) if sample else []
    fine = lambda one: _found(one, _literals(bounds, kind), len(bounds)) if bounds else F.lit(0)
    found = keys.select("at", "w", fine(F.col("at")).alias(CELL)).groupBy(CELL).agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.sum("w").alias("w")).collect()
    found = sorted((r[CELL], tuple(r["lo"]), tuple(r["hi"]), r["w"]) for r in found)
    share, so_far, joined = max(sum(f[3] for f in found) / n, 1e-9) if found else 1.0, 0.0, [0] * (len(bounds) + 1)
    spans: dict[int, list] = {}
    for number, low, high, w in found:
        cell = min(n - 1, int((so_far + w / 2) / share))
        so_far += w
        joined[number] = cell
        spans.setdefault(cell, [low, high])[1] = high
    edges = [(cell, *span) for cell, span in sorted(spans.items())]
    rank = lambda one: F.get(F.from_json(F.lit(json.dumps(joined)), "array<int>"), fine(one))
    own = df.withColumn("_at", at).withColumn(CELL, rank(at)).withColumn(GUARD, F.lit(0))
    out = own.drop("_at")
    neighbours = [(1, 1, edges[1:], edges)] + ([(-1, 2, edges, edges[1:])] if before else [])
    for flag, side, sources, targets in neighbours:
        to = dict(zip((e[0] for e in sources), (e[0] for e in targets)))
        if flag == 1 and wrap and edges:
            to[edges[0][0]] = edges[-1][0]
        if to:
            ends = {e[0]: e[side] for e in edges}
            cells = n
            edge = F.element_at(_literals([ends.get(c, edges[0][1]) for c in range(cells)], kind), F.col(CELL) + 1)
            target = F.element_at(F.from_json(F.lit(json.dumps([to.get(c, -1) for c in range(cells)])), "array<int>"), F.col(CELL) + 1)
            like = own.where(F.col("_at") == edge).groupBy(F.col(CELL)).agg(F.any_value(F.struct(*df.columns)).alias("row"))
            like = like.withColumn(CELL, target).where(F.col(CELL) >= 0).select("row.*", CELL, F.lit(flag).alias(GUARD))
            out = out.unionByName(like)
    place = placement_keys(spark, n)
    spot = F.element_at(F.from_json(F.lit(json.dumps(place)), "array<bigint>"), F.pmod(F.col(CELL), F.lit(n)) + 1)
    return out.withColumn("_spot", spot).repartition(n, "_spot").drop("_spot").sortWithinPartitions(CELL, GUARD, key, F.xxhash64(*ties))
