"""Folds along rows in order: partitions are sorted and streamed through Arrow batches, so memory holds a state and a batch, never a key's rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brindle.session import shared_folder


def _dealt(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each key's rows in one partition, in order.

    Dealt by a hash of the keys: rows that come from a join by the keys themselves would not be dealt anew, and a join may end up in other partitions than planned (broadcast, split) when it runs.
    """
    return df.select(*dict.fromkeys([*keys, *order, *columns])).repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def _schema(df: DataFrame, kept: list[str], outputs: str) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in kept], *T.StructType.fromDDL(outputs).fields])


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def running(df: DataFrame, keys: list[str], order: list[str], columns: list[str], outputs: str, start: Callable, step: Callable) -> DataFrame:
    """keys, order, columns and ``outputs`` (DDL) of each row, in order within each key.

    ``start(values of columns)`` makes a key's state at its first row, ``step(state, values)`` gives (state, outputs). Nulls come first.
    """
    dealt = _dealt(df, keys, order, columns)
    kept = dealt.columns
    schema = _schema(dealt, kept, outputs)
    arrow, n = to_arrow_schema(schema), len(outputs.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            out: list[list] = [[] for _ in range(n)]
            own = zip(*[b.column(c).to_pylist() for c in keys])
            values = zip(*[b.column(c).to_pylist() for c in columns]) if columns else ((),) * b.num_rows
            for k, v in zip(own, values):
                if k != key or state is None:
                    key, state = k, start(*v)
                state, got = step(state, *v)
                for place, x in zip(out, got):
                    place.append(x)
            yield pa.RecordBatch.from_arrays([*[b.column(i).cast(arrow.field(i).type) for i in range(len(kept))], *[pa.array(o, arrow.field(len(kept) + i).type) for i, o in enumerate(out)]], schema=arrow)

    return dealt.mapInArrow(run, schema)


def folded(df: DataFrame, keys: list[str], order: list[str], columns: list[str], outputs: str, start: Callable, step: Callable, end: Callable) -> DataFrame:
    """keys and ``outputs`` of each key: ``end(state)`` after ``state = step(state, values)`` along its rows in order."""
    dealt = _dealt(df, keys, order, columns)
    schema = _schema(dealt, keys, outputs)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for b in batches:
            for k, v in zip(zip(*[b.column(c).to_pylist() for c in keys]), zip(*[b.column(c).to_pylist() for c in columns])):
                if state is None or k != key:
                    if state is not None:
                        done.append((*key, *end(state)))
                    key, state = k, start()
                state = step(state, *v)
            if done:
                yield _batch(list(zip(*done)), arrow)
                done = []
        if state is not None:
            yield _batch(list(zip(*[(*key, *end(state))])), arrow)

    return dealt.mapInArrow(run, schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that what reads it twice sees the same rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def equal(a: str, b: str, columns: list[str]) -> Column:
    """Null-safe equality of two aliased frames' columns."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns])


def joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join by columns in which nulls are equal; they come once."""
    both = left.alias("l").join(right.alias("r"), equal("l", "r", columns), how)
    more = [] if how in ("left_semi", "left_anti") else [F.col(f"r.`{c}`").alias(c) for c in right.columns if c not in columns]
    return both.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns], *more)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the row's number within its key in order, from 0.

    Rows go to ranges of (keys, order) and are numbered there; a range's first number is the sum of the ranges before, a few rows a key. So a
    key of any size spreads over many tasks.
    """
    dealt = kept(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*keys, *order]]).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_c")).withColumn("_first", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) - 1
    return joined(dealt, counts, [*keys, "_part"]).withColumn(out, (local + F.col("_first")).cast("long")).drop("_part", "_first")
