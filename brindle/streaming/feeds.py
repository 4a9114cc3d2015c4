"""Streams of new rows: triggers, resumable work, windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that arrive in a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def on_new_rows(stream: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str):
    """Run ``act`` on each micro-batch of what is there now, once each across restarts."""
    return stream.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: rows whose key has no terminal record."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def to_reconcile(active: DataFrame, raw: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Keys of the active batch with raw events but no checkpoint."""
    return active.select(key).join(raw.select(key).distinct(), key, "left_semi").join(processed.select(key).distinct(), key, "left_anti")


def daily_stream(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Daily counts of a stream; days close once the watermark has passed them."""
    return stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, "1 day")).agg(F.count(F.lit(1)).alias("n"))
