"""Rows taken through a protocol in batches, step by step, with every step's result stored: whatever stops the driver, the next run goes on behind the last finished step.

A batch is a folder: its rows, then a table a step, each complete once Spark has marked it so. Rows whose last step is stored are done; the batch that has rows but not its last
step is the active one and comes first. Results do not depend on where a run was stopped, as a step that was cut short is written anew from the stored step before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.sources.readers import exists

Step = Callable[[dict[str, DataFrame]], DataFrame]


class Protocol:
    """``steps``: names and functions of the tables stored so far (``rows`` and earlier steps, by name). The last one has ``key``: its rows are the cards."""

    def __init__(self, spark: SparkSession, folder: str, key: str, steps: list[tuple[str, Step]]) -> None:
        if not steps or "rows" in dict(steps):
            raise ValueError("a protocol has steps, none of them named rows")
        self.spark, self.folder, self.key, self.steps = spark, folder.rstrip("/"), key, steps

    def _path(self, batch: int, name: str) -> str:
        return f"{self.folder}/batch={batch}/{name}"

    def _finished(self, batch: int, name: str) -> bool:
        return exists(self.spark, f"{self._path(batch, name)}/_SUCCESS")

    def _batches(self) -> int:
        """How many batches have their rows; they are numbered from 1, so that doubling and halving finds the last."""
        high = 1
        while self._finished(high, "rows"):
            high *= 2
        low = high // 2
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._finished(middle, "rows") else (low, middle)
        return low

    def active(self) -> int | None:
        """The batch that was begun and is not done."""
        last = self._batches()
        return last if last and not self._finished(last, self.steps[-1][0]) else None

    def cards(self) -> DataFrame | None:
        """What the last step gave, of all finished batches; None before the first."""
        last = self._batches()
        done = last - (self.active() is not None)
        if not done:
            return None
        paths = [self._path(b, self.steps[-1][0]) for b in range(1, done + 1)]
        return self.spark.read.parquet(*paths)

    def begin(self, rows: DataFrame, order: str, limit: int) -> int | None:
        """The active batch, else a new one of the first ``limit`` rows in order that have no card; None if all have."""
        if (batch := self.active()) is not None:
            return batch
        cards = self.cards()
        left = rows if cards is None else rows.join(cards.select(self.key), self.key, "left_anti")
        first = left.orderBy(order, self.key).limit(limit)
        if first.isEmpty():
            return None
        batch = self._batches() + 1
        first.write.mode("overwrite").parquet(self._path(batch, "rows"))
        return batch

    def finish(self, batch: int) -> None:
        """The steps of a batch that are not stored yet."""
        for k, (name, step) in enumerate(self.steps):
            if not self._finished(batch, name):
                done = {n: self.spark.read.parquet(self._path(batch, n)) for n in ["rows", *[n for n, _ in self.steps[:k]]]}
                step(done).write.mode("overwrite").parquet(self._path(batch, name))

    def run(self, rows: DataFrame, order: str, limit: int) -> DataFrame | None:
        """All rows to their cards. Every batch must give a card for each of its rows, else this ends with an error instead of taking them up again for ever."""
        while (batch := self.begin(rows, order, limit)) is not None:
            self.finish(batch)
            missing = self.spark.read.parquet(self._path(batch, "rows")).join(self.spark.read.parquet(self._path(batch, self.steps[-1][0])), self.key, "left_anti")
            if not missing.isEmpty():
                raise ValueError(f"batch {batch} leaves rows without a card")
        return self.cards()

    def progress(self, rows: DataFrame) -> DataFrame:
        """state, n: rows that are done, in the active batch, and still to come."""
        cards, batch = self.cards(), self.active()
        state = rows.select(self.key).withColumn("state", F.lit("pending"))
        for name, keys in (("active", self.spark.read.parquet(self._path(batch, "rows")) if batch else None), ("done", cards)):
            if keys is not None:
                state = state.join(keys.select(self.key).withColumn("_hit", F.lit(name)), self.key, "left").select(self.key, F.coalesce("_hit", "state").alias("state"))
        return state.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
