"""Hash-chained logs as a stream: the last event of each log is state, which may begin with stored ends."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ChainProcessor(StatefulProcessor):
    """Links the rows of a micro-batch, in order, behind the last event of their log."""

    def __init__(self, log: str, order: str, payload: str, names: list[str]) -> None:
        self.log, self.order, self.payload, self.names = log, order, payload, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getValueState("tail", "sequence bigint, hash string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.tail.update((int(row["sequence"]), row["event_sha256"]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values([self.order, self.payload], kind="stable")
        sequence, previous = self.tail.get() if self.tail.exists() else (0, None)
        before, own = [], []
        for text in pdf[self.payload]:
            before.append(previous)
            previous = hashlib.sha256(f"{previous or ''}\0{'' if text is None else text}".encode()).hexdigest()
            own.append(previous)
        self.tail.update((sequence + len(own), previous))
        yield pdf[self.names].assign(sequence=range(sequence + 1, sequence + 1 + len(own)), previous_sha256=before, event_sha256=own)

    def close(self) -> None:
        pass


def append_stream(stream: DataFrame, log: str, order: str, payload: str, tails: DataFrame | None = None) -> DataFrame:
    """The streaming twin of ``eventlog.append``: adds sequence, previous_sha256 and event_sha256.

    ``tails`` (log, sequence, event_sha256) are the ends of stored logs; they are read when the query first starts, later its own checkpoint counts. A micro-batch's rows of one log are ordered
    among themselves, so events must not arrive later than the batch of their successors. Needs the RocksDB state store.
    """
    spark = stream.sparkSession
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass"):
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    schema = StructType([*stream.schema.fields, *StructType.fromDDL("sequence bigint, previous_sha256 string, event_sha256 string").fields])
    first = tails.select(log, "sequence", "event_sha256").groupBy(log) if tails is not None else None
    return stream.groupBy(log).transformWithStateInPandas(ChainProcessor(log, order, payload, stream.columns), schema, "Append", "None", first)
