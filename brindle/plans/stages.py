"""The audit's stages over tables in one folder: freeze, repair, validate, check, approve, apply. Each reads what the one before wrote and refuses what does not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators import catalog, eventlog, research
from brindle.sources.readers import exists, stored


class Stages:
    """Tables by name in ``folder``, a path that Spark reads and writes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        if not exists(self.spark, self.path(name)):
            raise ValueError(f"{name} is not there yet")
        return self.spark.read.parquet(self.path(name))

    def freeze(self, rows: DataFrame, key: str = "input_id") -> DataFrame:
        """The snapshot, written once; a later call must bring the same rows."""
        return catalog.write_once(rows, self.path("snapshot"), key)

    def repair(self, log: str, order: str, good, name: str = "events") -> DataFrame:
        """Sound events up to each log's first bad one, as ``events_repaired``, with a manifest beside; the original stays as it is."""
        prefix, manifest = eventlog.repair(self.table(name), log, order, good)
        stored(manifest, self.path(f"{name}_manifest"))
        return stored(prefix, self.path(f"{name}_repaired"))

    def pilot(self, group: str, value, expected: int, key: str = "input_id") -> DataFrame:
        """The snapshot's rows of one group, which must be as many as expected."""
        rows = self.table("snapshot").where(F.col(group) == value)
        got = rows.count()
        if got != expected:
            raise ValueError(f"the pilot has {got} rows where {expected} were expected")
        return rows

    def validate(self, checks: DataFrame) -> DataFrame:
        """Counts of failures (check_name, failing), kept as ``validation``; any failure is an error once they are written."""
        return self._passed(stored(checks, self.path("validation")), "validation")

    def check(self, derived: DataFrame, independent: DataFrame, columns: list[str], key: str = "input_id") -> DataFrame:
        """A second derivation against the first, kept as ``checked``: key, differing, passed."""
        return stored(research.qa(derived, independent, key, columns), self.path("checked"))

    def approve(self, results: DataFrame, key: str = "input_id") -> DataFrame:
        """Every snapshot row has one result and a passed check, else an error; kept as ``approval``."""
        counts = research.coverage(self.table("snapshot"), results, self.table("checked"), key)
        return self._passed(stored(counts, self.path("approval")), "approval")

    def apply(self, decisions: DataFrame, column: str, key: str = "input_id") -> tuple[DataFrame, DataFrame]:
        """The catalog with approved changes, kept as ``applied``, and the list of changes, kept as ``changes``. Only after an approval without failures."""
        self._passed(self.table("approval"), "approval")
        base = self.table("snapshot")
        changes = stored(catalog.change_list(base, decisions, key, column), self.path("changes"))
        return stored(catalog.gated_changes(base, decisions, key, column), self.path("applied")), changes

    @staticmethod
    def _passed(counts: DataFrame, name: str) -> DataFrame:
        bad = counts.agg(F.sum("failing")).first()[0]
        if bad:
            raise ValueError(f"{name}: {bad} failures")
        return counts
