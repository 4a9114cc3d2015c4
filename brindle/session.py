"""Makes the package importable for Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package along once a context, unless the workers' path or working folder has it already."""
    sc = spark.sparkContext
    system = sc._jvm.System
    paths = [*(system.getenv("PYTHONPATH") or "").split(os.pathsep), system.getProperty("user.dir")]
    if sc.applicationId in _SHIPPED or str(ROOT) in paths:
        return
    folder = Path(tempfile.mkdtemp(prefix="brindle-"))  # the driver serves the file from there as long as it lives
    shutil.copytree(ROOT / "brindle", folder / "stage" / "brindle", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(folder / "brindle"), "zip", folder / "stage"))
    _SHIPPED.add(sc.applicationId)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as the block runs."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables and checkpoints, which is set as the checkpoint folder too.

    Where the session names none: a temporary one on a single machine, an error on a cluster, whose executors do not share one.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="brindle-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where.rstrip("/")
