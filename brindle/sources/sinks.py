"""Sinks: CSV texts, JSON lines, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.functions.hashing import plain_number
from brindle.functions.measure import finite
from brindle.functions.text import csv_field, csv_quote
from brindle.sources.readers import exists


def history_line(ts: Column, brand: Column, name: Column, mg: Column) -> Column:
    """Date,Time,Brand,Name,Mg: texts always quoted and neutralised, a number that is not finite is empty; null without a date."""
    number = F.when(finite(mg), plain_number(mg)).otherwise("")
    return F.when(ts.isNotNull(), F.concat_ws(",", F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss"), csv_quote(brand), csv_quote(name), number))


def csv_line(*columns: Column) -> Column:
    """Fields quoted only where needed."""
    return F.concat_ws(",", *[csv_field(c) for c in columns])


def write_history(df: DataFrame, path: str, line: str, header: str = "Date,Time,Brand,Name,Mg") -> None:
    """CRLF lines in part files; the header, with a byte order mark, is its own first part."""
    spark = df.sparkSession
    head = spark.range(1).select(F.lit("\ufeff" + header).alias(line))
    head.unionAll(df.where(F.col(line).isNotNull()).select(line)).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_audit(ledger: DataFrame, sources: DataFrame, path: str, counted: dict[str, Column], review: Column, review_line: Column, sound: Column) -> dict[str, int]:
    """Five artefacts from one pass over the ledger and one over the sources; gives the counts.

    ``ledger`` and ``sources`` as JSON lines, ``review`` (CSV lines of the rows that meet ``review``, from the ledger as written), ``summary`` and ``progress`` as texts. The numbers are
    observed while the tables are written: rows, rows for review and ``counted`` (name to condition) of the ledger, rows and outages (not ``sound``) of the sources.
    """
    spark, yes = ledger.sparkSession, lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    of_rows, of_sources = Observation(), Observation()
    write_json_lines(ledger.observe(of_rows, F.count(F.lit(1)).alias("rows"), yes(review).alias("for_review"), *[yes(c).alias(n) for n, c in counted.items()]), f"{path}/ledger")
    write_json_lines(sources.observe(of_sources, F.count(F.lit(1)).alias("sources"), yes(~sound).alias("outages")), f"{path}/sources")
    numbers = {"rows": 0, "for_review": 0, **dict.fromkeys(counted, 0), "sources": 0, "outages": 0, **of_rows.get, **of_sources.get}
    back = spark.read.schema(ledger.schema).json(f"{path}/ledger")
    back.where(review).select(review_line.alias("value")).write.mode("overwrite").text(f"{path}/review")
    texts = {"summary": ["# Audit", "", *[f"- {n}: {numbers[n]}" for n in ("rows", *counted)]], "progress": ["# Progress", "", *[f"- {n}: {numbers[n]}" for n in ("rows", "for_review", "sources", "outages")]]}
    for name, lines in texts.items():
        spark.range(1).select(F.lit("\n".join(lines)).alias("value")).write.mode("overwrite").text(f"{path}/{name}")
    return numbers


def _hash(df: DataFrame) -> list[Column]:
    """Row count and a sum of row hashes, whatever the order."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")).alias("digest")]


def stage(df: DataFrame, folder: str) -> str:
    """Write a new version beside the current one and hold what was written against what went in; gives its name. Readers still see the old one."""
    spark, version, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    path = f"{folder.rstrip('/')}/versions/{version}"
    df.observe(seen, *_hash(df)).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if back.agg(*_hash(back)).first().asDict() != seen.get:
        raise ValueError("what was written is not what went in")
    return version


def switch(spark: SparkSession, folder: str, version: str) -> None:
    """Make a staged version the current one: the pointer file is written beside and renamed into place, so readers see the old or the new one and never neither."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path
    fresh, pointer = where(f"{folder.rstrip('/')}/.current-{uuid.uuid4().hex}"), where(f"{folder.rstrip('/')}/CURRENT")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    store = pointer.getFileSystem(conf)
    if not store.exists(where(f"{folder.rstrip('/')}/versions/{version}/_SUCCESS")):
        raise ValueError("no such version, or one that was not finished")
    out = store.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri() if pointer.toUri().getScheme() else store.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(store.makeQualified(fresh), store.makeQualified(pointer), options)


def publish(df: DataFrame, folder: str) -> str:
    """``stage``, then ``switch``: a driver lost between them leaves the old version current."""
    version = stage(df, folder)
    switch(df.sparkSession, folder, version)
    return version


def published(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The current version; none yet gives no rows."""
    pointer = f"{folder.rstrip('/')}/CURRENT"
    if not exists(spark, pointer):
        return spark.createDataFrame([], schema)
    version = spark.read.text(pointer, wholetext=True).first()["value"].strip()
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/versions/{version}")
