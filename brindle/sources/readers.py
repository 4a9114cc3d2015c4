"""Readers. All go through Spark, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.operators import eventlog

_STRING = r'"(?:\\.|[^"\\]++)*+"'
_NUMBER = r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?"
#: A catalog literal on a line of its own; commas and brackets may stand before or after it.
CATALOG_ROW = rf"^[\s,\[]*\{{\s*b\s*:\s*({_STRING})\s*,\s*n\s*:\s*({_STRING})\s*,\s*mg\s*:\s*({_NUMBER})\s*,?\s*\}}[\s,;\]]*$"


def _literal(line: Column) -> list[Column]:
    quoted = lambda i: F.get_json_object(F.concat(F.lit('{"v":'), F.regexp_extract(line, CATALOG_ROW, i), F.lit("}")), "$.v")
    return [quoted(1).alias("b"), quoted(2).alias("n"), F.regexp_extract(line, CATALOG_ROW, 3).cast("double").alias("mg")]


def catalog_lines(df: DataFrame, line: str, number: str) -> DataFrame:
    """line_number, b, n, mg of the lines that hold a literal; others are passed over."""
    return df.where(F.col(line).rlike(CATALOG_ROW)).select(F.col(number).alias("line_number"), *_literal(F.col(line)))


def catalog_file(spark: SparkSession, path: str) -> DataFrame:
    """Catalog rows of one source file with original_index from 1. A source file is one record; its lines are numbered inside it, without a shuffle."""
    lines = F.transform(F.split("value", r"\r?\n"), lambda text, i: F.struct((i + 1).alias("at"), text.alias("text")))
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(lines, lambda x: x["text"].rlike(CATALOG_ROW))).alias("p", "x"))
    return rows.select((F.col("p") + 1).alias("original_index"), F.col("x.at").alias("line_number"), *_literal(F.col("x.text")))


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder, in whatever store the path names?"""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a path that must be new, and read back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_count(df: DataFrame, expected: int) -> DataFrame:
    """The same rows; another number of rows than expected ends the query."""
    got = df.count()
    if got != expected:
        raise ValueError(f"{got} rows where {expected} were expected")
    return df


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object a line; a malformed line ends the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def event_log(spark: SparkSession, path: str, schema: StructType | str, log: str, event: str, payload: str) -> DataFrame:
    """A folder of JSON Lines event logs, checked as it is read: a malformed line or a broken chain ends the query that reads it. A missing path gives no rows.

    ``schema`` has sequence, previous_sha256 and event_sha256 beside the columns named.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = StructType(list(schema.fields)).add("_broken", "string")
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    parsed = lines.select("file", "value", F.from_json("value", fields, {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    sound = F.col("r").isNotNull() & F.col("r._broken").isNull()
    message = F.concat(F.lit("malformed event in "), F.col("file"), F.lit(": "), F.left("value", F.lit(80)))
    parsed = parsed.where(F.when(sound, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return eventlog.require_chain(parsed.select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]), log, event, payload)


def cached_json(spark: SparkSession, path: str, pattern: str, schema: StructType | str) -> DataFrame:
    """One JSON document a file, by name pattern; a file that does not parse as a whole is passed over, all of it."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = StructType(list(schema.fields)).add("_broken", "string")
    whole = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", fields, {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where("r is not null and r._broken is null").select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def load_or_create(spark: SparkSession, path: str, make) -> DataFrame:
    """A snapshot that is written once and read ever after."""
    return spark.read.parquet(path) if exists(spark, path) else stored(make(), path)


def tagged_union(parts: list[tuple[DataFrame, dict]]) -> DataFrame:
    """Sources of differing columns in one table, each tagged with its facts."""
    out = None
    for df, tags in parts:
        df = df.withColumns({k: F.lit(v) for k, v in tags.items()})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def safe_json(raw: Column, fallback: str) -> Column:
    return F.coalesce(F.try_parse_json(F.when(raw != "", raw)), F.parse_json(F.lit(fallback)))
