"""Catalogs: numbering, duplicates, conflicts, freezing, reconciling, gated patches."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.sources.readers import exists, stored


def exact_duplicates(df: DataFrame, parts: list[Column], row: str, order: str) -> DataFrame:
    """row, duplicate_of: rows that repeat an earlier row's parts. Grouped on a digest, so rows of any width shuffle 32 bytes.

    The first row of each digest comes from a partial aggregation and is joined back; a group of any size is not one task's.
    """
    key = F.sha2(F.concat_ws("\u0000", *[F.coalesce(p.cast("string"), F.lit("\u0001")) for p in parts]), 256)
    keyed = df.select(F.col(row), F.col(order).alias("_o"), key.alias("_k"))
    first = keyed.groupBy("_k").agg(F.min_by(row, "_o").alias("duplicate_of"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return keyed.join(first, "_k").where(F.col(row) != F.col("duplicate_of")).select(row, "duplicate_of")


def conflict_groups(df: DataFrame, keys: list[Column], value: str) -> DataFrame:
    """Groups with more than one distinct value: keys, distinct_values, group_rows. Two-level aggregation, so a hot group is pre-aggregated."""
    names = [f"k{i}" for i in range(len(keys))]
    values = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.col(value).alias("v")).groupBy(*names, "v").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy(*names).agg(F.count("v").alias("distinct_values"), F.sum("n").alias("group_rows")).where("distinct_values > 1")


def counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def next_batch(df: DataFrame, processed: DataFrame, key: str, group: str, order: str, limit: int = 25) -> DataFrame:
    """The first rows, in order, of the group of the first unprocessed row."""
    if not 1 <= limit <= 25:
        raise ValueError("a batch has 1 to 25 rows")
    left = df.join(processed.select(key), key, "left_anti")
    head = left.agg(F.min_by(group, order).alias("_g"))
    return left.join(F.broadcast(head), F.col(group) == F.col("_g")).drop("_g").orderBy(order).limit(limit)


def freeze(snapshot: DataFrame, verdicts: DataFrame, key: str, condition: Column) -> DataFrame:
    """Snapshot rows whose verdict meets the condition."""
    return snapshot.join(verdicts.where(condition).select(key).distinct(), key, "left_semi")


def write_once(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write a frozen table; if it is there already it must hold the same rows, else this fails. ``key`` names the rows in the error."""
    spark = df.sparkSession
    if not exists(spark, path):
        return stored(df, path)
    old = spark.read.parquet(path)
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias("_row")
    extra = set_difference(old.select(digest, key), df.select(digest, key), "_row") if set(old.columns) == set(df.columns) else df.select(key)
    if not extra.isEmpty():
        raise ValueError("the frozen rows differ")
    return old


def override(base: DataFrame, newer: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join; where a newer row exists its columns replace the base's, nulls included."""
    n = newer.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    picked = [F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    return base.join(n, key, "left").select(*picked)


def apply_changes(base: DataFrame, decisions: DataFrame, key: str, column: str) -> DataFrame:
    """Rows without a ``remove`` decision, with ``to`` in place of the column where given. Rows without decision stay."""
    d = decisions.select(key, "decision", "to")
    keep = base.join(d, key, "left").where(~F.col("decision").eqNullSafe("remove"))
    return keep.select(*[F.coalesce("to", column).alias(column) if c == column else F.col(c) for c in base.columns])


def gated_changes(base: DataFrame, decisions: DataFrame, key: str, column: str, expected: DataFrame | None = None) -> DataFrame:
    """``apply_changes`` that refuses unless each key decided on exists and, with ``expected`` (key, from), holds that value or the new one."""
    if not decisions.join(base, key, "left_anti").isEmpty():
        raise ValueError("decisions for unknown rows")
    if expected is not None:
        odd = base.join(expected, key).join(decisions.select(key, "to"), key).where(~F.col(column).eqNullSafe(F.col("from")) & ~F.col(column).eqNullSafe(F.col("to")))
        if not odd.isEmpty():
            raise ValueError("the base state is not the one decided on")
    return apply_changes(base, decisions, key, column)


def change_list(base: DataFrame, decisions: DataFrame, key: str, column: str) -> DataFrame:
    """key, action, from, to: what ``apply_changes`` does to each row it changes."""
    d = base.select(key, F.col(column).alias("from")).join(decisions.select(key, "decision", "to"), key)
    gone = F.coalesce(F.col("decision") == "remove", F.lit(False))
    rows = d.select(key, F.when(gone, "remove").otherwise("change").alias("action"), "from", F.when(~gone, F.col("to")).alias("to"))
    return rows.where((F.col("action") == "remove") | (F.col("to").isNotNull() & ~F.col("to").eqNullSafe(F.col("from"))))


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows; a key that repeats ends the query."""
    if not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{key} repeats")
    return df


def outcome_counts(df: DataFrame, named: dict[str, Column], keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, total and the number of rows that meet each named condition: one pass, one partial aggregation."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in named.items()])


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """side, key: distinct keys that one side lacks."""
    both = a.select(key).distinct().withColumn("s", F.lit(1)).unionAll(b.select(key).distinct().withColumn("s", F.lit(2)))
    side = both.groupBy(key).agg(F.sum("s").alias("s")).where("s < 3")
    return side.select(F.when(F.col("s") == 1, "left").otherwise("right").alias("side"), key)


def same_sequence(a: DataFrame, b: DataFrame, index: str, column: str) -> Column | bool:
    """Do two ordered columns agree at every index?"""
    x = a.select(index, F.col(column).alias("x"))
    y = b.select(index, F.col(column).alias("y"))
    return x.join(y, index, "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).isEmpty()


def snapshot_join(unresolved: DataFrame, inputs: DataFrame, current: DataFrame, key: str, same: list[str]) -> DataFrame:
    """The ``inputs`` rows of all unresolved keys; ends the query that reads it, within its own plan, where a key repeats among the unresolved, is missing
    from the inputs or differs there in a column of ``same``, or where the current rows no longer have these columns' values.
    """
    left = unresolved.select(key, *[F.col(c).alias(f"_u_{c}") for c in same]).withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(key)))
    found = left.join(inputs.withColumn("_in", F.lit(True)), key, "left")
    equal = lambda a, b: reduce(lambda x, y: x & y, [F.col(a.format(c)).eqNullSafe(F.col(b.format(c))) for c in same])
    live = current.select(*[F.col(c).alias(f"_c_{c}") for c in same]).distinct().withColumn("_live", F.lit(True))
    held = found.join(live, equal("{}", "_c_{}"), "left")
    fault = (
        F.when(F.col("_times") > 1, "repeats among the unresolved")
        .when(F.col("_in").isNull(), "is missing from the inputs")
        .when(~equal("{}", "_u_{}"), "differs from its input")
        .when(F.col("_live").isNull(), "is no longer in the current rows")
    )
    message = F.concat(F.lit(f"{key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(" "), fault)
    return held.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).select(*inputs.columns)


def first_by_url(candidates: DataFrame, url: str, order: list[str], row: str) -> tuple[DataFrame, DataFrame]:
    """One record a URL, the first in order, with the number of rows that want it; and the pairs (url, row), each once, so that a URL that all rows want is no list."""
    rest = [c for c in candidates.columns if c not in (url, row)]
    first = candidates.groupBy(url).agg(F.min_by(F.struct(*rest), F.struct(*order, row)).alias("_r"), F.count_distinct(row).alias("n_rows"))
    return first.select(url, "_r.*", "n_rows"), candidates.select(url, row).distinct()


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The same rows; a row that fails the condition ends the query with the message."""
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def delete_user(df: DataFrame, users: DataFrame, key: str) -> DataFrame:
    return df.join(users.select(key), key, "left_anti")


def checks(named: list[tuple[str, DataFrame]]) -> DataFrame:
    """check, failing: how many rows each named frame of failures has."""
    out = None
    for name, failing in named:
        one = failing.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check_name"), "failing")
        out = one if out is None else out.unionAll(one)
    return out


def pairs_in_blocks(left: DataFrame, right: DataFrame, keys: list[str], item: str, block: int = 4096, pairs: int = 1 << 25) -> DataFrame:
    """The rows of ``left`` with each ``item`` of the rows of ``right`` that have equal keys; a row with a null among its keys has none.

    For groups that are large on both sides: blocks of about ``block`` rows of a group meet pair by pair, so a group spreads over many tasks. A task holds an array of one block's items and makes
    about ``pairs`` pairs; it makes no other pairs than those it returns.
    """
    spark, own = left.sparkSession, [c for c in left.columns if c not in keys]
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys)
    total = sizes.agg(F.sum(F.col("_l").cast("double") * F.col("_r"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / pairs))
    blocks = sizes.select(*keys, F.ceil(F.col("_l") / block).alias("_nl"), F.ceil(F.col("_r") / block).alias("_nr"))
    place = lambda c, n: F.pmod(F.xxhash64(*c), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rows = left.join(blocks, keys).withColumn("_x", place(own, F.col("_nl"))).select(*keys, *own, "_x", every(F.col("_nr")).alias("_y"))
    items = right.select(*keys, item).join(blocks, keys).withColumn("_y", place([item], F.col("_nr"))).groupBy(*keys, "_nl", "_y").agg(F.collect_list(item).alias("_items"))
    items = items.select(*keys, "_y", "_items", every(F.col("_nl")).alias("_x"))
    cell = [*keys, "_x", "_y"]
    return rows.repartition(tasks, *cell).join(items.repartition(tasks, *cell), cell).select(*own, F.explode("_items").alias(item))
