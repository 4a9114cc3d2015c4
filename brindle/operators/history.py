"""Per-user event histories: daily counts, streaks, achievements, merging, bands, costs."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brindle.functions.dates import last_sunday_before


def daily_counts(df: DataFrame, keys: list[str], ts: str, local_day: str | None = None, out: str = "n") -> DataFrame:
    """Rows a day; a stored local day wins over the instant's, rows without either go. One partial aggregation."""
    day = F.to_date(ts) if local_day is None else F.coalesce(F.col(local_day).try_cast("date"), F.to_date(ts))
    return df.select(*keys, day.alias("day")).where("day is not null").groupBy(*keys, "day").agg(F.count(F.lit(1)).alias(out))


def recorded_day_streak(days: DataFrame, user: str, anchor: Column, limit: str, n: str = "n") -> DataFrame:
    """Length of the run of recorded days within their limits that ends today or yesterday; 0 where there is none.

    ``days``: user, day, n and a limit; a day counts while 0 < n <= limit.
    """
    rows = days.select(user, "day", n, limit, anchor.cast("date").alias("_today")).where("day <= _today")
    good = rows.where((F.col(n) > 0) & (F.col(n) <= F.col(limit)))
    place = F.row_number().over(Window.partitionBy(user).orderBy(F.desc("day")))
    runs = good.withColumn("_run", F.date_add("day", place.cast("int")))
    ends = runs.groupBy(user, "_run").agg(F.max("day").alias("_last"), F.count(F.lit(1)).alias("streak"), F.max("_today").alias("_today"))
    broken = rows.where("day = _today").select(user, F.col(n).alias("_n"), F.col(limit).alias("_l")).where("_n > _l").select(user).withColumn("_over", F.lit(True))
    alive = ends.where("_last >= date_sub(_today, 1)").join(broken, user, "left").where("_over is null").select(user, "streak")
    return days.select(user).distinct().join(alive, user, "left").select(user, F.coalesce("streak", F.lit(0)).cast("long").alias("streak"))


def period_achievements(days: DataFrame, users: DataFrame, user: str, today: Column, limit: Column) -> DataFrame:
    """yesterday_success and clean_weekend of each user (user, created day).

    A day without rows counts 0; a period only counts if tracking began on or before its first day.
    """
    sunday = last_sunday_before(F.col("_today"))
    at = users.withColumn("_today", today.cast("date")).withColumn("_yesterday", F.date_sub("_today", 1)).withColumn("_sun", sunday).withColumn("_sat", F.date_sub("_sun", 1))
    sums = at.join(days, user, "left").groupBy(user, "created", "_yesterday", "_sat", "_sun")
    on = lambda c: F.coalesce(F.sum(F.when(F.col("day") == F.col(c), F.col("n"))), F.lit(0))
    got = sums.agg(on("_yesterday").alias("_y"), on("_sat").alias("_a"), on("_sun").alias("_b"))
    return got.select(
        user,
        ((F.col("created") <= F.col("_yesterday")) & (F.col("_y") <= limit)).alias("yesterday_success"),
        ((F.col("created") <= F.col("_sat")) & (F.col("_a") <= limit) & (F.col("_b") <= limit)).alias("clean_weekend"),
    )


def last_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, the last in order."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def newest_first(df: DataFrame, date: str, *ties: str) -> DataFrame:
    """Rows with the latest date first and those without one last, ties by further columns: a total sort by ranges."""
    return df.orderBy(F.col(date).desc_nulls_last(), *ties)


def merge_histories(local: DataFrame, remote: DataFrame, key: str, order: list[str], date: str | None = None) -> DataFrame:
    """Union by key, the remote side wins whole rows, then the last row of a side; one aggregation, no join. With ``date`` the newest come first, ties by key."""
    both = local.withColumn("_side", F.lit(0)).unionByName(remote.withColumn("_side", F.lit(1)))
    out = last_by_key(both, key, ["_side", *order]).drop("_side")
    return newest_first(out, date, key) if date else out


def local_only(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """Local rows, repeats too, whose key the remote side lacks."""
    return local.join(remote.select(key), key, "left_anti").select(*local.columns)


def owner_mode(owner: Column, uid: Column) -> Column:
    """guest, current or other: whether a synced history may merge."""
    return F.when(F.coalesce(owner, F.lit("")).isin("", "guest"), "guest").when(owner == uid, "current").otherwise("other")


def first_band(df: DataFrame, value: str, bands: list[dict], facts: list[str]) -> DataFrame:
    """Facts of the first band (in order) whose max is not under the value, else of the last; null values get none."""
    out = {}
    for fact in facts:
        c = F.lit(bands[-1][fact])
        for band in reversed(bands):
            c = F.when(F.col(value) <= band["max"], F.lit(band[fact])).otherwise(c)
        out[fact] = F.when(F.col(value).isNotNull(), c)
    return df.withColumns(out)


def calendar(days: DataFrame, keys: list[str]) -> DataFrame:
    """Daily counts with the missing days of each key's span as 0."""
    span = days.groupBy(*keys).agg(F.min("day").alias("a"), F.max("day").alias("b")).select(*keys, F.explode(F.sequence("a", "b")).alias("day"))
    return span.join(days, [*keys, "day"], "left").select(*keys, "day", F.coalesce("n", F.lit(0)).alias("n"))


def hourly_heatmap(df: DataFrame, ts: str) -> DataFrame:
    """Rows by day of week (0 = Sunday) and hour."""
    return df.groupBy((F.dayofweek(ts) - 1).cast("int").alias("dow"), F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def cost(n: Column, pack_price: float, per_pack: float) -> Column:
    """Assumed formula (the documentation names the feature only): units times the price of one."""
    return n * pack_price / per_pack


def taper_limit(day: Column, start: Column, target: Column, first: Column, strategy: str) -> Column:
    """Assumed formulas: smooth falls linearly to 0 at the target, weekly in steps of 7 days, cutoff drops at the target."""
    total, gone = F.datediff(target, start), F.datediff(day, start)
    if strategy == "weekly":
        gone = F.floor(gone / 7) * 7
    if strategy in ("smooth", "weekly"):
        return F.when(day >= target, F.lit(0)).otherwise(F.ceil(first * (total - gone) / total)).cast("long")
    return F.when(day >= target, F.lit(0)).otherwise(first).cast("long")


def page_of(df: DataFrame, order: list[Column], page: int, size: int = 14) -> DataFrame:
    """A page of an ordered listing; pages count from 1."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def _calls(spark: SparkSession, path: str) -> tuple[Any, Callable[[str], Any], dict[int, bool]]:
    """The store, its paths by name, and the numbers of the calls that a table of users has: is the call finished?"""
    jvm = spark._jvm
    place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    store = place("rows").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [x.getPath().getName() for x in store.listStatus(place("rows"))] if store.exists(place("rows")) else []
    return store, place, {int(n[6:]): store.exists(place(f"named/{n}/_SUCCESS")) for n in names if n.startswith("_call=")}


def _write_call(rows: DataFrame, named: DataFrame, path: str) -> None:
    """The users that a call names are written last: without them it is not there."""
    store, place, calls = _calls(named.sparkSession, path)
    n = max(calls, default=0) + 1
    while not store.createNewFile(place(f"rows/.call-{n}")):  # another caller's
        n += 1
    rows.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/rows/_call={n}")
    named.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/named/_call={n}")


def replace_users(snapshots: DataFrame, users: DataFrame, path: str, user: str) -> None:
    """Each of ``users`` gets the rows of ``snapshots`` in place of those stored; one without rows there ends up with none. Files of other users are not touched.

    A call adds its rows and the users it names, with or without rows, and changes no file; more users make no more files. A user's rows are those of the last finished call that names it
    (``stored_users``); rows of earlier calls stay on disk until ``compact_users``.
    """
    named = users.select(user).where(F.col(user).isNotNull()).distinct()
    _write_call(snapshots.join(named, user, "left_semi"), named, path)


def _last_calls(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of each user's last call; the users named in any."""
    done = [n for n, finished in sorted(_calls(spark, path)[2].items()) if finished]
    if not done:
        return spark.createDataFrame([], schema), spark.createDataFrame([], schema)
    read = lambda kind, reader: reader.option("basePath", f"{path.rstrip('/')}/{kind}").parquet(*[f"{path.rstrip('/')}/{kind}/_call={n}" for n in done])
    named = read("named", spark.read)
    user = named.columns[0]
    last = named.groupBy(user).agg(F.max("_call").cast("long").alias("_call"))
    rows = read("rows", spark.read.schema(StructType([*schema.fields, StructField("_call", LongType())])))
    return rows.join(last, [user, "_call"], "left_semi").select(*[f.name for f in schema.fields]), last.select(user)


def stored_users(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table that ``replace_users`` keeps; ``schema`` is that of the snapshots."""
    return _last_calls(spark, path, schema)[0]


def compact_users(spark: SparkSession, path: str, schema: StructType) -> None:
    """The same table as one call: rows that were replaced go from the disk. Nobody else may read or write it meanwhile; if it fails, the table holds what it held."""
    store, place, calls = _calls(spark, path)
    if any(calls.values()):
        _write_call(*_last_calls(spark, path, schema), path)
    for n in calls:  # a call's names go first: without them it is not read
        store.delete(place(f"named/_call={n}"), True)
        store.delete(place(f"rows/_call={n}"), True)
