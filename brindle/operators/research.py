"""Research records: search attempts, opened pages, owners, candidates, gates and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.urls import host
from brindle.operators import eventlog


def successful(kind: Column, wanted: str, status: Column, parse_status: Column, cache_hit: Column) -> Column:
    """A live, parsed answer with a 2xx status of the wanted kind."""
    return F.coalesce((kind == wanted) & status.between(200, 299) & (parse_status == "parsed") & ~cache_hit.eqNullSafe(F.lit(True)), F.lit(False))


def is_terminal(state: Column, elapsed_s: Column, budget_s: int = 600) -> Column:
    """A final state; running out only counts once the budget was used."""
    return F.coalesce(state.isin("verified", "conflicted") | ((state == "exhausted_10m") & (elapsed_s >= budget_s)), F.lit(False))


def owner_by_rules(url: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(owner, branch) of the first rule (part of the host, owner, branch); else the host owns itself."""
    h = host(url)
    out = F.when(h.isNull(), F.struct(F.lit(None).cast("string").alias("owner"), F.lit("unknown").alias("branch")))
    for part, owner, branch in rules:
        out = out.when(F.contains(h, F.lit(part)), F.struct(F.lit(owner).alias("owner"), F.lit(branch).alias("branch")))
    return out.otherwise(F.struct(h.alias("owner"), F.lit("retailer").alias("branch")))


def search_record(urls: Column, seen: Column, most: int = 10) -> Column:
    """struct(candidates, hosts, fresh): the first distinct URLs, their hosts, and those not seen before."""
    first = F.slice(F.array_distinct(F.array_compact(urls)), 1, most)
    return F.struct(first.alias("candidates"), F.array_distinct(F.transform(first, host)).alias("hosts"), F.array_except(first, F.coalesce(seen, F.array().cast("array<string>"))).alias("fresh"))


def by_listed_id(rows: DataFrame, attempts: DataFrame, row: str, ids: str) -> DataFrame:
    """Rows with the attempts whose id list names them."""
    return rows.join(attempts.withColumn(row, F.explode(F.array_distinct(ids))), row)


def first_urls(parts: list[DataFrame], row: str, url: str, order: str, most: int = 4) -> DataFrame:
    """row, url, rank: the first distinct URLs of each row over several sources, in order; repeats keep their first place."""
    both = parts[0].select(row, url, order)
    for p in parts[1:]:
        both = both.unionByName(p.select(row, url, order))
    once = both.where(F.col(url).isNotNull()).groupBy(row, url).agg(F.min(order).alias(order))
    rank = F.row_number().over(Window.partitionBy(row).orderBy(order, url))
    return once.withColumn("rank", rank).where(F.col("rank") <= most).select(row, url, F.col("rank").cast("long").alias("rank"))


def source_facts(df: DataFrame, url: str, exact: DataFrame, registry: DataFrame, facts: list[str]) -> DataFrame:
    """Facts by exact URL, else by host; both sides are small dimensions that Spark broadcasts by their size."""
    a = exact.select(F.col("url").alias(url), *[F.col(f).alias(f"_e_{f}") for f in facts])
    b = registry.select(F.col("host").alias("_host"), *[F.col(f).alias(f"_h_{f}") for f in facts])
    got = df.join(a, url, "left").withColumn("_host", F.regexp_replace(host(F.col(url)), r"^www\.", "")).join(b, "_host", "left")
    return got.select(*df.columns, *[F.coalesce(f"_e_{f}", f"_h_{f}").alias(f) for f in facts])


def evaluate(df: DataFrame, row: str, exact: str, value: str, branch: str, trusted: list[str]) -> DataFrame:
    """Evidence of each row: exact matches, distinct values, branches, trust, two retailers, conflict, enough."""
    use = F.col(exact) & F.col(value).isNotNull()
    got = df.groupBy(row).agg(
        F.count_if(F.col(exact)).alias("exact"),
        F.count_distinct(F.when(use, F.col(value))).alias("values"),
        F.count_distinct(F.when(use, F.col(branch))).alias("branches"),
        F.coalesce(F.bool_or(use & F.col(branch).isin(trusted)), F.lit(False)).alias("trusted"),
        F.count_distinct(F.when(use & F.startswith(F.col(branch), F.lit("retailer")), F.col(branch))).alias("retailers"),
        F.min(F.when(use, F.col(value))).alias("observed"),
    )
    conflict = F.col("values") > 1
    enough = ~conflict & (F.col("trusted") | (F.col("retailers") >= 2))
    return got.withColumn("conflict", conflict).withColumn("enough", enough)


def gates(events: DataFrame, row: str, system: str, query_key: str, success: str, owner_success: str, owner: str) -> DataFrame:
    """row, systems, queries, owner_systems, owner_known: what a row's research must show."""
    ok, own = F.col(success), F.col(owner_success)
    return events.groupBy(row).agg(
        F.count_distinct(F.when(ok, F.col(system))).alias("systems"),
        F.count_distinct(F.when(ok & (F.col(query_key) != ""), F.col(query_key))).alias("queries"),
        F.count_distinct(F.when(own, F.col(system))).alias("owner_systems"),
        F.coalesce(F.bool_or(own & (F.trim(owner) != "")), F.lit(False)).alias("owner_known"),
    )


def gate_errors(systems: Column, queries: Column, saturated: Column, owner_systems: Column, unreviewed: Column) -> Column:
    """Codes of the gates that a row fails."""
    rules = [("systems", systems >= 2), ("queries", queries >= 2), ("saturation", saturated & (systems >= 2) & (queries >= 2)), ("owner_systems", owner_systems >= systems), ("unreviewed", unreviewed == 0)]
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))


def protocol_complete(systems: Column, queries: Column, branches: Column, saturated: Column) -> Column:
    """Arrays of systems, queries and retailer branches that suffice, and saturation."""
    return (F.size(F.array_distinct(systems)) >= 2) & (F.size(F.array_distinct(queries)) >= 4) & (F.size(F.array_distinct(branches)) >= 3) & saturated


def reobserve(recorded: DataFrame, current: DataFrame, url: str, value: str, digest: str) -> DataFrame:
    """Recorded evidence against the page as it is now: gone, rejected (another value), refreshed (another digest) or kept."""
    now = current.select(url, F.col(value).alias("_v"), F.col(digest).alias("_d"), F.lit(True).alias("_seen"))
    got = recorded.join(now, url, "left")
    state = F.when(F.col("_seen").isNull(), "gone").when(~F.col(value).eqNullSafe(F.col("_v")), "rejected").when(~F.col(digest).eqNullSafe(F.col("_d")), "refreshed").otherwise("kept")
    return got.select(*[F.when(state == "refreshed", F.col("_d")).otherwise(F.col(digest)).alias(digest) if c == digest else F.col(c) for c in recorded.columns], state.alias("state"))


def redecide(recorded: DataFrame, current: DataFrame, row: str, url: str, exact: str, value: str, digest: str, branch: str, trusted: list[str]) -> DataFrame:
    """row, before, after, lost: whether each row's evidence was enough as recorded, and is with what the pages show now; evidence that is gone or says another value no longer counts."""
    now = reobserve(recorded, current, url, value, digest)
    was = evaluate(recorded, row, exact, value, branch, trusted).select(row, F.col("enough").alias("before"))
    left = now.withColumn(exact, F.col(exact) & F.col("state").isin("kept", "refreshed"))
    after = evaluate(left, row, exact, value, branch, trusted).select(row, F.col("enough").alias("after"))
    lost = now.groupBy(row).agg(F.count_if(F.col(exact) & F.col("state").isin("gone", "rejected")).alias("lost"))
    return was.join(after, row).join(lost, row)


def qa_record(cards: DataFrame, events: DataFrame, results: DataFrame, again: DataFrame, key: str, order: str) -> DataFrame:
    """key, input_card_sha256, raw_events_sha256, derived_result_sha256, qa_status: what the check of each result was made on, by hash.

    ``cards``, ``results`` and ``again`` (derived a second time) have key and ``json``, ``events`` key, ``order`` and ``json``; all canonical. A result passes if the second derivation
    gives the same text and card and events are there.
    """
    sha = lambda df, name: df.select(key, F.sha2("json", 256).alias(name))
    raw = eventlog.list_hash(events, key, order, "json").withColumnRenamed("list_sha256", "raw_events_sha256")
    got = sha(results, "derived_result_sha256").join(sha(cards, "input_card_sha256"), key, "left").join(raw, key, "left").join(sha(again, "_again"), key, "left")
    passed = F.col("_again").eqNullSafe(F.col("derived_result_sha256")) & F.col("input_card_sha256").isNotNull() & F.col("raw_events_sha256").isNotNull()
    return got.select(key, "input_card_sha256", "raw_events_sha256", "derived_result_sha256", F.when(passed, "qa_passed").otherwise("qa_failed").alias("qa_status"))


def qa(derived: DataFrame, independent: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """row, passed, differing columns: two derivations of the same rows, either of which may lack one."""
    a = derived.select(row, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    b = independent.select(row, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    off = F.array_compact(F.array(*[F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in columns], F.when(F.col("_in_a").isNull() | F.col("_in_b").isNull(), F.lit("missing"))))
    return a.join(b, row, "full_outer").select(row, off.alias("differing")).withColumn("passed", F.size("differing") == 0)


def coverage(ids: DataFrame, results: DataFrame, checked: DataFrame, row: str) -> DataFrame:
    """Counts that must all be 0 before changes may be applied: rows without result, repeated results, unchecked or failed rows."""
    repeated = results.groupBy(row).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = [("no_result", ids.join(results, row, "left_anti")), ("repeated", repeated), ("unchecked", ids.join(checked, row, "left_anti")), ("failed", checked.where(~F.col("passed")))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check_name"), "failing")
        out = one if out is None else out.unionAll(one)
    return out
