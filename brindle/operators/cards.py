"""Research cards: what is recorded of a source, decided about it, and checked before a card counts."""

from __future__ import annotations

import gzip
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.hashing import canonical_json, sha256_hex
from brindle.functions.matching import compare_identity, exact_variant
from brindle.functions.measure import finite, per_unit
from brindle.functions.text import csv_field, normalize_candidate, overlap_ratio
from brindle.functions.urls import is_http, url_key
from brindle.operators.discovery import OWNER_BRANCHES, core_tokens
from brindle.operators.validate import is_hash

#: What a card and its sources may say.
OUTCOMES = ["verified", "conflicted", "not_verifiable_after_protocol"]
DECISIONS = ["exact_match", "near_match", "wrong_variant"]
TRUSTED_BRANCHES = ["manufacturer", "brand_owner", "regulator_us", "regulator_canada", "regulator_sweden", "regulator_denmark"]
REVIEW_HEADER = ["input_id", "original_index", "brand", "name", "mg", "decision", "existence_status", "sale_status", "strength_status", "reason_code", "observed_mg_per_pouch", "evidence_urls", "notes"]
#: Columns of an observation.
OBSERVED = ["brand", "title", "sku", "gtin", "price", "available", "format", "observed_mg_per_pouch", "observed_mg_per_g", "net_weight_g", "pouch_count"]


def distinct_non_empty(values: Column) -> Column:
    """Distinct values in first order, without nulls and empty texts."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v.cast("string") != "")))


def market(brand: Column, us: list[str], swedish: list[str]) -> Column:
    """The market that a brand's registry is looked up in."""
    return F.when(brand.isin(us), "US").when(brand.isin(swedish), "Sweden/European retail").otherwise("UK/EU retail reference market")


def definition_join(df: DataFrame, brand: str, definitions: DataFrame) -> DataFrame:
    """Left join to official definitions (brand, owner, branch, kind, url) on the normalised brand; the first by url where a brand has several."""
    facts = [c for c in definitions.columns if c != "brand"]
    one = definitions.groupBy(normalize_candidate(F.col("brand")).alias("_brand")).agg(F.min_by(F.struct(*facts), "url").alias("_d"))
    return df.withColumn("_brand", normalize_candidate(F.col(brand))).join(one, "_brand", "left").select(*df.columns, *[F.col(f"_d.{c}").alias(c) for c in facts])


# --- decisions


def product_decision(brand: Column, name: Column, seen_brand: Column, seen_name: Column, strength: Column, page_kind: Column) -> Column:
    """exact_match, near_match or wrong_variant by brand equality and the name being in the seen one, in lower case."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    same_brand, same_name = low(seen_brand) == low(brand), F.contains(low(seen_name), low(name))
    exact = same_brand & same_name & finite(strength) & F.coalesce(page_kind == "product_detail", F.lit(False))
    return F.when(exact, "exact_match").when(same_brand | same_name, "near_match").otherwise("wrong_variant")


def preliminary_decision(brand: Column, name: Column, seen_brand: Column, seen_name: Column, claims: Column, page_kind: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """The same by canonical identity; exact needs a claim by pouch or gram (``claims``: array of basis, value)."""
    same = compare_identity(brand, name, seen_brand, seen_name, aliases)["identity_match"]
    claimed = F.coalesce(F.exists(claims, lambda c: c["basis"].isin("per_pouch", "per_g")), F.lit(False))
    exact = (same == "exact") & claimed & F.coalesce(page_kind == "product_detail", F.lit(False))
    return F.when(exact, "exact_match").when(same == "near", "near_match").otherwise("wrong_variant")


def title_overlap(name: Column, title: Column) -> Column:
    """Share of the name's core words, repeats counted, that the title has; 0 where the name has none."""
    return overlap_ratio(core_tokens(name), core_tokens(title))


def classify(name: Column, mg: Column, title: Column, observed: Column) -> Column:
    """A page's title against a row: another strength on a close title is wrong, then the exact rule, then half the words."""
    stated = F.replace(F.regexp_extract(title, r"(?i)(\d+(?:[.,]\d+)?)\s*mg", 1), F.lit(","), F.lit(".")).try_cast("double")
    close = title_overlap(name, title) >= 0.5
    return (
        F.when(F.coalesce(title, F.lit("")) == "", "near_match")
        .when(F.coalesce(stated != mg, F.lit(False)) & close, "wrong_variant")
        .when(exact_variant(name, mg, title, observed), "exact_match")
        .when(close, "near_match")
        .otherwise("wrong_variant")
    )


def evidence_decision(sources: DataFrame, key: str) -> DataFrame:
    """key, outcome, met, values: exact sources with a strength, by key.

    ``sources``: key, match_decision, strength, source_owner, evidence_branch. More than one value from more than one owner conflicts; a trusted branch or two retail owners
    verify. One pass: owners and values are counted after each (key, owner, value) is one row, so no row is copied for a second distinct count.
    """
    exact = F.col("match_decision") == "exact_match"
    use = exact & finite(F.col("strength"))
    retail = F.startswith(F.col("evidence_branch"), F.lit("retailer_")) | (F.col("evidence_branch") == "retailer_group")
    small = sources.groupBy(key, F.coalesce("source_owner", "evidence_branch").alias("_o"), F.when(use, F.col("strength")).alias("_v")).agg(
        F.bool_or(use & F.col("evidence_branch").isin(TRUSTED_BRANCHES)).alias("_t"), F.bool_or(use & retail).alias("_r")
    )
    known = F.col("_v").isNotNull()
    got = small.groupBy(key).agg(
        F.array_sort(F.collect_set("_v")).alias("values"),
        F.size(F.collect_set(F.when(known, F.col("_o")))).alias("_owners"),
        F.size(F.collect_set(F.when(known & F.col("_r"), F.col("_o")))).alias("_retail"),
        F.coalesce(F.bool_or("_t"), F.lit(False)).alias("_trusted"),
    )
    conflict = (F.size("values") > 1) & (F.col("_owners") > 1)
    verified = (F.size("values") > 0) & (F.col("_trusted") | (F.col("_retail") >= 2))
    outcome = F.when(conflict, "conflicted").when(verified, "verified").otherwise("not_verifiable_after_protocol")
    return got.select(key, outcome.alias("outcome"), (conflict | verified).alias("met"), "values")


def independent_evidence(opened: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """key, evidence, groups, values, rejected, conflict: exact evidence derived anew from opened pages and decisions, for a second opinion.

    ``opened``: key, url, page_kind, parse_status, status, identity_matches, strength, source_class, owner_group. ``decided``: key, url, match_decision. A page decided exact that
    does not hold up is rejected; evidence beyond one page an owner group shows as evidence > groups.
    """
    both = opened.join(decided.where("match_decision = 'exact_match'").select(key, "url").distinct(), [key, "url"])
    holds = F.coalesce((F.col("source_class") != "unknown") & (F.col("page_kind") == "product_detail") & (F.col("parse_status") == "parsed") & F.col("status").between(200, 299) & F.col("identity_matches") & finite(F.col("strength")), F.lit(False))
    small = both.select(key, holds.alias("_h"), "owner_group", "strength").groupBy(key, "_h", "owner_group", "strength").agg(F.count(F.lit(1)).alias("_n"))
    sum_of = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    got = small.groupBy(key).agg(
        sum_of(F.col("_h")).alias("evidence"),
        F.size(F.collect_set(F.when(F.col("_h"), F.col("owner_group")))).alias("groups"),
        F.size(F.collect_set(F.when(F.col("_h"), F.col("strength")))).alias("values"),
        sum_of(~F.col("_h")).alias("rejected"),
    )
    return got.withColumn("conflict", (F.col("values") > 1) & (F.col("groups") > 1))


# --- projections


def _fields(names: list[str], have: list[str], renamed: dict[str, str] | None = None) -> list[Column]:
    """The named columns as they are, null where the table lacks them."""
    return [(F.col(n) if n in have else F.lit(None).cast("string")).alias((renamed or {}).get(n, n)) for n in names]


def flat_record(df: DataFrame, digest_of: str, checked_at: Column, kind: str = "structured_product_detail") -> DataFrame:
    """One flat record of a response and what was parsed from it; ``digest_of`` is the body, whose hash stays in its place."""
    head = [n for n in ("url", "status", "source_owner", "branch") if n in df.columns]
    rest = [n for n in df.columns if n not in (*head, *OBSERVED, digest_of)]
    return df.select(*head, checked_at.alias("checked_at"), sha256_hex(F.coalesce(digest_of, F.lit(""))).alias("response_sha256"), F.lit(kind).alias("evidence_kind"), *_fields(OBSERVED, df.columns), *rest)


def live_records(df: DataFrame, body: str, checked_at: Column) -> DataFrame:
    """Flat records of live pages; pages without a title give none."""
    return flat_record(df.where(F.col("title").isNotNull() & (F.col("title") != "")), body, checked_at, "live_product_detail")


def evidence(df: DataFrame, note: Column) -> Column:
    """struct: a record as a piece of evidence, what was observed in a struct of its own."""
    head = ["source_id", "source_owner", "branch", "url", "title", "checked_at", "response_sha256"]
    kind = F.coalesce("evidence_kind", F.lit("structured_source")) if "evidence_kind" in df.columns else F.lit("structured_source")
    return F.struct(kind.alias("evidence_type"), *_fields(head, df.columns), F.struct(*_fields(OBSERVED, df.columns, {"title": "name"})).alias("observed"), note.alias("note"))


def explicit_facts(df: DataFrame, market_: Column) -> Column:
    """struct: stated facts, the strength worked out from concentration, weight and count where it is not stated, and how."""
    numbers = {n: (F.col(n) if n in df.columns else F.lit(None)).cast("double") for n in ("observed_mg_per_pouch", "observed_mg_per_g", "net_weight_g", "pouch_count")}
    direct, per_g, grams, count = numbers.values()
    value = per_unit(direct, per_g, grams, count)
    how = F.when(~F.coalesce(finite(direct), F.lit(False)) & value.isNotNull(), "mg_per_g * net_weight_g / pouch_count")
    return F.struct(*_fields(["brand"], df.columns), *_fields(["title"], df.columns, {"title": "name"}), value.alias("strength_mg_per_pouch"), per_g.alias("mg_per_g"), grams.alias("net_weight_g"), count.alias("pouch_count"), *_fields(["sku", "gtin"], df.columns), market_.alias("market"), how.alias("calculation"))


def direct_source(df: DataFrame, market_: Column, decision: Column, reason: Column) -> DataFrame:
    """A page as a direct source: its facts, the decision and a sentence that says what was read. Columns url, source_owner, evidence_branch, title and the observation."""
    seen = df.withColumn("explicit", explicit_facts(df, market_)).withColumn("match_decision", decision).withColumn("match_reason", reason)
    e = F.col("explicit")
    stated = F.when(finite(e["strength_mg_per_pouch"]), F.concat(F.format_string("%s", e["strength_mg_per_pouch"]), F.lit(" mg per pouch"))).when(finite(e["mg_per_g"]), F.concat(F.format_string("%s", e["mg_per_g"]), F.lit(" mg/g"))).otherwise("not stated per pouch")
    said = F.when(F.col("match_decision") == "exact_match", F.concat(F.lit("Opened page "), F.coalesce("title", "url"), F.lit("; explicit nicotine is "), stated)).otherwise(F.concat(F.lit("Opened "), "url", F.lit("; kept as "), "match_decision", F.lit(" because "), "match_reason"))
    kind = F.col("source_type") if "source_type" in df.columns else F.lit(None).cast("string")
    return seen.withColumn("source_type", F.coalesce(kind, F.lit("product_detail"))).withColumn("evidence_paraphrase", said)


def repaired_source(df: DataFrame, meta_owner: Column, meta_branch: Column, meta_type: Column) -> DataFrame:
    """Sources with their registry's facts filled in; one that is no product page, or was not decided exact on a known branch, becomes near_match."""
    kind = F.coalesce(meta_type, F.col("source_type"), F.lit("product_detail"))
    firm = (kind == "product_detail") & (F.col("match_decision") == "exact_match") & F.col("evidence_branch").isNotNull()
    out = {
        "source_owner": F.coalesce(meta_owner, F.col("source_owner"), F.lit("unknown")),
        "evidence_branch": F.coalesce(meta_branch, F.col("evidence_branch"), F.lit("retailer_unknown")),
        "source_type": kind,
        "match_decision": F.when(F.coalesce(firm, F.lit(False)), F.col("match_decision")).otherwise("near_match"),
    }
    return df.select(*[c for c in df.columns if c not in out], *[v.alias(k) for k, v in out.items()])


def drop_nulls(values: Column) -> Column:
    """A map without its null values."""
    return F.map_filter(values, lambda _, v: v.isNotNull())


def source_step(branch: Column) -> Column:
    """The protocol step that a source's branch stands for."""
    return F.when(branch.isin(OWNER_BRANCHES), "manufacturer_catalog").when(branch == "regulator", "national_registry").otherwise("retailer_catalog")


def branch_record(df: DataFrame, name: Column, body: Column) -> DataFrame:
    """Catalog pages with whether all core words of the name occur in the body."""
    words = core_tokens(name)
    return df.withColumn("tokens_found", (F.size(words) > 0) & F.forall(words, lambda w: F.contains(F.lower(F.coalesce(body, F.lit(""))), w)))


def pending(rows: DataFrame, cards: DataFrame, key: str) -> DataFrame:
    """A placeholder for each row that no card has."""
    return rows.join(cards.select(key), key, "left_anti").select(F.lit(2).alias("schema"), *rows.columns, F.lit("pending").alias("status"), F.lit("pending").alias("qa_status"))


def triple(b: Column, n: Column, mg: Column) -> Column:
    return F.struct(b.alias("b"), n.alias("n"), mg.cast("double").alias("mg"))


def same_triple(one: Column, other: Column) -> Column:
    """Equality that a null does not escape."""
    return one.eqNullSafe(other)


def card_hash(*named: Column) -> Column:
    """SHA-256 of the canonical JSON of a struct of the columns, as cards, snapshots and event lists are hashed."""
    return sha256_hex(canonical_json(F.to_json(F.struct(*named), {"ignoreNullFields": "false"})))


def review_steps(rows: DataFrame, sources: DataFrame, matches: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """key and the status of each protocol step. ``rows``: key, b, n, mg. ``sources``: id, branch. ``matches``: key, branch, evidence_kind. ``attempts``: key.

    Sources are a bounded registry: their ids are aggregated once; matches and attempts are counted by key before they are joined.
    """
    ids = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("id"))))
    all_ = sources.agg(ids(F.lit(True)).alias("_all"), ids(F.col("branch") == "retailer").alias("_retail"), ids(F.col("branch").isin(OWNER_BRANCHES)).alias("_owner"), ids(F.col("branch") == "regulator").alias("_law"))
    hit = matches.groupBy(key).agg(F.count(F.lit(1)).alias("_m"), F.count_if(F.col("branch").isin(OWNER_BRANCHES)).alias("_mo"), F.count_if(F.col("evidence_kind") == "structured_product_detail").alias("_md"))
    opened = attempts.groupBy(key).agg(F.count(F.lit(1)).alias("_o"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    step = lambda c, name, yes, no: F.struct(F.when(F.size(c) > 0, yes).otherwise(no).alias("status"), F.col(c).alias("source_ids")).alias(name)
    full = rows.join(hit, key, "left").join(opened, key, "left").withColumn("_one", F.lit(1)).join(F.broadcast(all_.withColumn("_one", F.lit(1))), "_one")  # one row: the ids of the registry
    return full.select(
        key,
        step("_all", "mass_indexes", "completed", "unavailable"),
        F.struct(F.lit("completed").alias("status"), F.col("_retail").alias("source_ids"), (zero("_m") > 0).alias("exact_attribute_match")).alias("retailer_indexes"),
        F.struct(F.when(F.size("_owner") > 0, "completed").otherwise("unavailable").alias("status"), F.col("_owner").alias("source_ids"), (zero("_mo") > 0).alias("exact_attribute_match")).alias("manufacturer_catalog"),
        step("_law", "national_registries", "landing_pages_checked", "not_run"),
        F.struct(F.concat_ws(" ", "b", "n", F.col("mg").cast("string"), F.lit("mg per pouch")).alias("query"), zero("_o").alias("opened_detail_candidates"), zero("_md").alias("matched_detail_records")).alias("exact_query"),
    )


# --- validation


def card_errors(card_rows: DataFrame, key: str, pass_state: str | None = None) -> DataFrame:
    """key, errors: what is wrong with each card; an empty array is a good card.

    Columns: schema, brand, full_name, market, outcome, qa_status, threshold_met, original, queries (array of system, query, url, checked_at, response_sha256), opened (array of urls), sources
    (array of url, source_owner, evidence_branch, match_decision, strength, response_sha256), retailer_branches, catalog_status, registry_status, no_new_domains, no_new_candidates.
    """
    c = F.col
    yes = lambda x: F.coalesce(x, F.lit(False))
    many = lambda a, f: F.size(F.array_distinct(F.transform(a, f)))
    queries, sources, opened = (F.coalesce(c(n), F.array().cast(card_rows.schema[n].dataType)) for n in ("queries", "sources", "opened"))
    exact = F.filter(sources, lambda s: (s["match_decision"] == "exact_match") & finite(s["strength"]))
    retail = F.filter(sources, lambda s: F.startswith(s["evidence_branch"], F.lit("retailer_")) | (s["evidence_branch"] == "retailer_group"))
    query_ok = F.forall(queries, lambda q: yes(q["system"].isNotNull() & (q["query"] != "") & is_http(q["url"]) & q["checked_at"].isNotNull() & is_hash(q["response_sha256"])))
    source_ok = F.forall(sources, lambda s: yes(is_http(s["url"]) & is_hash(s["response_sha256"]) & s["match_decision"].isin(DECISIONS)))
    filled = lambda *names: yes(F.lit(True) if not names else F.forall(F.array(*[F.coalesce(c(n).cast("string"), F.lit("")) for n in names]), lambda v: v != ""))
    systems, asked = many(queries, lambda q: q["system"]), many(queries, lambda q: F.struct(q["system"], q["query"]))
    branches = F.size(F.array_distinct(F.coalesce(c("retailer_branches"), F.array().cast("array<string>"))))
    trusted = F.exists(exact, lambda s: yes(s["evidence_branch"].isin(TRUSTED_BRANCHES)))
    rules = [
        ("schema", yes(c("schema") == 2)),
        ("original", c("original").isNotNull()),
        ("outcome", yes(c("outcome").isin(OUTCOMES))),
        ("qa_status", yes(c("qa_status") == pass_state) if pass_state else filled("qa_status")),
        ("identity", filled("brand", "full_name", "market")),
        ("too_few_queries", F.size(queries) >= 4),
        ("malformed_query", query_ok),
        ("duplicate_query", asked == F.size(queries)),
        ("search_systems", systems >= 2),
        ("opened_urls", c("opened").isNotNull() & (F.size(F.array_distinct(opened)) == F.size(opened))),
        ("malformed_source", source_ok),
        ("unopened_source", F.size(F.array_except(F.transform(sources, lambda s: s["url"]), opened)) == 0),
        ("protocol", (systems >= 2) & (asked >= 4) & filled("catalog_status", "registry_status") & (branches >= 3) & yes(c("no_new_domains")) & yes(c("no_new_candidates"))),
        ("retailer_branches", branches >= 3),
        ("verified_without_threshold", ~yes(c("outcome") == "verified") | (yes(c("threshold_met")) & (trusted | (many(retail, lambda s: s["source_owner"]) >= 2)))),
        ("conflict_without_evidence", ~yes(c("outcome") == "conflicted") | ((many(exact, lambda s: s["strength"]) >= 2) & (many(exact, lambda s: s["source_owner"]) >= 2))),
        ("threshold_without_outcome", ~yes(c("outcome") == "not_verifiable_after_protocol") | ~yes(c("threshold_met"))),
    ]
    return card_rows.select(key, F.array_compact(F.array(*[F.when(~good, F.lit(code)) for code, good in rules])).alias("errors"))


def card_set_errors(frozen: DataFrame, cards: DataFrame, checked: DataFrame, key: str, expected: int | None = None) -> DataFrame:
    """check_name, failing over a whole set: ids of rows, cards and checks that repeat or that one side lacks, originals that differ, checks that did not pass."""
    twice = lambda df: df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lacks = lambda a, b: a.select(key).distinct().join(b.select(key), key, "left_anti")
    differ = frozen.select(key, F.col("original").alias("_a")).join(cards.select(key, "original"), key).where(~F.col("_a").eqNullSafe(F.col("original")))
    parts = [
        ("repeated_rows", twice(frozen)),
        ("repeated_cards", twice(cards)),
        ("repeated_checks", twice(checked)),
        ("rows_without_card", lacks(frozen, cards)),
        ("cards_without_row", lacks(cards, frozen)),
        ("rows_without_check", lacks(frozen, checked)),
        ("checks_without_row", lacks(checked, frozen)),
        ("original_differs", differ),
        ("not_passed", checked.where(~F.col("qa_status").eqNullSafe(F.lit("passed")))),
    ]
    out = None
    for name, bad in parts:
        one = bad.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check_name"), "failing")
        out = one if out is None else out.unionAll(one)
    if expected is not None:
        count = frozen.agg(F.abs(F.count(F.lit(1)) - expected).alias("failing")).select(F.lit("row_count").alias("check_name"), "failing")
        out = out.unionAll(count)
    return out


def event_errors(events: DataFrame, kinds: list[str], forbidden: Column) -> DataFrame:
    """Adds errors: a raw event's own faults (its place in the chain is ``eventlog.verify_chain``'s). ``forbidden``: does the payload hold a derived field?"""
    c = F.col
    yes = lambda x: F.coalesce(x, F.lit(False))
    rules = [
        ("input_id", yes(c("input_id") != "")),
        ("event_id", yes(c("event_id").cast("string") != "")),
        ("event_type", yes(c("event_type").isin(kinds))),
        ("payload", yes(F.startswith(F.ltrim(c("payload")), F.lit("{"))) & F.try_parse_json("payload").isNotNull()),
        ("recorded_at", c("recorded_at").try_cast("timestamp").isNotNull()),
        ("sequence", yes(c("sequence") >= 1)),
        ("previous_hash", F.when(c("sequence") == 1, c("previous_event_sha256").isNull()).otherwise(is_hash(c("previous_event_sha256")))),
        ("event_hash", is_hash(c("event_sha256"))),
        ("derived_field", ~yes(forbidden)),
    ]
    return events.withColumn("errors", F.array_compact(F.array(*[F.when(~good, F.lit(code)) for code, good in rules])))


def batch_state(expected: DataFrame, checked: DataFrame, key: str, pending_rows: int, unreviewed: int) -> DataFrame:
    """check_name, failing: what keeps a batch from counting as done. Pending or unreviewed rows, ids that only one side has, checks that did not pass."""
    spark = expected.sparkSession
    counts = spark.createDataFrame([("pending", pending_rows), ("unreviewed", unreviewed)], "check_name string, failing long")
    parts = [("unchecked", expected.join(checked, key, "left_anti")), ("unexpected", checked.join(expected, key, "left_anti")), ("failed", checked.where(~F.col("qa_status").eqNullSafe(F.lit("qa_passed"))))]
    for name, bad in parts:
        counts = counts.unionAll(bad.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check_name"), "failing"))
    return counts


# --- events' addresses


def opened_urls(candidate: Column, requested: Column, final: Column) -> Column:
    """Canonical addresses under which an opened page is known: asked for, requested, arrived at."""
    return F.array_distinct(F.array_compact(F.array(url_key(candidate), url_key(requested), url_key(final))))


def decision_url(candidate: Column, final: Column, url: Column) -> Column:
    return url_key(F.coalesce(candidate, final, url))


def accounting_with_aliases(candidates: DataFrame, opened: DataFrame, decided: DataFrame, key: str, rules: list[str]) -> DataFrame:
    """key, url, opened, decided, unreviewed of each candidate, where a page counts under every address it was opened by.

    ``candidates``: key, url. ``opened``: key, urls (array), sequence. ``decided``: key, url, sequence, decision, rejection_rule. The last page at an address and the last decision about any of a page's addresses count.
    A candidate that was refused unopened by one of ``rules`` is reviewed; one that is neither opened nor refused is not, nor is an opened one without a decision.
    """
    alias = opened.select(key, F.col("sequence").alias("_page"), F.explode(F.array_distinct("urls")).alias("url")).where("url is not null")
    last = alias.groupBy(key, "url").agg(F.max("_page").alias("_page"))
    direct = decided.select(key, "url", F.struct("sequence", "decision", "rejection_rule").alias("_d")).where("url is not null")
    spread = direct.join(last, [key, "url"]).select(key, "_page", "_d").join(alias, [key, "_page"]).select(key, "url", "_d")
    final = direct.unionByName(spread).groupBy(key, "url").agg(F.max("_d").alias("_d"))
    got = candidates.select(key, "url").distinct().join(last, [key, "url"], "left").join(final, [key, "url"], "left")
    was_opened, was_decided = F.col("_page").isNotNull(), F.col("_d").isNotNull()
    refused = ~was_opened & F.coalesce(F.col("_d.rejection_rule").isin(rules), F.lit(False))
    return got.select(key, "url", was_opened.alias("opened"), was_decided.alias("decided"), F.col("_d.decision").alias("decision"), (F.when(was_opened, ~was_decided).otherwise(~refused)).alias("unreviewed"))


# --- results


def needs_review(decision: Column, strength: Column, existence: Column, evidence_types: Column) -> Column:
    clash = F.coalesce(F.array_contains(evidence_types, "internal_strength_conflict"), F.lit(False))
    yes = lambda x: F.coalesce(x, F.lit(False))
    return yes(decision == "review") | yes(strength == "unverified") | yes(existence == "ambiguous") | clash


def review_lines(ledger: DataFrame) -> DataFrame:
    """input_id, line: the rows a person must look at, as CSV of 13 columns under ``REVIEW_HEADER``.

    ``ledger``: input_id, b, n, mg, decision, existence, sale_status, strength, reason, observed, evidence (array of evidence_type, url).
    """
    kinds = F.transform("evidence", lambda e: e["evidence_type"])
    clash = F.coalesce(F.array_contains(kinds, "internal_strength_conflict"), F.lit(False))
    note = F.when(clash, F.concat(F.when(F.col("reason") == "exact_duplicate", "Exact duplicate removed safely; ").otherwise(""), F.lit("conflicting same normalized brand+name values remain explicitly unresolved; do not infer from product name."))).otherwise(
        "Insufficient authoritative evidence for an automatic identity or mg change; retained conservatively."
    )
    urls = F.array_join(F.filter(F.transform("evidence", lambda e: e["url"]), lambda u: F.coalesce(u, F.lit("")) != ""), " | ")
    number = lambda c: F.regexp_replace(F.col(c).cast("double").cast("string"), r"\.0$", "")
    place = F.regexp_extract("input_id", r"^input-(\d+)-", 1)
    fields = [F.col("input_id"), place, F.col("b"), F.col("n"), number("mg"), F.col("decision"), F.col("existence"), F.col("sale_status"), F.col("strength"), F.col("reason"), number("observed"), urls, note]
    chosen = ledger.where(needs_review(F.col("decision"), F.col("strength"), F.col("existence"), kinds))
    return chosen.select("input_id", F.concat_ws(",", *[csv_field(f) for f in fields]).alias("line"))


def ledger_row(cards: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """A ledger row for each card. ``cards``: key, mg, outcome, brand, full_name, market. ``sources``: key, url, source_owner, match_decision, strength, calculation, mg_per_g, net_weight_g, pouch_count, ord."""
    exact, known = F.col("match_decision") == "exact_match", (F.col("match_decision") == "exact_match") & finite(F.col("strength"))
    first = lambda c: F.min_by(c, F.when(known, F.col("ord")))
    got = sources.groupBy(key).agg(
        F.coalesce(F.bool_or(exact), F.lit(False)).alias("_exact"),
        F.array_sort(F.collect_set(F.when(known, F.col("strength")))).alias("observed_mg_values"),
        F.array_sort(F.collect_set(F.when(known, F.col("source_owner")))).alias("mg_evidence_owners"),
        F.array_sort(F.collect_set("source_owner")).alias("source_owner"),
        *[first(c).alias(c) for c in ("mg_per_g", "net_weight_g", "pouch_count")],
        F.min_by("calculation", F.when(known & F.col("calculation").isNotNull(), F.col("ord"))).alias("calculation"),
    )
    none = F.array().cast("array<double>")
    full = cards.join(got, key, "left").withColumn("observed_mg_values", F.coalesce("observed_mg_values", none)).withColumn("_exact", F.coalesce("_exact", F.lit(False)))
    single = F.when(F.size("observed_mg_values") == 1, F.get("observed_mg_values", 0))
    outcome = F.col("outcome")
    return full.select(
        key,
        F.col("brand").alias("canonical_brand"),
        F.col("full_name").alias("canonical_name"),
        "market",
        F.when(F.col("_exact"), "exact_attributes").otherwise("no_match").alias("match_status"),
        F.when(F.col("_exact"), "confirmed").otherwise("ambiguous").alias("existence_status"),
        F.when(outcome == "conflicted", "conflicted").when(outcome == "verified", "verified").otherwise("unverified").alias("strength_status"),
        single.alias("observed_mg_per_pouch"),
        "observed_mg_values",
        "mg_evidence_owners",
        "source_owner",
        "mg_per_g",
        "net_weight_g",
        "pouch_count",
        "calculation",
        F.when(outcome == "conflicted", "review").otherwise("keep").alias("decision"),
        F.when(outcome == "conflicted", "strength_conflict").when(outcome == "verified", "verified_identity_and_mg").otherwise("v2_not_verifiable_after_protocol").alias("reason_code"),
        F.when((outcome == "verified") & single.isNotNull() & (single != F.col("mg")), single).alias("proposed_mg"),
    )


def final_record(cards: DataFrame, evaluated: DataFrame, queries: DataFrame, key: str) -> DataFrame:
    """A research record for each row: its terminal state, evidence counts (``research.evaluate``) and its queries, distinct and sorted."""
    asked = queries.groupBy(key).agg(F.array_sort(F.collect_set("query")).alias("queries"))
    got = cards.join(evaluated, key, "left").join(asked, key, "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    state = F.when(no("conflict"), "conflicted").when(no("enough"), "verified").otherwise("exhausted_10m/unverified")
    return got.select(*cards.columns, state.alias("research_status"), F.coalesce("exact", F.lit(0)).alias("exact_matches"), F.when(no("enough"), F.col("observed")).alias("observed"), F.coalesce("queries", F.array().cast("array<string>")).alias("queries"))


def progress(frozen: DataFrame, records: DataFrame, key: str, order: str, most: int = 25) -> DataFrame:
    """One row: rows, done, verified, conflicted, exhausted, remaining and the next ids in order (at most ``most``, which is the report's length)."""
    last = frozen.join(records.select(key, "research_status"), key, "left")
    done = F.col("research_status").isin("verified", "conflicted", "exhausted_10m/unverified")
    by = lambda state: F.count_if(F.col("research_status") == state)
    sums = last.agg(F.count(F.lit(1)).alias("rows"), F.count_if(done).alias("done"), by("verified").alias("verified"), by("conflicted").alias("conflicted"), by("exhausted_10m/unverified").alias("exhausted"))
    left = last.where(~F.coalesce(done, F.lit(False)))
    following = left.orderBy(order).limit(most).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k")))), lambda r: r["k"]).alias("next_ids"))
    return sums.withColumn("remaining", F.col("rows") - F.col("done")).withColumn("_one", F.lit(1)).join(following.withColumn("_one", F.lit(1)), "_one").drop("_one")  # one row and one row


def manifest(files: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """name, kind, value: hashes of files (path, sha256) and rows of tables, as a manifest lists them."""
    out = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.lit("sha256").alias("kind"), F.col("sha256").alias("value"))
    for name, df in counts.items():
        out = out.unionAll(df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(name).alias("name"), F.lit("rows").alias("kind"), "value"))
    return out


def report_lines(events: DataFrame) -> DataFrame:
    """section, ord, line of a report: queries, opened pages and decisions of an event log (sequence, input_id, event_type, system, query, url, match_decision, reason)."""
    c = F.col
    section = F.when(c("event_type") == "search_attempt", "Raw queries").when(c("event_type") == "url_opened", "Opened URLs").when(c("event_type") == "candidate_decision", "Decisions")
    none = lambda n, other="": F.coalesce(c(n), F.lit(other))
    line = F.when(c("event_type") == "search_attempt", F.concat_ws(" — ", none("system", "unknown"), none("query"))).when(c("event_type") == "url_opened", none("url")).otherwise(F.concat_ws(" — ", none("url"), none("match_decision"), none("reason")))
    return events.select(section.alias("section"), c("sequence").alias("ord"), F.concat(F.lit("- "), "input_id", F.lit(": "), line).alias("line")).where("section is not null")


def packed_gzip(content: Column) -> Column:
    """Bytes as gzip without a time stamp: equal bytes give equal files."""

    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else gzip.compress(bytes(b), 9, mtime=0))

    return run(content.cast("binary"))


def gzip_holds(packed: Column, digest: Column) -> Column:
    """Does a gzip file unpack to bytes of this SHA-256? A damaged file does not."""

    @F.pandas_udf("boolean")
    def run(files: pd.Series, digests: pd.Series) -> pd.Series:
        def one(b, d):
            try:
                return b is not None and hashlib.sha256(gzip.decompress(bytes(b))).hexdigest() == d
            except (OSError, EOFError):
                return False

        return pd.Series([one(b, d) for b, d in zip(files, digests)])

    return run(packed, digest)


def json_text(text: Column) -> Column:
    """A text as a JSON literal."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'^\{"v":(.*)\}$', 1)


def pattern_text(text: Column) -> Column:
    """A text as a pattern that matches just it."""
    return F.regexp_replace(text, r"([.*+?^${}()|\[\]\\])", r"\\$1")
