"""The catalog audit end to end: a snapshot and observations to a ledger, an event log to results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.hashing import plain_number, row_id
from brindle.functions.matching import compare_identity
from brindle.functions.measure import finite, per_unit, strength_of_claims
from brindle.functions.text import material_key, normalize_candidate, product_type
from brindle.functions.urls import owner_join, url_key
from brindle.operators import catalog, eventlog, evidence, research


def snapshot(rows: DataFrame, index: str = "original_index") -> DataFrame:
    """input_id, original_index, b, n, mg."""
    return rows.select(row_id(F.col(index), F.col("b"), F.col("n"), plain_number(F.col("mg"))).alias("input_id"), F.col(index).alias("original_index"), "b", "n", "mg")


def build_ledger(snap: DataFrame, records: DataFrame) -> DataFrame:
    """One verdict a snapshot row from structured observations.

    ``records``: title, brand, evidence_kind, branch, source_owner, observed_mg_per_pouch, observed_mg_per_g, net_weight_g, pouch_count,
    available, price, ord. A record matches on its normalised title and either its brand or its being a product record.
    """
    rows = snap.withColumn("_n", normalize_candidate(F.col("n"))).withColumn("_b", normalize_candidate(F.col("b")))
    invalid = (F.trim("b") == "") | (F.trim("n") == "") | ~finite(F.col("mg")) | (F.col("mg") < 0)
    seen = records.where("title is not null").withColumn("_n", normalize_candidate(F.col("title"))).withColumn("_rb", normalize_candidate(F.col("brand")))
    match = rows.where(~F.coalesce(invalid, F.lit(True))).join(seen, "_n").where((F.col("_rb") == F.col("_b")) | F.col("evidence_kind").isin("structured_product_json", "structured_product_detail"))
    value = per_unit(F.col("observed_mg_per_pouch"), F.col("observed_mg_per_g"), F.col("net_weight_g"), F.col("pouch_count"))
    match = match.withColumn("_v", value)
    found = match.groupBy("input_id").agg(
        F.count(F.lit(1)).alias("matches"),
        evidence.threshold(F.col("branch"), F.col("source_owner"), F.col("_v").isNotNull(), ["manufacturer", "regulator"]).alias("_enough"),
        F.min_by("_v", F.when(F.col("_v").isNotNull(), F.struct(F.col("observed_mg_per_pouch").isNull(), F.col("ord")))).alias("observed"),
        F.count_distinct("_v").alias("_values"),
        evidence.sale_status(F.col("available"), F.col("price")).alias("sale_status"),
    )
    twice = catalog.exact_duplicates(snap.withColumn("_m", plain_number(F.col("mg"))), [F.col("b"), F.col("n"), F.col("_m")], "input_id", "original_index")
    clash = catalog.conflict_groups(rows, [F.col("_b"), F.col("_n")], "mg").select(F.col("k0").alias("_b"), F.col("k1").alias("_n"), F.lit(True).alias("_clash"))
    all_ = rows.join(twice, "input_id", "left").join(clash, ["_b", "_n"], "left").join(found, "input_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    v = evidence.verdict(F.coalesce(invalid, F.lit(True)), F.col("duplicate_of"), yes(F.col("_clash")) | yes(F.col("_values") > 1), yes(F.col("matches") > 0), yes(F.col("_enough")), F.col("observed"), F.col("mg"))
    return all_.select("input_id", "original_index", "b", "n", "mg", product_type(F.col("b"), F.col("n")).alias("product_type"), "duplicate_of", "observed", F.coalesce("sale_status", F.lit("unknown")).alias("sale_status"), v.alias("v")).select("*", "v.*").drop("v")


def decisions(ledger: DataFrame) -> DataFrame:
    """input_id, decision, to: what ``catalog.apply_changes`` takes."""
    return ledger.select("input_id", "decision", F.when(F.col("reason") == "verified_mg_correction", F.col("observed")).alias("to"))


def derive_results(snap: DataFrame, events: DataFrame, registry: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """input_id, outcome and the gates behind it, from a raw event log alone.

    ``events``: input_id, sequence, event_type, system, query, status, parse_status, cache_hit, candidate_urls, url, page_kind, brand, name, claims,
    net_weight_g, pouch_count, match_decision, owner. ``registry``: ord, host, source_class, owner_group_id.
    """
    c = F.col
    ok = lambda kind: research.successful(c("event_type"), kind, c("status"), c("parse_status"), c("cache_hit"))
    e = events.withColumn("_search", ok("search_attempt")).withColumn("_owner", ok("owner_lookup")).withColumn("_q", material_key(c("query"))).withColumn("url", url_key(c("url")))
    gate = research.gates(e, "input_id", "system", "_q", "_search", "_owner", "owner")
    found = e.where("_search").select("input_id", "sequence", F.explode_outer(F.transform("candidate_urls", url_key)).alias("url"))
    fresh = found.where("url is not null").groupBy("input_id", "url").agg(F.min("sequence").alias("sequence")).select("input_id", "sequence").distinct().withColumn("_new", F.lit(True))
    tired = e.where("_search").select("input_id", "sequence").join(fresh, ["input_id", "sequence"], "left").groupBy("input_id").agg(F.count_if(c("_new").isNull()).alias("no_new"))
    opened = eventlog.last_event(e.where("event_type = 'url_opened' and url is not null"), ["input_id", "url"], "sequence", ["status", "parse_status", "page_kind", "brand", "name", "claims", "net_weight_g", "pouch_count"])
    decided = eventlog.last_event(e.where("event_type = 'candidate_decision' and url is not null"), ["input_id", "url"], "sequence", ["match_decision"])
    book = found.where("url is not null").select("input_id", "url").distinct().join(opened.withColumn("_open", F.lit(True)), ["input_id", "url"], "left").join(decided, ["input_id", "url"], "left")
    unread = book.groupBy("input_id").agg(F.count_if(c("_open").isNull() | c("match_decision").isNull()).alias("unreviewed"))
    strength = strength_of_claims(c("claims"), c("net_weight_g"), c("pouch_count"))
    exact = book.join(snap.select("input_id", "b", "n"), "input_id").where("_open and match_decision = 'exact_match' and page_kind = 'product_detail' and parse_status = 'parsed' and status between 200 and 299")
    exact = exact.withColumn("_s", strength).withColumn("_i", compare_identity(c("b"), c("n"), c("brand"), c("name"), aliases)).where("_i.identity_match = 'exact' and _s.value is not null")
    exact = owner_join(exact.select("input_id", "url", c("_s.value").alias("value")), "url", registry)
    exact = exact.withColumn("group", F.coalesce("owner_group_id", "url")).withColumn("trusted", F.coalesce(c("source_class").isin("official", "regulator"), F.lit(False)))
    proof = evidence.by_owner_group(exact, "input_id", "group", "value", "trusted")
    all_ = snap.select("input_id").join(gate, "input_id", "left").join(tired, "input_id", "left").join(unread, "input_id", "left").join(proof, "input_id", "left")
    zero = lambda n: F.coalesce(c(n), F.lit(0))
    errors = research.gate_errors(zero("systems"), zero("queries"), zero("no_new") >= 2, zero("owner_systems"), zero("unreviewed"))
    no = lambda n: F.coalesce(c(n), F.lit(False))
    return all_.select("input_id", errors.alias("errors"), zero("unreviewed").alias("unreviewed"), no("conflict").alias("conflict"), no("verified").alias("verified")).withColumn("outcome", evidence.outcome(c("errors"), c("conflict"), c("verified")))
