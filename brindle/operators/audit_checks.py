"""The whole audit's checks over snapshot, ledger, research records and the resulting catalog: how many rows fail each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.measure import EPSILON, finite
from brindle.operators.catalog import same_sequence

#: What a final ledger row may say.
ALLOWED = {
    "match_status": ["exact_id", "exact_attributes", "reviewed_alias", "ambiguous", "no_match"],
    "existence_status": ["confirmed", "ambiguous", "not_found", "invalid"],
    "sale_status": ["buyable_now", "listed_unavailable", "discontinued", "unknown"],
    "strength_status": ["verified", "corrected", "conflicted", "unverified"],
    "decision": ["keep", "remove", "review"],
}
#: How research ends, and the branches that own their facts.
TERMINAL = ["verified", "conflicted", "exhausted_10m"]
AUTHORITIES = ["manufacturer", "brand_owner", "regulator"]
RETAIL = ["retailer", "retailer_group"]


def _no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def counted(df: DataFrame, failing: dict[str, Column]) -> DataFrame:
    """check_name, failing: rows that meet each condition, all counted in one pass; null conditions do not count."""
    sums = df.agg(*[F.count_if(_no(c)).alias(f"c{i}") for i, c in enumerate(failing.values())])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failing")) for i, n in enumerate(failing)])).alias("r")).select("r.*")


def id_sets(expected: DataFrame, got: DataFrame, key: str, name: str) -> DataFrame:
    """check_name, failing for ids that repeat in ``got`` and ids that one side lacks: both sides are counted by id once."""
    sides = expected.select(key, F.lit(1).alias("e"), F.lit(0).alias("g")).unionAll(got.select(key, F.lit(0), F.lit(1)))
    per = sides.groupBy(key).agg(F.sum("e").alias("e"), F.sum("g").alias("g"))
    return counted(per, {f"{name}_repeated": F.col("g") > 1, f"{name}_missing": (F.col("e") > 0) & (F.col("g") == 0), f"{name}_unexpected": (F.col("e") == 0) & (F.col("g") > 0)})


def unhashed(evidence: Column) -> Column:
    """Is there a piece of evidence with an address but no digest?"""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.exists(evidence, lambda e: filled(e["url"]) & ~filled(e["response_sha256"]))


def independent(evidence: Column) -> Column:
    """An authority, or two retail owners, among evidence with address and digest."""
    sound = F.filter(evidence, lambda e: (F.coalesce(e["url"], F.lit("")) != "") & (F.coalesce(e["response_sha256"], F.lit("")) != ""))
    owners = F.array_distinct(F.transform(F.filter(sound, lambda e: _no(e["branch"].isin(RETAIL)) & (F.coalesce(e["source_owner"], F.lit("")) != "")), lambda e: e["source_owner"]))
    return F.exists(sound, lambda e: _no(e["branch"].isin(AUTHORITIES))) | (F.size(owners) >= 2)


def ledger_checks(ledger: DataFrame) -> DataFrame:
    """Each ledger row by itself. Columns: the statuses, reason_code, evidence (array of evidence_type, url, response_sha256, branch, source_owner), changes (array of action, field, to), calculated, observed."""
    c = F.col
    pieces, changes = F.coalesce(F.size("evidence"), F.lit(0)), F.coalesce(F.size("changes"), F.lit(0))
    no_reason = F.coalesce(c("reason_code"), F.lit("")) == ""
    failing = {f"invalid_{f}": ~_no(c(f).isin(v)) for f, v in ALLOWED.items()}
    failing["missing_reason"] = no_reason
    failing["evidence_without_digest"] = unhashed(c("evidence"))
    failing["decision_without_evidence"] = c("decision").isin("remove", "review") & (no_reason | (pieces < 1))
    failing["change_without_evidence"] = (changes > 0) & (no_reason | (pieces < 1))
    failing["calculation_differs"] = c("calculated").isNotNull() & ~_no(F.abs(c("calculated") - c("observed")) <= EPSILON)
    return counted(ledger, failing)


def frozen_checks(ledger: DataFrame, frozen: DataFrame, key: str, budget_s: int = 600) -> DataFrame:
    """Ledger rows of the frozen ids: exhausted ones used their time and say so; changes rest on independent branches. More columns: terminal_reason, research_status, active_search_seconds."""
    rows = ledger.join(frozen.select(key).distinct(), key, "left_semi")
    out = F.col("terminal_reason") == "exhausted_10m"
    changed = F.exists("changes", lambda x: x["action"] == "change")
    return counted(rows, {"ledger_exhausted_early": out & ~_no(F.col("active_search_seconds") >= budget_s), "ledger_exhausted_status": out & ~_no(F.col("research_status") == "exhausted_10m/unverified"), "change_without_independent_evidence": changed & ~_no(independent(F.col("evidence")))})


def research_checks(research: DataFrame, required: list[str], budget_s: int = 600) -> DataFrame:
    """Terminal research records: time used, status that agrees, no required column null, evidence with digests."""
    rows = research.where(F.col("terminal_reason").isin(TERMINAL))
    out = F.col("terminal_reason") == "exhausted_10m"
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return counted(
        rows,
        {
            "research_exhausted_early": out & (~_no(F.col("research_status") == "exhausted_10m/unverified") | ~_no(F.col("active_search_seconds") >= budget_s)),
            "research_status_differs": ~out & ~_no(F.col("research_status") == F.col("terminal_reason")),
            "research_field_missing": missing,
            "research_evidence_without_digest": unhashed(F.col("evidence")),
        },
    )


def catalog_checks(catalog: DataFrame, expected: DataFrame, order: str) -> DataFrame:
    """The resulting catalog (b, n, mg): valid rows, no exact repeats, and the sequence that the ledger approved."""
    bad = (F.coalesce(F.trim("b"), F.lit("")) == "") | (F.coalesce(F.trim("n"), F.lit("")) == "") | ~_no(finite(F.col("mg")) & (F.col("mg") >= 0))
    repeats = catalog.groupBy("b", "n", "mg").agg(F.count(F.lit(1)).alias("times"))
    line = F.struct("b", "n", F.col("mg").cast("double").alias("mg"))
    differs = not same_sequence(catalog.withColumn("_row", line), expected.withColumn("_row", line), order, "_row")
    spark = catalog.sparkSession
    return counted(catalog, {"catalog_invalid": bad}).unionAll(counted(repeats, {"catalog_repeated": F.col("times") > 1})).unionAll(spark.createDataFrame([("catalog_sequence_differs", int(differs))], "check_name string, failing long"))


def audit(snapshot: DataFrame, ledger: DataFrame, frozen: DataFrame, research: DataFrame, reviewed: DataFrame, catalog: DataFrame, expected: DataFrame, required: list[str], key: str = "input_id", order: str = "original_index") -> DataFrame:
    """check_name, failing over all checks; an audit is good when every count is 0. An empty table fails what it lacks, nothing else."""
    terminal = research.where(F.col("terminal_reason").isin(TERMINAL))
    clash = ledger.where(F.exists("evidence", lambda e: _no(e["evidence_type"] == "internal_strength_conflict")))
    parts = [
        id_sets(snapshot, ledger, key, "ledger"),
        id_sets(frozen, terminal, key, "research"),
        counted(frozen.groupBy(key).agg(F.count(F.lit(1)).alias("n")), {"frozen_repeated": F.col("n") > 1}),
        counted(frozen.select(key).join(snapshot.select(key), key, "left_anti"), {"frozen_outside_snapshot": F.lit(True)}),
        ledger_checks(ledger),
        frozen_checks(ledger, frozen, key),
        research_checks(research, required),
        counted(clash.select(key).join(reviewed.select(key), key, "left_anti"), {"conflict_not_in_review": F.lit(True)}),
        catalog_checks(catalog, expected, order),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
