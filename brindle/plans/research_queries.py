"""Registered queries over research operators: evidence, gates, candidates, cards and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import hashing, text, urls
from brindle.operators import audit_checks, cards, catalog, discovery, evidence, history, research, validate
from brindle.plans.queries import _t, query

SOURCES = """SELECT l_partkey, CASE l_returnflag WHEN 'R' THEN 'exact_match' WHEN 'A' THEN 'near_match' ELSE 'wrong_variant' END AS match_decision, CASE WHEN l_tax > 0 THEN round(l_discount * 100) END AS strength,
's' || (l_suppkey % 4) AS source_owner, CASE l_linenumber WHEN 1 THEN 'manufacturer' WHEN 2 THEN 'retailer_a' WHEN 3 THEN 'retailer_group' ELSE 'community' END AS evidence_branch, l_orderkey * 10 + l_linenumber AS ord, l_linestatus FROM lineitem"""


def _sources(spark, sf):
    c = F.col
    flag = F.when(c("l_returnflag") == "R", "exact_match").when(c("l_returnflag") == "A", "near_match").otherwise("wrong_variant")
    branch = F.when(c("l_linenumber") == 1, "manufacturer").when(c("l_linenumber") == 2, "retailer_a").when(c("l_linenumber") == 3, "retailer_group").otherwise("community")
    strength = F.when(c("l_tax") > 0, F.round(c("l_discount") * 100))
    return _t(spark, sf, "lineitem").select("l_partkey", flag.alias("match_decision"), strength.alias("strength"), F.concat(F.lit("s"), (c("l_suppkey") % 4).cast("string")).alias("source_owner"), branch.alias("evidence_branch"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("ord"), "l_linestatus")


@query(f"""WITH s AS (SELECT *, match_decision = 'exact_match' AND strength IS NOT NULL AS use FROM ({SOURCES})),
g AS (SELECT l_partkey, list_sort(list_distinct(list(strength) FILTER (use))) AS v, count(DISTINCT source_owner) FILTER (use) AS owners, count(DISTINCT source_owner) FILTER (use AND (starts_with(evidence_branch, 'retailer_') OR evidence_branch = 'retailer_group')) AS retail, coalesce(bool_or(use AND evidence_branch = 'manufacturer'), false) AS trusted FROM s GROUP BY 1)
SELECT l_partkey, CASE WHEN len(v) > 1 AND owners > 1 THEN 'conflicted' WHEN len(v) > 0 AND (trusted OR retail >= 2) THEN 'verified' ELSE 'not_verifiable_after_protocol' END AS outcome, coalesce(len(v) > 1 AND owners > 1, false) OR coalesce(len(v) > 0 AND (trusted OR retail >= 2), false) AS met,
coalesce(array_to_string(list_transform(v, lambda x: CAST(x AS INTEGER)), ','), '') AS vals FROM g""")
def evidence_decision(spark, sf):
    got = cards.evidence_decision(_sources(spark, sf), "l_partkey")
    return got.select("l_partkey", "outcome", "met", F.array_join(F.col("values").cast("array<int>"), ",").alias("vals"))


@query(f"""WITH s AS (SELECT *, match_decision = 'exact_match' AS e, match_decision = 'exact_match' AND strength IS NOT NULL AS use FROM ({SOURCES})),
g AS (SELECT l_partkey, CAST(count_if(e) AS BIGINT) AS exact, count(DISTINCT strength) FILTER (use) AS values, count(DISTINCT evidence_branch) FILTER (use) AS branches, coalesce(bool_or(use AND evidence_branch = 'manufacturer'), false) AS trusted, count(DISTINCT evidence_branch) FILTER (use AND starts_with(evidence_branch, 'retailer')) AS retailers, min(strength) FILTER (use) AS observed FROM s GROUP BY 1)
SELECT *, values > 1 AS conflict, NOT values > 1 AND (trusted OR retailers >= 2) AS enough FROM g""")
def evaluated_evidence(spark, sf):
    s = _sources(spark, sf).withColumn("e", F.col("match_decision") == "exact_match")
    return research.evaluate(s, "l_partkey", "e", "strength", "evidence_branch", ["manufacturer"])


@query(f"""WITH s AS (SELECT *, match_decision = 'exact_match' AS e, l_linestatus = 'F' AND source_owner <> 's0' AND strength IS NOT NULL AS h FROM ({SOURCES}) JOIN (SELECT DISTINCT l_partkey, ord FROM ({SOURCES}) WHERE match_decision = 'exact_match') USING (l_partkey, ord))
SELECT l_partkey, CAST(count_if(h) AS BIGINT) AS evidence, CAST(count(DISTINCT source_owner) FILTER (h) AS INTEGER) AS groups, CAST(count(DISTINCT strength) FILTER (h) AS INTEGER) AS values, CAST(count_if(NOT h) AS BIGINT) AS rejected,
count(DISTINCT strength) FILTER (h) > 1 AND count(DISTINCT source_owner) FILTER (h) > 1 AS conflict FROM s GROUP BY 1""")
def independent_evidence(spark, sf):
    """Opened pages: one a line, known by its order number; a page of owner s0 is of an unknown class."""
    s = _sources(spark, sf)
    page = s.select("l_partkey", F.col("ord").alias("url"), F.lit("product_detail").alias("page_kind"), F.lit("parsed").alias("parse_status"), F.when(F.col("l_linestatus") == "F", 200).otherwise(404).alias("status"), F.lit(True).alias("identity_matches"), "strength", F.when(F.col("source_owner") == "s0", "unknown").otherwise("retailer").alias("source_class"), F.col("source_owner").alias("owner_group"))
    return cards.independent_evidence(page, s.select("l_partkey", F.col("ord").alias("url"), "match_decision"), "l_partkey")


@query(f"""WITH s AS (SELECT * FROM ({SOURCES})), k AS (SELECT *, match_decision = 'exact_match' AND strength IS NOT NULL AS known FROM s),
g AS (SELECT l_partkey, bool_or(match_decision = 'exact_match') AS exact, coalesce(list_sort(list_distinct(list(strength) FILTER (known))), []) AS v, coalesce(list_sort(list_distinct(list(source_owner) FILTER (known))), []) AS owners, list_sort(list_distinct(list(source_owner))) AS all_owners, arg_min(ord, ord) FILTER (known) AS first_ord FROM k GROUP BY 1)
SELECT p_partkey, p_brand AS canonical_brand, CASE WHEN coalesce(exact, false) THEN 'exact_attributes' ELSE 'no_match' END AS match_status, CASE WHEN p_size % 3 = 0 THEN 'verified' WHEN p_size % 3 = 1 THEN 'conflicted' ELSE 'unverified' END AS strength_status,
CASE WHEN len(v) = 1 THEN v[1] END AS observed_mg_per_pouch, coalesce(array_to_string(owners, '|'), '') AS owners, coalesce(array_to_string(all_owners, '|'), '') AS source_owner, first_ord AS pouch_count, CASE WHEN p_size % 3 = 1 THEN 'review' ELSE 'keep' END AS decision,
CASE WHEN p_size % 3 = 0 AND len(v) = 1 AND v[1] <> p_size THEN v[1] END AS proposed_mg FROM part LEFT JOIN g ON l_partkey = p_partkey""")
def card_ledger(spark, sf):
    outcome = F.when(F.col("p_size") % 3 == 0, "verified").when(F.col("p_size") % 3 == 1, "conflicted").otherwise("not_verifiable_after_protocol")
    rows = _t(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("mg"), outcome.alias("outcome"), F.col("p_brand").alias("brand"), F.col("p_name").alias("full_name"), F.lit("US").alias("market"))
    none = F.lit(None).cast("double")
    s = _sources(spark, sf).select(F.col("l_partkey").alias("p_partkey"), "source_owner", "match_decision", "strength", "ord", none.alias("mg_per_g"), none.alias("net_weight_g"), F.col("ord").alias("pouch_count"), F.lit(None).cast("string").alias("calculation"))
    got = cards.ledger_row(rows, s, "p_partkey")
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    return got.select("p_partkey", "canonical_brand", "match_status", "strength_status", "observed_mg_per_pouch", joined("mg_evidence_owners").alias("owners"), joined("source_owner").alias("source_owner"), "pouch_count", "decision", "proposed_mg")


GATES = """SELECT user_id, count(DISTINCT CASE WHEN value > 10 THEN event_type END) AS systems, count(DISTINCT CASE WHEN value > 10 THEN k END) AS queries, count(DISTINCT CASE WHEN value > 30 THEN event_type END) AS owner_systems, coalesce(bool_or(value > 30 AND event_type <> 'view'), false) AS owner_known
FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) GROUP BY 1"""


def _gates(spark, sf):
    e = _t(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k")).withColumn("ok", F.col("value") > 10).withColumn("own", F.col("value") > 30).withColumn("owner", F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")))
    return research.gates(e, "user_id", "event_type", "k", "ok", "own", "owner")


@query(GATES)
def research_gates(spark, sf):
    return _gates(spark, sf)


@query(f"""SELECT user_id, array_to_string(list_filter([CASE WHEN systems < 5 THEN 'systems' END, CASE WHEN queries < 5 THEN 'queries' END], lambda x: x IS NOT NULL), '|') AS few, systems >= 2 AND queries >= 2 AND owner_systems >= systems AS passed FROM ({GATES})""")
def gate_failures(spark, sf):
    """The gates' own codes as one condition, and the two counts against a higher bar."""
    g = _gates(spark, sf)
    errors = research.gate_errors(F.col("systems"), F.col("queries"), F.lit(True), F.col("owner_systems"), F.lit(0))
    few = F.array_compact(F.array(F.when(F.col("systems") < 5, "systems"), F.when(F.col("queries") < 5, "queries")))
    return g.select("user_id", F.array_join(few, "|").alias("few"), (F.size(errors) == 0).alias("passed"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'gone' WHEN p_size % 4 = 1 THEN 'rejected' WHEN p_size % 4 = 2 THEN 'refreshed' ELSE 'kept' END AS state, CASE WHEN p_size % 4 = 2 THEN sha256(p_name || '!') ELSE sha256(p_name) END AS digest FROM part""")
def reobserved(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_size", F.sha2("p_name", 256).alias("digest"), "p_name")
    turn = F.col("p_size") % 4
    now = p.where(turn != 0).select("p_partkey", F.when(turn == 1, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"), F.when(turn == 2, F.sha2(F.concat("p_name", F.lit("!")), 256)).otherwise(F.col("digest")).alias("digest"))
    return research.reobserve(p.drop("p_name"), now, "p_partkey", "p_size", "digest").select("p_partkey", "state", "digest")


@query("""WITH a AS (SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f FROM orders GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0 THEN 1 ELSE 0 END) AS f FROM orders WHERE o_custkey % 20 <> 3 GROUP BY 1)
SELECT o_custkey, array_to_string(list_filter([CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END, CASE WHEN a.f IS DISTINCT FROM b.f THEN 'f' END, CASE WHEN b.n IS NULL THEN 'missing' END], lambda x: x IS NOT NULL), '|') AS differing, a.n IS NOT DISTINCT FROM b.n AND a.f IS NOT DISTINCT FROM b.f AS passed FROM a LEFT JOIN b USING (o_custkey)""")
def second_derivation(spark, sf):
    """Two derivations of the same customers; the second loses some rows and some customers."""
    o = _t(spark, sf, "orders")
    sums = lambda df, hit: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("int")).alias("f"))
    done = F.col("o_orderstatus") == "F"
    got = research.qa(sums(o, done), sums(o.where("o_custkey % 20 <> 3"), done & (F.col("o_orderkey") % 50 != 0)), "o_custkey", ["n", "f"])
    return got.select("o_custkey", F.array_join("differing", "|").alias("differing"), "passed")


@query("""SELECT 'no_result' AS check_name, count(*) AS failing FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'repeated', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'unchecked', count(*) FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'failed', count(*) FROM customer WHERE c_acctbal >= 0 AND c_nationkey = 7""")
def result_coverage(spark, sf):
    c = _t(spark, sf, "customer")
    checked = c.where("c_acctbal >= 0").select("c_custkey", (F.col("c_nationkey") != 7).alias("passed"))
    return research.coverage(c.select("c_custkey"), _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), checked, "c_custkey")


@query("""SELECT 'pending' AS check_name, CAST(2 AS BIGINT) AS failing UNION ALL SELECT 'unreviewed', 0 UNION ALL SELECT 'unchecked', count(*) FROM customer WHERE c_nationkey < 20 AND c_acctbal < 0 UNION ALL SELECT 'unexpected', count(*) FROM customer WHERE c_nationkey >= 20 AND c_acctbal >= 0 UNION ALL SELECT 'failed', count(*) FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'""")
def batch_state(spark, sf):
    c = _t(spark, sf, "customer")
    checked = c.where("c_acctbal >= 0").select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "qa_failed").otherwise("qa_passed").alias("qa_status"))
    return cards.batch_state(c.where("c_nationkey < 20").select("c_custkey"), checked, "c_custkey", 2, 0)


@query("""WITH f AS (SELECT p_partkey, p_name FROM part), k AS (SELECT p_partkey, CASE WHEN p_size = 5 THEN upper(p_name) ELSE p_name END AS p_name FROM part WHERE p_size <> 4), q AS (SELECT p_partkey, p_size FROM part WHERE p_size > 1)
SELECT 'repeated_rows' AS check_name, CAST(0 AS BIGINT) AS failing UNION ALL SELECT 'repeated_cards', 0 UNION ALL SELECT 'repeated_checks', count(*) FROM part WHERE p_size = 9 UNION ALL SELECT 'rows_without_card', count(*) FROM part WHERE p_size = 4 UNION ALL SELECT 'cards_without_row', 0
UNION ALL SELECT 'rows_without_check', count(*) FROM part WHERE p_size <= 1 UNION ALL SELECT 'checks_without_row', 0 UNION ALL SELECT 'original_differs', count(*) FROM f JOIN k USING (p_partkey) WHERE f.p_name <> k.p_name
UNION ALL SELECT 'not_passed', count(*) FROM q WHERE p_size = 8 UNION ALL SELECT 'row_count', abs(count(*) - 1000) FROM part""")
def card_set_checks(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_size", F.struct("p_name").alias("original"))
    made = p.where("p_size <> 4").withColumn("original", F.when(F.col("p_size") == 5, F.struct(F.upper("original.p_name").alias("p_name"))).otherwise(F.col("original")))
    checked = p.where("p_size > 1").select("p_partkey", F.when(F.col("p_size") == 8, "failed").otherwise("passed").alias("qa_status"), "p_size")
    checked = checked.unionAll(checked.where("p_size = 9"))
    return cards.card_set_errors(p, made, checked, "p_partkey", 1000)


@query("""WITH e AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS input_id, event_type, CASE WHEN event_id % 17 = 0 THEN '[1]' ELSE props END AS payload, event_id % 19 AS sequence, CASE WHEN event_id % 19 = 1 THEN NULL WHEN event_id % 23 = 0 THEN 'x' ELSE sha256('p') END AS previous, event_id % 29 = 0 AS derived FROM events)
SELECT event_id, array_to_string(list_filter([CASE WHEN input_id = '' THEN 'input_id' END, CASE WHEN event_type NOT IN ('view', 'click') THEN 'event_type' END, CASE WHEN payload = '[1]' THEN 'payload' END, CASE WHEN sequence < 1 THEN 'sequence' END, CASE WHEN sequence <> 1 AND previous = 'x' THEN 'previous_hash' END, CASE WHEN derived THEN 'derived_field' END], lambda x: x IS NOT NULL), '|') AS errors FROM e""")
def raw_event_errors(spark, sf):
    n = F.col("event_id")
    e = _t(spark, sf, "events").select(
        "event_id", F.when(n % 13 == 0, "").otherwise(F.col("user_id").cast("string")).alias("input_id"), "event_type", F.when(n % 17 == 0, "[1]").otherwise(F.col("props")).alias("payload"), F.col("ts").cast("string").alias("recorded_at"), (n % 19).alias("sequence"),
        F.when(n % 19 == 1, F.lit(None)).when(n % 23 == 0, "x").otherwise(F.sha2(F.lit("p"), 256)).alias("previous_event_sha256"), F.sha2(n.cast("string"), 256).alias("event_sha256"), (n % 29 == 0).alias("d"),
    )
    return cards.event_errors(e, ["view", "click"], F.col("d")).select("event_id", F.array_join("errors", "|").alias("errors"))


@query("""WITH e AS (SELECT user_id, event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
c AS (SELECT DISTINCT user_id, k FROM e WHERE event_type = 'view'), o AS (SELECT user_id, event_id, unnest([k, k + 1]) AS k FROM e WHERE event_type = 'click'),
l AS (SELECT user_id, k, max(event_id) AS page FROM o GROUP BY 1, 2), d AS (SELECT user_id, k, event_id FROM e WHERE event_type = 'purchase'),
s AS (SELECT user_id, k, event_id FROM d UNION ALL SELECT o.user_id, o.k, d.event_id FROM d JOIN l ON l.user_id = d.user_id AND l.k = d.k JOIN o ON o.user_id = d.user_id AND o.event_id = l.page),
f AS (SELECT user_id, k, max(event_id) AS last FROM s GROUP BY 1, 2)
SELECT c.user_id, c.k, page IS NOT NULL AS opened, last IS NOT NULL AS decided, last AS decision, CASE WHEN page IS NOT NULL THEN last IS NULL ELSE NOT coalesce(last % 2 = 0, false) END AS unreviewed FROM c LEFT JOIN l ON l.user_id = c.user_id AND l.k = c.k LEFT JOIN f ON f.user_id = c.user_id AND f.k = c.k""")
def alias_accounting(spark, sf):
    """Each click opens two neighbouring addresses; a purchase decides one of them and so both; even decisions are refusals."""
    e = _t(spark, sf, "events").select("user_id", F.col("event_id").alias("sequence"), "event_type", F.get_json_object("props", "$.k").cast("int").alias("url"))
    of = lambda t: e.where(F.col("event_type") == t)
    opened = of("click").select("user_id", "sequence", F.array(F.col("url"), F.col("url") + 1).alias("urls"))
    decided = of("purchase").select("user_id", "url", "sequence", F.col("sequence").alias("decision"), F.when(F.col("sequence") % 2 == 0, "rule").alias("rejection_rule"))
    return cards.accounting_with_aliases(of("view"), opened, decided, "user_id", ["rule"]).withColumnRenamed("url", "k")


@query("""SELECT 'input-' || lpad(CAST(p_partkey + 1 AS VARCHAR), 8, '0') || '-x' AS input_id, 'input-' || lpad(CAST(p_partkey + 1 AS VARCHAR), 8, '0') || '-x,' || lpad(CAST(p_partkey + 1 AS VARCHAR), 8, '0') || ',' || p_brand || ',"' || p_name || ', new",' || p_size || ',' || CASE WHEN p_size % 2 = 0 THEN 'review' ELSE 'keep' END || ',confirmed,unknown,' || CASE WHEN p_size % 3 = 0 THEN 'unverified' ELSE 'verified' END || ',' || CASE WHEN p_size % 5 = 0 THEN 'exact_duplicate' ELSE 'other' END || ',' || CASE WHEN p_size % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) || '.5' END || ',http://a.com/' || p_partkey || ' | http://b.com/,' ||
CASE WHEN p_size % 5 = 0 THEN 'Exact duplicate removed safely; conflicting same normalized brand+name values remain explicitly unresolved; do not infer from product name.' WHEN p_size = 11 THEN 'conflicting same normalized brand+name values remain explicitly unresolved; do not infer from product name.' ELSE 'Insufficient authoritative evidence for an automatic identity or mg change; retained conservatively.' END AS line
FROM part WHERE p_size % 2 = 0 OR p_size % 3 = 0 OR p_size % 5 = 0 OR p_size = 11""")
def review_lines(spark, sf):
    p, size = _t(spark, sf, "part"), F.col("p_size")
    piece = lambda kind, url: F.struct(kind.alias("evidence_type"), url.alias("url"))
    clash = F.when((size % 5 == 0) | (size == 11), "internal_strength_conflict").otherwise("page")
    ledger = p.select(
        F.concat(F.lit("input-"), F.lpad((F.col("p_partkey") + 1).cast("string"), 8, "0"), F.lit("-x")).alias("input_id"), F.col("p_brand").alias("b"), F.concat("p_name", F.lit(", new")).alias("n"), size.alias("mg"),
        F.when(size % 2 == 0, "review").otherwise("keep").alias("decision"), F.lit("confirmed").alias("existence"), F.lit("unknown").alias("sale_status"), F.when(size % 3 == 0, "unverified").otherwise("verified").alias("strength"),
        F.when(size % 5 == 0, "exact_duplicate").otherwise("other").alias("reason"), F.when(size % 7 != 0, size + 0.5).alias("observed"),
        F.array(piece(clash, F.concat(F.lit("http://a.com/"), F.col("p_partkey").cast("string"))), piece(F.lit("page"), F.lit(None).cast("string")), piece(F.lit("page"), F.lit("http://b.com/"))).alias("evidence"),
    )
    return cards.review_lines(ledger)


@query("""WITH s AS (SELECT o_custkey, max(CASE o_orderstatus WHEN 'F' THEN 'verified' WHEN 'P' THEN 'conflicted' ELSE 'pending' END) AS research_status FROM orders GROUP BY 1), l AS (SELECT c_custkey, research_status, coalesce(research_status IN ('verified', 'conflicted'), false) AS done FROM customer LEFT JOIN s ON o_custkey = c_custkey)
SELECT count(*) AS rows, CAST(count_if(done) AS BIGINT) AS done, CAST(count_if(coalesce(research_status = 'verified', false)) AS BIGINT) AS verified, CAST(count_if(coalesce(research_status = 'conflicted', false)) AS BIGINT) AS conflicted, CAST(0 AS BIGINT) AS exhausted, CAST(count_if(NOT done) AS BIGINT) AS remaining,
(SELECT coalesce(string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey), '') FROM (SELECT c_custkey FROM l WHERE NOT done ORDER BY c_custkey LIMIT 25)) AS next_ids FROM l""")
def research_progress(spark, sf):
    state = F.when(F.col("o_orderstatus") == "F", "verified").when(F.col("o_orderstatus") == "P", "conflicted").otherwise("pending")
    done = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(state).alias("research_status"))
    got = cards.progress(_t(spark, sf, "customer").select("c_custkey"), done, "c_custkey", "c_custkey")
    return got.withColumn("next_ids", F.array_join(F.col("next_ids").cast("array<string>"), ","))


PATHS = """SELECT p_partkey AS rec, 'https://shop' || (p_size % 6) || '.example.com/' || replace(p_name, ' ', '-') || '/' || lower(p_type) || '-' || replace(lower(p_brand), '#', '-') AS url, CASE WHEN p_size % 5 = 0 THEN 'manufacturer' ELSE 'retailer' END AS branch, 'o' || (p_size % 6) AS owner FROM part"""


def _paths(spark, sf):
    p, size = _t(spark, sf, "part"), F.col("p_size")
    url = F.concat(F.lit("https://shop"), (size % 6).cast("string"), F.lit(".example.com/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/"), F.lower("p_type"), F.lit("-"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")))
    return p.select(F.col("p_partkey").alias("rec"), url.alias("url"), F.when(size % 5 == 0, "manufacturer").otherwise("retailer").alias("branch"), F.concat(F.lit("o"), (size % 6).cast("string")).alias("source_owner"))


@query(f"""WITH r AS (SELECT DISTINCT p_brand || '|' || p_name || '|' || p_type AS id, list_distinct(string_split(replace(lower(p_brand), '#', ' '), ' ')) AS bw, list_filter(list_distinct(string_split(lower(p_name || ' ' || p_type), ' ')), lambda w: NOT list_contains(string_split(replace(lower(p_brand), '#', ' '), ' '), w)) AS nw FROM part),
d AS (SELECT rec, url, branch, owner, list_filter(regexp_split_to_array(regexp_replace(url, '^https?://[^/]*', ''), '[^a-z0-9]+'), lambda w: w <> '') AS pw FROM ({PATHS})), u AS (SELECT url, branch, owner, pw, min(rec) AS rec FROM d GROUP BY ALL),
s AS (SELECT id, rec, url, owner, CASE WHEN branch <> 'manufacturer' AND NOT list_has_all(pw, bw) THEN 0 ELSE len(list_intersect(nw, pw)) / len(nw) END AS score, branch FROM r, u),
o AS (SELECT *, row_number() OVER (PARTITION BY id, owner ORDER BY score DESC, url, rec) AS k FROM s WHERE score >= CASE WHEN branch = 'manufacturer' THEN 0.6 ELSE 0.9 END),
t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, url, rec) AS rank FROM o WHERE k = 1)
SELECT id, rec, url, owner, round(score, 6) AS score, rank FROM t WHERE rank <= 3""")
def detail_candidates(spark, sf):
    """Distinct (brand, name and type) rows against addresses that carry all three; equal addresses count once."""
    rows = _t(spark, sf, "part").select(F.concat_ws("|", "p_brand", "p_name", "p_type").alias("id"), F.col("p_brand").alias("b"), F.concat_ws(" ", "p_name", "p_type").alias("n")).distinct()
    records = _paths(spark, sf).groupBy("url", "branch", "source_owner").agg(F.min("rec").alias("rec"))
    return discovery.detail_candidates(rows, records, "id", "rec").withColumn("score", F.round("score", 6))


@query(f"""WITH r AS (SELECT DISTINCT p_name || '|' || p_type AS id, string_split(lower(p_name || ' ' || p_type), ' ') AS nw FROM part), d AS (SELECT url, owner, min(rec) AS rec, list_distinct(list_filter(regexp_split_to_array(url, '[^a-z0-9]+'), lambda w: w <> '')) AS pw FROM ({PATHS}) GROUP BY 1, 2),
s AS (SELECT id, rec, url, owner, len(list_filter(nw, lambda w: list_contains(pw, w))) / len(nw) AS score FROM r, d WHERE list_contains(pw, nw[1])),
o AS (SELECT *, row_number() OVER (PARTITION BY id, owner ORDER BY score DESC, url, rec) AS k FROM s WHERE score >= 0.7), t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, url, rec) AS rank FROM o WHERE k = 1)
SELECT id, rec, url, owner, round(score, 6) AS score, rank FROM t WHERE rank <= 8""")
def index_candidates(spark, sf):
    rows = _t(spark, sf, "part").select(F.concat_ws("|", "p_name", "p_type").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("n")).distinct()
    records = _paths(spark, sf).groupBy("url", "source_owner").agg(F.min("rec").alias("rec"))
    return discovery.index_candidates(rows, records, "id", "rec").withColumn("score", F.round("score", 6))


@query("""WITH a AS (SELECT DISTINCT p_name AS id, list_sort(string_split(lower(p_name), ' ')) AS w FROM part), b AS (SELECT p_partkey AS rec, p_name, list_sort(string_split(lower(p_name), ' ')) AS w, p_size FROM part)
SELECT a.id, b.rec FROM a JOIN b USING (w) WHERE b.p_size % 9 <> 0""")
def exact_records(spark, sf):
    """Names against titles with a strength: that of the row in most, another in some, a descriptor in all."""
    size = F.col("p_size")
    rows = _t(spark, sf, "part").select(F.col("p_name").alias("id"), F.concat("p_name", F.lit(" 6mg")).alias("n"), F.lit(6.0).alias("mg")).distinct()
    title = F.concat_ws(" ", F.lit("Buy"), "p_name", F.lit("Medium"), F.when(size % 9 == 0, "8 mg").otherwise("6 mg"))
    records = _t(spark, sf, "part").select(F.col("p_partkey").alias("rec"), title.alias("title"), F.lit(None).cast("double").alias("observed"))
    return discovery.exact_records(rows, records, "id", "rec")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN (CASE WHEN p_size % 2 = 0 THEN 'exact_match' ELSE 'near_match' END) WHEN p_size % 3 = 1 THEN 'near_match' ELSE 'wrong_variant' END AS decision, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'US' WHEN p_brand = 'Brand#3' THEN 'Sweden/European retail' ELSE 'UK/EU retail reference market' END AS market FROM part""")
def product_decisions(spark, sf):
    """The seen page has brand and name, the brand alone, or neither; a strength on even sizes."""
    p, size = _t(spark, sf, "part"), F.col("p_size")
    seen_brand = F.when(size % 3 == 2, "other").otherwise(F.upper("p_brand"))
    seen_name = F.when(size % 3 == 0, F.concat(F.lit("new "), F.upper("p_name"))).otherwise("nothing alike")
    decision = cards.product_decision(F.col("p_brand"), F.col("p_name"), seen_brand, seen_name, F.when(size % 2 == 0, size.cast("double")), F.lit("product_detail"))
    return p.select("p_partkey", decision.alias("decision"), cards.market(F.col("p_brand"), ["Brand#1", "Brand#2"], ["Brand#3"]).alias("market"))


@query("""SELECT p_partkey, sha256('{"b":"' || p_brand || '","mg":' || p_size || ',"n":"' || p_name || '","note":null}') AS card_sha256, 'input-' || sha256(p_brand || chr(0) || chr(0) || p_name) AS fingerprint FROM part""")
def card_hashes(spark, sf):
    """Canonical JSON sorts keys and writes whole doubles as integers; a null part keeps its place in a fingerprint."""
    p = _t(spark, sf, "part")
    digest = cards.card_hash(F.col("p_name").alias("n"), F.col("p_brand").alias("b"), F.col("p_size").cast("double").alias("mg"), F.lit(None).cast("string").alias("note"))
    return p.select("p_partkey", digest.alias("card_sha256"), F.concat(F.lit("input-"), hashing.fingerprint(F.col("p_brand"), F.lit(None).cast("string"), F.col("p_name"))).alias("fingerprint"))


@query("""SELECT page_id, CASE WHEN h LIKE '%blog.%' THEN 'Blogs' ELSE h END AS owner, CASE WHEN h LIKE '%blog.%' THEN 'community' ELSE 'retailer' END AS branch FROM (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS h FROM pages)""")
def rule_owners(spark, sf):
    owner = research.owner_by_rules(F.col("url"), [("blog.", "Blogs", "community")])
    return _t(spark, sf, "pages").select("page_id", owner.alias("o")).select("page_id", "o.owner", "o.branch")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 AND l_tax > 0.02 THEN 'conflicted' WHEN l_tax > 0.02 THEN 'verified' ELSE 'exhausted_10m' END AS terminal, CASE WHEN l_quantity > 30 THEN 'exact_match' WHEN l_discount >= 0.05 THEN 'near_match' ELSE 'wrong_variant' END AS class,
CASE WHEN l_linenumber > 4 THEN 'pending' WHEN l_discount > 0.05 THEN 'conflicted' WHEN l_tax > 0.02 THEN 'verified' ELSE 'unresolved_after_complete_search' END AS outcome, CASE WHEN l_returnflag = 'R' THEN 'manufacturer_catalog' WHEN l_returnflag = 'A' THEN 'national_registry' ELSE 'retailer_catalog' END AS step FROM lineitem""")
def decision_tables(spark, sf):
    c = F.col
    off, tax = c("l_discount") > 0.05, c("l_tax") > 0.02
    branch = F.when(c("l_returnflag") == "R", "brand_owner").when(c("l_returnflag") == "A", "regulator").otherwise("retailer")
    errors = F.when(c("l_linenumber") > 4, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", evidence.terminal_state(off & tax, tax).alias("terminal"), evidence.candidate_class(c("l_quantity") > 30, c("l_discount"), 0.05).alias("class"), evidence.outcome(errors, off, tax).alias("outcome"), cards.source_step(branch).alias("step")
    )


@query("""WITH d AS (SELECT c_mktsegment, o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
s AS (SELECT c_mktsegment, o_orderpriority, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY 1, 2) SELECT s.c_mktsegment, s.o_orderpriority, s.day, coalesce(n, 0) AS n FROM s LEFT JOIN d USING (c_mktsegment, o_orderpriority, day)""")
def calendar_days(spark, sf):
    """Orders by segment, priority and day, with the days without any."""
    o = _t(spark, sf, "orders").join(_t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    keys = ["c_mktsegment", "o_orderpriority"]
    return history.calendar(history.daily_counts(o, keys, "o_orderdate"), keys)


@query("""SELECT o_orderkey, CAST(CASE WHEN g >= 90 THEN 0 ELSE ceil(20.0 * (90 - g) / 90) END AS BIGINT) AS smooth, CAST(CASE WHEN g >= 90 THEN 0 ELSE ceil(20.0 * (90 - g // 7 * 7) / 90) END AS BIGINT) AS weekly, CAST(CASE WHEN g >= 90 THEN 0 ELSE 20 END AS BIGINT) AS cutoff FROM (SELECT o_orderkey, CAST(o_orderkey % 120 AS INTEGER) AS g FROM orders)""")
def taper_limits(spark, sf):
    start = F.lit("2024-01-01").cast("date")
    day, target = F.date_add(start, (F.col("o_orderkey") % 120).cast("int")), F.date_add(start, 90)
    return _t(spark, sf, "orders").select("o_orderkey", *[history.taper_limit(day, start, target, F.lit(20), s).alias(s) for s in ("smooth", "weekly", "cutoff")])


@query("SELECT event_id, user_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 14 OFFSET 28")
def listing_page(spark, sf):
    """The third page of the newest events; a page is the feature."""
    return history.page_of(_t(spark, sf, "events").select("event_id", "user_id", "ts"), [F.desc("ts"), F.asc("event_id")], 3)


@query("""SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'packPrice:invalid_price' ELSE '' END || CASE WHEN c_nationkey = 0 THEN (CASE WHEN c_acctbal <= 0 THEN '|' ELSE '' END) || 'pouchesPerPack:invalid_pouch_count' ELSE '' END AS errors FROM customer""")
def settings_errors(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.lit("EUR").alias("currency"), F.col("c_acctbal").alias("pack_price"), F.col("c_nationkey").cast("double").alias("per_pack"), F.lit(5.0).alias("daily_limit"), F.lit("track").alias("goal"), F.lit(None).cast("string").alias("strategy"), F.lit(None).cast("string").alias("target_date"))
    return validate.check(c, validate.settings_rules(F.lit("2024-01-31"))).select("c_custkey", validate.error_text(F.col("errors")).alias("errors"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'email' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'topic' WHEN c_nationkey = 4 THEN 'message' WHEN c_acctbal < 0 THEN 'reopen' END AS failing FROM customer""")
def contact_verdicts(spark, sf):
    n = F.col("c_nationkey")
    form = _t(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.when(n == 3, "nobody@here").otherwise("Some.One@Example.com").alias("email"), F.col("c_mktsegment").alias("topic"), F.when(n == 4, " short  ").otherwise("A message that is long enough").alias("message"), F.lit("").alias("website"),
        F.when(F.col("c_acctbal") < 0, 99_500).otherwise(90_000).alias("opened_ms"),
    )
    return form.select("c_custkey", validate.contact_verdict(F.lit(100_000), ["BUILDING", "AUTOMOBILE", "MACHINERY", "FURNITURE"]).alias("failing"))


@query("""WITH i AS (SELECT c_custkey, c_nationkey, unnest(range(0, c_nationkey % 4 + 1)) AS k FROM customer), p AS (SELECT c_custkey, k AS o, 'http://h' || k || '.com/' AS url FROM i UNION ALL SELECT c_custkey, 10 + k, 'http://h' || (3 - k) || '.com/' FROM i), f AS (SELECT c_custkey, url, min(o) AS o FROM p GROUP BY 1, 2)
SELECT c_custkey, url, rank FROM (SELECT c_custkey, url, row_number() OVER (PARTITION BY c_custkey ORDER BY o, url) AS rank FROM f) WHERE rank <= 3""")
def first_urls(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.explode(F.sequence(F.lit(0), F.col("c_nationkey") % 4)).alias("k"))
    at = lambda k: F.concat(F.lit("http://h"), k.cast("string"), F.lit(".com/")).alias("url")
    return research.first_urls([c.select("c_custkey", F.col("k").alias("o"), at(F.col("k"))), c.select("c_custkey", (F.col("k") + 10).alias("o"), at(3 - F.col("k")))], "c_custkey", "url", "o", most=3)


@query("""SELECT p_partkey, round(CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.5 END, 6) AS overlap, CASE WHEN p_size % 2 = 0 THEN 'exact_match' WHEN p_size % 3 = 0 THEN 'wrong_variant' ELSE 'near_match' END AS class FROM part""")
def classified_titles(spark, sf):
    """Titles with the whole two-word name, or with its first word and another; every third of the latter states another strength."""
    p, size = _t(spark, sf, "part"), F.col("p_size")
    first = F.get(F.split("p_name", " "), 0)
    title = F.when(size % 2 == 0, F.concat_ws(" ", F.lit("Buy"), "p_name", F.lit("6 mg"))).otherwise(F.concat_ws(" ", first, F.lit("zzz"), F.when(size % 3 == 0, "9 mg")))
    got = p.select("p_partkey", F.round(cards.title_overlap(F.col("p_name"), title), 6).alias("overlap"), cards.classify(F.col("p_name"), F.lit(6.0), title, F.lit(None).cast("double")).alias("class"))
    return got


@query("""SELECT event_id, lower(split_part(event_type, ' ', 1)) AS field, '"' || event_type || '\\"' || '"' AS json, event_type || '\\.\\*' AS pattern FROM events""")
def quoted_texts(spark, sf):
    t = F.col("event_type")
    return _t(spark, sf, "events").select("event_id", text.field_name(F.concat(t, F.lit("_-"))).alias("field"), cards.json_text(F.concat(t, F.lit('"'))).alias("json"), cards.pattern_text(F.concat(t, F.lit(".*"))).alias("pattern"))


@query("""SELECT page_id, list_has_any(list_filter(regexp_split_to_array(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''), ['en', 'de']) AS known, NOT regexp_matches(lower(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)), '/blog/|/article|/category|/tag|/mixpack/|/pages/|/collections/') AS product FROM pages""")
def path_facts(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.arrays_overlap(urls.path_tokens(F.col("url")), F.array(F.lit("en"), F.lit("de"))).alias("known"), urls.is_likely_product(F.col("url")).alias("product"))


@query("""WITH l AS (SELECT p_partkey, CASE WHEN p_size = 1 THEN 'lost' ELSE 'exact_id' END AS match_status, CASE WHEN p_size % 10 = 0 THEN 'remove' WHEN p_size % 10 = 1 THEN 'review' ELSE 'keep' END AS decision, CASE WHEN p_size % 20 = 0 THEN NULL ELSE 'r' END AS reason_code, p_size % 3 AS pieces, CASE WHEN p_size % 7 = 0 THEN p_size + 1 ELSE p_size END AS calculated, p_size AS observed FROM part)
SELECT unnest(['invalid_match_status', 'invalid_existence_status', 'invalid_sale_status', 'invalid_strength_status', 'invalid_decision', 'missing_reason', 'evidence_without_digest', 'decision_without_evidence', 'change_without_evidence', 'calculation_differs']) AS check_name,
CAST(unnest([count_if(match_status = 'lost'), 0, 0, 0, 0, count_if(reason_code IS NULL), count_if(pieces = 2), count_if(decision <> 'keep' AND (reason_code IS NULL OR pieces = 0)), 0, count_if(calculated <> observed)]) AS BIGINT) AS failing FROM l""")
def ledger_checks(spark, sf):
    """A ledger made of parts: one size has an unknown status, every third has no evidence, every third evidence without a digest."""
    size = F.col("p_size")
    piece = lambda digest: F.struct(F.lit("page").alias("evidence_type"), F.lit("http://a/").alias("url"), digest.alias("response_sha256"), F.lit("retailer").alias("branch"), F.lit("o").alias("source_owner"))
    proof = F.when(size % 3 == 1, F.array(piece(F.lit("d")))).when(size % 3 == 2, F.array(piece(F.lit("d")), piece(F.lit(None).cast("string"))))
    ledger = _t(spark, sf, "part").select(
        "p_partkey", F.when(size == 1, "lost").otherwise("exact_id").alias("match_status"), F.lit("confirmed").alias("existence_status"), F.lit("unknown").alias("sale_status"), F.lit("verified").alias("strength_status"),
        F.when(size % 10 == 0, "remove").when(size % 10 == 1, "review").otherwise("keep").alias("decision"), F.when(size % 20 != 0, "r").alias("reason_code"), proof.alias("evidence"), F.array().cast("array<struct<action:string,field:string,to:double>>").alias("changes"),
        F.when(size % 7 == 0, size + 1).otherwise(size).cast("double").alias("calculated"), size.cast("double").alias("observed"),
    )
    return audit_checks.ledger_checks(ledger)


@query("""SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'remove' ELSE 'change' END AS action, p_size AS "from", CASE WHEN p_size % 7 <> 0 THEN p_size + 100 END AS "to" FROM part WHERE p_size > 20 AND (p_size % 7 = 0 OR p_size % 5 = 0)""")
def change_list(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_size")
    d = p.where("p_size > 20").select("p_partkey", F.when(F.col("p_size") % 7 == 0, "remove").otherwise("keep").alias("decision"), F.when(F.col("p_size") % 5 == 0, F.col("p_size") + 100).alias("to"))
    return catalog.change_list(p, d, "p_partkey", "p_size")


@query(r"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([\s\S]*?)</a>', 1)) AS found, unnest(regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([\s\S]*?)</a>', 2)) AS title, unnest(range(len(regexp_extract_all(html, '<a href="([^"]+)"[^>]*>([\s\S]*?)</a>')))) AS k FROM pages)
SELECT page_id, url, found, trim(regexp_replace(regexp_replace(arg_min(title, k), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM l GROUP BY 1, 2, 3""")
def search_pages(spark, sf):
    """The links of every page, marked as the results of an engine's page; tests hold the other engines' parsers against fixed pages."""
    p = _t(spark, sf, "pages")
    found = discovery.search_results(F.replace("html", F.lit("<a href="), F.lit('<a class="result__a" href=')), F.lit("https://lite.engine.example/"))
    return p.select("page_id", "url", F.explode(found).alias("r")).select("page_id", "url", F.col("r.url").alias("found"), "r.title")




@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag <> 'N' AS exact, l_tax AS value, CASE WHEN l_suppkey % 4 = 0 THEN 'official' ELSE 'retailer:' || l_suppkey END AS branch, l_linenumber % 3 <> 0 AS there, l_linenumber % 4 <> 2 AS same FROM lineitem),
e AS (SELECT l_partkey, w, CASE WHEN w = 0 THEN exact ELSE exact AND there AND same END AS x, value, branch FROM l, (VALUES (0), (1)) t(w)),
g AS (SELECT l_partkey, w, count(DISTINCT CASE WHEN x THEN value END) AS v, coalesce(bool_or(x AND branch = 'official'), false) AS trusted, count(DISTINCT CASE WHEN x AND branch LIKE 'retailer%' THEN branch END) AS r FROM e GROUP BY 1, 2),
d AS (SELECT l_partkey, w, NOT v > 1 AND (trusted OR r >= 2) AS enough FROM g), k AS (SELECT l_partkey, CAST(count_if(exact AND NOT (there AND same)) AS BIGINT) AS lost FROM l GROUP BY 1)
SELECT k.l_partkey, b.enough AS before, a.enough AS after, lost FROM k JOIN d b ON b.l_partkey = k.l_partkey AND b.w = 0 JOIN d a ON a.l_partkey = k.l_partkey AND a.w = 1""")
def redecided(spark, sf):
    """Parts decided on all their lines, then on those that a second look still finds with the same tax."""
    c, rows = F.col, _t(spark, sf, "lineitem")
    url = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax").alias("url")
    recorded = rows.select("l_partkey", url, (c("l_returnflag") != "N").alias("exact"), c("l_tax").alias("value"), F.lit("d").alias("digest"), F.when(c("l_suppkey") % 4 == 0, "official").otherwise(F.concat(F.lit("retailer:"), c("l_suppkey").cast("string"))).alias("branch"))
    current = rows.where("l_linenumber % 3 <> 0").select(url, F.when(c("l_linenumber") % 4 == 2, c("l_tax") + 1).otherwise(c("l_tax")).alias("value"), F.lit("e").alias("digest")).distinct()
    return research.redecide(recorded, current, "l_partkey", "url", "exact", "value", "digest", "branch", ["official"])


@query("""WITH r AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, '[' || string_agg('{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey) || ']' AS log FROM orders GROUP BY 1)
SELECT o_custkey AS k, sha256('{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS input_card_sha256, sha256(log) AS raw_events_sha256, sha256('{"n":' || n || '}') AS derived_result_sha256, CASE WHEN f = 0 THEN 'qa_passed' ELSE 'qa_failed' END AS qa_status FROM r JOIN customer ON c_custkey = o_custkey""")
def qa_records(spark, sf):
    """Customers' order counts, derived again without the finished orders: only those without any pass."""
    c, o = F.col, _t(spark, sf, "orders").withColumn("k", F.col("o_custkey"))
    cards = _t(spark, sf, "customer").select(c("c_custkey").alias("k"), F.to_json(F.struct(c("c_name").alias("name"), c("c_mktsegment").alias("segment"))).alias("json"))
    events = o.select("k", "o_orderkey", F.to_json(F.struct(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"))).alias("json"))
    count = lambda df: df.groupBy("k").agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"))).alias("json"))
    return research.qa_record(cards, events, count(o), count(o.where("o_orderstatus <> 'F'")), "k", "o_orderkey")


@query(r"""WITH u AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN replace(url, 'http', 'ftp') WHEN page_id % 10 = 1 THEN replace(url, '.example', '.google.example') WHEN page_id % 10 = 2 THEN 'no address' ELSE replace(url, '.html', '.pdf') END AS url FROM pages)
SELECT page_id, CASE WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'malformed_candidate_url' WHEN NOT regexp_matches(lower(url), '^https?:') THEN 'non_http_url' WHEN regexp_matches(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), 'google\.') THEN 'obvious_search_or_social_domain'
WHEN regexp_matches(lower(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)), '\.pdf$') THEN 'non_product_document_or_forum' END AS reason FROM u""")
def invalid_urls(spark, sf):
    """Page addresses, some made into other schemes, search hosts, documents or none."""
    url, place = F.col("url"), F.col("page_id") % 10
    changed = F.when(place == 0, F.replace(url, F.lit("http"), F.lit("ftp"))).when(place == 1, F.replace(url, F.lit(".example"), F.lit(".google.example"))).when(place == 2, "no address").otherwise(F.replace(url, F.lit(".html"), F.lit(".pdf")))
    return _t(spark, sf, "pages").select("page_id", discovery.invalid_candidate(changed).alias("reason"))
