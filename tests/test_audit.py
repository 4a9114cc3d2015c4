"""The audit end to end on small tables."""

from pyspark.sql import functions as F

from brindle.operators import catalog, research
from brindle.plans import audit

REC = "title string, brand string, evidence_kind string, branch string, source_owner string, observed_mg_per_pouch double, observed_mg_per_g double, net_weight_g double, pouch_count double, available boolean, price double, ord int"


def test_ledger(spark):
    rows = [(1, "A", "Mint", 6.0), (2, "A", "Mint", 6.0), (3, "B", "Ice", 4.0), (4, "C", "Ice X", 4.0), (5, "D", "Cola", 3.0), (6, "D", "Cola", 5.0), (7, "", "x", 1.0), (8, "E", "None", 2.0)]
    snap = audit.snapshot(spark.createDataFrame(rows, "original_index int, b string, n string, mg double"))
    records = [("ice", "b", "page", "manufacturer", "o1", 4.5, None, None, None, True, 2.0, 1), ("ICE X", "shop", "structured_product_json", "retailer", "o2", None, 16.0, 5.0, 20.0, False, None, 2), ("ice x", "other", "page", "retailer", "o3", 4.0, None, None, None, None, None, 3)]
    ledger = audit.build_ledger(snap, spark.createDataFrame(records, REC))
    got = {r.original_index: (r.reason, r.decision, r.sale_status) for r in ledger.collect()}
    assert got == {
        1: ("unverified_keep_conservative", "keep", "unknown"),
        2: ("exact_duplicate", "remove", "unknown"),
        3: ("verified_mg_correction", "keep", "buyable_now"),
        4: ("matched_identity_mg_evidence_recorded", "keep", "listed_unavailable"),
        5: ("strength_conflict", "review", "unknown"),
        6: ("strength_conflict", "review", "unknown"),
        7: ("invalid_catalog_row", "remove", "unknown"),
        8: ("unverified_keep_conservative", "keep", "unknown"),
    }
    final = catalog.gated_changes(snap, audit.decisions(ledger), "input_id", "mg")
    assert sorted((r.original_index, r.mg) for r in final.collect()) == [(1, 6.0), (3, 4.5), (4, 4.0), (5, 3.0), (6, 5.0), (8, 2.0)]


EV = "input_id string, sequence int, event_type string, system string, query string, status int, parse_status string, cache_hit boolean, candidate_urls array<string>, url string, page_kind string, brand string, name string, claims array<struct<basis string, value double>>, net_weight_g double, pouch_count double, match_decision string, owner string"


def event(i, s, kind, **k):
    names = [f.split()[0] for f in EV.replace("array<struct<basis string, value double>>", "x").split(", ")]
    base = dict.fromkeys(names) | {"input_id": i, "sequence": s, "event_type": kind, "status": 200, "parse_status": "parsed"}
    return tuple((base | k)[n] for n in names)


def log(i, decision="exact_match", value=10.0):
    u = "https://shop.maker.com/p"
    out = [event(i, s, "search_attempt", system=a, query=q, candidate_urls=[u]) for s, (a, q) in enumerate([("s1", "mint a"), ("s2", "mint a"), ("s1", "mint b")], 1)]
    out += [event(i, 4, "owner_lookup", system="s1", owner="o"), event(i, 5, "owner_lookup", system="s2", owner="")]
    out.append(event(i, 6, "url_opened", url=u, page_kind="product_detail", brand="A", name="Mint", claims=[("per_pouch", value)]))
    return [*out, event(i, 7, "candidate_decision", url=u, match_decision=decision)] if decision else out


def test_results(spark):
    snap = spark.createDataFrame([("x", "A", "Mint"), ("y", "A", "Mint"), ("z", "A", "Mint"), ("w", "A", "Mint")], "input_id string, b string, n string")
    events = spark.createDataFrame(log("x") + log("y", "wrong_variant") + log("z", None), EV)
    registry = spark.createDataFrame([(1, "maker.com", "official", "g")], "ord int, host string, source_class string, owner_group_id string")
    got = {r.input_id: r for r in audit.derive_results(snap, events, registry).collect()}
    assert {k: r.outcome for k, r in got.items()} == {"x": "verified", "y": "unresolved_after_complete_search", "z": "pending", "w": "pending"}
    assert got["z"].errors == ["unreviewed"] and len(got["w"].errors) == 3
    same = research.qa(audit.derive_results(snap, events, registry), audit.derive_results(snap, events, registry), "input_id", ["outcome"])
    assert {r.failing for r in research.coverage(snap, audit.derive_results(snap, events, registry), same, "input_id").collect()} == {0}


def test_research_pieces(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()[0]
    assert one(research.owner_by_rules(F.lit("https://www.shop.de/x"), [("shop.", "Shop", "retailer_group")]))["owner"] == "Shop"
    r = one(research.search_record(F.array(F.lit("https://a.com/1"), F.lit("https://a.com/1"), F.lit("https://b.com/")), F.array(F.lit("https://b.com/"))))
    assert r["hosts"] == ["a.com", "b.com"] and r["fresh"] == ["https://a.com/1"]
    old = spark.createDataFrame([("u", 1.0, "d1"), ("v", 1.0, "d1"), ("w", 1.0, "d1"), ("x", 1.0, "d1")], "url string, value double, digest string")
    new = spark.createDataFrame([("u", 1.0, "d1"), ("v", 2.0, "d1"), ("w", 1.0, "d2")], "url string, value double, digest string")
    assert {r.url: (r.state, r.digest) for r in research.reobserve(old, new, "url", "value", "digest").collect()} == {"u": ("kept", "d1"), "v": ("rejected", "d1"), "w": ("refreshed", "d2"), "x": ("gone", "d1")}
    a = spark.createDataFrame([(1, "u", 3), (1, "v", 1), (1, "u", 0)], "row int, url string, o int")
    assert [(r.url, r["rank"]) for r in research.first_urls([a, a.limit(0)], "row", "url", "o", 1).collect()] == [("u", 1)]
    ev = spark.createDataFrame([(1, True, 6.0, "retailer:a"), (1, True, 6.0, "retailer:b"), (2, True, 6.0, "retailer:a"), (2, True, 7.0, "official")], "row int, exact boolean, value double, branch string")
    assert {r.row: (r.conflict, r.enough) for r in research.evaluate(ev, "row", "exact", "value", "branch", ["official"]).collect()} == {1: (False, True), 2: (True, False)}
