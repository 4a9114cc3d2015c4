"""Search answers, candidate rules and projections on fixed examples."""

import base64

import pytest
from pyspark.sql import functions as F

from brindle.functions import hashing, matching, text, urls
from brindle.operators import cards, discovery, documents, eventlog, history
from brindle.sources import readers


def one(spark, column, **values):
    row = spark.range(1).select(*[(v if not isinstance(v, (str, int, float, type(None))) else F.lit(v)).alias(k) for k, v in values.items()] or [F.lit(0).alias("_")])
    return row.select(column).first()[0]


def pairs(rows):
    return [(r.url, r.title) for r in rows]


def test_result_pages(spark):
    packed = base64.b64encode(b"https://shop.se/zyn").decode().rstrip("=")
    bing = f'<li class="b_algo" data-x><h2 class="h"> <a target="_blank" href="https://www.bing.com/ck/a?p=1&amp;u=a1{packed}&amp;n=1"><strong>Zyn</strong>  Mint</a></h2></li><li class="b_algo"><h2><a href="https://www.bing.com/maps">Own</a></h2></li><li class="b_algo"><h2><a href="ftp://x.se/">No</a></h2></li>'
    assert pairs(one(spark, discovery.search_results(F.lit(bing), F.lit("https://www.bing.com/search?q=zyn")))) == [("https://shop.se/zyn", "Zyn Mint")]
    google = '<a class="x" href="https://shop.se/a?x=1&amp;y=2" data-z><br><h3 class="t">A &amp; B</h3></a><a href="https://www.google.com/own"><h3>Own</h3></a><a href="https://shop.se/a?x=1&amp;y=2"><h3>Again</h3></a>'
    assert pairs(one(spark, discovery.search_results(F.lit(google), F.lit("https://www.google.com/search")))) == [("https://shop.se/a?x=1&y=2", "A & B")]
    other = """<a rel="nofollow" class="result__a" href="//duck.example/l/?uddg=https%3A%2F%2Fshop.se%2Fb&amp;rut=1">B &#8211; <b>shop</b></a><a class='result-link' href="https://shop.se/c">C</a>"""
    assert pairs(one(spark, discovery.search_results(F.lit(other), F.lit("https://lite.duck.example/")))) == [("https://shop.se/b", "B – shop"), ("https://shop.se/c", "C")]
    assert one(spark, discovery.search_results(F.lit(None).cast("string"), F.lit("https://www.bing.com/"))) == [] == one(spark, discovery.search_results(F.lit(other), F.lit("nowhere")))


def test_search_response(spark):
    ask = lambda status, body, hit=False, failed=None: one(spark, discovery.search_response(F.lit(status), F.lit(hit), F.lit(failed).cast("string"), F.lit(body).cast("string"), F.array(F.lit("http://page/")))).asDict()
    assert ask(200, '{"candidates": ["http://a/", {"url": "http://b/"}, {"x": 1}, ""]}') == {"parse_status": "parsed", "candidate_urls": ["http://a/", "http://b/"]}
    assert ask(200, "<html>") == ask(200, "{broken") == {"parse_status": "parsed", "candidate_urls": ["http://page/"]}
    for bad in (ask(404, "x"), ask(200, "x", hit=True), ask(200, "x", failed="timeout"), ask(None, None)):
        assert bad == {"parse_status": "not_parsed", "candidate_urls": []}


def test_product_response(spark):
    ask = lambda body, url="https://a/b", title=None, status=200: one(spark, discovery.product_response(F.lit(status), F.lit(False), F.lit(None).cast("string"), F.lit(title).cast("string"), F.lit(body).cast("string"), F.lit(url))).asDict()
    full = ask("Strength 10,4 mg per pouch, 16 mg/g. Net weight: 13 g, 20 pouches. Add to cart", title="Zyn")
    assert full == {"parse_status": "parsed", "page_kind": "product_detail", "title": "Zyn", "strength_mg_per_pouch": 10.4, "mg_per_g": 16.0, "net_weight_g": 13.0, "pouch_count": 20.0}
    weak = ask("20 mg/g", url="https://a/products/x")
    assert weak["strength_mg_per_pouch"] is None and weak["mg_per_g"] == 20 and weak["page_kind"] == "product_detail"
    gone = ask("10 mg per pouch", title="Zyn", status=500)
    assert gone["parse_status"] == "not_parsed" and gone["page_kind"] == "unknown" and gone["strength_mg_per_pouch"] is None


@pytest.mark.parametrize(
    "url, rule",
    [
        ("https://shop.se/products/zyn", None),
        ("https://ad.navercorp.com/x", "obvious_search_or_social_domain"),
        ("https://x.kr/go/BN_redirect?x", "obvious_search_or_social_domain"),
        ("https://x.org/a/file.PDF", "non_product_document_or_forum"),
        ("https://x.org/bbs/12", "non_product_document_or_forum"),
        ("https://x.org/fabbs/12", None),
        ("https://www.sec.gov/Archives/edgar/1", "non_product_document_or_forum"),
        ("https://www.sec.gov/news", None),
        ("https://x.org/?documentId=4", "non_product_document_or_forum"),
        ("https://x.org/?mydocumentId=4", None),
        ("https://snusexpress.com/apres", "non_product_document_or_forum"),
        ("https://snusexpress.com/apres/mint", None),
        ("https://x.kr/new/a?bmode=view", "non_product_document_or_forum"),
        ("https://x.kr/?act=board.x&bbs_mode=view", "non_product_document_or_forum"),
        ("not a url", "malformed_candidate_url"),
        (None, "malformed_candidate_url"),
    ],
)
def test_rejected_candidates(spark, url, rule):
    assert one(spark, discovery.rejected_candidate(F.lit(url).cast("string"))) == rule


def test_invalid_candidates(spark):
    for url, why in [("https://shop.se/a", None), ("ftp://shop.se/a", "non_http_url"), ("shop.se/a", "malformed_candidate_url"), ("https://m.facebook.com/a", "obvious_search_or_social_domain"), ("https://a.se/x.zip", "non_product_document_or_forum"), ("https://a.se/Download/x", "non_product_document_or_forum")]:
        assert one(spark, discovery.invalid_candidate(F.lit(url))) == why


def test_exact_records_by_the_rule(spark):
    """The join on one word finds what the rule finds over all pairs."""
    names = ["Zyn Citrus 6mg", "Zyn Citrus", "Velo Mint 4 mg", "Buy online", "ＺＹＮ Citrus 6mg", "Killa 13"]
    titles = ["ZYN Citrus Medium 6 mg", "Zyn citrus 8mg", "Citrus Zyn", "velo mint", "Velo Mint Extra", "Zyn Citrus 6 mg pouches", "The product", "Killa 13", None]
    rows = spark.createDataFrame([(i, n, 6.0) for i, n in enumerate(names)], "row int, n string, mg double")
    records = spark.createDataFrame([(i, t, 8.0 if i == 2 else None) for i, t in enumerate(titles)], "rec int, title string, observed double")
    got = {tuple(r) for r in discovery.exact_records(rows, records, "row", "rec").collect()}
    both = rows.crossJoin(records.where("title is not null"))  # a handful of pairs, in a test
    want = {tuple(r) for r in both.where(matching.exact_variant(F.col("n"), F.col("mg"), F.col("title"), F.col("observed"))).select("row", "rec").collect()}
    assert got == want and (4, 0) in got and (3, 6) in got


def test_exact_records_of_many_copies(spark, tmp_path):
    """Copies of few titles make a small file of many records: they are not broadcast, and equal titles meet a name once."""
    names = spark.createDataFrame([("Zyn Citrus", "Zyn Citrus 6mg", 6.0), ("again", "Zyn Citrus 6mg", 6.0), ("Velo", "Velo", None), (None, "Velo", 6.0)], "row string, n string, mg double")
    title = F.when(F.col("id") % 3 == 0, "Buy Zyn Citrus Medium 6 mg").when(F.col("id") % 3 == 1, "Zyn Citrus 8 mg").otherwise("Velo")
    spark.range(30_000).select(F.col("id").alias("rec"), title.alias("title"), F.when(F.col("id") % 2 == 0, 8.0).alias("observed")).write.parquet(str(tmp_path / "r"))
    got = discovery.exact_records(names, spark.read.parquet(str(tmp_path / "r")), "row", "rec")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("FileScan" in x.split("Exchange hashpartitioning")[0] for x in plan.split("BroadcastExchange")[1:])
    want = {(n, i) for i in range(30_000) for n in (("Zyn Citrus", "again") if i % 3 == 0 and i % 2 else ("Velo",) if i % 3 == 2 else ())}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_sitemap_entries_and_regulator(spark):
    body = "<urlset><url><loc> http://a/1 </loc></url><url><loc>http://a/2</loc><lastmod>2024-01-02</lastmod></url></urlset>"
    df = spark.createDataFrame([(1, body), (2, "<sitemapindex><sitemap><loc>http://a/s</loc></sitemap></sitemapindex>")], "k int, body string")
    assert [tuple(r) for r in discovery.sitemap_entries(df, "k", "body").orderBy("pos").collect()] == [(1, 0, "http://a/1", None), (1, 1, "http://a/2", "2024-01-02")]
    cells = spark.createDataFrame([(1, "ZYN Nicotine Pouches  Cool Mint 3 mg"), (2, "on! PLUS 6 mg Mint"), (3, "on! 4 Wintergreen 4 mg"), (4, "Velo 4 mg"), (5, "ZYN")], "k int, cell string")
    got = {r.k: (r.title, r.brand, r.observed_mg_per_pouch) for r in discovery.regulator_products(cells, "k", "cell").collect()}
    assert got[1] == ("ZYN Cool Mint 3 mg", "ZYN", 3.0) and got[3] == ("on! Wintergreen 4 mg 4 mg", "on!", 4.0) and set(got) == {1, 2, 3}


def test_card_errors(spark):
    query = lambda i, s: {"system": s, "query": f"q{i}", "url": "https://a.com/", "checked_at": "t", "response_sha256": "a" * 64}
    source = {"url": "https://a.com/p", "source_owner": "o", "evidence_branch": "manufacturer", "match_decision": "exact_match", "strength": 6.0, "response_sha256": "b" * 64}
    good = {
        "id": 1, "schema": 2, "brand": "b", "full_name": "n", "market": "m", "outcome": "verified", "qa_status": "passed", "threshold_met": True, "original": "o", "queries": [query(i, "s%d" % (i % 2)) for i in range(4)], "opened": ["https://a.com/p"],
        "sources": [source], "retailer_branches": ["a", "b", "c"], "catalog_status": "ok", "registry_status": "ok", "no_new_domains": True, "no_new_candidates": True,
    }
    bad = [
        {"schema": 1}, {"outcome": "maybe"}, {"qa_status": "pending"}, {"brand": ""}, {"queries": good["queries"][:3]}, {"queries": [*good["queries"], good["queries"][0]]}, {"opened": []}, {"threshold_met": False},
        {"sources": [{**source, "evidence_branch": "retailer_x"}]}, {"outcome": "conflicted"}, {"outcome": "not_verifiable_after_protocol"}, {"retailer_branches": ["a"]}, {"sources": None, "queries": None, "opened": None}, {"sources": [{**source, "response_sha256": "x"}]},
    ]
    shape = "id int, schema int, brand string, full_name string, market string, outcome string, qa_status string, threshold_met boolean, original string, queries array<struct<system:string,query:string,url:string,checked_at:string,response_sha256:string>>, opened array<string>, sources array<struct<url:string,source_owner:string,evidence_branch:string,match_decision:string,strength:double,response_sha256:string>>, retailer_branches array<string>, catalog_status string, registry_status string, no_new_domains boolean, no_new_candidates boolean"
    order = [f.split()[0] for f in shape.replace(",url", ";url").split(", ")]
    rows = [tuple(({**good, **change, "id": i})[c] for c in order) for i, change in enumerate([{}, *bad])]
    got = {r.id: r.errors for r in cards.card_errors(spark.createDataFrame(rows, shape), "id", "passed").collect()}
    assert got[0] == [] and got[1] == ["schema"] and got[2] == ["outcome"] and got[3] == ["qa_status"] and got[4] == ["identity"]
    assert "too_few_queries" in got[5] and got[6] == ["duplicate_query"] and got[7] == ["unopened_source"] and got[8] == ["verified_without_threshold"] == got[9]
    assert got[10] == ["conflict_without_evidence"] and got[11] == ["threshold_without_outcome"] and set(got[12]) == {"protocol", "retailer_branches"}
    assert {"opened_urls", "too_few_queries", "search_systems", "verified_without_threshold"} <= set(got[13]) and got[14] == ["malformed_source"]


def test_projections(spark):
    df = spark.createDataFrame([("https://a.se/p", 200, "owner", "retailer", "Zyn", None, 16.0, 13.0, 20.0, "body", "extra")], "url string, status int, source_owner string, branch string, title string, observed_mg_per_pouch double, observed_mg_per_g double, net_weight_g double, pouch_count double, body string, odd string")
    flat = cards.flat_record(df, "body", F.lit("now")).first()
    assert flat.response_sha256 == "230d8358dc8e8890b4c58deeb62912ee2f20357ae92a5cc861b98e68fe31acb5" and flat.brand is None and flat.evidence_kind == "structured_product_detail" and flat.odd == "extra" and "body" not in flat
    seen = df.select(cards.evidence(df, F.lit("n")).alias("e")).first().e
    assert seen.observed.name == "Zyn" and seen.evidence_type == "structured_source" and seen.checked_at is None
    got = cards.direct_source(df.withColumn("evidence_branch", F.lit("x")), F.lit("US"), F.lit("exact_match"), F.lit("r")).first()
    assert got.explicit.strength_mg_per_pouch == pytest.approx(10.4) and got.explicit.calculation == "mg_per_g * net_weight_g / pouch_count" and got.explicit.market == "US" and got.evidence_paraphrase.startswith("Opened page Zyn; explicit nicotine is 10.4")
    none = F.lit(None).cast("string")
    repaired = cards.repaired_source(cards.direct_source(df.withColumn("evidence_branch", F.lit(None).cast("string")), F.lit("US"), F.lit("exact_match"), F.lit("r")), none, none, none).first()
    assert (repaired.match_decision, repaired.evidence_branch, repaired.source_owner) == ("near_match", "retailer_unknown", "owner")
    assert cards.live_records(df.withColumn("title", F.lit("")), "body", F.lit("now")).count() == 0
    assert one(spark, cards.drop_nulls(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(None).cast("int")))) == {"a": 1}
    assert one(spark, cards.distinct_non_empty(F.array(F.lit("b"), F.lit(""), F.lit(None), F.lit("a"), F.lit("b")))) == ["b", "a"]
    same = cards.same_triple(cards.triple(F.lit("b"), F.lit("n"), F.lit(6)), cards.triple(F.lit("b"), F.lit("n"), F.lit(6.0)))
    assert one(spark, same) and not one(spark, cards.same_triple(cards.triple(F.lit("b"), F.lit("n"), F.lit(None)), cards.triple(F.lit("b"), F.lit("n"), F.lit(6.0))))
    packed = cards.packed_gzip(F.lit("text"))
    assert one(spark, cards.gzip_holds(packed, F.sha2(F.lit("text"), 256))) and not one(spark, cards.gzip_holds(F.lit(b"nonsense"), F.lit("x")))
    assert one(spark, F.hex(packed)) == one(spark, F.hex(cards.packed_gzip(F.lit("text"))))


def test_review_steps_and_records(spark):
    rows = spark.createDataFrame([(1, "b", "n", 6.0), (2, "b", "m", 4.0)], "id int, b string, n string, mg double")
    sources = spark.createDataFrame([("s1", "retailer"), ("s2", "regulator")], "id string, branch string")
    matches = spark.createDataFrame([(1, "retailer", "structured_product_detail")], "id int, branch string, evidence_kind string")
    got = {r.id: r for r in cards.review_steps(rows, sources, matches, spark.createDataFrame([(2,), (2,)], "id int"), "id").collect()}
    assert got[1].retailer_indexes.exact_attribute_match and not got[2].retailer_indexes.exact_attribute_match and got[1].manufacturer_catalog.status == "unavailable"
    assert got[1].mass_indexes.source_ids == ["s1", "s2"] and got[2].exact_query.opened_detail_candidates == 2 and got[2].exact_query["query"] == "b m 4.0 mg per pouch"
    done = spark.createDataFrame([(1, 2, 1, True, False, 6.0)], "id int, exact long, values long, enough boolean, conflict boolean, observed double").drop("values")
    final = {r.id: (r.research_status, r.exact_matches, r.observed, r["queries"]) for r in cards.final_record(rows, done, spark.createDataFrame([(1, "q"), (1, "a"), (1, "q")], "id int, query string"), "id").collect()}
    assert final == {1: ("verified", 2, 6.0, ["a", "q"]), 2: ("exhausted_10m/unverified", 0, None, [])}
    assert [r.id for r in cards.pending(rows, matches, "id").collect()] == [2]
    events = spark.createDataFrame([(1, "i", "search_attempt", None, "q", None, None, None), (2, "i", "candidate_decision", None, None, "u", "near_match", "r"), (3, "i", "other", None, None, None, None, None)], "sequence int, input_id string, event_type string, system string, query string, url string, match_decision string, reason string")
    assert [(r.section, r.line) for r in cards.report_lines(events).orderBy("ord").collect()] == [("Raw queries", "- i: unknown — q"), ("Decisions", "- i: u — near_match — r")]
    files = spark.createDataFrame([("file:/x/y/a.json", "abc")], "path string, sha256 string")
    assert {tuple(r) for r in cards.manifest(files, {"rows": rows}).collect()} == {("a.json", "sha256", "abc"), ("rows", "rows", "2")}


def test_decisions_on_examples(spark):
    claims = F.array(F.struct(F.lit("per_pouch").alias("basis"), F.lit(6.0).alias("value")))
    none = F.array().cast("array<struct<basis:string,value:double>>")
    decide = lambda seen, claims_, kind="product_detail": one(spark, cards.preliminary_decision(F.lit("Zyn"), F.lit("Zyn Citrus 6mg"), F.lit("ZYN"), F.lit(seen), claims_, F.lit(kind)))
    assert decide("Zyn Citrus", claims) == "exact_match" and decide("Zyn Citrus", none) == "wrong_variant" and decide("Zyn Citrus Cool", claims) == "near_match" and decide("Zyn Mint", claims) == "wrong_variant"
    registry = spark.createDataFrame([("ZYN", "maker", "b.com"), ("Zyn", "other", "a.com")], "brand string, owner string, url string")
    rows = spark.createDataFrame([("zyn",), ("velo",)], "b string")
    assert {(r.b, r.owner) for r in cards.definition_join(rows, "b", registry).collect()} == {("zyn", "other"), ("velo", None)}


def test_keys_and_forms(spark):
    key = lambda u: one(spark, urls.url_key(F.lit(u)))
    assert key("HTTP://A.com:8080/x") == "http://a.com:8080/x" != key("http://a.com/x") and key("https://a.com:443/x#F") == "https://a.com/x#F" and key("http://u:p@A.com?q") == "http://u:p@a.com/?q"
    assert one(spark, text.normalize_candidate(F.lit("ＺＹＮ Ｍint"))) == "zyn mint" and one(spark, text.identity_tokens(F.lit("ＺＹＮ Ｍint"))) == ["zyn", "mint"] and one(spark, text.material_key(F.lit("Ｐage 2 ＺＹＮ exact continuation 3"))) == "zyn"
    none = F.lit(None).cast("string")
    assert one(spark, hashing.fingerprint(F.lit("a"), none, F.lit("b")) != hashing.fingerprint(F.lit("a"), F.lit("b")))
    seen = lambda status, body: tuple(one(spark, documents.restrictions(F.lit(status), F.lit(body).cast("string"))))
    assert seen(403, None)[0] and seen(429, "")[0] and seen(200, "Unusual traffic")[0] and seen(200, "REGION RESTRICTED")[1] and seen(200, "geoblock")[1] and seen(200, "you must be over 18")[2] and seen(200, "fine") == (False, False, False)


def test_catalog_lines_with_commas(spark, tmp_path):
    lines = ['export const DB = [', '  { b: "77 Pouches", n: "77 \\"Ice\\"", mg: 10.4 },', '  ,{ b: "ZYN", n: "ZYN {9}", mg: 9 }', ',{b:"V",n:"W",mg:-.5},', "// { b: no }", "];"]
    (tmp_path / "db.js").write_text("\r\n".join(lines))
    got = [tuple(r) for r in readers.catalog_file(spark, str(tmp_path / "db.js")).orderBy("original_index").collect()]
    assert got == [(1, 2, "77 Pouches", '77 "Ice"', 10.4), (2, 3, "ZYN", "ZYN {9}", 9.0), (3, 4, "V", "W", -0.5)]
    frozen = str(tmp_path / "frozen")
    made = readers.load_or_create(spark, frozen, lambda: spark.range(3))
    assert made.count() == 3 == readers.load_or_create(spark, frozen, lambda: pytest.fail("made twice")).count()


def test_one_log_without_a_window(spark):
    """A table that is one log: gaps, repeats and foreign predecessors are found by joins."""
    base = spark.createDataFrame([(f"e{i}", f"p{i}", i) for i in range(1, 9)], "event_id string, payload string, o int").withColumn("g", F.lit(1))
    log = eventlog.append(base, "g", "o", "payload").drop("g", "o")
    assert eventlog.verify_chain(log, None, "event_id", "payload").where("fault is not null").count() == 0
    broken = log.where("sequence <> 4").withColumn("payload", F.when(F.col("sequence") == 2, "x").otherwise(F.col("payload")))
    assert {r.event_id: r.fault for r in eventlog.verify_chain(broken, None, "event_id", "payload").where("fault is not null").collect()} == {"e2": "event_hash", "e5": "sequence"}
    twice = log.unionAll(log.where("sequence = 3"))
    assert {r.fault for r in eventlog.verify_chain(twice, None, "event_id", "payload").where("sequence = 3").collect()} == {"duplicate_event_id"}


def test_histories_newest_first(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1)], "id string, at int")
    assert [r.id for r in history.merge_histories(df, df.limit(0), "id", ["at"], date="at").collect()] == ["a", "b", "c"]
