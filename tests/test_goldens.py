"""Small cases with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brindle.functions import dates, hashing, matching, measure, text, urls
from brindle.operators import catalog, documents, eventlog, evidence, history, validate
from brindle.sources import readers, sinks
from brindle.streaming import feeds, limiter

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "days, expected",
    [
        ([(D(2025, 11, 28), 1, 3)], 0),
        ([(D(2026, 8, 14), 2, 3), (D(2026, 8, 13), 1, 3), (D(2026, 8, 12), 3, 3)], 3),
        ([(D(2026, 8, 14), 1, 3)], 1),
        ([(D(2026, 8, 13), 1, 3), (D(2026, 8, 12), 2, 3), (D(2026, 8, 11), 1, 3)], 3),
        ([(D(2026, 8, 12), 1, 3)], 0),
        ([(D(2026, 8, 14), 1, 3), (D(2026, 8, 13), 1, 3), (D(2026, 8, 11), 1, 3)], 2),
        ([(D(2026, 8, 14), 1, 2), (D(2026, 8, 13), 2, 1), (D(2026, 8, 12), 1, 2)], 1),
        ([(D(2026, 8, 14), 9, 2), (D(2026, 8, 13), 1, 2)], 0),
    ],
)
def test_streak(spark, days, expected):
    df = spark.createDataFrame([("u", d, n, k) for d, n, k in days], "user string, day date, n long, lim long")
    assert history.recorded_day_streak(df, "user", F.lit("2026-08-14"), "lim").first()["streak"] == expected


@pytest.mark.parametrize(
    "created, days, limit, expected",
    [
        (D(2026, 8, 14), [], 2, (False, False)),
        (D(2026, 8, 7), [(D(2026, 8, 8), 1), (D(2026, 8, 13), 1)], 2, (True, True)),
        (D(2026, 8, 1), [(D(2026, 8, 8), 3), (D(2026, 8, 13), 3)], 2, (False, False)),
    ],
)
def test_achievements(spark, created, days, limit, expected):
    users = spark.createDataFrame([("u", created)], "user string, created date")
    counts = spark.createDataFrame([("u", d, n) for d, n in days], "user string, day date, n long")
    r = history.period_achievements(counts, users, "user", F.lit("2026-08-14"), F.lit(limit)).first()
    assert (r["yesterday_success"], r["clean_weekend"]) == expected


def test_merge(spark):
    local = spark.createDataFrame([("local", 8, "L"), ("same", 9, "Local")], "id string, at int, name string")
    remote = spark.createDataFrame([("same", 9, "Remote"), ("remote", 10, "R")], "id string, at int, name string")
    assert {(r.id, r.name) for r in history.merge_histories(local, remote, "id", ["at"]).collect()} == {("local", "L"), ("same", "Remote"), ("remote", "R")}
    assert [r.id for r in history.local_only(local, remote, "id").collect()] == ["local"]


def test_bands_and_owner(spark):
    from brindle.plans.queries import BANDS

    df = spark.createDataFrame([(3.0,), (3.1,), (5000.0,), (None,)], "v double")
    assert [r.label for r in history.first_band(df, "v", BANDS, ["label"]).collect()] == ["Top 10% (Casual)", "Average", "Ultra", None]
    assert one(spark, history.owner_mode(F.lit("a"), F.lit("a"))) == "current" and one(spark, history.owner_mode(F.lit(None).cast("string"), F.lit("a"))) == "guest"


def test_taper(spark):
    at = lambda day, s: one(spark, history.taper_limit(F.lit(day).cast("date"), F.lit("2026-08-01").cast("date"), F.lit("2026-08-11").cast("date"), F.lit(10), s))
    assert (at("2026-08-01", "smooth"), at("2026-08-06", "smooth"), at("2026-08-11", "smooth")) == (10, 5, 0)
    assert (at("2026-08-06", "weekly"), at("2026-08-10", "cutoff"), at("2026-08-11", "cutoff")) == (10, 10, 0)


def test_settings(spark):
    rows = [("CZK", 150.0, 20.0, 5.0, "track", None, None), ("", -1.0, 0.0, -2.0, "quit", "smooth", "2020-01-01"), ("CZK", 1.0, 2.5, 0.0, "x", None, None)]
    df = spark.createDataFrame(rows, "currency string, pack_price double, per_pack double, daily_limit double, goal string, strategy string, target_date string")
    got = [r.e for r in validate.check(df, validate.settings_rules(F.lit("2026-08-14"))).select(validate.error_text(F.col("errors")).alias("e")).collect()]
    assert got[0] == "" and len(got[1].split("|")) == 5 and got[2] == "goal:invalid_goal|pouchesPerPack:invalid_pouch_count"


def test_entries_and_numbers(spark):
    df = spark.createDataFrame([("x');--", "B", "N", 1.0, "2026-08-14T09:00:00"), ("ok-1", "B", " ", 1.0, "2027-01-01"), ("ok-2", "B", "N", 1001.0, "bad")], "id string, brand string, name string, mg double, date string")
    got = [r.e for r in validate.check(df, validate.entry_rules(F.lit("2026-08-14"))).select(validate.error_text(F.col("errors")).alias("e")).collect()]
    assert got == ["id:invalid_id", "date:invalid_date|name:invalid_name", "date:invalid_date|mg:invalid_strength"]
    assert [one(spark, validate.number(F.lit(x))) for x in ("149.90", "5d", "NaN", "")] == [149.9, None, None, 0.0]


def test_contact(spark):
    row = lambda **k: {"name": "A", "email": "a@b.cz", "topic": "bug", "message": "0123456789", "website": "", "opened_ms": 0} | k
    rows = [row(), row(email="nope"), row(topic="x"), row(message="short"), row(opened_ms=9_999)]
    df = spark.createDataFrame(rows, "name string, email string, topic string, message string, website string, opened_ms long")
    assert [r.v for r in df.select(validate.contact_verdict(F.lit(10_000), ["bug"]).alias("v")).collect()] == [None, "email", "topic", "message", "reopen"]


def test_csv(spark):
    line = sinks.history_line(F.lit("2026-08-14 09:30:00").cast("timestamp"), F.lit('=HYPERLINK("https://invalid.example")'), F.lit('Řada, "silná"\nnová'), F.lit(10.0))
    assert one(spark, line) == '2026-08-14,09:30:00,"\'=HYPERLINK(""https://invalid.example"")","Řada, ""silná""\nnová",10'
    assert one(spark, sinks.csv_line(F.lit("a,b"), F.lit(None).cast("string"), F.lit("c"))) == '"a,b",,c'


def test_csv_file(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,)], "line string")
    sinks.write_history(df, str(tmp_path / "out"), "line")
    body = "".join(sorted(p.read_bytes().decode() for p in (tmp_path / "out").glob("part-*"))[::-1])
    assert "﻿Date,Time,Brand,Name,Mg\r\n" in body and body.count("\r\n") == 2


def test_row_id(spark):
    v = hashing.row_id(F.lit(1), F.lit("77 Pouches"), F.lit("77 Black Currant Ice"), hashing.plain_number(F.lit(10.4)))
    assert one(spark, v) == "input-0001-085e88ca93ef03ac9893ea0830450cefc336587739f2f7e327d94de387234a0d"


def test_row_id_of_late_rows(spark):
    assert [one(spark, hashing.row_id(F.lit(n), F.lit("a")))[:-65] for n in (42, 9999, 10000, 123456)] == ["input-0042", "input-9999", "input-10000", "input-123456"]


def test_canonical_json(spark):
    assert one(spark, hashing.canonical_json(F.lit('{"b": 1.0, "a": [2, {"d": 1, "c": null}]}'))) == '{"a":[2,{"c":null,"d":1}],"b":1}'
    assert one(spark, hashing.canonical_json(F.lit("{"))) is None
    assert len(one(spark, hashing.keyed_identifier("s", "email", F.lit(" A@b.cz ")))) == 64


def test_catalog_lines(spark):
    lines = [(1, "export const X = ["), (2, '  { b: "A \\"q\\"", n: "Mint", mg: 6 },'), (3, "  { b: 'no' },"), (4, '{b:"B",n:"Ice",mg:.5}')]
    got = readers.catalog_lines(spark.createDataFrame(lines, "no int, line string"), "line", "no").collect()
    assert [(r.line_number, r.b, r.n, r.mg) for r in got] == [(2, 'A "q"', "Mint", 6.0), (4, "B", "Ice", 0.5)]


def test_normalisers(spark):
    assert one(spark, text.normalize_candidate(F.lit("  ZYN® Citrus—6mg (Slim) "))) == "zyn citrus 6 mg slim"
    assert one(spark, text.normalize_candidate(F.lit("Ｚｙｎ"), compose=True)) == "zyn"
    assert one(spark, text.identity_tokens(F.lit("Buy #12 Blackcurrant 6 mg Pouches 4.0"))) == ["hash12", "black", "currant", "4"]
    assert one(spark, text.explicit_strengths(F.lit("6mg or 9,5 MG"))) == [6.0, 9.5]
    assert one(spark, text.material_key(F.lit("Page 2 zyn MINT mint"))) == "mint zyn"
    assert one(spark, text.overlap_ratio(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a")))) == 0.5


@pytest.mark.parametrize(
    "name, mg, title, observed, expected",
    [
        ("Citrus 6mg", 6.0, "Citrus 6 mg medium", None, True),
        ("Citrus 6mg", 6.0, "Citrus Lime 6mg", None, False),
        ("Citrus 6mg", 6.0, "Citrus 9mg", None, False),
        ("Citrus", 6.0, "Citrus 6mg", 6.0, True),
        ("Citrus", 6.0, "Citrus 6mg", 9.0, False),
        ("Mint Mint", 6.0, "Mint", None, False),
    ],
)
def test_exact_variant(spark, name, mg, title, observed, expected):
    assert one(spark, matching.exact_variant(F.lit(name), F.lit(mg), F.lit(title), F.lit(observed).cast("double"))) is expected


def test_compare_identity(spark):
    alias = {"77 pouches": ["77 pouches", "77"]}
    m = lambda b, n: one(spark, matching.compare_identity(F.lit("77 Pouches"), F.lit("77 Cola Cherry"), F.lit(b).cast("string"), F.lit(n), alias))["identity_match"]
    assert (m("77", "77 Cola Cherry 10mg"), m("77", "77 Cola Cherry Ice"), m("77", "77 Cola Vanilla"), m(None, "77 Cola Cherry")) == ("exact", "near", "wrong", "near")


def test_measure(spark):
    claims = F.array(F.struct(F.lit("per_g").alias("basis"), F.lit(16.0).alias("value")))
    assert one(spark, measure.strength_of_claims(claims, F.lit(13.0), F.lit(20.0)))["value"] == pytest.approx(10.4)
    assert one(spark, measure.strength_of_claims(claims, F.lit(None).cast("double"), F.lit(20.0)))["value"] is None
    assert one(spark, measure.per_unit(F.lit(None).cast("double"), F.lit(16.0), F.lit(13.0), F.lit(0.0))) is None


def test_urls(spark):
    assert one(spark, urls.url_key(F.lit("HTTPS://WWW.A.com#x"))) == "https://www.a.com/#x"
    assert one(spark, urls.url_key(F.lit("nope"))) is None
    assert one(spark, urls.is_likely_product(F.lit("https://a.com/Blog/x"))) is False
    reg = spark.createDataFrame([(2, "a.com", "later"), (1, "a.com", "first")], "ord int, host string, owner string")
    df = spark.createDataFrame([("https://www.shop.a.com/p",), ("https://nota.com/",)], "url string")
    assert {(r.url, r.owner) for r in urls.owner_join(df, "url", reg).collect()} == {("https://www.shop.a.com/p", "first"), ("https://nota.com/", None)}


def test_robots(spark):
    groups = documents.robots(F.lit("User-agent: *\nDisallow: /a\nAllow: /a/b\nCrawl-delay: 2\nUser-agent: x\nDisallow: /"))
    ok = lambda p: one(spark, urls.robots_allows(groups, F.lit(p)))
    assert (ok("/a/c"), ok("/a/b/c"), ok("/z")) == (False, True, True)


def test_dates(spark):
    assert one(spark, dates.last_sunday_before(F.lit("2026-08-09").cast("date"))) == D(2026, 8, 2)
    assert one(spark, dates.local_day(F.lit("garbage"))) is None
    spark.conf.set("spark.sql.session.timeZone", "Europe/Prague")
    try:
        assert one(spark, dates.local_day(F.lit("2026-08-14T22:30:00Z"))) == D(2026, 8, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_chain(spark):
    df = spark.createDataFrame([("l", i, f"p{i}") for i in range(6)], "log string, event int, payload string")
    chain = eventlog.append(df, "log", "event", "payload")
    assert eventlog.verify_chain(chain, "log", "event", "payload").where("fault is not null").count() == 0
    bad = chain.withColumn("payload", F.when(F.col("event") == 3, "x").otherwise(F.col("payload")))
    got = eventlog.verify_chain(bad, "log", "event", "payload")
    assert [(r.event, r.fault) for r in got.where("fault is not null").collect()] == [(3, "event_hash")]
    prefix, manifest = eventlog.repair(got, "log", "event", F.col("fault").isNull())
    assert prefix.count() == 3 and manifest.first()["kept"] == 3
    gone = chain.where("event <> 2")
    assert eventlog.verify_chain(gone, "log", "event", "payload").where("fault is not null").count() == 3


def test_decisions(spark):
    v = lambda **k: one(spark, evidence.verdict(*[F.lit(k.get(n, d)).cast(t) for n, d, t in (("invalid", False, "boolean"), ("dup", None, "string"), ("conflict", False, "boolean"), ("matched", False, "boolean"), ("enough", False, "boolean"), ("observed", None, "double"), ("mg", 6.0, "double"))]))["reason"]
    assert v(invalid=True, dup="a") == "invalid_catalog_row" and v(dup="a", conflict=True) == "exact_duplicate" and v(conflict=True) == "strength_conflict"
    assert v(enough=True, observed=7.0) == "verified_mg_correction" and v(matched=True) == "matched_identity_mg_evidence_recorded" and v() == "unverified_keep_conservative"
    assert one(spark, evidence.branch_key(F.lit("retailer"), F.lit("x"))) == "retailer:x"


def test_limiter(spark):
    m = 60_000
    rows = [(i, t * m, s, e) for i, (t, s, e) in enumerate([(0, "s", "a"), (1, "s", "b"), (2, "s", "c"), (3, "s", "d"), (16, "s", "e"), (20, "t", "f"), (40, "u", "f"), (60, "v", "f"), (80, "w", "f"), (100, "x", "f"), (120, "y", "f")])]
    df = spark.createDataFrame(rows, "i int, t long, source string, email string")
    got = {r.i: r.accepted for r in limiter.limit_by_two(df, ("source", "email"), "t", "i").collect()}
    assert [got[i] for i in range(11)] == [True, True, True, False, True, True, True, True, True, True, False]
    assert limiter.fold(rows and [(r[1], (r[2], r[3])) for r in rows], [(3, 15 * m), (5, 1440 * m)]) == [got[i] for i in range(11)]


def test_limiter_stream(spark, tmp_path):
    rows = [(i, i * 1000, "k" if i % 2 else "j") for i in range(12)]
    df = spark.createDataFrame(rows, "i long, t long, k string")
    batch = {r.i: r.accepted for r in limiter.limit_by_key(df, "k", "t", "i", 3, 8000).collect()}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = limiter.limit_stream(feeds.new_rows(spark, str(tmp_path / "in"), df.schema), "k", "t", "i", 3, 8000)
    q = stream.writeStream.format("memory").queryName("limited").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.i: r.accepted for r in spark.table("limited").collect()} == batch


def test_documents(spark):
    page = '<title>ZYN Citrus 6mg | Shop</title><script type="application/ld+json">{"@graph":[{"@type":"Product","name":"Citrus","brand":{"name":"ZYN"},"offers":{"price":"4.29","availability":"https://schema.org/InStock"},"additionalProperty":[{"name":"Nicotine","value":"13.2 mg"}]}]}</script><script type="application/ld+json">{broken</script><p>13.2 mg per pouch</p>'
    df = spark.createDataFrame([(1, page)], "id int, body string")
    r = documents.product_facts(df, "id", "body").first()
    assert (r.title, r.brand, r.price, r.available, r.mg_per_pouch) == ("Citrus", "ZYN", 4.29, True, 13.2)
    assert one(spark, documents.title(F.lit(page))) == "ZYN Citrus 6mg"
    links = spark.createDataFrame([(1, "https://a.com/x/", '<a href="y">One</a><a href="/x/y">Two</a><a href="https://b.com/">B</a>')], "id int, url string, body string")
    assert [(r.href, r.label) for r in documents.own_links(links, "id", "url", "body").orderBy("href").collect()] == [("https://a.com/x/y", "Two")]
    shop = spark.createDataFrame([(1, '{"products":[{"title":"T","variants":[{"title":"v","price":"1.5","available":true},{"title":"w"}]},{"title":"U"}]}')], "id int, body string")
    assert documents.shop_products(shop, "id", "body").count() == 3
    maps = spark.createDataFrame([("s", "<sitemapindex><loc>t</loc></sitemapindex>"), ("t", "<urlset><loc>p1</loc><loc>p2</loc></urlset>")], "url string, body string")
    assert {r.url for r in documents.crawl(maps, maps.where("url = 's'")).collect()} == {"p1", "p2"}
    assert one(spark, documents.unwrap(F.lit("https://duckduckgo.com/l/?uddg=https%3A%2F%2Fa.com%2F"))) == "https://a.com/"


def test_freeze_and_gates(spark, tmp_path):
    df = spark.createDataFrame([(1, 6.0), (2, 7.0)], "k int, mg double")
    path = str(tmp_path / "frozen")
    assert catalog.write_once(df, path, "k").count() == 2 and catalog.write_once(df, path, "k").count() == 2
    with pytest.raises(ValueError):
        catalog.write_once(df.where("k = 1"), path, "k")
    d = spark.createDataFrame([(1, "remove", None), (2, "keep", 9.0)], "k int, decision string, to double")
    assert [(r.k, r.mg) for r in catalog.gated_changes(df, d, "k", "mg").collect()] == [(2, 9.0)]
    with pytest.raises(ValueError):
        catalog.gated_changes(df, spark.createDataFrame([(5, "keep", 1.0)], "k int, decision string, to double"), "k", "mg")
    assert catalog.same_sequence(df, df, "k", "mg")
    with pytest.raises(Exception):
        catalog.require(df, F.col("mg") < 7, "too strong").collect()


def test_nulls_and_empty(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert catalog.conflict_groups(none, [F.col("k")], "v").count() == 0
    some = spark.createDataFrame([(None, 1), (None, None), (1, 2)], "k int, v int")
    assert history.daily_counts(spark.createDataFrame([(1, None)], "u int, ts timestamp"), ["u"], "ts").count() == 0
    assert catalog.exact_duplicates(some, [F.col("k")], "v", "v").count() >= 0
