"""Logs with carried state, checked reads, long lists, limiters by sessions, paged listings."""

import hashlib
import json
import random
import resource

import pytest
from pyspark.sql import functions as F

from brindle.functions import hashing
from brindle.operators import eventlog, folds, graph
from brindle.session import settings
from brindle.sources import paged, readers
from brindle.streaming import feeds, limiter, logs

EVENTS = "log string, event string, n int, payload string"
STORED = EVENTS + ", sequence bigint, previous_sha256 string, event_sha256 string"


def events(seed=1, n=60):
    r = random.Random(seed)
    return [(r.choice(["a", "b", "c", None]), f"e{i}", i, r.choice(["x", "", None, "é"])) for i in range(n)]


def plain_chain(rows, state=None):
    state, out = dict(state or {}), {}
    for log, event, _, text in sorted(rows, key=lambda r: (r[2], r[3] or "")):
        n, before = state.get(log, (0, None))
        own = hashlib.sha256(f"{before or ''}\0{text or ''}".encode()).hexdigest()
        state[log] = (n + 1, own)
        out[event] = (n + 1, before, own)
    return out


def chained(df):
    return {r["event"]: (r["sequence"], r["previous_sha256"], r["event_sha256"]) for r in df.collect()}


def test_append_goes_on_from_tails(spark):
    rows = events()
    df = spark.createDataFrame(rows, EVENTS).repartition(3)
    assert chained(eventlog.append(df, "log", "n", "payload")) == plain_chain(rows)
    first = eventlog.append(df.where("n < 25 and log is not null"), "log", "n", "payload")
    rest = eventlog.append(df.where("n >= 25 and log is not null"), "log", "n", "payload", eventlog.log_tails(first, "log"))
    assert chained(first.unionByName(rest)) == plain_chain([r for r in rows if r[0]])
    assert eventlog.append(df.where("n < 0"), "log", "n", "payload").count() == 0


def test_append_behind_a_join_that_changes_as_it_runs(spark):
    """Planned as a sort-merge join of events and tails, run as a broadcast join whose rows stay where they are."""
    rows = spark.range(0, 6000, 1, 8).select((F.col("id") % 7).alias("u"), F.col("id").alias("e"), F.col("id").cast("string").alias("p"))
    first = eventlog.append(rows.where("e < 40"), "u", "e", "p")
    joins = {"spark.sql.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, joins):
        second = eventlog.append(rows.where("e >= 40"), "u", "e", "p", eventlog.log_tails(first, "u"))
        got = {r.e: (r.sequence, r.previous_sha256, r.event_sha256) for r in first.unionByName(second).collect()}
    assert got == {r.e: (r.sequence, r.previous_sha256, r.event_sha256) for r in eventlog.append(rows, "u", "e", "p").collect()} and len(got) == 6000


def test_append_stream_restarts(spark, tmp_path):
    """Two micro-batches, a stop and a third give the chain of one batch, behind the stored ends of some of the logs."""
    rows = [r for r in events(3, 80) if r[0]]
    df = spark.createDataFrame(rows, EVENTS)
    stored = eventlog.append(df.where("n < 20 and log <> 'c'"), "log", "n", "payload")
    state = {r["log"]: (r["sequence"], r["event_sha256"]) for r in eventlog.log_tails(stored, "log").collect()}
    got = lambda: chained(spark.read.schema(STORED).parquet(str(tmp_path / "out")))
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": logs.ROCKSDB}):
        for lo, hi, trigger in ((20, 40, 1), (40, 60, 1), (60, 80, 1)):
            df.where(f"n >= {lo} and n < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            if lo == 20:
                continue
            linked = logs.append_stream(spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", trigger).parquet(str(tmp_path / "in")), "log", "n", "payload", eventlog.log_tails(stored, "log"))
            linked.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert got() == plain_chain([r for r in rows if r[2] >= 20], state)
    with pytest.raises(ValueError):
        logs.append_stream(feeds.new_rows(spark, str(tmp_path / "in"), df.schema), "log", "n", "payload")


def write_log(folder, made):
    folder.mkdir()
    (folder / "part.jsonl").write_text("\n".join(json.dumps(r.asDict()) for r in made) + "\n\n")


def test_checked_read(spark, tmp_path):
    made = eventlog.append(spark.createDataFrame([r for r in events() if r[0]], EVENTS), "log", "n", "payload").collect()
    read = lambda name: readers.event_log(spark, str(tmp_path / name), STORED, "log", "event", "payload")
    assert read("none").count() == 0 and read("none").columns == [f.split()[0] for f in STORED.split(", ")]
    write_log(tmp_path / "good", made)
    assert sorted(map(str, read("good").collect())) == sorted(map(str, made))
    changed = {"event_hash": lambda r, i: r.__class__(**{**r.asDict(), "payload": "changed"}) if i == 7 else r, "sequence": lambda r, i: None if i == 7 else r, "previous_hash": lambda r, i: r.__class__(**{**r.asDict(), "previous_sha256": "0"}) if i == 7 else r, "duplicate_event_id": lambda r, i: made[7] if i == 8 else r}
    for fault, change in changed.items():
        write_log(tmp_path / fault, [x for i, r in enumerate(made) if (x := change(r, i)) is not None])
        with pytest.raises(Exception, match=f"invalid event chain: log ., event e[0-9]*, (sequence|{fault})"):
            read(fault).collect()
    write_log(tmp_path / "malformed", made)
    with open(tmp_path / "malformed" / "part.jsonl", "a") as f:
        f.write('{"log": "a", \n')
    with pytest.raises(Exception, match="malformed event in .*part.jsonl"):
        read("malformed").select("event").collect()


def test_long_list_in_bounded_memory(spark):
    """A list of 160 MB streams through a worker that keeps far less."""
    df = spark.range(40_000, numPartitions=4).select(F.lit("k").alias("key"), "id", F.concat(F.lit('"'), F.repeat(F.lit("x"), 4000), F.col("id").cast("string"), F.lit('"')).alias("item"))
    (row,) = eventlog.list_hash(df, "key", "id", "item").collect()
    digest = hashlib.sha256(b"[")
    for i in range(40_000):
        digest.update(f'{"," if i else ""}"{"x" * 4000}{i}"'.encode())
    digest.update(b"]")
    assert row["list_sha256"] == digest.hexdigest()

    def peak(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    kept = folds.folded(df, ["key"], ["id"], ["item"], "n bigint", lambda: 0, lambda s, x: s + len(x), lambda s: (s,))
    assert kept.first()["n"] == sum(4002 + len(str(i)) for i in range(40_000))
    assert spark.range(1).mapInArrow(peak, "kb bigint").first()["kb"] < 600_000


def test_list_hash_is_that_of_the_list(spark):
    items = [{"b": 1, "a": [2.0, {"z": "é", "y": None}]}, None, "x", [1.5]]
    df = spark.createDataFrame([("k", i, json.dumps(x) if x is not None else None) for i, x in enumerate(items)] + [("l", 0, "{}")], "key string, n int, raw string")
    got = {r["key"]: r["list_sha256"] for r in eventlog.list_hash(df.withColumn("item", hashing.canonical_json(F.col("raw"))), "key", "n", "item").collect()}
    text = '[{"a":[2,{"y":null,"z":"é"}],"b":1},null,"x",[1.5]]'
    assert got == {"k": hashlib.sha256(text.encode()).hexdigest(), "l": hashlib.sha256(b"[{}]").hexdigest()}


def attempts(seed, n, span, keys=4):
    r = random.Random(seed)
    return [(i, r.choice([*(f"s{k}" for k in range(keys)), None]), f"m{r.randint(0, keys)}", r.randint(0, span)) for i in range(n)]


@pytest.mark.parametrize("span", [3000, 60_000, 2_000_000])
def test_two_keys_by_sessions(spark, span):
    """One component of keys over the whole time; cut in time it gives what one fold gives, in several tasks."""
    rows, rules = attempts(span, 500, span), ((3, 900), (5, 8000))
    df = spark.createDataFrame(rows, "i int, source string, mail string, t long").repartition(3)
    order = sorted(rows, key=lambda r: (r[3], r[0]))
    want = {r[0]: ok for r, ok in zip(order, limiter.fold([(t, (s, m)) for _, s, m, t in order], list(rules)))}
    assert {r["i"]: r["accepted"] for r in limiter.limit_by_two(df, ("source", "mail"), "t", "i", rules).collect()} == want
    if span > 1_000_000:
        cut = limiter.sessions(limiter.sessions(df.fillna("none"), "source", "t", "i", 900, "a"), "mail", "t", "i", 8000, "b")
        nodes = cut.select(F.concat_ws("/", "source", "a").alias("a"), F.concat_ws("/", F.lit("m"), "mail", "b").alias("b"))
        assert graph.components(nodes, "a", "b").select("component").distinct().count() > 20


def test_sessions(spark):
    rows = [(i, "k", t) for i, t in enumerate([0, 5, 9, 19, 29, 640, 645, 1300])] + [(100, "l", 3), (101, None, 4), (102, None, 5)]
    got = {r["i"]: r["s"] for r in limiter.sessions(spark.createDataFrame(rows, "i int, k string, t long"), "k", "t", "i", 10, "s", 2).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 19, 4: 29, 5: 640, 6: 640, 7: 1300, 100: 3, 101: 4, 102: 4}


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(300)]
    rows = chain + [("s", f"t{i}") for i in range(50)] + [("x", "x"), ("a0", "a1"), ("a1", "a0"), (None, "y")]
    r.shuffle(rows)
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect()}
    want = {**{f"c{i:03}": "c000" for i in range(301)}, **{f"t{i}": "s" for i in range(50)}, "s": "s", "x": "x", "a0": "a0", "a1": "a0"}
    assert got == want


def test_paged_listing(spark, tmp_path):
    """Full pages to the first short one; missing, broken and odd pages end a listing; what lies behind is not read."""

    def land(source, page, text):
        folder = tmp_path / f"source={source}" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "body.json").write_text(text)

    full = lambda k: json.dumps({"products": [{"id": k + i, "t": "é"} for i in range(3)]})
    for page in range(1, 8):
        land("long", page, full(10 * page))
    land("short", 1, full(0)), land("short", 2, json.dumps({"products": [{"id": 5}]})), land("short", 3, full(50))
    land("broken", 1, full(0)), land("broken", 2, "{"), land("broken", 3, full(50))
    land("none", 2, full(0))
    land("odd", 1, json.dumps({"products": {"id": 1}}))
    land("empty", 1, json.dumps({"products": []}))
    for each in (1, 2, 20):
        listed = paged.listing(spark, str(tmp_path), page_size=3, last_page=6, pages_per_task=each)
        ids = {}
        for r in paged.items_of(listed, "id int, t string").collect():
            ids.setdefault(r["source"], []).append(r["id"])
        assert {k: sorted(v) for k, v in ids.items()} == {"long": [10 * p + i for p in range(1, 7) for i in range(3)], "short": [0, 1, 2, 5], "broken": [0, 1, 2]}
        report = {r["source"]: (r["status"], r["pages"], r["n_items"]) for r in paged.source_report(listed).collect()}
        assert report == {"long": ("ok", 6, 18), "short": ("ok", 2, 4), "broken": ("partial", 2, 3), "none": ("unavailable", 1, 0), "odd": ("unavailable", 1, 0), "empty": ("ok", 1, 0)}
    assert listed.where("source = 'long'").select("sha256").distinct().count() == 6
    assert paged.listing(spark, str(tmp_path / "nowhere")).count() == 0
    with pytest.raises(Exception, match="count from 1"):
        paged.listing(spark, str(tmp_path), page_size=0).count()


def test_landed_pages_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s/{i % 2}", f"t{i}") for i in range(11)], "id int, source string, t string").withColumn("item", F.struct("id", "t"))
    paged.land_pages(df, str(tmp_path / "p"), "source", "id", "item", 4)
    got = paged.items_of(paged.listing(spark, f"file:{tmp_path}/p", page_size=4), "id int, t string")
    assert sorted((r["id"], r["source"], r["page"], r["place"]) for r in got.collect()) == sorted((i, f"s/{i % 2}", i // 2 // 4 + 1, i // 2 % 4 + 1) for i in range(11))


def test_long_catalog_literals(spark):
    """Names of a hundred thousand characters, escapes among them, overflow no stack."""
    name = 'x\\"y' * 25_000
    df = spark.createDataFrame([(1, f'  {{ b: "B", n: "{name}", mg: 4.5 }},'), (2, f'{{ b: "B", n: "{name}, mg: 4 }}')], "i int, line string")
    (row,) = readers.catalog_lines(df, "line", "i").collect()
    assert (row["line_number"], row["b"], row["mg"]) == (1, "B", 4.5) and row["n"] == 'x"y' * 25_000


def test_result_pages_in_parts():
    from brindle.operators import discovery

    page = '<a href="https://a.example/1">x<h3 class="t">One <b>more</b></h3></a><a href="https://b.example/2"><a href="https://c.example/3"><h3>Two</h3><a href="https://d.example/4">'
    assert discovery._results(page, "www.google.com") == [{"url": "https://a.example/1", "title": "One more"}, {"url": "https://b.example/2", "title": "Two"}]
    bing = '<li class="b_algo"><h2><a href="https://a.example/1">One</a></h2><li class="b_algo"><p><h2> <a class="x" href="https://b.example/2">Two</a> </h2>'
    assert discovery._results(bing, "www.bing.com") == [{"url": "https://a.example/1", "title": "One"}, {"url": "https://b.example/2", "title": "Two"}]
    assert discovery._results('<a href="https://x.com/"><h3>' * 20_000, "www.google.com") == []


def test_decisions_after_a_second_look(spark):
    from brindle.operators import research

    rows = [("a", "u1", True, 4.0, "d", "official"), ("b", "u2", True, 4.0, "d", "retailer:x"), ("b", "u3", True, 4.0, "d", "retailer:y"), ("c", "u4", True, 4.0, "d", "official"), ("d", "u5", False, 4.0, "d", "official")]
    recorded = spark.createDataFrame(rows, "id string, url string, exact boolean, mg double, sha string, branch string")
    current = spark.createDataFrame([("u1", 4.0, "e"), ("u2", 4.0, "d"), ("u4", 6.0, "d"), ("u5", 4.0, "d")], "url string, mg double, sha string")
    got = {r["id"]: (r["before"], r["after"], r["lost"]) for r in research.redecide(recorded, current, "id", "url", "exact", "mg", "sha", "branch", ["official"]).collect()}
    assert got == {"a": (True, True, 0), "b": (True, False, 1), "c": (True, False, 1), "d": (False, False, 0)}


def test_known_sources(spark):
    from brindle.sources import registry

    addresses = {"https://www.haypp.com/x": "haypp-group", "http://shop.velo.com": "bat-velo", "https://www.accessdata.fda.gov/a": "us-fda", "https://notvelo.com/": None, "none": None, None: None, "https://velo.com.evil.example/": None}
    df = spark.createDataFrame([(u,) for u in addresses], "url string")
    got = {r["url"]: (r["source_class"], r["owner_group_id"]) for r in registry.with_source(df, "url").collect()}
    assert {u: g for u, (_, g) in got.items()} == addresses
    assert got["http://shop.velo.com"][0] == "official" and got[None][0] == got["none"][0] == "unknown" and registry.known_sources(spark).count() == 14
