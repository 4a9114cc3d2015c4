"""Prefix trie, centroid clustering and disclosure of personal data, against plain versions."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

pytest.importorskip("brindle.llm")
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import centroids, html, pii, queries, secrets, sharding, trie

# --- 11: conversation prefix trie


def plain_trie(rows):
    """conv_id, depth -> (parent, n_convs, n_children, n_leaves, saved, sha) by sets of whole prefixes."""
    convs = {}
    for c, n, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((n is not None, n or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in convs.items():
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = 0 if base == c else zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(base, [])[:h] + v[h:]
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = {}
    for p, members in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(r[:-1] == q for r in nodes if r)]
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in under)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(p))))
        out[min(members), len(p)] = (min(nodes[p[:-1]]) if p else None, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def made_trie(df, **options):
    t = trie.build(df, **options)
    rows = t.nodes.drop("turn", "ordinal").join(trie.ids_sha256(t.members), ["conv_id", "depth"], "left").collect()
    none = hashlib.sha256(b"").hexdigest()
    assert len({(r["conv_id"], r["depth"]) for r in rows}) == len(rows)
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"] or none) for r in rows}


def random_conversations(seed, n):
    r, rows = random.Random(seed), []
    for c in [*range(n), -3, -5, -7, 10**12]:
        for k in range(r.choice([0, 1, 2, 3, 5, 9, 12])):
            rows.append((c, r.choice([None, k, k, k]), r.choice(["user", None, "", "assistant"]), r.choice(["a", "b", "é", None, "", "a b"]) if k > 2 else r.choice("ab")))
    return rows + rows[:4] + [(None, 1, "user", "no key")]


@pytest.mark.parametrize("bits", [64, 3])
def test_trie_brute_force(spark, bits):
    """Three bits of fingerprint make nearly all groups collide; splits keep them apart."""
    rows = random_conversations(5, 24 if bits == 3 else 60)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    assert made_trie(df, bits=bits) == plain_trie(rows)


def test_trie_long_conversations(spark):
    """One conversation holds nearly all rows and spreads over all ranges; another repeats its turns."""
    rows = [(5, k, "user", f"turn {k % 7}") for k in range(3000)] + [(6, k, "user", f"turn {k % 7}") for k in range(40)] + [(7, 0, "x", "y")]
    made = made_trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(4))
    built = {5: rows[:3000], 6: rows[:40]}
    assert max(d for _, d in made) == 3000 and made[5, 0][1] == 3
    h = zlib.crc32(b"6") % 9
    shared = [k for k in range(3001) if made[5, k][1] >= 2]
    assert shared[: h + 1] == list(range(h + 1)) and made[5, 41 if 41 in shared else 3000][2] in (0, 1) and built
    assert made[5, 3000][2:5] == (0, 1, 0) and made[5, 2999][2:4] == (1, 1)


def test_trie_empty_and_clash(spark):
    assert made_trie(spark.createDataFrame([], CONVERSATIONS)) == {}
    df = spark.createDataFrame([(1, 0, "user", "x"), (2, 0, "user", "x" * 200_000)], CONVERSATIONS).withColumn("depth", F.lit("clash")).withColumn("g", F.lit(1))
    assert made_trie(df) == plain_trie([(1, 0, "user", "x"), (2, 0, "user", "x" * 200_000)])


def test_trie_texts(spark):
    t = trie.build(spark.createDataFrame([(0, 0, "user", "x"), (0, 1, None, None)], CONVERSATIONS))
    assert sorted((r["depth"], r["role"], r["text"]) for r in t.texts().collect()) == [(0, None, None), (1, "user", "x"), (2, "", "")]


def test_powers():
    k = np.array([0, 1, 2, 4095, 4096, 10**9, 2**47])
    assert trie.powers(k).tolist() == [pow(trie._BASE, int(i), 1 << 64) for i in k]


# --- 12: centroid clustering


def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        own = [[] for _ in c]
        for _, v in kept:
            own[near(v)].append(v)
        c = [[sum(x) // len(m) for x in zip(*m)] if m else old for m, old in zip(own, c)]
    got = [(i, near(v), far(v, c[near(v)])) for i, v in kept]
    hashes = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    top = (1 << 63) - 1
    return sorted(((i, j, min(d, top), min(sum(e for _, b, e in got if b == j), top), min(sum(e for _, _, e in got), top), hashes[j]) for i, j, d in got), key=str)


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def made_clusters(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in centroids.cluster(df).collect()), key=str)


def vectors(seed, n, spread=1.0):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(5, 64)) * 4
    return [(i, [float(np.float32(x)) for x in middle[i % 5] + spread * r.normal(size=64)]) for i in range(n)]


def test_clusters_brute_force(spark):
    rows = vectors(3, 90)
    rows += [(200, None), (201, [1.0] * 63), (202, [float("nan")] + [0.0] * 63), (203, [float("inf")] * 64), (204, [None] + [0.0] * 63), (205, []), (None, [0.25] * 64), rows[0], rows[0], (rows[0][0], [0.5] * 64)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("q", F.lit("clash")).withColumn("norms", F.lit(1))
    assert made_clusters(df) == plain_clusters(rows)


def test_clusters_ties_few_and_none(spark):
    same = [(i, [0.5] * 64) for i in range(12)]
    assert made_clusters(spark.createDataFrame(same, VECTORS)) == plain_clusters(same)
    few = vectors(1, 3)
    assert made_clusters(spark.createDataFrame(few, VECTORS)) == plain_clusters(few)
    assert made_clusters(spark.createDataFrame([(1, [1.0])], VECTORS)) == []


def test_clusters_large_components(spark):
    """Beyond longs the integers are Python's; distances that fit no long are the largest long."""
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=64) * 10.0 ** (i % 13)]) for i in range(40)]
    assert made_clusters(spark.createDataFrame(rows, VECTORS).repartition(2)) == plain_clusters(rows)


def test_screening(spark):
    """Bounds never exceed distances, and on vectors with clusters most centroids are never looked at."""
    x = np.floor(1024 * np.array([v for _, v in vectors(7, 400)])).astype(np.int64)
    c = x[:8]
    best, d, took = centroids.nearest(x, centroids.compressed(x, 16), c, 16)
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (d == full.min(1)).all() and took < 0.6 * full.size
    low = ((centroids.compressed(x, 16)[:, None] - centroids.compressed(c, 16)[None]) ** 2).sum(2)
    assert (low <= full * (1 + 1e-9) + 1e-6).all()


def test_repeated_runs_agree(spark):
    one, two = (sorted(map(tuple, queries.op12_centroids(spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert one == two


# --- 13: personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def holds(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "card":
            total = sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
            return 12 <= len(d) <= 19 and total % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "phone": 9 <= len(d) <= 15}[kind]

    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if holds(k, m[0])]
    return ",".join(s for _, _, s in sorted(found))


def test_pii_fuzz(spark):
    r = random.Random(6)
    bits = ["a", "b.c", "@", "x@y.z", ".", "-", " ", "  ", "+", "_", "%", "1", "255", "256", "0", "1.2.3.4", "010.9.8.7.6", "4111111111111111", "4111 1111-1111 1111", "+1 (386) 555-3733", "(", ")", "😀", "é", "\n", "", "79927398713"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 14)))) for i in range(3000)]
    rows += [(3000, None), (3000, None), (3001, ""), (None, "x@y.z"), (5, "x@y.z 1.2.3.4"), (5, "x@y.z 1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("hash", F.lit("clash")).withColumn("spans", F.lit(1))
    got = sorted(((r["doc_id"], r["base_sha256"], r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]) for r in pii.digest(pii.find(df, least=2.0)).collect()), key=str)
    want = [(i, plain_spans(t)) for i, t in rows]
    assert got == sorted(((i, hashlib.sha256(s.encode()).hexdigest(), len(s.split(",")) if s else 0) for i, s in want), key=str)
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pii_hostile(spark):
    """A quarter of a megabyte of anything is read in seconds and overflows no stack; a plain search agrees on shorter ones."""
    units = ["a", "a.", "1", "1.", "1 ", "1-", "+1", "+1(", "a@", "a@b.", "@a.", "\ue002\ue003", "x "]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(units)], "doc_id long, unit string").repartition(4)
    n = F.floor(F.lit(250_000) / F.length("unit")).cast("int")
    began = time.time()
    got = {r["key"]: r["n"] for r in pii.base_spans(df.withColumn("text", F.repeat("unit", n))).select("key", F.size("spans").alias("n")).collect()}
    assert time.time() - began < 60
    assert [got[i] for i, u in enumerate(units) if u not in ("1.", "a@b.")] == [0] * (len(units) - 2) and got[3] == 31250
    short = {r["doc_id"]: r["base_sha256"] for r in pii.digest(pii.find(df.withColumn("text", F.repeat("unit", F.lit(150))), least=2.0)).collect()}
    assert short == {i: hashlib.sha256(plain_spans(u * 150).encode()).hexdigest() for i, u in enumerate(units)}


def told_documents():
    """Someone's name stands beside their address in different contexts, and once alone; a copied text repeats its words often."""
    r = random.Random(1)
    words = [f"w{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, f"{some(30)} Quillfeather {some(2)} quill@mail.example {some(30)} 778899 {some(3)}") for i in range(4)]
    rows += [(10, f"{some(20)} quill@mail.example {some(20)} QUILLFEATHER said, and quillfeathers did not."), (11, f"{some(5)} Quillfeather alone")]
    copied = f"{some(10)} Brackwater {some(1)} brack@mail.example {some(10)}"
    return rows + [(100 + i, copied) for i in range(30)] + [(200 + i, some(40)) for i in range(200)]


def test_disclosing_terms(spark):
    df = spark.createDataFrame(told_documents(), "doc_id long, text string").repartition(3)
    base = pii.base_spans(df)
    told = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosures(pii.written(base, "base"), df, least=0.0).collect()}
    # 5 documents have the name, 4 of them beside the address of 5: log(4 * n / (5 * 6)) of log(n / 5)
    n = len(told_documents())
    name = told["email:quill@mail.example", "quillfeather"]
    assert abs(name - np.log(4 * n / (5 * 6)) / np.log(n / 5)) < 1e-9
    assert not any(e == "email:brack@mail.example" for e, _ in told)
    found = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(df, least=0.85)).collect()}
    texts = dict(told_documents())
    terms = {d: [texts[d][int(s.split(":")[1]) : int(s.split(":")[2])] for s in v.split(",") if s.startswith("term")] for d, v in found.items()}
    assert terms[0] == ["Quillfeather"] and terms[11] == [] and terms[100] == [] and all(not v for d, v in terms.items() if d >= 200)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df, least=0.85).collect()}
    assert "Quillfeather [" not in clean[0] and "[...]" in clean[0] and "[EMAIL]" in clean[0] and "quill@" not in clean[0]
    assert clean[11] == texts[11] and clean[200] == texts[200] and "brack@" not in clean[100] and "Brackwater" in clean[100]
    assert clean[0].replace("[...]", "Quillfeather").replace("[EMAIL]", "quill@mail.example") == texts[0]


def test_sanitise_overlaps(spark):
    rows = [(1, "é😀 4111 1111 1111 1111x@y.z!", "keep"), (1, "call +1 (386) 555-3733.", "k"), (2, None, "n"), (3, "", "e"), (3, "", "e")]
    got = sorted(((r["doc_id"], r["text"], r["hash"]) for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string, hash string")).collect()), key=str)
    assert got == sorted([(1, "é😀 [CARD]!", "keep"), (1, "call [PHONE].", "k"), (2, None, "n"), (3, "", "e"), (3, "", "e")], key=str)


def test_pii_native(spark):
    plan = pii.digest(pii.find(spark.createDataFrame(told_documents(), "doc_id long, text string")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- 8: malformed pages and named boilerplate; 4: hostile texts


@pytest.mark.parametrize("unit", ['<a "', "<a '\"", "<a ", "<", "<!", "<!--", "<a>", "<nav><article>", "<p>a", "<b <i <u \"", "<div a='\"' \"", '<article class="related">', "&#"])
def test_hostile_pages(unit):
    """A megabyte of anything that never closes is read in seconds."""
    began = time.time()
    html.lines_of(unit * (1_000_000 // len(unit)))
    assert time.time() - began < 6


def test_named_boilerplate():
    inside = ['<div class="notice">X</div>', '<div role="alert">X</div>', '<p class="advert">X</p>', '<ins class="adsbygoogle">X</ins>', '<figure class="ad">X</figure>', '<span class="ad">X</span>']
    inside += ['<ol class="commentlist"><li class="comment">X</li></ol>', '<div class="user-comments">X</div>', "<label>X</label>", '<section class="comments">X</section>', "<form>X</form>", '<div role="form">X</div>']
    for box in inside:
        assert html.lines_of(f"<main><p>Body.</p>{box}<p>More.</p></main>") == [("Body.", True), ("More.", True)], box
    assert html.lines_of('<article class="related"><p>Body.</p></article>') == [("Body.", True)]
    assert html.lines_of('<article><p>Body.</p></article><article class="related"><p>X</p></article>') == [("Body.", True)]
    assert html.lines_of('<article><pre>a <span class="comment"># b</span></pre></article>') == [("a # b", True)]
    assert html.lines_of("<p <b>hi</b> x <y and z < 3") == [("hi x <y and z < 3", False)]


def test_alignment_in_halves():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice("abcdef") for _ in range(r.randint(0, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        for most in (1 << 24, 20):
            shared = html.common_lines(a, b, most)
            rest = iter(b)
            assert sum(shared) == row[-1] and all(x in rest for x, s in zip(a, shared) if s)


def test_secrets_hostile(spark):
    """Key heads without an end, and other repeats, take seconds for a quarter of a megabyte."""
    units = ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----\nab-c", "a", "token=", "1", 'key: "aaaa', "----", "password "]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(units)], "doc_id long, unit string").repartition(4)
    text = F.repeat("unit", F.floor(F.lit(250_000) / F.length("unit")).cast("int"))
    forest, key = secrets.train(spark), "-----BEGIN RSA PRIVATE KEY-----\n" + "aB3+/x" * 20 + "\n-----END RSA PRIVATE KEY-----"
    began = time.time()
    got = {r["doc_id"]: r["n"] for r in secrets.scan(df.select("doc_id", text.alias("text")), forest).select("doc_id", F.size("findings").alias("n")).collect()}
    assert time.time() - began < 60 and got[0] == got[1] == 0
    (found,) = secrets.findings(spark.createDataFrame([(1, f"{units[0]} x {key} y")], "doc_id long, text string"), forest).collect()
    assert found["secret"] == key


# --- 7: a plain k-d tree


def plain_tree(units, axes, shards):
    spread = {a: max(max(u[a] for u in units) - min(u[a] for u in units), 1e-12) for a in axes}
    out = {}

    def grow(own, count, first):
        if count == 1 or not own:
            out.update({u["id"]: first for u in own})
            return
        axis = max(axes, key=lambda a: (max(u[a] for u in own) - min(u[a] for u in own)) / spread[a])
        own = sorted(own, key=lambda u: (u[axis], u[axes[-1]]))
        left = (count + 1) // 2
        goal, so_far, cut = sum(u["_bytes"] for u in own) * left / count, 0, len(own)
        for i, u in enumerate(own):
            if so_far + u["_bytes"] >= goal:
                cut = i + 1 if so_far + u["_bytes"] - goal <= goal - so_far else i
                break
            so_far += u["_bytes"]
        grow(own[:cut], left, first)
        grow(own[cut:], count - left, first + left)

    grow(units, shards, 0)
    return out


@pytest.mark.parametrize("shards,seed", [(8, 1), (5, 2), (3, 3)])
def test_tree_brute_force(spark, shards, seed):
    """Histograms refined over rounds give the cuts of a tree that sorts its units."""
    r = random.Random(seed)
    units = [{"id": i, "_bytes": r.choice([1, 5, 9, 300]), "x": float(r.choice([0, 1, 1, 1, 7])), "y": r.random() * 3, "h": r.random()} for i in range(400)]
    df = spark.createDataFrame([tuple(u.values()) for u in units], "id int, _bytes long, x double, y double, h double").repartition(3)
    got = {row["id"]: row["shard"] for row in sharding.split(df, ["x", "y", "h"], shards).collect()}
    assert got == plain_tree(units, ["x", "y", "h"], shards)
