"""Personal data by patterns, and terms that give it away by co-occurrence: information-theoretic sanitisation in DataFrame and SQL functions only.

Four kinds of protected entities (addresses, IP numbers, cards, phones) are found by expressions. The words near an entity are its context. How much of an entity a term discloses is their pointwise
mutual information over the corpus, as a share of the entity's information content:

    PMI(e, t) / IC(e) = log(p(e, t) / (p(e) p(t))) / log(1 / p(e)),   p over documents

which is 1 where the term occurs only beside the entity. Terms above the threshold, in enough different contexts, are sensitive wherever a document that has the entity uses them: numbers are generalised to their
size, words removed. Copies of one text give one context, so a text that is copied a thousand times makes no term sensitive.

Expressions are anchored where a run of their first characters begins (or the match before ends), and repeat possessively: each character is read a bounded
number of times, and no text overflows the matcher's stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import written

#: Kinds in order, their expressions (as the contract has them, anchored and possessive) and what a text must contain for a match.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_RUN = r"[\p{L}\p{N}]"
#: Two private characters around each match while a text is taken apart.
_MARK = ""
TERM = "term"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = lambda d, i: d * 2 - F.when(d > 4, 9).otherwise(0) if i else d
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, value(d.cast("int"), True)).otherwise(d.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    size = F.length(_digits(match))
    return size.between(9, 15) if kind == "phone" else F.when(size.between(12, 19), luhn(_digits(match))).otherwise(F.lit(False))


def _entity(kind: str, match: Column) -> Column:
    value = F.lower(match) if kind == "email" else match if kind == "ip" else _digits(match)
    return F.concat(F.lit(f"{kind}:"), value)


def _apart(text: Column, pattern: str | Column) -> Column:
    """What is before the first match, the match, what is between, and so on; one pass marks the matches, texts that have the mark themselves take two."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    marked = F.split(F.regexp_replace(text, pattern, F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    two = F.flatten(F.zip_with(between, found, lambda b, c: F.when(c.isNull(), F.array(b)).otherwise(F.array(b, c))))
    return F.when(F.contains(text, F.lit(_MARK)), two).otherwise(marked)


def _words(text: Column) -> Column:
    """Words of 3 to 40 letters and digits in lower case, in order."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(f"{_RUN}++"), F.lit(0)), lambda w: F.length(w).between(3, 40))


def _context(before: Column, after: Column, words: int, reach: int) -> Column:
    """Up to ``words`` words on each side, as far as they stand whole within ``reach`` characters."""
    near = F.when(F.length(before) > reach, F.regexp_replace(F.right(before, F.lit(reach)), f"^{_RUN}+", "")).otherwise(before)
    far = F.when(F.length(after) > reach, F.regexp_replace(F.left(after, F.lit(reach)), f"{_RUN}+$", "")).otherwise(after)
    left = _words(near)
    return F.array_distinct(F.concat(F.slice(left, F.greatest(F.size(left) - words + 1, F.lit(1)), F.lit(words)), F.slice(_words(far), 1, words)))


def _candidates(kind: str, pieces: Column, words: int, reach: int) -> Column:
    """Of each match: kind, place among its kind, characters since the match before, length, and if it holds, entity and context."""
    number = KINDS.index(kind)

    def one(i: Column) -> Column:
        match, gap = F.get(pieces, i), F.get(pieces, i - 1)
        ok = _holds(kind, match)
        context = _context(gap, F.get(pieces, i + 1), words, reach)
        return F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(gap).alias("gap"), F.length(match).alias("size"), F.when(ok, _entity(kind, match)).alias("entity"), F.when(ok, context).alias("terms"))

    return F.transform(F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: i % 2 == 1), one)


def _ends(rows: DataFrame, *by: str) -> DataFrame:
    """``start`` and ``end`` in code points from ``gap`` and ``size`` of all matches in order ``i``."""
    upto = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("long")).withColumn("start", F.col("end") - F.col("size"))


_SPAN = "array<struct<start: bigint, kind: int, end: bigint, entity: string, terms: array<string>>>"


def base_spans(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 8, reach: int = 256) -> DataFrame:
    """row, key, hash (of the text) and spans (start, kind number, end, entity, terms of its context; by start, then kind) of each row.

    Leftmost, without overlap within a kind; matches that fail their check are dropped without another try. A null text is empty.
    Texts are read once and stay in their rows; only matches, with the keys, are shuffled to be counted up.
    """
    step = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    need = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "ip": F.col("text").rlike("[0-9][.][0-9]"), "card": F.col("text").rlike("[0-9][\\x20-]?[0-9]")}
    step = step.select("row", "key", "hash", *[F.when(need[k], _apart(F.col("text"), PATTERNS[k])).otherwise(F.array(F.lit(""))).alias(k) for k in KINDS])
    step = step.select("row", "key", "hash", F.concat(*[_candidates(k, F.col(k), words, reach) for k in KINDS]).alias("found"))
    rows = step.select("row", "key", "hash", F.explode_outer("found").alias("f")).select("row", "key", "hash", "f.*").repartition("row")
    rows = _ends(rows, "row", "kind")
    span = F.when(F.col("entity").isNotNull(), F.struct("start", "kind", "end", "entity", "terms"))
    return rows.groupBy("row").agg(F.first("key").alias("key"), F.first("hash").alias("hash"), F.sort_array(F.collect_list(span)).cast(_SPAN).alias("spans"))


def _known(base: DataFrame) -> DataFrame:
    """row, key, hash, entity, term, context: each term near each entity."""
    span = base.where(F.size("spans") > 0).select("row", "key", "hash", F.explode("spans").alias("s"))
    return span.select("row", "key", "hash", "s.entity", F.explode("s.terms").alias("term"), F.xxhash64("s.terms").alias("context"))


def _small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` (written, narrow) marked for broadcast where it has few rows; joined by a shuffle where not."""
    return F.broadcast(df) if df.count() <= most else df


def disclosures(base: DataFrame, df: DataFrame, text: str = "text", least: float = 0.9, support: int = 3) -> DataFrame:
    """entity, term, disclosure: terms that give at least ``least`` of an entity's information, seen in ``support`` different contexts of it or more.

    Counts are over all documents. An entity that every document has carries no information.
    """
    pairs = _known(base).groupBy("row", "entity", "term").agg(F.min("context").alias("context"))
    pairs = pairs.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= support).drop("contexts")
    pairs = written(pairs, "pairs")
    docs = base.count()
    none = pairs.select("entity", "term", F.lit(0.0).alias("disclosure")).where("false")
    if pairs.isEmpty():
        return none
    holders = base.select(F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity")).join(_small(written(pairs.select("entity").distinct(), "entities")), "entity", "left_semi").groupBy("entity").agg(F.count(F.lit(1)).alias("holders"))
    terms = _small(written(pairs.select("term").distinct(), "terms"))
    used = df.select(F.explode(F.array_distinct(_words(F.coalesce(F.col(text), F.lit(""))))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("used")).join(terms, "term")
    n, c = F.lit(float(docs)), F.col
    share = (F.log("together") + F.log(n) - F.log("holders") - F.log("used")) / (F.log(n) - F.log("holders"))
    told = pairs.join(holders, "entity").join(used, "term").where(c("holders") < docs).select("entity", "term", F.least(share, F.lit(1.0)).alias("disclosure"))
    return written(told.where(c("disclosure") >= least), "disclosures")


def term_spans(base: DataFrame, told: DataFrame, df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, hash, added (start, end, term): every use, in any case, of a disclosing term in the texts that have its entity with it; uses within base spans are left out."""
    hits = _known(base).join(told, ["entity", "term"], "left_semi").groupBy("key", "hash").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    hits = written(hits, "hits")
    spans = base.select("key", "hash", "spans").dropDuplicates(["key", "hash"])
    small = hits.count() <= 20_000
    texts = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text")).alias("d")
    same = lambda a, b: F.col(f"{a}.key").eqNullSafe(F.col(f"{b}.key")) & (F.col(f"{a}.hash") == F.col(f"{b}.hash"))
    keyed = texts.join((F.broadcast(hits) if small else hits).alias("h"), same("d", "h")).select("h.*", "d.text").dropDuplicates(["key", "hash"])
    pattern = F.concat(F.lit(f"(?iu)(?<!{_RUN})(?:"), F.array_join("terms", "|"), F.lit(f")(?!{_RUN})"))
    pieces = keyed.select("key", "hash", _apart(F.col("text"), pattern).alias("p"))
    one = lambda i: F.struct(i.alias("i"), F.length(F.get("p", i - 1)).alias("gap"), F.length(F.get("p", i)).alias("size"), F.lower(F.get("p", i)).alias("term"))
    found = pieces.select("key", "hash", F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.size("p") - 1), lambda i: i % 2 == 1), one)).alias("f")).select("key", "hash", "f.*")
    found = _ends(found, "key", "hash").alias("f").join(spans.alias("b"), same("f", "b"), "left")
    apart = ~F.exists("b.spans", lambda s: (s["start"] < F.col("f.end")) & (F.col("f.start") < s["end"]))
    return found.where(F.coalesce(apart, F.lit(True))).groupBy("f.key", "f.hash").agg(F.sort_array(F.collect_list(F.struct("f.start", "f.end", "f.term"))).alias("added"))


def find(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.9, support: int = 3) -> DataFrame:
    """key, hash, spans (base spans without contexts) and added (terms) of each row of ``df``; rows that repeat give rows each.

    An empty table gives no rows; a null or empty text has no spans; a null key is one like others.
    """
    base = written(base_spans(df, key, text), "spans")
    told = disclosures(base, df, text, least, support)
    lean = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    kind = "array<struct<start: bigint, end: bigint, term: string>>"
    if told.isEmpty():
        return base.select("key", "hash", lean.alias("spans"), F.array().cast(kind).alias("added"))
    added = term_spans(base, told, df, key, text).alias("a")
    both = base.alias("b").join(added, F.col("b.key").eqNullSafe(F.col("a.key")) & (F.col("b.hash") == F.col("a.hash")), "left")
    return both.select("b.key", "b.hash", lean.alias("spans"), F.coalesce("a.added", F.array().cast(kind)).alias("added"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text."""
    kinds = F.array(*[F.lit(k) for k in [*KINDS, TERM]])
    label = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    extra = F.transform("added", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    text = lambda spans: F.array_join(F.transform(F.array_sort(spans), label), ",")
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(F.col("key").alias(key), *counts, F.sha2(text(F.col("spans")), 256).alias("base_sha256"), text(F.concat("spans", extra)).alias("spans"))


def sanitise(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.9, support: int = 3) -> DataFrame:
    """The rows of ``df`` with entities replaced by their kind, disclosing numbers by their first digit and as many x, and disclosing words by ``[...]``. Other columns stay.

    Spans that overlap or touch become one. Texts with spans are taken apart into characters, some fifty bytes each, so a text must fit a task fifty times.
    """
    found = find(df, key, text, least, support).where((F.size("spans") > 0) | (F.size("added") > 0)).dropDuplicates(["key", "hash"])
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    general = lambda t: F.when(t.rlike("^[0-9]+$"), F.concat(F.left(t, F.lit(1)), F.repeat(F.lit("x"), F.length(t) - 1))).otherwise("[...]")
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("put")))
    more = F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), general(s["term"]).alias("put")))
    # a span that begins inside those before it adds nothing but its end
    rows = found.select("key", "hash", F.posexplode(F.array_sort(F.concat(base, more))).alias("i", "s")).select("key", "hash", "i", "s.*")
    w = Window.partitionBy("key", "hash").orderBy("i")
    rows = rows.withColumn("new", F.coalesce(F.col("start") >= F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(w))
    runs = rows.groupBy("key", "hash", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("put", "i").alias("put"))
    before = F.coalesce(F.lag("end").over(Window.partitionBy("key", "hash").orderBy("run")), F.lit(0))
    cuts = runs.withColumn("before", before).groupBy("key", "hash").agg(F.sort_array(F.collect_list(F.struct("start", "end", "put", "before"))).alias("cuts"), F.max("end").alias("rest"))
    d = df.withColumn("_hash", F.xxhash64(text)).alias("d")
    both = d.join(cuts.alias("c"), F.col(f"d.{key}").eqNullSafe(F.col("c.key")) & (F.col("d._hash") == F.col("c.hash")), "left")
    chars = F.regexp_extract_all(F.col(f"d.{text}"), F.lit("(?s)."), F.lit(0))
    both = both.select(*[F.col(f"d.`{c}`") for c in df.columns], "c.cuts", "c.rest", F.when(F.col("c.cuts").isNotNull(), chars).alias("_chars"))
    part = F.transform("cuts", lambda s: F.concat(F.array_join(F.slice("_chars", (s["before"] + 1).cast("int"), (s["start"] - s["before"]).cast("int")), ""), s["put"]))
    end = F.array_join(F.slice("_chars", (F.col("rest") + 1).cast("int"), F.size("_chars")), "")
    put = F.when(F.col("cuts").isNotNull(), F.concat(F.array_join(part, ""), end)).otherwise(F.col(text))
    return both.select(*[put.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
