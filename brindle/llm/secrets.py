"""Secret scanning with a random forest that removes false positives.

Candidates come from one regular expression over the whole text. Each has features: length, character transitions,
dictionary coverage, path look and neighbouring words. A forest, grown in numpy on the driver from labelled
findings, is compiled to one SQL expression over the features, so the scan is DataFrame and SQL functions only: no
Python runs on executors, and a document never leaves its row.
"""

from __future__ import annotations

import json
import random
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words whose assigned value is a candidate even unquoted.
NAMES = "token|secret|passw|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|authorization|auth(?!or)|bearer|credential|signing|encryption"
#: Forms of candidates. Private key blocks, values after a hot name (after a blank alone only with a digit or mixed case), known forms,
#: runs of 16 or more key characters with a digit ('=' only as padding, so that a name and its value are two), and quoted values that are assigned.
CANDIDATE = (
    # a body ends at the next five dashes, so heads without an end are read once
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]++|-(?!----))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
    r"|(?<=[=:> ])(?=[^\s\"'<>,;]{8})"
    # cheap conditions first: looking back for a name costs most and is seldom due
    rf"(?:(?<=[=:]>? ?)(?<=(?i:{NAMES})[A-Za-z0-9_-]{{0,20}}[\"']? ?[=:]{{1,2}}>? ?)|(?<= )(?=\S{{0,200}}[0-9]|\S{{0,200}}[a-z][A-Z])(?<=(?i:{NAMES})[A-Za-z0-9_-]{{0,20}} ))"
    rf"(?!(?i:{NAMES})[A-Za-z0-9_-]{{0,20}}[\"']? ?[=:])"
    r"[^\s\"'<>,;]{7,}[^\s\"'<>,;.)\]}]"
    rf"|(?<=[\"'])(?<=(?i:{NAMES})[A-Za-z0-9_-]{{0,20}}[\"']? ?[=:]{{1,2}}>? ?[\"'])[^\s\"']{{8,}}(?=[\"'])"
    r"|(?<![A-Za-z0-9+/_.-])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20,}|sk[-_](?:live|test)[-_][A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_.-]+)"
    rf"|(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_.-]*[0-9])(?![A-Za-z0-9_-]{{0,64}}(?i:{NAMES})[A-Za-z0-9_-]{{0,20}}[\"']? ?[=:])"
    r"[A-Za-z0-9+/_.-]{16,}(?:={1,2}(?![A-Za-z0-9+/_.=-]))?"
    r"|(?<=[=:] ?[\"'])[^\s\"']{8,}(?=[\"'])"
)
#: Words of ordinary identifiers and prose.
DICTIONARY = (
    "account address article author button client column config content context control count country current default delete demo detail document domain download element email error event example "
    "field file filter form format function group handler header home image index info input item label language level link list local message method model module name node number object option order "
    "page param parent path post print product project query release report request response result role root sample script search section select server service session size source start state static status "
    "string style submit system table test text theme time title type update upload user value version video view width window your changeme placeholder dummy xxxx 1234 abcd"
).split()
#: Words near a secret, and words near other long strings.
HOT_WORDS = "token secret passw passwd pwd apikey api_key api-key access_key private_key client_secret auth bearer credential signing encryption"
COLD_WORDS = "commit sha sha1 sha256 md5 checksum digest integrity revision uuid guid etag build isbn phone tel fax card iban order invoice http https www src href jpg png css"

FEATURES = {
    "length": "least(length(c), 400)",
    "digits": "regexp_count(c, '[0-9]') / length(c)",
    "upper": "regexp_count(c, '[A-Z]') / length(c)",
    "transitions": "regexp_count(c, '[a-z](?=[0-9A-Z])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])') / length(c)",
    "spoken": "regexp_count(lower(c), '[aeiou](?=[bcdfghjklmnprstvwz])|[bcdfghjklmnprstvwz](?=[aeiou])') / length(c)",
    "variety": "size(array_distinct(split(left(c, 64), ''))) / least(length(c), 64)",
    "hex": "cast(c rlike '^[0-9a-fA-F]+$' as int)",
    "dictionary": "1 - length(regexp_replace(lower(c), '" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + "', '')) / length(c)",
    "path": "regexp_count(c, '[/.]') / length(c) + cast(b rlike '[/\\\\\\\\]$' or a rlike '^[/\\\\\\\\.][A-Za-z]' as int)",
    "words": "regexp_count(c, '[_-]') / length(c)",
    "hot": "cast(lower(b) rlike '" + "|".join(HOT_WORDS.split()) + "' as int)",
    "cold": "cast(lower(b) rlike '(^|[^a-z])(" + "|".join(COLD_WORDS.split()) + ")([^a-z]|$)' as int)",
    "assigned": "cast(b rlike '[=:] ?[\"'']?$' as int)",
    "quoted": "cast(a rlike '^[\"'']' as int)",
    "form": "cast(c rlike '^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-|sk[-_](live|test)?[-_]?[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{10,}[.]|-----BEGIN)' as int)",
}


def labelled_findings(seed: int = 31, each: int = 120) -> list[tuple[str, str, str, int]]:
    """(text before, candidate, text after, label): examples of secrets and of what is mistaken for them."""
    r = random.Random(seed)
    hexa, alnum, b64 = string.hexdigits[:16], string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    word = lambda: r.choice(DICTIONARY[:-6])
    prose = lambda: " ".join(r.choice("the of and in that la que der und les est una for with".split()) for _ in range(3)) + " "
    hot = lambda: r.choice(["token", "secret", "api_key", "password", "client_secret", "auth_token", "access_key", "Authorization: Bearer", "credential"])
    put = lambda: r.choice([(" = \"", "\""), (" = '", "'"), (": \"", "\","), ("=", " "), (": ", "\n"), (" ", " ")])
    out = []
    for _ in range(each):
        for made in (pick(hexa, r.choice([32, 40, 48, 64])), pick(alnum, r.randint(20, 64)), pick(b64, r.choice([40, 44, 64])) + r.choice(["", "=", "=="]), pick(alnum, r.randint(8, 16)) + r.choice("!#$%") + pick("0123456789", 2)):
            op, close = put()
            out.append((prose() + hot() + op, made, close + prose(), 1))
        for made in ("AKIA" + pick(string.ascii_uppercase + string.digits, 16), r.choice(["ghp_", "gho_"]) + pick(alnum, 36), "sk_live_" + pick(alnum, 24), "eyJ" + pick(alnum, 30) + "." + pick(alnum, 40) + "." + pick(alnum, 30), "-----BEGIN RSA PRIVATE KEY-----\n" + pick(b64, 64) + "\n-----END RSA PRIVATE KEY-----"):
            out.append((prose() + r.choice(["", hot() + " = ", "key "]), made, " " + prose(), 1))
        out.append((prose() + r.choice(["commit ", "sha1 ", "sha256: ", "md5 = ", "checksum ", "revision ", "etag: \""]), pick(hexa, r.choice([32, 40, 64])), " " + prose(), 0))
        out.append((prose() + r.choice(["", "id ", "uuid ", "guid: ", "id=\""]), "-".join(pick(hexa, n) for n in (8, 4, 4, 4, 12)), " " + prose(), 0))
        out.append((prose(), "_".join(word() for _ in range(r.randint(2, 4))) + "_" + pick("0123456789", r.randint(1, 4)), " " + prose(), 0))
        out.append((prose() + r.choice(["https://", "src=\"/", "/", "path: "]), "/".join(word() for _ in range(r.randint(2, 4))) + f"/{r.randint(1, 99999)}" + r.choice([".jpg", ".html", "", ".css"]), r.choice(["\"", " ", "?x="]) + prose(), 0))
        out.append((prose() + hot() + " = \"", r.choice(["changeme12345678", "your_token_here_1", "example-secret-0000", "xxxxxxxxxxxxxxxx1", "placeholder_value_1", "test_token_12345678", "dummy-password-1234"]) + pick("0123456789", r.randint(0, 2)), "\" " + prose(), 0))
        out.append((prose() + r.choice(["", "card ", "phone ", "tel: ", "order "]), pick("0123456789", r.randint(16, 20)), " " + prose(), 0))
        out.append((prose() + r.choice(["color = \"", "name: \"", "title = '", "class=\""]), " ".join(word() for _ in range(r.randint(1, 3))).replace(" ", r.choice(["-", "_"])) + word(), "\" " + prose(), 0))
        out.append((prose(), "-".join([pick("0123456789", 4), pick("0123456789", 2), pick("0123456789", 2)]) + "T" + ":".join(pick("0123456789", 2) for _ in range(1)) + pick("0123456789", 4) + "-" + pick("0123456789", 4), " " + prose(), 0))
        out.append((prose() + r.choice(["", "mail ", "see "]), ".".join(word() for _ in range(3)) + pick("0123456789", 2) + "." + word(), r.choice(["@", " "]) + prose(), 0))
        name = lambda: r.choice(["AWS_ACCESS_KEY_ID", "api_key", "DB_PASSWORD", "app-token", "CLIENT_SECRET"]) + r.choice(["=", ": ", ":", " = "])
        out.append((prose() + name(), r.choice(["AKIA" + pick(string.ascii_uppercase + string.digits, 16), pick(hexa, 32), pick(alnum, r.randint(9, 15)), pick(string.ascii_letters, 32)]), r.choice([" ", "\n"]) + prose(), 1))
        out.append((prose() + r.choice([name(), hot() + " "]), r.choice([word() + word(), word() + "_" + word(), word() + "." + word() + "()", "https://" + word() + ".com/" + word(), "${" + word() + "_" + word()]), r.choice([" ", "\n"]) + prose(), 0))
    return out


class Forest:
    """CART trees on bootstrap samples with random features at each split; compiled to SQL."""

    def __init__(self, trees: int = 15, depth: int = 6, least: int = 4, seed: int = 13):
        self.n, self.depth, self.least, self.seed, self.trees = trees, depth, least, seed, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.n):
            rows = rng.integers(0, len(y), len(y))
            self.trees.append(self._grow(x[rows], y[rows], self.depth, rng))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, rng) -> tuple | float:
        p = float(y.mean())
        if depth == 0 or len(y) < 2 * self.least or p in (0.0, 1.0):
            return round(p, 4)
        best = (1e-9, None, None)
        for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, t = x[order, f], np.cumsum(y[order])
            k = np.arange(1, len(y))
            ok = (v[1:] > v[:-1]) & (k >= self.least) & (len(y) - k >= self.least)
            if not ok.any():
                continue
            left, right = t[:-1] / k, (t[-1] - t[:-1]) / (len(y) - k)
            gain = p * (1 - p) - (k * left * (1 - left) + (len(y) - k) * right * (1 - right)) / len(y)
            i = int(np.where(ok, gain, -1).argmax())
            if gain[i] > best[0]:
                best = (gain[i], int(f), float((v[i] + v[i + 1]) / 2))
        _, f, cut = best
        if f is None:
            return round(p, 4)
        go = x[:, f] <= cut
        return f, cut, self._grow(x[go], y[go], depth - 1, rng), self._grow(x[~go], y[~go], depth - 1, rng)

    def predict(self, x: np.ndarray) -> np.ndarray:
        def walk(t, row):
            while isinstance(t, tuple):
                t = t[2] if row[t[0]] <= t[1] else t[3]
            return t

        return np.array([sum(walk(t, row) for t in self.trees) / len(self.trees) for row in x])

    def sql(self, name) -> str:
        """The score as an expression; ``name(i)`` is the SQL of feature i."""

        def tree(t) -> str:
            return f"{t}D" if not isinstance(t, tuple) else f"CASE WHEN {name(t[0])} <= {t[1]!r}D THEN {tree(t[2])} ELSE {tree(t[3])} END"

        return "(" + " + ".join(tree(t) for t in self.trees) + f") / {len(self.trees)}"


def _features(prefix: str = "") -> str:
    """named_struct of the features of before (b), candidate (c) and after (a), fields of ``prefix``."""
    parts = []
    for k, e in FEATURES.items():
        for v in "cba":
            e = _swap(e, v, f"{prefix}{v}")
        parts.append(f"'{k}', cast({e} as double)")
    return "named_struct(" + ", ".join(parts) + ")"


def _swap(expression: str, name: str, to: str) -> str:
    """Replace a bare variable outside string literals."""
    out, inside, i = [], False, 0
    while i < len(expression):
        ch = expression[i]
        if ch == "'":
            inside = not inside
        if not inside and ch == name and not (i and (expression[i - 1].isalnum() or expression[i - 1] in "_.")) and not (i + 1 < len(expression) and (expression[i + 1].isalnum() or expression[i + 1] in "_(")):
            out.append(to)
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def train(spark: SparkSession, findings: list[tuple[str, str, str, int]] | None = None) -> Forest:
    """A forest from labelled findings; their features come from the same SQL as at scoring."""
    findings = findings or labelled_findings()
    rows = json.dumps([dict(zip("bcay", f)) for f in findings])
    table = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<b string, c string, a string, y int>>")).alias("r")).select("r.*")
    got = table.select("y", F.expr(_features()).alias("f")).select("y", "f.*").collect()
    x = np.array([[float(v) for v in r[1:]] for r in got])
    return Forest().fit(x, np.array([r[0] for r in got]))


#: Two private characters around each candidate while a text is taken apart.
_MARK = "\ue000\ue001"


def _pieces(text: str) -> Column:
    """A text as an array: what is before the first candidate, the candidate, what is between, and so on; odd places are candidates. Null is empty.

    One pass of the expression marks the candidates; a text that has the mark itself is taken apart by two passes.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    marked = F.split(F.regexp_replace(t, CANDIDATE, f"{_MARK}$0{_MARK}"), _MARK, -1)
    between, found = F.split(t, CANDIDATE, -1), F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
    apart = F.flatten(F.zip_with(between, found, lambda b, c: F.when(c.isNull(), F.array(b)).otherwise(F.array(b, c))))
    return F.when(F.contains(t, F.lit(_MARK)), apart).otherwise(marked)


def _pairs(pieces: str) -> Column:
    """The candidates of ``_pieces`` in text order, each with the 48 characters before it, the 24 after it and the gap to the one before.

    What is before a candidate begins with the candidate before it, so a name that is one itself is seen.
    """
    p = F.col(pieces)
    places = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: i % 2 == 1)

    def pair(i: Column) -> Column:
        gap = F.get(p, i - 1)
        return F.struct(F.right(F.concat(F.right(F.coalesce(F.get(p, i - 2), F.lit("")), F.lit(48)), gap), F.lit(48)).alias("b"), F.get(p, i).alias("c"), F.left(F.get(p, i + 1), F.lit(24)).alias("a"), F.length(gap).alias("gap"))

    return F.transform(places, pair)


def _with_pieces(df: DataFrame, forest: Forest, text: str, keep: list[str], pieces: str, out: str) -> DataFrame:
    names = list(FEATURES)
    step = df.select(*keep, _pieces(text).alias(pieces))
    step = step.select(*keep, pieces, _pairs(pieces).alias("_found"))
    step = step.select(*keep, pieces, F.expr(f"transform(_found, x -> named_struct('gap', x.gap, 'c', x.c, 'f', {_features('x.')}))").alias("_found"))
    score = forest.sql(lambda i: f"x.f.{names[i]}")
    return step.select(*keep, pieces, F.expr(f"transform(_found, x -> named_struct('gap', x.gap, 'secret', x.c, 'score', {score}))").alias(out))


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def scan(df: DataFrame, forest: Forest, text: str = "text", out: str = "findings") -> DataFrame:
    """Adds an array of candidates in text order: gap (code points since the one before), secret, score.

    Null and empty texts have none. All of a text is read, once; earlier columns of the name are replaced.
    """
    keep = [c for c in df.columns if c != out]
    return _with_pieces(df, forest, text, keep, _fresh(df, "_pieces"), out).select(*keep, out)


def findings(df: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text", cut: float = 0.5) -> DataFrame:
    """A row for each finding that the forest accepts: key, start (code points before it), length, secret, score.

    Repeated rows give their findings again. Only candidates, a small table, are shuffled for the positions.
    """
    base = scan(df.select(key, text), forest, text, "_findings")
    # numbered before the arrays are taken apart, in a step of its own: an id beside posexplode would number candidates; a filter
    # on the findings would be pushed below them and scan every text twice, which the numbering prevents too
    rows = base.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.col(key), F.posexplode("_findings").alias("_pos", "_f"))
    upto = Window.partitionBy("_row").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("_f.secret")
    rows = rows.select(key, (F.sum(F.col("_f.gap") + size).over(upto) - size).cast("long").alias("start"), size.cast("long").alias("length"), F.col("_f.secret").alias("secret"), F.col("_f.score").alias("score"))
    return rows.where(F.col("score") >= cut)


def redact(df: DataFrame, forest: Forest, text: str = "text", cut: float = 0.5, mask: str = "[SECRET]") -> DataFrame:
    """The same rows with accepted findings replaced in the text; other columns and texts without findings are as they were. An empty table gives no rows."""
    name, pieces = _fresh(df, "_findings"), _fresh(df, "_pieces")
    step = _with_pieces(df, forest, text, df.columns, pieces, name)
    masked = F.transform(pieces, lambda p, i: F.when((i % 2 == 1) & (F.get(F.col(name), F.floor(i / 2).cast("int"))["score"] >= cut), F.lit(mask)).otherwise(p))
    hit = F.exists(name, lambda f: f["score"] >= cut)
    return step.select(*[F.when(hit, F.array_join(masked, "")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in df.columns])
