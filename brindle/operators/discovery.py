"""From search answers to candidates: result pages, candidate rules, scored joins of catalog rows and records."""

from __future__ import annotations

import base64
import html
import json
import re
from urllib.parse import parse_qs, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.matching import exact_variant
from brindle.functions.text import first_number, identity_tokens, normalize_candidate, squeeze, tokens, unicode_form
from brindle.functions.urls import host, is_http, is_likely_product, path, path_tokens
from brindle.operators import evidence, folds

#: Result pages. Name, part of the engine's host, patterns of (link, title) in parts that follow one another, the title between the last two, the redirect's parameter, the engine's own domain.
RESULT_PAGES = [
    ("google", "google.", [(r"""<a[^>]+href="(https?://[^"?]+(?:\?[^"']*)?)"[^>]*>""", "<h3[^>]*>", "</h3>")], None, "google.com"),
    ("bing", "bing.", [(r"""<li[^>]+class="b_algo\"""", r"""<h2[^>]*>\s*<a[^>]+href="([^"]+)"[^>]*>""", r"</a>\s*</h2>")], "u", "bing.com"),
    ("other", "", [(r"""<a[^>]*class="result__a"[^>]*href="([^"]+)"[^>]*>""", "</a>"), (r"""<a[^>]*class=['"]result-link['"][^>]*href="([^"]+)"[^>]*>""", "</a>")], "uddg", None),
]
#: Words that name no product in a path, in an index address, and in a title's core.
PATH_WORDS = ["mg", "per", "pouch", "pouches", "nicotine"]
SEARCH_WORDS = ["buy", "online", "nicotine", "pouch", "pouches", "product", "products", "per", "the", "mg", "g", "from", "up", "to", "strength"]
CORE_WORDS = ["buy", "online", "nicotine", "pouch", "pouches", "product", "products", "per", "the"]
#: Branches that own what they show.
OWNER_BRANCHES = ["manufacturer", "brand_owner"]

#: Addresses that are never product pages. Rule, then what must all hold: (part, pattern).
SEARCH_RULES = [
    [("host", r"(^|\.)navercorp\.com$")],
    [("host", r"(^|\.)papago-plus\.com$")],
    [("path", "bn_redirect")],
]
DOCUMENT_RULES = [
    [("path", r"\.(pdf|docx?|xlsx?)$")],
    [("path", r"(^|/)(bbs|forum|board)(/|$)")],
    [("path", r"(^|/)bbs([_-]|/|$)")],
    [("path", r"(^|/)paintingpic/read\.php")],
    [("path", "(^|/)conference/history_abstract_book(/|$)")],
    [("path", r"(^|/)download_attachment(_common)?\.php$")],
    [("path", r"(^|/)tv/view\.html$")],
    [("path", r"(^|/)article/[^/]+\.page$")],
    [("path", r"(^|/)download_pdf\.php$")],
    [("host", r"^(www\.)?sec\.gov$"), ("path", "/archives/edgar/")],
    [("path", r"(filedown|com_trend)\.php$")],
    [("path", r"(^|[/.])(file(down|download)|download(_[a-z0-9]+)?|nttfiledownload|gongmefiledown|downloadservlet|getexcelfile\d*|download_post_attachment|bbsdownload)(\.|/|$)")],
    [("host", r"(^|\.)jmir\.org$"), ("path", "/2021/1/pdf$")],
    [("path", r"(^|/)(gastenboek|guestbook)\.php$")],
    [("path", r"/(readdownloadfile|downloadfile|file_download)\.(do|jsp)$")],
    [("path", "/upldownloadfile$")],
    [("path", r"(^|/)\w+_download\.(do|jsp|php)$")],
    [("path", r"(^|/)file/down(load)?(\.|/|$)")],
    [("path", "(^|/)documents?/download(/|$)")],
    [("query", "(^|[?&])documentid=")],
    [("query", "(^|[?&])fn=filedownload([&#]|$)")],
    [("query", "(^|[?&])fn=(down)?file([&#]|$)")],
    [("query", "(^|[?&])com_board_basic=read_form([&#]|$)")],
    [("query", "(^|[?&])picseq=")],
    [("host", r"(^|\.)tistory\.com$")],
    [("host", r"^(docs\.aws\.amazon\.com|www\.worldradiohistory\.com)$")],
    [("host", r"(^|\.)curia\.europa\.eu$")],
    [("host", r"(^|\.)kworb\.net$")],
    [("host", r"(^|\.)bloggang\.com$")],
    [("host", r"(^|\.)gist\.github\.com$")],
    [("host", r"(^|\.)camra\.org\.uk$")],
    [("host", r"(^|\.)thetastingalliance\.com$"), ("path", "^/results/")],
    [("host", r"(^|\.)theinternationalman\.com$"), ("path", r"/connoisseur-products-and-services\.php$")],
    [("host", r"(^|\.)colombopereira\.com$")],
    [("host", r"(^|\.)edepot\.wur\.nl$")],
    [("host", r"^(www\.)?nicoleaks\.com$")],
    [("host", r"^(dl\.)?kotra\.or\.kr$"), ("path", "(^|/)digital-files(/|$)")],
    [("host", r"(^|\.)teamsi\.co\.kr$")],
    [("host", r"^(impfood\.)?mfds\.go\.kr$"), ("path", "(^|/)file/downloadfile$")],
    [("host", r"(^|\.)theguitar\.co\.kr$")],
    [("host", r"(^|\.)guitarshop\.co\.kr$")],
    [("host", r"(^|\.)caffeineinformer\.com$")],
    [("path", "(^|/)collections(/|$)")],
    [("path", "^/nicotine-pouches/?$")],
    [("host", r"(^|\.)snusexpress\.com$"), ("exact", "^/apres$")],
    [("host", r"(^|\.)kita\.net$"), ("path", r"(^|/)tradenavi/sps/spsdetail\.do$")],
    [("host", r"(^|\.)huggingface\.co$"), ("path", "(^|/)blob(/|$)")],
    [("path", r"(^|/)events?_[^/]+\.html?$")],
    [("path", r"(^|/)reunions/[^/]+\.html?$")],
    [("path", r"(^|/)journal/view\.php$")],
    [("path", r"(^|/)fldownload\.do$")],
    [("path", r"(^|/)down_proc\.asp$")],
    [("path", r"(^|/)down_lst_sym\.php$"), ("query", "(^|[?&])mode=abook([&#]|$)")],
    [("host", r"^(www\.)?gitlab\.com$"), ("path", "(^|/)blob(/|$)")],
    [("path", r"(^|/)commune/view\.php$")],
    [("path", r"(^|/)zeroboard/zboard\.php$")],
    [("path", r"(^|/)mibbs\.cgi$")],
    [("path", r"(^|/)contentnewfile\.do$")],
    [("query", r"(^|[?&])act=board(\.[^&#]*)?([&#]|$)"), ("query", "(^|[?&])bbs_mode=view([&#]|$)")],
    [("query", "(^|[?&])cath=board([&#]|$)"), ("query", "(^|[?&])exec=view([&#]|$)")],
    [("path", r"(^|/)sub\d+_[^/]+\.php$"), ("query", "(^|[?&])(mode|bmode)=view([&#]|$)")],
    [("path", "(^|/)new(/|$)"), ("query", "(mode|bmode)=view")],
]


def _target(href: str, name: str, redirect: str | None) -> str | None:
    """Where a result link leads, behind the engine's redirect."""
    if redirect is None:
        return href
    try:
        packed = parse_qs(urlsplit(urljoin("https://engine.invalid", href)).query).get(redirect, [""])[0]
        if name != "bing":
            return packed or href
        return base64.urlsafe_b64decode(packed[2:] + "=" * (-len(packed[2:]) % 4)).decode() if packed.startswith("a1") else href
    except ValueError:
        return href if name == "bing" else None


def _in_parts(body: str, parts: tuple[str, ...]):
    """(link, title) of each place where the parts follow one another with anything between. Where a part has no place left there is none for any later start either, so a page is searched once."""
    at = 0
    while True:
        link, before = "", 0
        for part in parts:
            m = re.compile(part, re.I).search(body, at)
            if m is None:
                return
            link, title, at = (m[1] if m.re.groups else link), body[before : m.start()], m.end()
            before = at
        yield link, title


def _results(body: str, engine: str) -> list[dict]:
    name, _, patterns, redirect, own = next(p for p in RESULT_PAGES if p[1] in engine)
    found: dict[str, str] = {}
    for pattern in patterns:
        for href, inner in _in_parts(body, pattern):
            url = _target(html.unescape(href), name, redirect)
            if url is None or own and (not url.lower().startswith("http") or own in (urlsplit(url).hostname or "")):
                continue
            found.setdefault(url, " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inner)).split()))
    return [{"url": u, "title": t} for u, t in found.items()]


def search_results(body: Column, url: Column) -> Column:
    """array<struct<url, title>> of a result page, in order of patterns and page; the engine is told by the page's host.

    Redirects are unwrapped, the engine's own links and repeats go. A null body gives none; so does a page whose address has no host.
    """

    @F.pandas_udf("array<struct<url:string,title:string>>")
    def run(bodies: pd.Series, engines: pd.Series) -> pd.Series:
        return pd.Series([_results(b, e) if b and e else [] for b, e in zip(bodies, engines)])

    return run(body, host(url))


def search_response(status: Column, cache_hit: Column, failed: Column, body: Column, page_candidates: Column) -> Column:
    """struct(parse_status, candidate_urls): a live 2xx answer's JSON ``candidates`` (texts or objects with a url), else the links of its page."""
    live = F.coalesce(status.between(200, 299) & ~cache_hit.eqNullSafe(F.lit(True)) & failed.isNull(), F.lit(False))
    text = F.coalesce(body, F.lit(""))

    @F.pandas_udf("array<string>")
    def listed(s: pd.Series) -> pd.Series:
        def one(raw):
            try:
                rows = json.loads(raw or "").get("candidates")
            except (ValueError, AttributeError):
                return None
            urls = [r.get("url") if isinstance(r, dict) else r for r in rows] if isinstance(rows, list) else None
            return urls if urls is None else [u for u in urls if isinstance(u, str) and u]

        return s.map(one)

    found = listed(F.when(live & F.startswith(F.ltrim(text), F.lit("{")), text))
    parsed = live & (found.isNotNull() | (F.length(text) > 0))
    none = F.array().cast("array<string>")
    return F.struct(F.when(parsed, "parsed").otherwise("not_parsed").alias("parse_status"), F.when(live, F.coalesce(found, page_candidates, none)).otherwise(none).alias("candidate_urls"))


def product_response(status: Column, cache_hit: Column, failed: Column, title: Column, body: Column, final_url: Column) -> Column:
    """struct(parse_status, page_kind, title, strength_mg_per_pouch, mg_per_g, net_weight_g, pouch_count) of an answer's text.

    A strength counts only where the text names the pouch, and a decimal comma is a point (the reference takes any ``N mg``, ``20 mg/g`` too, and drops commas).
    """
    live = F.coalesce(status.between(200, 299) & ~cache_hit.eqNullSafe(F.lit(True)) & failed.isNull(), F.lit(False))
    text = F.coalesce(body, F.lit(""))
    number = lambda *patterns: F.when(live, first_number(text, list(patterns)))
    strength, per_g = number(r"(?i)\b(\d+(?:[.,]\d+)?)\s*mg\s*(?:per\s*pouch|/\s*pouch)\b"), number(r"(?i)\b(\d+(?:[.,]\d+)?)\s*mg\s*/\s*g\b")
    detail = F.concat_ws(" ", final_url, text).rlike(r"(?i)/products?\b|add\s+to\s+(?:cart|basket)|product\s+details")
    name = F.when(live & (F.coalesce(title, F.lit("")) != ""), title)
    return F.struct(
        F.when(name.isNotNull() | strength.isNotNull() | per_g.isNotNull(), "parsed").otherwise("not_parsed").alias("parse_status"),
        F.when(live & detail, "product_detail").otherwise("unknown").alias("page_kind"),
        name.alias("title"),
        strength.alias("strength_mg_per_pouch"),
        per_g.alias("mg_per_g"),
        number(r"(?i)\b(?:net\s+weight|weight)\s*[:\-]?\s*(\d+(?:[.,]\d+)?)\s*g\b").alias("net_weight_g"),
        number(r"(?i)\b(\d+)\s*(?:pouches|pouch|bags)\b").alias("pouch_count"),
    )


def _meets(url: Column, rules: list[list[tuple[str, str]]]) -> Column:
    part = {"host": host(url), "path": F.lower(path(url)), "exact": path(url), "query": F.lower(F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1))}
    out = F.lit(False)
    for rule in rules:
        one = F.lit(True)
        for where, pattern in rule:
            one = one & part[where].rlike(pattern)
        out = out | one
    return out


def rejected_candidate(url: Column) -> Column:
    """The rule by which an address can be refused unopened, or null."""
    return (
        F.when(~is_http(url) | url.isNull(), "malformed_candidate_url")
        .when(_meets(url, SEARCH_RULES), "obvious_search_or_social_domain")
        .when(_meets(url, DOCUMENT_RULES), "non_product_document_or_forum")
    )


def invalid_candidate(url: Column) -> Column:
    """Why an address is no candidate at all, or null: malformed, not http(s), a search or social host, a document."""
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return (
        F.when(scheme == "", "malformed_candidate_url")
        .when(~scheme.isin("http", "https"), "non_http_url")
        .when(~is_http(url), "malformed_candidate_url")
        .when(host(url).rlike(r"search\.|google\.|bing\.|duckduckgo\.|facebook\.|instagram\.|youtube\."), "obvious_search_or_social_domain")
        .when(F.lower(path(url)).rlike(r"\.(pdf|docx?|xlsx?|zip)$|download|attachment|file"), "non_product_document_or_forum")
    )


def _words(text: Column, strengths: str, dropped: list[str], numbers: bool = True) -> Column:
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), strengths, " ")
    out = tokens(squeeze(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")))
    return F.filter(out, lambda w: ~w.isin(dropped) & (F.lit(numbers) | ~w.rlike(r"^\d+(?:[.,]\d+)?$")))


def core_tokens(text: Column) -> Column:
    """Words of a name or title without strengths and shop words; numbers stay."""
    return _words(unicode_form(F.coalesce(text, F.lit(""))), r"\b\d+(?:[.,]\d+)?\s*mg\b", CORE_WORDS)


def discovery_tokens(text: Column) -> Column:
    """Words of a name without strengths, search words and numbers."""
    return _words(text, r"(\d+(?:[.,]\d+)?)\s*mg\b", SEARCH_WORDS, numbers=False)


def brand_words(brand: Column) -> Column:
    return F.filter(F.array_distinct(tokens(normalize_candidate(brand))), lambda w: ~w.isin(PATH_WORDS))


def name_words(brand: Column, name: Column) -> Column:
    """Words of the name that the path must show: not the brand's, no numbers."""
    own = brand_words(brand)
    return F.filter(F.array_except(F.array_distinct(tokens(normalize_candidate(name))), own), lambda w: ~w.isin(PATH_WORDS) & ~w.rlike(r"(?i)^\d+(?:[.,]\d+)?(?:mg|g)?$"))


def path_score(brand_needed: Column, name_needed: Column, branch: Column, path_words: Column) -> Column:
    """Share of the name's words in a path: 0 unless an owner's page or all brand words are there; 0.5 where the name has none."""
    hits = F.size(F.array_intersect(name_needed, path_words)) / F.size(name_needed)
    return F.when(~F.coalesce(branch.isin(OWNER_BRANCHES), F.lit(False)) & (F.size(F.array_except(brand_needed, path_words)) > 0), 0.0).when(F.size(name_needed) == 0, 0.5).otherwise(hits)


def _meeting(rows: DataFrame, records: DataFrame, row: str, record: str, need: str, have: str, least: float, row_facts: list[str] | None = None, record_facts: list[str] | None = None, also: Column | None = None) -> DataFrame:
    """Distinct (row, record) that share one of the row's rarest words: every record with ``least`` of them does, as it lacks too few to miss all of these.

    ``also``: a condition on facts of both sides that drops pairs as soon as they meet.
    """
    frequency = records.select(F.explode(have).alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_df"))
    words = rows.select(row, F.size(need).alias("_n"), F.explode(need).alias("_w")).join(frequency, "_w")
    ranked = rows.select(row, F.size(need).alias("_n")).join(words.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("_df", "_w"))).alias("_all")), row)
    # words that no record has count as the rarest; a row that lacks too many of them meets none
    unknown = F.col("_n") - F.size("_all")
    room = F.col("_n") - F.ceil(F.lit(least) * F.col("_n") - 1e-9) + 1 - unknown
    rare = ranked.where(room > 0).select(row, F.explode(F.slice("_all", 1, room.cast("int"))).alias("_x")).select(row, F.col("_x._w").alias("_w"))
    if row_facts:
        rare = rare.join(rows.select(row, *row_facts), row)
    met = rare.join(records.select(record, *(record_facts or []), F.explode(have).alias("_w")).hint("merge"), "_w")
    return (met.where(also) if also is not None else met).select(row, record).distinct()


def detail_candidates(rows: DataFrame, records: DataFrame, row: str, record: str, k: int = 3, owner_least: float = 0.6, other_least: float = 0.9) -> DataFrame:
    """row, record, url, owner, score, rank: the best record of the k best owners by words of its path.

    ``rows``: row, b, n. ``records``: record, url, branch, source_owner. Scores reach ``owner_least`` on an owner's page and ``other_least`` elsewhere; ties go to the smaller url.
    A row without name words scores 0.5 everywhere and so has none.
    """
    a = rows.select(row, brand_words(F.col("b")).alias("_b"), name_words(F.col("b"), F.col("n")).alias("_n")).where(F.size("_n") > 0).withColumn("_a", evidence.set_name(F.col("_n")))
    b = records.where(is_likely_product(F.col("url"))).select(record, "url", "branch", F.coalesce("source_owner", F.col(record).cast("string")).alias("owner"), F.array_distinct(path_tokens(F.col("url"))).alias("_p"))
    b = b.withColumn("_s", evidence.set_name(F.col("_p"))).withColumn("_owned", F.coalesce(F.col("branch").isin(OWNER_BRANCHES), F.lit(False)))
    needs, haves = a.groupBy("_a").agg(F.any_value("_n").alias("_need")), b.groupBy("_s").agg(F.any_value("_p").alias("_have"))
    scored = folds.kept(evidence.set_scores(needs, haves, min(owner_least, other_least)), "scores")
    entry = F.struct((-F.col("score")).alias("s"), F.col("url"), F.col(record).alias("r")).alias("_e")
    # what an owner's pages score does not depend on the brand, so the best of each owner is one for all rows of a set
    owned = scored.where(F.col("score") >= owner_least).join(b.where("_owned"), "_s").groupBy("_a", "owner").agg(F.min(entry).alias("_e"))
    others = scored.where(F.col("score") >= other_least).join(b.where("not _owned"), "_s").join(a.select(row, "_a", "_b"), "_a").where(F.size(F.array_except("_b", "_p")) == 0)
    best = a.select(row, "_a").join(owned, "_a").select(row, "owner", "_e").unionByName(others.select(row, "owner", entry))
    return _ranked_owners(best.groupBy(row, "owner").agg(F.min("_e").alias("_b")), row, record, k)


def index_candidates(rows: DataFrame, records: DataFrame, row: str, record: str, k: int = 8, least: float = 0.7) -> DataFrame:
    """row, record, url, owner, score, rank: as ``detail_candidates`` over whole addresses of index records; the name's first word must be there, repeats of a word count."""
    a = rows.select(row, _words(F.col("n"), r"(\d+(?:[.,]\d+)?)\s*mg\b", SEARCH_WORDS).alias("_n")).where(F.size("_n") > 0)
    b = records.where("url is not null").select(record, "url", F.coalesce("source_owner", F.col(record).cast("string"), "url").alias("owner"), F.array_distinct(tokens(squeeze(F.regexp_replace(F.lower("url"), r"[^\p{L}\p{N}]+", " ")))).alias("_p"))
    met = a.select(row, "_n", F.element_at("_n", 1).alias("_w")).join(b.select(record, "url", "owner", "_p", F.explode("_p").alias("_w")), "_w")
    scored = met.withColumn("score", F.size(F.filter("_n", lambda w: F.array_contains(F.col("_p"), w))) / F.size("_n")).where(F.col("score") >= least)
    return _best_owners(scored, row, record, k)


def _best_owners(scored: DataFrame, row: str, record: str, k: int) -> DataFrame:
    return _ranked_owners(scored.groupBy(row, "owner").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("url"), F.col(record).alias("r"))).alias("_b")), row, record, k)


def _ranked_owners(best: DataFrame, row: str, record: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(row).orderBy("_b.s", "_b.url", "_b.r"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(row, F.col("_b.r").alias(record), F.col("_b.url").alias("url"), "owner", (-F.col("_b.s")).alias("score"), F.col("rank").cast("long").alias("rank"))


def exact_records(rows: DataFrame, records: DataFrame, row: str, record: str) -> DataFrame:
    """row, record of titles that name exactly the row's variant (``rows``: row, n, mg; ``records``: record, title, observed).

    A title has all of the row's words, so rows and titles meet on the row's rarest word alone; a row without words meets titles without words. Equal names and equal titles meet once and are dealt
    out to their rows and records afterwards. Neither rows nor records are ever broadcast, however small their files are.
    """
    rows = rows.where(F.col(row).isNotNull()).select(row, F.coalesce("n", F.lit("")).alias("n"), "mg").withColumn("_a", _keyed("mg", "n"))
    records = records.where(F.col(record).isNotNull() & F.col("title").isNotNull()).select(record, "title", "observed").withColumn("_b", _keyed("observed", "title"))
    a = rows.select("_a", "n", "mg").distinct().withColumn("_need", F.array_distinct(identity_tokens(F.col("n"))))
    b = records.select("_b", "title", "observed").distinct().withColumn("_have", F.array_distinct(identity_tokens(F.col("title"))))
    empty = F.array(F.lit(""))
    a = a.withColumn("_need", F.when(F.size("_need") == 0, empty).otherwise(F.col("_need")))
    b = b.withColumn("_have", F.concat("_have", empty))
    pairs = _meeting(a, b, "_a", "_b", "_need", "_have", 1.0).join(a.select("_a", "n", "mg").hint("merge"), "_a").join(b.select("_b", "title", "observed").hint("merge"), "_b")
    same = pairs.where(exact_variant(F.col("n"), F.col("mg"), F.col("title"), F.col("observed"))).select("_a", "_b")
    return records.select(record, "_b").hint("merge").join(same.join(rows.select(row, "_a").hint("merge"), "_a"), "_b").select(row, record)


def _keyed(number: str, text: str) -> Column:
    """A number, which may be null, and a text as one text."""
    return F.concat(F.coalesce(F.col(number).cast("string"), F.lit("")), F.lit("\u0000"), F.col(text))


def open_records(rows: DataFrame, records: DataFrame, row: str, record: str, kind: str = "structured_product_json") -> DataFrame:
    """``exact_records`` among records of one kind (``records`` also has url, evidence_kind) that can be opened."""
    return exact_records(rows, records.where((F.col("evidence_kind") == kind) & F.col("url").isNotNull()), row, record)


def sitemap_entries(df: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, url, lastmod of a sitemap's entries, each read from its own ``url`` block, so an entry without lastmod shifts no other; indexes give none."""
    inside = lambda tag: F.regexp_extract("_block", rf"(?is)<{tag}\b[^>]*>\s*([^<]+?)\s*</{tag}>", 1)
    blocks = df.where(~F.col(body).rlike("(?i)<sitemapindex")).select(key, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<url\b[^>]*>.*?</url>"), F.lit(0))).alias("pos", "_block"))
    return blocks.select(key, "pos", inside("loc").alias("url"), F.nullif(inside("lastmod"), F.lit("")).alias("lastmod")).where("url <> ''")


def regulator_products(df: DataFrame, key: str, cell: str) -> DataFrame:
    """key, title, brand, observed_mg_per_pouch of a regulator's table cells (decoded texts) that name a listed brand and a strength."""
    t = squeeze(F.col(cell))
    brand = F.when(t.rlike("(?i)^on!"), "on!").when(t.rlike(r"(?i)^zyn\b"), "ZYN")
    short = squeeze(F.regexp_replace(t, r"(?i)\s+nicotine\s+pouch(es)?\s*", " "))
    order = r"(?i)^(on!)\s+(PLUS\s+)?(\d+(?:[.,]\d+)?)\s+(.+)$"
    group = lambda i: F.regexp_extract("_t", order, i)
    rows = df.select(key, brand.alias("brand"), first_number(t, [r"(?i)(\d+(?:[.,]\d+)?)\s*mg\b"]).alias("observed_mg_per_pouch"), short.alias("_t")).where("brand is not null and observed_mg_per_pouch is not null")
    moved = squeeze(F.concat_ws(" ", group(1), group(2), group(4), group(3), F.lit("mg")))
    return rows.select(key, F.when(F.col("_t").rlike(order), moved).otherwise(F.col("_t")).alias("title"), "brand", "observed_mg_per_pouch")
