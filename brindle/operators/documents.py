"""Documents to rows: links, sitemaps, robots, product JSON, structured data, facts."""

from __future__ import annotations

import base64
import json
from urllib.parse import parse_qs, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.text import decode_html, first_number
from brindle.functions.urls import host
from brindle.session import shared_folder

LINK = r'(?i)<a\s[^>]*?href="([^"]*)"'


def links(df: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, href of every anchor in order."""
    return df.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(LINK), F.lit(1))).alias("pos", "href"))


def title(body: Column) -> Column:
    """The page title, decoded, up to the first bar; null when there is none."""
    t = decode_html(F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1))
    t = F.split_part(t, F.lit(" | "), F.lit(1))
    return F.when(t != "", t)


def meta_content(body: Column, name: str) -> Column:
    """Content of a meta tag, attributes in either order."""
    one = F.regexp_extract(body, rf'(?i)<meta[^>]*(?:name|property)="{name}"[^>]*content="([^"]*)"', 1)
    two = F.regexp_extract(body, rf'(?i)<meta[^>]*content="([^"]*)"[^>]*(?:name|property)="{name}"', 1)
    t = decode_html(F.when(one != "", one).otherwise(two))
    return F.when(t != "", t)


def sitemap(df: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, url, is_index: locations of a sitemap or of a sitemap index."""
    return df.select(key, F.col(body).rlike("(?i)<sitemapindex").alias("is_index"), F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<loc[^>]*>\s*(.*?)\s*</loc>"), F.lit(1))).alias("pos", "url")).withColumn("url", decode_html(F.col("url"), False))


def crawl(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Page URLs reachable from seed sitemaps through indexes of any depth; breadth first over a table of pages (url, body), each round a join, checkpointed."""
    shared_folder(pages.sparkSession)
    seen, front, found = seeds.select("url").distinct(), seeds.select("url").distinct(), None
    while True:
        rows = sitemap(front.join(pages, "url").withColumnRenamed("url", "page"), "page", "body").select(F.col("url").alias("loc"), "is_index")
        leaf = rows.where("not is_index").select(F.col("loc").alias("url"))
        found = leaf if found is None else found.unionAll(leaf)
        front = rows.where("is_index").select(F.col("loc").alias("url")).distinct().join(seen, "url", "left_anti").checkpoint()
        if front.isEmpty():
            break
        seen = seen.unionAll(front)
    return found.distinct()


def robots(text: Column) -> Column:
    """Rule groups of a robots file that name every agent (*). Agent lines that follow one another share a group, as the robots standard has it."""

    @F.pandas_udf("array<struct<disallow:array<string>,allow:array<string>,crawl_delay:double>>")
    def run(s: pd.Series) -> pd.Series:
        def one(body):
            groups, agents, fresh = [], [], False
            for line in (body or "").splitlines():
                field, _, value = line.split("#")[0].partition(":")
                field, value = field.strip().lower(), value.strip()
                if field == "user-agent":
                    agents = agents if fresh else []
                    agents.append(value)
                    if not fresh:
                        groups.append((agents, {"disallow": [], "allow": [], "crawl_delay": None}))
                    fresh = True
                elif groups and field in ("disallow", "allow", "crawl-delay"):
                    fresh = False
                    if field == "crawl-delay":
                        groups[-1][1]["crawl_delay"] = float(value) if value.replace(".", "", 1).isdigit() else None
                    elif value:
                        groups[-1][1][field].append(value)
            return [g for names, g in groups if "*" in names]

        return s.map(one)

    return run(text)


def shop_products(df: DataFrame, key: str, body: str) -> DataFrame:
    """One row for each product and variant of a shop's JSON; a product without variants gives one row."""
    shape = "products array<struct<title string, vendor string, handle string, variants array<struct<title string, sku string, price string, available boolean>>>>"
    rows = df.select(key, F.from_json(body, f"struct<{shape}>".replace("products ", "products:", 1)).alias("j")).select(key, F.explode("j.products").alias("p"))
    rows = rows.select(key, "p", F.explode_outer("p.variants").alias("v"))
    return rows.select(key, F.col("p.title").alias("title"), F.col("p.vendor").alias("vendor"), F.col("p.handle").alias("handle"), F.col("v.title").alias("variant"), F.col("v.sku").alias("sku"), F.col("v.price").try_cast("double").alias("price"), F.col("v.available").alias("available"))


def resolve(base: Column, href: Column) -> Column:
    """A link relative to its page, absolute."""

    @F.pandas_udf("string")
    def run(b: pd.Series, h: pd.Series) -> pd.Series:
        def one(x, y):
            try:
                return None if x is None or y is None else urljoin(x, y)
            except ValueError:
                return None

        return pd.Series([one(x, y) for x, y in zip(b, h)])

    return run(base, href)


def own_links(df: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """key, href, label of same-host anchors, the last label of a link wins."""
    rows = df.select(key, url, F.posexplode(F.regexp_extract_all(body, F.lit(r'(?is)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>'), F.lit(0))).alias("pos", "a"))
    rows = rows.select(key, url, "pos", resolve(F.col(url), F.regexp_extract("a", r'(?is)href="([^"]*)"', 1)).alias("href"), decode_html(F.col("a")).alias("label"))
    rows = rows.where(host(F.col("href")) == host(F.col(url)))
    return rows.groupBy(key, "href").agg(F.max_by("label", "pos").alias("label"))


def unwrap(url: Column) -> Column:
    """The target behind a search engine's redirect (uddg, u=a1<base64>, url or q), else the URL."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(u):
            try:
                q = parse_qs(urlsplit(u or "").query)
                for name in ("uddg", "url", "q"):
                    if q.get(name, [""])[0].startswith("http"):
                        return q[name][0]
                packed = q.get("u", [""])[0]
                if packed.startswith("a1"):
                    return base64.urlsafe_b64decode(packed[2:] + "=" * (-len(packed[2:]) % 4)).decode()
            except ValueError:
                pass
            return u

        return s.map(one)

    return run(url)


def external_candidates(body: Column, own_hosts: list[str]) -> Column:
    """Distinct http(s) links of a page to hosts outside a list."""
    found = F.regexp_extract_all(body, F.lit(r'(?i)href="(https?://[^"]+)"'), F.lit(1))
    return F.array_distinct(F.filter(found, lambda u: ~F.exists(F.array(*[F.lit(h) for h in own_hosts]), lambda h: F.endswith(host(u), h))))


def _walk(value):
    if isinstance(value, list):
        for v in value:
            yield from _walk(v)
    elif isinstance(value, dict):
        yield value
        for v in value.values():
            yield from _walk(v)


PRODUCT = "array<struct<name:string,brand:string,sku:string,gtin:string,price:double,available:boolean,claims:array<struct<basis:string,value:double,unit:string,label:string>>>>"


def json_ld_products(body: Column) -> Column:
    """Product nodes at any depth of a page's JSON-LD; malformed blocks are passed over. Strength claims come from additionalProperty."""

    @F.pandas_udf(PRODUCT)
    def run(s: pd.Series) -> pd.Series:
        import re

        block = re.compile(r'<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', re.I | re.S)
        num = re.compile(r"(\d+(?:[.,]\d+)?)")

        def text(v):
            return v.get("name") if isinstance(v, dict) else v if isinstance(v, str) else None

        def product(n):
            offers = n.get("offers")
            offer = next((o for o in _walk(offers) if "price" in o), {}) if offers else {}
            claims = []
            for p in n.get("additionalProperty") or []:
                if isinstance(p, dict):
                    label, value = str(p.get("name", "")), num.search(str(p.get("value", "")))
                    whole = f"{label} {p.get('value', '')} {p.get('unitText', '')}".lower()
                    if value and "mg" in whole:
                        claims.append({"basis": "per_g" if "/g" in whole.replace(" ", "") else "per_pouch", "value": float(value[1].replace(",", ".")), "unit": "mg", "label": label})
            try:
                price = float(str(offer.get("price")).replace(",", "."))
            except ValueError:
                price = None
            stock = str(offer.get("availability", "")).rsplit("/", 1)[-1].lower()
            return {"name": text(n.get("name")), "brand": text(n.get("brand")), "sku": n.get("sku"), "gtin": n.get("gtin13") or n.get("gtin"), "price": price, "available": None if not stock else stock == "instock", "claims": claims}

        def one(page):
            out = []
            for raw in block.findall(page or ""):
                try:
                    doc = json.loads(raw)
                except ValueError:
                    continue
                for n in _walk(doc):
                    kinds = n.get("@type")
                    if any(str(k).lower() == "product" for k in (kinds if isinstance(kinds, list) else [kinds])):
                        out.append(product(n))
            return out

        return s.map(one)

    return run(body)


def product_facts(df: DataFrame, key: str, body: str) -> DataFrame:
    """One wide row a page: structured data first, visible text as the fallback."""
    step = df.select(key, F.col(body), F.get(json_ld_products(F.col(body)), 0).alias("p"), decode_html(F.col(body)).alias("t"))
    return step.select(
        key,
        F.coalesce("p.name", meta_content(F.col(body), "og:title"), title(F.col(body))).alias("title"),
        F.col("p.brand").alias("brand"),
        F.col("p.price").alias("price"),
        F.col("p.available").alias("available"),
        first_number(F.col("t"), [r"(?i)(\d+(?:[.,]\d+)?)\s*mg\s*(?:per|/)\s*(?:pouch|piece)", r"(?i)nicotine[^0-9]{0,20}(\d+(?:[.,]\d+)?)\s*mg(?!\s*/\s*g)"]).alias("mg_per_pouch"),
        first_number(F.col("t"), [r"(?i)(\d+(?:[.,]\d+)?)\s*mg\s*/\s*g\b"]).alias("mg_per_g"),
        first_number(F.col("t"), [r"(?i)(\d+)\s*(?:pouches|pieces|pcs)\b"]).alias("count"),
    )


def table_cells(df: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, cell: decoded table cells in order."""
    return df.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).alias("pos", "cell")).withColumn("cell", decode_html(F.col("cell")))


def reference_counts(df: DataFrame, key: str, body: str) -> DataFrame:
    """key, blocks, links of a reference page."""
    return df.select(key, F.regexp_count(body, F.lit(r"(?i)<(?:p|li|tr)[\s>]")).cast("long").alias("blocks"), F.regexp_count(body, F.lit(r"(?i)<a\s")).cast("long").alias("links"))


def restrictions(status: Column, body: Column) -> Column:
    """struct(captcha, geoblocked, age_gate) of a response; a null status or body shows nothing."""
    b = F.lower(F.coalesce(body, F.lit("")))
    #: Statuses and phrases that show a restriction.
    return F.struct(
        (b.rlike("captcha|verify you are human|unusual traffic") | F.coalesce(status.isin(403, 429), F.lit(False))).alias("captcha"),
        (b.rlike("not available in your country|geoblock|region restricted")).alias("geoblocked"),
        b.rlike("age verification|verify your age|over 18").alias("age_gate"),
    )
