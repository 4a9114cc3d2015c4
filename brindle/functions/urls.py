"""URL functions over built-in parsing and regular expressions; malformed URLs give null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.text import normalize_candidate, tokens

#: Parts of paths that are not product pages.
NON_PRODUCT_PATHS = r"/blog/|/article|/category|/tag|/mixpack/|/pages/|/collections/"


def host(url: Column) -> Column:
    """Lower-case host of an http(s) URL without port and user; null if there is none."""
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h == "", F.lit(None)).otherwise(h)


def path(url: Column) -> Column:
    p = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(p == "", F.lit("/")).otherwise(p)


def is_http(url: Column) -> Column:
    return host(url).isNotNull()


def url_key(url: Column) -> Column:
    """A canonical spelling: lower scheme and host, a path of at least /; user, port (but the scheme's own), query and fragment stay."""
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z]+)://", 1))
    part = lambda pattern: F.regexp_extract(url, pattern, 1)
    user, port = part(r"^[A-Za-z]+://([^/?#@]*@)"), part(r"^[A-Za-z]+://(?:[^/?#@]*@)?[^/?#:]+:0*(\d+)(?:[/?#]|$)")
    usual = F.when(scheme == "https", "443").otherwise("80")
    shown = F.when((port == "") | (port == usual), "").otherwise(F.concat(F.lit(":"), port))
    return F.when(is_http(url), F.concat(scheme, F.lit("://"), user, host(url), shown, path(url), part(r"^[^?#]*(\?[^#]*)"), part("(#.*)$")))


def path_tokens(url: Column) -> Column:
    return tokens(normalize_candidate(path(url)))


def is_likely_product(url: Column, banned: str = NON_PRODUCT_PATHS) -> Column:
    return is_http(url) & ~F.lower(path(url)).rlike(banned)


def rejection_rule(url: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Name of the first rule (name, part, pattern) that a URL meets; part is host, path or url. Null: none."""
    part = {"host": host(url), "path": F.lower(path(url)), "url": F.lower(url)}
    out = F.when(~is_http(url), F.lit("malformed_candidate_url"))
    for name, where, pattern in rules:
        out = out.when(part[where].rlike(pattern), F.lit(name))
    return out


def robots_allows(groups: Column, path_: Column) -> Column:
    """``groups``: array of structs with disallow and allow prefixes; blocked if a group's prefix hits and none of its allows does."""
    hit = lambda prefix: (prefix != "") & F.startswith(path_, prefix)
    return ~F.exists(groups, lambda g: F.exists(g["disallow"], hit) & ~F.exists(g["allow"], hit))


def cache_slug(url: Column) -> Column:
    return F.concat_ws("-", F.regexp_replace(F.coalesce(host(url), F.lit("none")), "[^a-z0-9]+", "-"), F.substring(F.sha2(url, 256), 1, 16))


def owner_join(df: DataFrame, url: str, registry: DataFrame) -> DataFrame:
    """Left join to a registry (ord, host, and facts) on the host or a dot suffix of it; the first registry row wins.

    Each host becomes its suffixes (a handful), so the join is an equality; the registry is a small dimension that
    Spark may broadcast by its own size check. Rows need no key: the result is folded before the join, on distinct hosts.
    """
    bare = F.regexp_replace(host(F.col(url)), r"^www\.", "")
    hosts = df.select(bare.alias("_host")).where("_host is not null").distinct()
    parts = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    facts = [c for c in registry.columns if c != "host"]
    found = hosts.select("_host", F.explode(suffixes).alias("host")).join(registry, "host").groupBy("_host").agg(F.min_by(F.struct(*facts), "ord").alias("_r"))
    return df.withColumn("_host", bare).join(found, "_host", "left").select(*df.columns, *[F.col(f"_r.{c}").alias(c) for c in facts if c != "ord"])
