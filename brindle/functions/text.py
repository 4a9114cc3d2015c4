"""Text functions: normalisers, tokens, CSV fields, number extraction. All are Column to Column."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that wrap a product title without naming it.
WRAPPER_WORDS = ["buy", "online", "nicotine", "pouch", "pouches", "per", "the", "product", "products", "can", "cans", "piece", "pieces"]
#: Shop words in titles.
MARKETING_WORDS = ["buy", "from", "online", "order", "save", "shipping", "delivery", "next", "day", "fast", "stock", "now", "shop", "today"]
#: Words a title may have beyond the name.
DESCRIPTOR_WORDS = ["medium", "low", "normal", "regular"]


def unicode_form(text: Column, form: str = "NFKC") -> Column:
    """Unicode normal form. ASCII texts never leave the JVM: only the others are sent, Arrow-batched, to Python's tables."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None else unicodedata.normalize(form, x))

    return F.coalesce(run(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def _folding() -> tuple[str, str]:
    """Characters whose compatibility decomposition, without marks, is one ASCII character, and those characters."""
    found = {}
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0), *range(0x2460, 0x24FF), *range(0xFF01, 0xFF5F)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            found[chr(code)] = base
    return "".join(found), "".join(found.values())


def ascii_fold(text: Column) -> Column:
    """Accents off and wide forms narrow, on the JVM; characters that decompose into several stay."""
    return F.translate(F.regexp_replace(text, "[\u0300-\u036f]", ""), *_folding())


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_candidate(text: Column, compose: bool = True) -> Column:
    """NFKC, lower case, ``3mg`` as ``3 mg``, punctuation and symbols as spaces. Without ``compose`` texts that are known to be in that form are spared the check."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    t = F.lower(unicode_form(t) if compose else t)
    t = F.regexp_replace(t, r"(\d)\s*(mg|g)\b", "$1 $2")
    return squeeze(F.regexp_replace(t, r"[\p{P}\p{S}]+", " "))


def tokens(text: Column) -> Column:
    """Space-separated tokens without empty ones."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def identity_tokens(text: Column, drop_bare_strength: Column | bool = False) -> Column:
    """Tokens that identify a variant: strengths in mg go, and bare numbers but the first token if asked."""
    drop = F.lit(drop_bare_strength) if isinstance(drop_bare_strength, bool) else drop_bare_strength
    t = F.lower(unicode_form(F.coalesce(text, F.lit(""))))
    for pattern, to in (  # fixed values: patterns whose results must match
        (r"#\s*(\d+(?:[.,]\d+)?)", "hash$1"),
        (r"\bblackcurrant\b", "black currant"),
        (r"(\d+(?:[.,]\d+)?)\s*mg\b", "$1mg"),
        (r"[^\p{L}\p{N}.,]+", " "),
        (r"(?<!\d)[.,]|[.,](?!\d)", " "),
    ):
        t = F.regexp_replace(t, pattern, to)
    words = F.filter(tokens(squeeze(t)), lambda w: ~w.isin(WRAPPER_WORDS))
    words = F.transform(words, lambda w: F.when(w.rlike(r"^\d+\.0+$"), F.regexp_replace(w, r"\.0+$", "")).otherwise(w))
    return F.filter(words, lambda w, i: ~w.rlike(r"^\d+(?:[.,]\d+)?mg$") & ~(drop & (i > 0) & w.rlike(r"^\d+(?:[.,]\d+)?$")))


def explicit_strengths(text: Column) -> Column:
    """All ``N mg`` values of a text; a decimal comma is a point."""
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\d+(?:[.,]\d+)?)\s*mg\b"), F.lit(1)), lambda v: F.replace(v, F.lit(","), F.lit(".")).try_cast("double"))


def identity_text(text: Column) -> Column:
    """Entities decoded, accents and strengths off, ASCII words only."""
    t = F.lower(ascii_fold(decode_html(text, strip_tags=False)))
    t = F.regexp_replace(t, r"\b\d+(?:[.,]\d+)?\s*mg(?:\s*/\s*(?:g|pouch))?\b", " ")
    return squeeze(F.regexp_replace(t, "[^a-z0-9]+", " "))


def canonical_brand(text: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """The normalised brand, or the key whose aliases have it; null when nothing is left."""
    t = identity_text(text)
    out = F.when(t == "", F.lit(None)).otherwise(t)
    for key, names in (aliases or {}).items():
        out = F.when(t.isin(names), F.lit(key)).otherwise(out)
    return out


def product_core(name: Column, brand: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """Tokens of a name behind its brand (longest alias first), without shop words and numbers."""
    t = identity_text(name)
    known = F.array(brand)
    for key, names in (aliases or {}).items():
        known = F.when(brand == key, F.array(*[F.lit(n) for n in sorted(names, key=len, reverse=True)])).otherwise(known)
    hit = F.element_at(F.filter(known, lambda a: a.isNotNull() & (a != "") & ((t == a) | F.startswith(t, F.concat(a, F.lit(" "))))), 1)
    rest = F.when(F.size(F.filter(known, lambda a: (t == a) | F.startswith(t, F.concat(a, F.lit(" "))))) > 0, F.substr(t, F.length(hit) + 1)).otherwise(t)
    return F.filter(tokens(rest), lambda w: ~w.isin(MARKETING_WORDS) & ~w.rlike(r"^\d+$"))


def material_key(text: Column) -> Column:
    """Distinct sorted words of a query without paging words: equal keys ask for the same."""
    t = F.lower(unicode_form(F.coalesce(text, F.lit(""))))
    t = F.regexp_replace(t, r"\b(?:(?:exact\s+)?continuation|page)\s*\d+\b", " ")
    return F.array_join(F.array_sort(F.array_distinct(tokens(squeeze(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))))), " ")


def let(body, **values: Column) -> Column:
    """``body`` of a struct of values: each value is computed once, outside the body, whose lambdas may use it whatever it is made of."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 0)


def overlap_ratio(needed: Column, have: Column) -> Column:
    """Share of ``needed`` (repeats count) that ``have`` has; 0 when nothing is needed."""
    share = lambda v: F.when(F.size(v["need"]) > 0, F.size(F.filter(v["need"], lambda t: F.array_contains(v["have"], t))) / F.size(v["need"])).otherwise(F.lit(0.0))
    return let(share, need=needed, have=have)


def neutral_formula(text: Column) -> Column:
    """A text that a spreadsheet would run gets an apostrophe."""
    return F.when(text.rlike(r"^[\t\r ]*[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def csv_quote(text: Column) -> Column:
    """Always quoted, neutralised; null is empty."""
    return F.concat(F.lit('"'), F.replace(neutral_formula(F.coalesce(text, F.lit(""))), F.lit('"'), F.lit('""')), F.lit('"'))


def csv_field(text: Column) -> Column:
    """Quoted only where needed; null is empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(t.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


def decode_html(text: Column, strip_tags: bool = True) -> Column:
    """Five named entities decoded, tags off, white space squeezed."""
    t = F.coalesce(text, F.lit(""))
    if strip_tags:
        t = F.regexp_replace(t, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return squeeze(t)


def first_number(text: Column, patterns: list[str]) -> Column:
    """The first pattern's first group that is a number; a decimal comma is a point."""
    return F.coalesce(*[F.replace(F.regexp_extract(text, p, 1), F.lit(","), F.lit(".")).try_cast("double") for p in patterns])


def field_name(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))


def product_type(brand: Column, name: Column) -> Column:
    t = F.lower(F.concat_ws(" ", brand, name))
    return (
        F.when(t.rlike(r"\b(?:nicotine[- ]?free|no nicotine|zero nicotine|bez nikotinu)\b"), "non-nicotine")
        .when(t.rlike(r"(?:^|\s)(?:caffeine|caffeinated|kofein(?:ový|ové|ove)?)(?=\s|$)"), "caffeine_or_mixed")
        .otherwise("nicotine_or_unknown")
    )


def search_queries(brand: Column, name: Column, suffixes: list[str]) -> Column:
    """One query a suffix, distinct and squeezed."""
    return F.array_distinct(F.array(*[squeeze(F.concat_ws(" ", brand, name, F.lit(s))) for s in suffixes]))
