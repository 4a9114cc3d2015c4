"""Composite matching predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brindle.functions.measure import EPSILON, finite
from brindle.functions.text import DESCRIPTOR_WORDS, canonical_brand, explicit_strengths, identity_tokens, let, product_core


def _count(words: Column, word: Column) -> Column:
    return F.size(F.filter(words, lambda w: w == word))


def exact_variant(name: Column, mg: Column, title: Column, observed: Column) -> Column:
    """Equal token multisets but for descriptor words in the title, and strengths that agree."""
    mine, theirs = explicit_strengths(name), explicit_strengths(title)
    covers = lambda v: F.forall(v["need"], lambda w: _count(v["have"], w) >= _count(v["need"], w)) & F.forall(v["have"], lambda w: (_count(v["have"], w) <= _count(v["need"], w)) | w.isin(DESCRIPTOR_WORDS))
    same = let(covers, need=identity_tokens(name), have=identity_tokens(title, F.size(mine) > 0))
    near = lambda a, b: F.abs(a - b) < EPSILON
    share = F.exists(mine, lambda a: F.exists(theirs, lambda b: near(a, b)))
    bad_title = (F.size(mine) > 0) & (F.size(theirs) > 0) & ~share
    bad_row = (F.size(mine) == 0) & (F.size(theirs) > 0) & finite(observed) & (F.abs(observed - mg) > EPSILON)
    bad_observed = (F.size(mine) > 0) & finite(observed) & ~F.exists(mine, lambda a: near(a, observed))
    return same & ~F.coalesce(bad_title, F.lit(False)) & ~F.coalesce(bad_row, F.lit(False)) & ~F.coalesce(bad_observed, F.lit(False))


def compare_identity(brand: Column, name: Column, seen_brand: Column, seen_name: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """struct(identity_match, missing, extra): exact, near (nothing missing) or wrong."""
    want_brand, got_brand = canonical_brand(brand, aliases), F.when(F.coalesce(seen_brand, F.lit("")) != "", canonical_brand(seen_brand, aliases))
    want, got = product_core(name, want_brand, aliases), product_core(seen_name, F.coalesce(got_brand, want_brand), aliases)
    missing, extra = F.array_except(want, got), F.array_except(got, want)
    same = F.coalesce(got_brand == want_brand, F.lit(False))
    kind = F.when(same & (F.size(missing) == 0) & (F.size(extra) == 0), "exact").when(F.size(missing) == 0, "near").otherwise("wrong")
    return F.struct(kind.alias("identity_match"), missing.alias("missing"), extra.alias("extra"))


def all_present(needed: Column, have: Column) -> Column:
    """At least one token is needed and none is missing."""
    return (F.size(needed) > 0) & (F.size(F.array_except(needed, have)) == 0)


def all_substrings(words: Column, body: Column) -> Column:
    """Every word longer than two characters occurs in the body."""
    return F.forall(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.contains(F.lower(body), w))
