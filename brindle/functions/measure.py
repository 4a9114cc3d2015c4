"""Measurements: strengths from direct values or from concentration, weight and count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def per_unit(direct: Column, per_gram: Column, grams: Column, count: Column) -> Column:
    """The direct value, else per_gram * grams / count where all are finite and the count positive."""
    ok = finite(per_gram) & finite(grams) & finite(count) & (count > 0)
    return F.coalesce(F.when(finite(direct), direct), F.when(ok, per_gram * grams / count))


def strength_of_claims(claims: Column, grams: Column, count: Column) -> Column:
    """struct(value, calculation) from claims (value, basis): a per_pouch claim wins; per_g needs weight and a whole count."""
    first = lambda basis: F.element_at(F.filter(claims, lambda c: (c["basis"] == basis) & finite(c["value"])), 1)["value"]
    has = lambda basis: F.exists(claims, lambda c: (c["basis"] == basis) & finite(c["value"]))
    whole = finite(count) & (count == F.floor(count)) & (count > 0) & finite(grams) & (grams > 0)
    direct = F.when(has("per_pouch"), first("per_pouch"))
    derived = F.when(has("per_g") & whole, first("per_g") * grams / count)
    tag = F.when(direct.isNotNull(), "direct_mg_per_pouch").when(derived.isNotNull(), "mg_per_g_x_net_weight_div_pouches")
    return F.struct(F.coalesce(direct, derived).alias("value"), tag.alias("calculation"))
