"""Row validators: an errors column (array of field, code) and ok. Nothing throws on user data."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.measure import finite

#: Formats.
ID_FORMAT = "^[A-Za-z0-9_-]{1,128}$"
DAY_FORMAT = r"^\d{4}-\d{2}-\d{2}$"
EMAIL_FORMAT = r"(?i)^[a-z0-9._%+-]+@(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}$"
HASH_FORMAT = "^[a-f0-9]{64}$"
NUMBER_FORMAT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """A text as a double where it is a plain number; empty is 0, as the form's own coercion has it."""
    return F.when(F.trim(text) == "", F.lit(0.0)).when(text.rlike(NUMBER_FORMAT), F.trim(text).try_cast("double"))


def check(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Adds errors and ok; a rule (field, code, condition) whose condition is false or null is an error."""
    found = [F.when(~F.coalesce(c, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(code).alias("code"))) for f, code, c in rules]
    return df.withColumn("errors", F.array_compact(F.array(*found))).withColumn("ok", F.size("errors") == 0)


def error_text(errors: Column) -> Column:
    """Errors as one sorted text."""
    return F.array_join(F.array_sort(F.transform(errors, lambda e: F.concat_ws(":", e["field"], e["code"]))), "|")


def whole(x: Column) -> Column:
    return finite(x) & (x == F.floor(x))


def settings_rules(today: Column) -> list[tuple[str, str, Column]]:
    """Columns: currency, pack_price, per_pack, daily_limit (doubles), goal, strategy, target_date (texts)."""
    c = F.col
    quit_ = c("goal") == "quit"
    return [
        ("currency", "invalid_currency", F.length(F.trim("currency")).between(1, 8)),
        ("packPrice", "invalid_price", finite(c("pack_price")) & (c("pack_price") > 0)),
        ("pouchesPerPack", "invalid_pouch_count", whole(c("per_pack")) & c("per_pack").between(1, 1000)),
        ("dailyLimit", "invalid_daily_limit", whole(c("daily_limit")) & (c("daily_limit") >= 0)),
        ("goal", "invalid_goal", c("goal").isin("quit", "track")),
        ("strategy", "invalid_strategy", ~F.coalesce(quit_, F.lit(False)) | c("strategy").isin("smooth", "weekly", "cutoff")),
        ("targetDate", "invalid_target_date", ~F.coalesce(quit_, F.lit(False)) | (c("target_date").rlike(DAY_FORMAT) & (c("target_date") >= today.cast("string")))),
    ]


def entry_rules(today: Column) -> list[tuple[str, str, Column]]:
    """Columns: id, brand, name (texts), mg (double), date (timestamp or text)."""
    c = F.col
    return [
        ("id", "invalid_id", c("id").rlike(ID_FORMAT)),
        ("brand", "invalid_brand", F.length(F.trim("brand")).between(1, 120)),
        ("name", "invalid_name", F.length(F.trim("name")).between(1, 120)),
        ("mg", "invalid_strength", finite(c("mg")) & c("mg").between(0, 1000)),
        ("date", "invalid_date", F.to_date(c("date").try_cast("timestamp")) <= today.cast("date")),
    ]


def atomic(df: DataFrame, document: str) -> DataFrame:
    """Rows of documents all of whose rows are ok: one bad row rejects its document."""
    good = df.groupBy(document).agg(F.bool_and("ok").alias("_all")).where("_all").select(document)
    return df.join(good, document, "left_semi")


def contact_verdict(now_ms: Column, topics: list[str], least_ms: int = 2_000, most_ms: int = 7_200_000) -> Column:
    """First failing rule of a contact form (name, email, topic, message, website, opened_ms), or null."""
    name, email, message = F.trim("name"), F.lower(F.trim("email")), F.trim("message")
    good = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(F.length(F.coalesce(name, F.lit(""))) > 80, "name")
        .when(~good(F.length(email).between(1, 254) & email.rlike(EMAIL_FORMAT)), "email")
        .when(~good(F.col("topic").isin(topics)), "topic")
        .when(~good(F.length(message).between(10, 3000)), "message")
        .when(F.col("website").isNull(), "data")
        .when(F.col("opened_ms").isNull(), "reopen")
        .when(~(now_ms - F.col("opened_ms")).between(least_ms, most_ms), "reopen")
    )


def is_hash(text: Column) -> Column:
    return F.coalesce(text.rlike(HASH_FORMAT), F.lit(False))


def json_or(text: Column, fallback: str) -> Column:
    """A text parsed as a variant; null, empty and malformed give the fallback."""
    return F.coalesce(F.try_parse_json(F.when(text != "", text)), F.parse_json(F.lit(fallback)))


def _keys_of(value):
    if isinstance(value, list):
        for v in value:
            yield from _keys_of(v)
    elif isinstance(value, dict):
        for k, v in value.items():
            yield re.sub("[^a-zA-Z0-9]", "", k).lower()
            yield from _keys_of(v)


def forbidden_keys(text: Column, names: list[str]) -> Column:
    """Does a JSON text use one of the names as a key, folded to letters and digits, at any depth? Texts inside values do not count; null and malformed texts have no keys.

    Only texts in which a name occurs at all, letters and digits taken together, are parsed, Arrow-batched.
    """
    wanted = frozenset(names)

    @F.pandas_udf("boolean")
    def run(s: pd.Series) -> pd.Series:
        def one(raw):
            try:
                return raw is not None and any(k in wanted for k in _keys_of(json.loads(raw)))
            except ValueError:
                return False

        return s.map(one)

    letters = F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", ""))
    maybe = F.coalesce(letters.rlike("|".join(names)), F.lit(False)) if names else F.lit(False)
    escaped = F.coalesce(F.contains(text, F.lit("\\u")), F.lit(False))
    return F.coalesce(run(F.when(maybe | escaped, text)), F.lit(False))
