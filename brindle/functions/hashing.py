"""Digests: row fingerprints, canonical JSON, keyed identifiers."""

from __future__ import annotations

import hashlib
import hmac
import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("string"), 256)


def plain_number(x: Column) -> Column:
    """A double as its shortest plain text: ``10``, ``10.4``. For magnitudes from 0.001 up to 10 million."""
    return F.regexp_replace(x.cast("double").cast("string"), r"\.0$", "")


def fingerprint(*parts: Column) -> Column:
    """SHA-256 over the parts with NUL between them; a null part is an empty one and keeps its place."""
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def row_id(index: Column, *parts: Column, prefix: str = "input", width: int = 4) -> Column:
    """``prefix-0001-<fingerprint>`` from a position that counts from 1; one of more than ``width`` digits keeps them all."""
    place = index.cast("string")
    return F.concat(F.lit(prefix + "-"), F.when(F.length(place) < width, F.lpad(place, width, "0")).otherwise(place), F.lit("-"), fingerprint(*parts))


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(value[k]) for k in sorted(value)}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("canonical JSON has no such number")
        return int(value) if value == int(value) else value
    return value


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys, no spaces and whole floats as integers; malformed or non-finite gives null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else json.dumps(_plain(json.loads(x)), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                return None

        return s.map(one)

    return run(text)


def keyed_identifier(secret: str, kind: str, value: Column) -> Column:
    """HMAC-SHA256 of kind, NUL and the trimmed, lowered value."""
    if not secret:
        raise ValueError("a secret is required")

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: hmac.new(secret.encode(), f"{kind}\0{('' if v is None else v).strip().lower()}".encode(), hashlib.sha256).hexdigest())

    return run(value)
