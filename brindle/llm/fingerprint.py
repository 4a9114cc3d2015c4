"""Document fingerprints by Order MinHash.

The k-mers of a text (8 bytes of UTF-8) are numbered by occurrence. For each of 64 hash functions
the two pairs (k-mer, number) with the smallest hashes are taken and put back in text order; the hash of
that tuple is one place of the signature. The share of equal places falls with edit distance:
unlike a set sketch it sees the order of what is shared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import CELL, GUARD, extended, in_order

K = 8
SKETCHES = 64
BLOCK = 2048

_A = np.random.default_rng(17).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ROWS = np.arange(SKETCHES)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _K1
    x ^= x >> np.uint64(29)
    x *= _K2
    x ^= x >> np.uint64(32)
    return x


def _occurrences(x: np.ndarray) -> np.ndarray | None:
    """For each place how often its k-mer came before; None if never."""
    n = len(x)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    order = (x >> bits << bits) | np.arange(n, dtype=np.uint64)
    order.sort()
    group = order >> bits
    same = group[1:] == group[:-1]
    if not same.any():
        return None
    first = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(n), 0))
    out = np.empty(n, np.uint64)
    out[(order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = (np.arange(n) - first).astype(np.uint64)
    return out


def signature(raw: bytes) -> np.ndarray:
    """64 places of 16 bits. An empty text has a signature of its own; a text shorter than a k-mer is one k-mer."""
    if not raw:
        return (_A >> np.uint64(40)).astype(np.uint16)
    v = np.frombuffer(raw.ljust(K, b"\0"), np.uint8).astype(np.uint64)
    two = v[:-1] | v[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    mers = four[:-4] | four[4:] << np.uint64(32)
    x = _mixed(mers)
    times = _occurrences(x)
    if times is not None:
        x = _mixed(x + times * _K3)
    values, places = [], []
    for s in range(0, len(x), BLOCK):
        m = x[None, s : s + BLOCK] * _A[:, None]
        for _ in range(min(2, m.shape[1])):
            i = m.argmin(1)
            values.append(m[_ROWS, i])
            places.append(i + s)
            m[_ROWS, i] = _FULL
    if len(values) > 2:
        v, p = np.stack(values, 1), np.stack(places, 1)
        i = np.argpartition(v, 1, 1)[:, :2]
        p = p[_ROWS[:, None], i]
    else:
        p = np.stack([places[0], places[-1]], 1)
    p.sort(1)
    return (_mixed(_mixed(mers[p[:, 0]]) + mers[p[:, 1]] * _K3) >> np.uint64(48)).astype(np.uint16)


def text_form(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def from_text(form: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(form), ">u2").astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def add_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each whole text (null: empty). One pass, no shuffle."""
    keep = [c for c in df.columns if c != out]
    base = df.select(*keep)
    at = keep.index(text)

    def run(batches):
        for b in batches:
            forms = [text_form(signature((t.as_py() or "").encode())) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string())], [*keep, out])

    return base.mapInArrow(run, extended(base, **{out: "string"}))


def with_next_text(df: DataFrame, make, fields: dict[str, str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in falling order of the key, each with the row after it (the last with the first).

    ``make(text, state, next_text, next_state)`` gives the values of ``fields``; ``make.state(text)`` is worked out
    once a row. Rows with null keys come last; equal keys follow in order of a hash of their text. One shuffle of the
    texts: ranges of the key in a task, the row after a range as a guard.
    """
    base = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text), F.coalesce(-F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("_key"))
    dealt = in_order(base, "_key", [F.col(text)], before=False, wrap=True, weight=F.octet_length(F.col(text)) + 64).select(key, text, CELL, GUARD)
    schema = extended(df.select(key), **fields)

    def run(batches):
        waiting = None
        cell, guarded = None, False
        arrow_kind = None
        keys, values = [], []
        for b in batches:
            arrow_kind = b.schema.field(0).type
            for k, t, c, g in zip(*(col for col in b.columns)):
                k, t, c, g = k.as_py(), t.as_py(), c.as_py(), g.as_py()
                if c != cell:
                    cell, guarded, waiting = c, False, None
                if guarded:
                    continue
                state = make.state(t)
                if waiting is not None:
                    keys.append(waiting[0])
                    values.append(make(waiting[1], waiting[2], t, state))
                waiting = (k, t, state)
                guarded = g == 1
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, arrow_kind), *(pa.array(col) for col in zip(*values))], [key, *fields])
                keys, values = [], []

    return dealt.mapInArrow(run, schema)


class EditedNext:
    """A text's fingerprint against that of its edited form and of the text after it.

    Edited: the last third of the code points (rounded down) replaced by as many, or all, of the next text's first ones.
    """

    fields = {"n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}

    def state(self, text: str) -> np.ndarray:
        return signature(text.encode())

    def __call__(self, text: str, sig: np.ndarray, after: str, after_sig: np.ndarray) -> tuple:
        n = len(text)
        edited = (text[: n - n // 3] + after[: n // 3]).encode()
        edited_sig = signature(edited)
        return n, hashlib.sha256(edited).hexdigest(), text_form(sig), text_form(edited_sig), likeness(sig, edited_sig), likeness(sig, after_sig)
