"""Packing token sequences by vector best-fit.

Each bin has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths). Pieces go longest first to the open bin that leaves the smallest weighted norm of what
remains (or has the largest weighted dot product with the piece), among the bins where every
constraint holds. Bins are indexed by their remaining tokens and, there, by their remaining vector.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm.common import extended, written


@dataclass(frozen=True)
class Capacity:
    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024


def _byte_characters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenIds:
    """Ids of a tokenizers file, none added around a text (add_special_tokens=False, nothing else set).

    Byte-level BPE files with the usual pattern whose ids follow the order of the merges give equal ids by rank, which
    is faster; that is used where it holds, texts with the content of an added token go to the library, and each batch's first text is held against the tokenizers library.
    """

    def __init__(self, path: str, pattern: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self.added = file["model"], [t["content"] for t in file.get("added_tokens") or []]
        self.fast = None
        vocab, byte = model["vocab"], _byte_characters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [vocab.get("".join(m), -1) for m in merges]
        top = max(made, default=-1)
        plain = {t: i for t, i in vocab.items() if all(c in byte for c in t) and i <= top}
        if made and made == sorted(set(made)) and len(plain) == 256 + len(made):
            ranks = {bytes(byte[c] for c in t): i for t, i in plain.items()}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list:
        if self.fast is None:
            return [e.ids for e in self.slow.encode_batch(texts, add_special_tokens=False)]
        ids = [self.slow.encode(t, add_special_tokens=False).ids if any(a in t for a in self.added) else self.fast.encode_ordinary(t) for t in texts]
        if texts and ids[0] != self.slow.encode(texts[0], add_special_tokens=False).ids:
            raise ValueError("ids by rank differ from the tokenizers library's")
        return ids


_TOKENS: dict[tuple, TokenIds] = {}


def pieces(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", end: int = 2, size: int = 1024) -> DataFrame:
    """Tokens of each text and ``end``, cut only where longer than ``size``; the first piece takes the remainder.

    Gives key, piece, start, length, ids_crc32. A null text is empty: one piece with the end token alone.
    Repeated rows give their own pieces. One pass, no shuffle.
    """
    base = df.select(key, text)

    def run(batches):
        if (path, pattern) not in _TOKENS:
            _TOKENS[path, pattern] = TokenIds(path, pattern)
        encode = _TOKENS[path, pattern]
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                row, number, start, length, crc = [], [], [], [], []
                for r, ids in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    packed = np.array([*ids, end], "<u4")
                    n = len(packed)
                    cuts = [0, *range(n % size or size, n + 1, size)]
                    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                        row.append(r)
                        number.append(k)
                        start.append(i)
                        length.append(j - i)
                        crc.append(zlib.crc32(packed[i:j]))
                arrays = [part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(arrays, [key, "piece", "start", "length", "ids_crc32"])

    return base.mapInArrow(run, extended(df.select(key), piece="int", start="long", length="long", ids_crc32="long"))


def best_fit(lengths: np.ndarray, cap: Capacity = Capacity(), weights: tuple = (1.0, 1e-3, 1e-3), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first (ties: in order given). ``rule``: "norm" takes the bin that leaves the smallest weighted norm, "dot" the largest weighted dot product.

    A bin counts only if all three capacities allow the piece; no lengths give no bins; a piece that no empty bin holds is an error.
    """
    n = len(lengths)
    bin_of, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    wt, wd, wc = weights
    levels: list[dict] = [{} for _ in range(cap.tokens + 1)]
    mask, bins = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        square = size * size
        if size > cap.tokens or square > cap.cost or cap.documents < 1:
            raise ValueError(f"a piece of {size} tokens exceeds a bin")
        best, found = None, None
        rest, left = mask >> size, size
        while rest:
            low = (rest & -rest).bit_length() - 1
            left, rest = left + low, rest >> low
            least = wt * ((left - size) / cap.tokens) ** 2
            if best is not None and rule == "norm" and least >= best:
                break
            for docs, cost in levels[left]:
                if docs >= 1 and cost >= square:
                    if rule == "norm":
                        score = least + wd * ((docs - 1) / cap.documents) ** 2 + wc * ((cost - square) / cap.cost) ** 2
                    else:
                        score = -(wt * size * left / cap.tokens**2 + wd * docs / cap.documents**2 + wc * square * cost / cap.cost**2)
                    if best is None or score < best:
                        best, found = score, (left, docs, cost)
            left, rest = left + 1, rest >> 1
        if found is None:
            number, left, docs, cost = bins, cap.tokens, cap.documents, cap.cost
            bins += 1
        else:
            left, docs, cost = found
            same = levels[left][docs, cost]
            number = same.pop()
            if not same:
                del levels[left][docs, cost]
                if not levels[left]:
                    mask &= ~(1 << left)
        bin_of[i], offset[i] = number, cap.tokens - left
        left, docs, cost = left - size, docs - 1, cost - square
        if left and docs and cost:
            levels[left].setdefault((docs, cost), []).append(number)
            mask |= 1 << left
    return bin_of, offset


def pack(cut: DataFrame, cap: Capacity = Capacity(), per_group: int = 20_000, rule: str = "norm") -> DataFrame:
    """Adds sequence_id and offset to rows with ``length``.

    Rows are dealt evenly by a hash of all columns into groups of about ``per_group`` pieces, and each is packed alone, so a task
    holds a bounded group and a sequence never spans two; each group leaves at most a few sequences part full.
    """
    groups = max(1, round(cut.count() / per_group))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(*cut.columns), F.lit(groups)))
    names = cut.columns

    def run(table: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(table, sort_keys=[(c, "ascending") for c in names])
        table = table.take(order)
        bins, offset = best_fit(table["length"].to_numpy(), cap, rule=rule)
        base = table["_group"][0].as_py() << 32
        return table.select(names).append_column("sequence_id", pa.array(bins + base, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("_group").applyInArrow(run, extended(cut, sequence_id="long", offset="long"))


def pack_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", end: int = 2, cap: Capacity = Capacity()) -> DataFrame:
    """Tokenize, cut and pack whole documents: a row for each piece. An empty table gives no rows."""
    return pack(written(pieces(df, path, pattern, key, text, end, cap.tokens), "pieces"), cap)
