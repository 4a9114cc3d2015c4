"""Byte-level BPE encoding and decoding as transducers.

The ranks of a vocabulary compile into a finite-state transducer. A BPE encoding is valid exactly
if each of its tokens and each pair of neighbours is its own encoding, so the machine reads bytes
and keeps every hypothesis "tokens so far, place in the token trie" that can still be extended;
that set, with the output common to all hypotheses taken off and emitted, is a state of the
determinised machine. States and transitions are made when first needed, for pieces of any length, and forgotten when there are too many.
Lookahead is bounded: every live hypothesis is the one encoding of a prefix that ends within a longest token of the byte read, and a token leaves once
all of these agree on it; tests hold that to two longest tokens.

Decoding streams: a UTF-8 automaton takes token after token and holds back the bytes of an unfinished code point. Its transition from the start state is
known for each token, so only tokens that cut a code point are run byte by byte.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from brindle.llm.common import extended

#: The characters with the Unicode property White_Space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"

_NONE = -1
_TOP = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line. Vocabularies are part of the installation, not data."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Lazily determinised encoder of one piece (a pre-token) into ids."""

    def __init__(self, ranks: dict[bytes, int], most_transitions: int = 600_000):
        """``most_transitions``: a bound of the machine's memory; beyond it states are made anew from the current hypotheses."""
        self.ranks, self.most = ranks, most_transitions
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.trie: dict[int, int] = {}
        self.token_at, self.inner = array("l", [_NONE]), bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                nxt = self.trie.get(key)
                if nxt is None:
                    nxt = self.trie[key] = len(self.token_at)
                    self.token_at.append(_NONE)
                    self.inner.append(0)
                    self.inner[node] = 1
                node = nxt
            self.token_at[node] = rank
        self._spines: dict[int, tuple] = {}
        self._splits: dict[bytes, list] = {}
        self._pairs: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._ends: list[tuple | None] = []
        self._next: dict[int, tuple[int, tuple]] = {}
        self._start = self._state(((_NONE, (), 0),))

    def _state(self, hypotheses: tuple) -> int:
        n = self._ids.get(hypotheses)
        if n is None:
            n = self._ids[hypotheses] = len(self._states)
            self._states.append(hypotheses)
            self._ends.append(next((pending for _, pending, node in hypotheses if node == 0), None))
        return n

    def _parts(self, token: bytes, below: int) -> list[bytes]:
        """Plain merging with ranks under ``below``: only for single tokens, to learn how they are made."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while True:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], _TOP)
                if r < best:
                    best, at = r, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _made_of(self, piece: bytes) -> list[bytes]:
        """The two pieces whose merge makes ``piece``; another number of pieces if merging does not make it."""
        got = self._splits.get(piece)
        if got is None:
            got = self._splits[piece] = self._parts(piece, self.ranks[piece])
        return got

    def _spine(self, token: int) -> tuple[list, list] | None:
        """The pieces at a token's left and right edge while it is made, each with the rank that ends it; None if merging does not make it."""
        got = self._spines.get(token, 0)
        if got == 0:
            raw = self.bytes_of[token]
            left, right, ok = [(raw, _TOP)], [(raw, _TOP)], True
            for side, edge in ((left, 0), (right, -1)):
                piece = raw
                while len(piece) > 1 and ok:
                    parts, rank = self._made_of(piece), self.ranks[piece]
                    ok = len(parts) == 2
                    piece = parts[edge]
                    side.append((piece, rank))
            got = self._spines[token] = (left, right) if ok else None
        return got

    def _compatible(self, a: int, b: int) -> bool:
        """Does the encoding of the two tokens' bytes keep the boundary between them?"""
        key = a << 32 | b
        got = self._pairs.get(key)
        if got is None:
            if len(self._pairs) > 4 * self.most:
                self._pairs.clear()
            x, y = self._spine(a), self._spine(b)
            got = x is not None and y is not None
            if got:
                for left, left_end in x[1]:
                    for right, right_end in y[0]:
                        m = self.ranks.get(left + right, _TOP)
                        if m < left_end and m <= right_end and m < _TOP:
                            got = False
                            break
                    if not got:
                        break
            self._pairs[key] = got
        return got

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        """The state after one more byte and the tokens that all its hypotheses share; at most one hypothesis ends a token there."""
        get, token_at, inner, pairs = self.trie.get, self.token_at, self.inner, self._pairs
        out, ended = [], False
        for last, pending, node in self._states[state]:
            nxt = get(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                out.append((last, pending, nxt))
            if not ended and (token := token_at[nxt]) >= 0:
                if last < 0:
                    ended = self._spine(token) is not None
                else:
                    known = pairs.get(last << 32 | token)
                    ended = self._compatible(last, token) if known is None else known
                if ended:
                    out.append((token, (*pending, token), 0))
        if not out:
            raise ValueError("the vocabulary does not cover these bytes")
        common = out[0][1]
        for _, pending, _ in out:
            if not common:
                break
            if pending is not common:
                k = 0
                for p, q in zip(common, pending):
                    if p != q:
                        break
                    k += 1
                common = common[:k]
        if k := len(common):
            out = [(last, pending[k:], node) for last, pending, node in out]
        return self._state(tuple(out)), common

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids: list[int] = []
        state, follow = self._start, self._next
        for byte in piece:
            got = follow.get(state << 8 | byte)
            if got is None:
                if len(follow) >= self.most:
                    hypotheses = self._states[state]
                    self._clear()
                    state, follow = self._state(hypotheses), self._next
                got = follow[state << 8 | byte] = self._step(state, byte)
            state, emitted = got
            if emitted:
                ids += emitted
        end = self._ends[state]
        if end is None:
            raise ValueError("the vocabulary does not cover these bytes")
        ids += end
        return ids


class _Pieces(dict):
    """Packed ids of pieces met before; emptied when full."""

    def __init__(self, machine: Transducer, most: int):
        super().__init__()
        self.machine, self.most = machine, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[piece] = array("I", self.machine.encode(piece.encode())).tobytes()
        return ids


class Encoder:
    """Texts to packed ids: pieces by a pattern, each through the transducer unless it was met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_cached: int = 400_000):
        self.machine = Transducer(ranks)
        self.find = regex.compile(pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")).findall
        self.pieces = _Pieces(self.machine, most_cached)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))


def _utf8_transitions() -> list[list[int]]:
    """Next state by state and byte, -1 for a byte that cannot follow.

    State 0 is between code points; 1 to 3 wait for so many more bytes; 4 to 7 follow E0, ED, F0 and F4, whose next byte has a narrower range.
    """
    tail = range(0x80, 0xC0)
    out = [[-1] * 256 for _ in range(8)]
    first = [(range(0x80), 0), (range(0xC2, 0xE0), 1), (range(0xE1, 0xF0), 2), (range(0xF1, 0xF4), 3), ((0xE0,), 4), ((0xED,), 5), ((0xF0,), 6), ((0xF4,), 7)]
    rest = [(1, tail, 0), (2, tail, 1), (3, tail, 2), (4, range(0xA0, 0xC0), 1), (5, range(0x80, 0xA0), 1), (6, range(0x90, 0xC0), 2), (7, range(0x80, 0x90), 2)]
    for state, span, to in [*((0, span, to) for span, to in first), *rest]:
        for b in span:
            out[state][b] = to
    return out


_UTF8 = _utf8_transitions()


class Utf8Machine:
    """Incremental UTF-8: takes bytes, gives the bytes of finished code points; bytes that belong to none pass as they are."""

    def __init__(self) -> None:
        self.state, self.tail = 0, b""

    def feed(self, data: bytes) -> bytes:
        state, held = self.state, len(self.tail)
        data, done = self.tail + data, 0
        for i in range(held, len(data)):
            nxt = _UTF8[state][data[i]]
            if nxt < 0 and state:
                done, nxt = i, _UTF8[0][data[i]]
            state = max(nxt, 0)
            if not state:
                done = i + 1
        self.state, self.tail = state, data[done:]
        return data[:done]

    def finish(self) -> bytes:
        """What is left, finished or not."""
        tail, self.state, self.tail = self.tail, 0, b""
        return tail


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.table: list[bytes] = [b""] * (max(ranks.values()) + 1)
        self.whole = np.ones(len(self.table), bool)
        for token, rank in ranks.items():
            self.table[rank] = token
            machine = Utf8Machine()
            self.whole[rank] = token.isascii() or machine.feed(token) == token

    def stream(self, packed: bytes, block: int = 1 << 12):
        """The bytes of the ids in parts that end with whole code points, one for each ``block`` ids."""
        machine, table, ids = Utf8Machine(), self.table, np.frombuffer(packed, "<u4")
        for i in range(0, len(ids), block):
            own, cuts = ids[i : i + block].tolist(), [*np.flatnonzero(~self.whole[ids[i : i + block]]).tolist(), -1]
            parts, at, k = [], 0, 0
            while at < len(own):
                if machine.state:
                    parts.append(machine.feed(table[own[at]]))
                    at += 1
                    continue
                while 0 <= cuts[k] < at:
                    k += 1
                to = cuts[k] if cuts[k] >= 0 else len(own)
                parts += map(table.__getitem__, own[at:to])
                if to < len(own):
                    parts.append(machine.feed(table[own[to]]))
                at = to + 1
            yield b"".join(parts)
        yield machine.finish()


_ENCODERS: dict[tuple, tuple[Encoder, Decoder]] = {}


def codec(path: str, pattern: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder a process and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        ranks = read_ranks(path)
        _ENCODERS[path, pattern] = Encoder(ranks, pattern), Decoder(ranks)
    return _ENCODERS[path, pattern]


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of each whole text as an array of longs; null is empty. One pass, no shuffle."""
    keep = [c for c in df.columns if c != ids]
    base = df.select(*keep)
    at = keep.index(text)

    def run(batches):
        encoder, _ = codec(path, pattern)
        for b in batches:
            packed = [np.frombuffer(encoder.encode(t or ""), "<u4").astype(np.int64) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packed, pa.list_(pa.int64()))], [*keep, ids])

    return base.mapInArrow(run, extended(base, **{ids: "array<bigint>"}))


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the bytes that arrays of ids stand for; a null array is empty. One pass, no shuffle."""
    keep = [c for c in df.columns if c != text]
    base = df.select(*keep)
    at = keep.index(ids)

    def run(batches):
        _, decoder = codec(path, pattern)
        for b in batches:
            raw = [b"".join(decoder.stream(np.array(i or [], "<u4").tobytes())) for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], [*keep, text])

    return base.mapInArrow(run, extended(base, **{text: "binary"}))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and decode in one pass and keep digests only: key, n_tokens, ids_sha256, decoded_sha256.

    Null texts count as empty. Repeated keys give a row each.
    """
    base = df.select(key, text)

    def run(batches):
        encoder, decoder = codec(path, pattern)
        for b in batches:
            n, one, two = [], [], []
            for t in b.column(1):
                packed = encoder.encode(t.as_py() or "")
                n.append(len(packed) // 4)
                one.append(hashlib.sha256(packed).hexdigest())
                digest = hashlib.sha256()
                for part in decoder.stream(packed):
                    digest.update(part)
                two.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return base.mapInArrow(run, extended(df.select(key), n_tokens="long", ids_sha256="string", decoded_sha256="string"))
