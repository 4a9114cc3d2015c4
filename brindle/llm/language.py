"""Language identification with a byte convolutional network.

One-hot bytes, folded to 64 classes, pass through filters of several widths; the
largest answer of each filter in a window of fixed length goes to a softmax layer.
Because inputs are one-hot, a filter of width w is a sum of w table rows, so windows
are scored with precomputed tables over byte pairs and triples, in numpy, over whole
texts. Training (Adam, in numpy, on the driver) uses a bounded sample of windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import extended, fold, slices, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
CLASSES = 64
UNDETERMINED = "und"

_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 13, 32]] = 27
_CLASS[48:58] = 28
_CLASS[39] = 29
for _b in range(26):
    _CLASS[65 + _b] = _CLASS[97 + _b] = 1 + _b
for _b in range(128, 256):
    _CLASS[_b] = 30 + _b % 34
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


class ByteConvNet:
    """Filters of widths 2, 3 and 4 over byte classes, max pooling per window, one softmax layer."""

    def __init__(self, languages: list[str], filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.filters = list(languages), filters
        self.w = [rng.normal(0, 0.3, (k, CLASSES, filters)).astype(np.float32) for k in WIDTHS]
        self.b = np.zeros(len(WIDTHS) * filters, np.float32)
        self.d = rng.normal(0, 0.2, (len(WIDTHS) * filters, len(languages))).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)
        self._tables = None

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, at = [], []
        n = x.shape[1] - max(WIDTHS) + 1
        for w in self.w:
            r = w[0][x[:, :n]]
            for o in range(1, len(w)):
                r += w[o][x[:, o : n + o]]
            a = r.argmax(1)
            at.append(a)
            best.append(np.take_along_axis(r, a[:, None], 1)[:, 0])
        return np.concatenate(best, 1) + self.b, np.concatenate(at, 1)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 3) -> ByteConvNet:
        """``x``: windows of byte classes, WINDOW + 3 wide; ``y``: language numbers. Classes are drawn evenly."""
        rng = np.random.default_rng(seed)
        rows = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        params = [*self.w, self.b, self.d, self.c]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            k = rng.integers(0, len(rows), batch)
            i = np.array([rows[j][rng.integers(len(rows[j]))] for j in k])
            xb = x[i]
            z, at = self._pool(xb)
            h = np.maximum(z, 0)
            logits = h @ self.d + self.c
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(batch), k] -= 1
            p /= batch
            gd, gc, gh = h.T @ p, p.sum(0), (p @ self.d.T) * (z > 0)
            grads, f = [], self.filters
            for n, w in enumerate(self.w):
                g, gn, an = np.zeros_like(w), gh[:, n * f : n * f + f], at[:, n * f : n * f + f]
                for o in range(len(w)):
                    np.add.at(g[o], (np.take_along_axis(xb, an + o, 1), np.arange(f)[None]), gn)
                grads.append(g)
            for q, g, mm, vv in zip(params, [*grads, gh.sum(0), gd, gc], m, v):
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                q -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-6)
        self._tables = None
        return self

    def tables(self) -> tuple[np.ndarray, ...]:
        """Answers of the filters to every byte pair or triple: width 2, width 3, and width 4 as two pairs."""
        if self._tables is None:
            w2, w3, w4 = self.w
            flat = lambda t: np.ascontiguousarray(t.reshape(-1, self.filters))
            pair = lambda a, b: flat(a[:, None] + b[None])
            self._tables = pair(*w2), flat(w3[0][:, None, None] + w3[1][None, :, None] + w3[2][None, None]), pair(w4[0], w4[1]), pair(w4[2], w4[3])
        return self._tables

    def window_logits(self, x: np.ndarray, block: int = 128) -> np.ndarray:
        """``x``: one row of byte classes, a whole number of windows and 3 classes more."""
        t2, t3, t4a, t4b = self.tables()
        n, f = (len(x) - 3) // WINDOW, self.filters
        out = np.empty((n, len(self.languages)), np.float32)
        for i in range(0, n, block):
            k = min(block, n - i)
            c = x[i * WINDOW : (i + k) * WINDOW + 3].astype(np.int32)
            pair = c[:-1] * CLASSES + c[1:]
            size = k * WINDOW
            triple = pair[:size] * CLASSES + c[2 : size + 2]
            r2, r3 = t2.take(pair[:size], 0), t3.take(triple, 0)
            r4 = t4a.take(pair[:size], 0)
            r4 += t4b.take(pair[2 : size + 2], 0)
            z = np.concatenate([r.reshape(k, WINDOW, f).max(1) for r in (r2, r3, r4)], 1) + self.b
            out[i : i + k] = np.maximum(z, 0) @ self.d + self.c
        return out

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and probability for each text: the mean of its windows' logits, by their letters."""
        sizes = np.diff(offsets)
        windows = np.maximum(1, -(-sizes // WINDOW))
        first = np.concatenate([[0], np.cumsum(windows)])
        x = np.zeros(first[-1] * WINDOW + 3, np.uint8)
        codes = _CLASS[raw]
        for i, s in enumerate(sizes):
            x[first[i] * WINDOW : first[i] * WINDOW + s] = codes[offsets[i] : offsets[i + 1]]
        logits = self.window_logits(x)
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        body = x[:-3].reshape(-1, WINDOW)
        weight = (((body > 0) & (body < 27)) | (body > 29)).sum(1).astype(np.float32) + 1e-3
        total = np.add.reduceat(logits * weight[:, None], first[:-1], 0) / np.add.reduceat(weight, first[:-1])[:, None]
        p = np.exp(total - total.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return best, p[np.arange(len(best)), best]


def _windows_of(text: str, seed: int, most: int) -> list[bytes]:
    raw = text.encode()
    if len(raw) <= WINDOW:
        return [raw]
    rng = np.random.default_rng(seed)
    return [raw[s : s + WINDOW] for s in rng.integers(0, len(raw) - WINDOW + 1, most)]


def training_windows(df: DataFrame, text: str, lang: str, key: str, per_language: int = 600, windows: int = 4) -> list[tuple[str, bytes]]:
    """A bounded sample: about ``per_language`` documents of each language by a hash of the key, ``windows`` windows of each."""
    rows = df.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), F.col(key).cast("string").alias("k"))
    counts = {r[0]: r[1] for r in rows.groupBy("l").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(min(1.0, per_language / n)))])
    drawn = rows.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < share[F.col("l")] * (1 << 30))

    def cut(batches):
        for b in batches:
            got = [(lang_, w) for t, lang_, k in zip(*(c.to_pylist() for c in b.columns)) for w in _windows_of(t, len(t), windows)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.binary())], ["l", "w"])

    return sorted((r[0], bytes(r[1])) for r in drawn.mapInArrow(cut, "l string, w binary").collect())


def train(windows: list[tuple[str, bytes]], steps: int = 500) -> ByteConvNet | None:
    """The network learned from (language, window) pairs, the same for the same pairs; None where there are none."""
    languages = sorted({lang for lang, _ in windows})
    if not languages:
        return None
    x = np.zeros((len(windows), WINDOW + 3), np.uint8)
    for i, (_, w) in enumerate(windows):
        x[i, : len(w)] = _CLASS[np.frombuffer(w, np.uint8)]
    y = np.array([languages.index(lang) for lang, _ in windows])
    return ByteConvNet(languages).fit(x, y, steps if len(languages) > 1 else 1)


_LETTER = regex.compile(r"\p{L}")


def identify(df: DataFrame, model: ByteConvNet | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its probability; earlier columns of these names are replaced.

    A text that is null or has no letter (Unicode category L) gets ``und`` and 0.0, and so does every text when there is no
    model (no labelled text to learn from). Texts of any length are scored whole. One pass, no shuffle.
    """
    keep = [c for c in df.columns if c not in (pred, score)]
    base = df.select(*keep)
    schema = extended(base, **{pred: "string", score: "double"})
    at = keep.index(text)

    def run(batches):
        for b in batches:
            raw, offsets = text_bytes(b.column(at))
            n = b.num_rows
            names, probs = [UNDETERMINED] * n, np.zeros(n)
            if model is not None:
                for i, j in slices(offsets, 1 << 20):
                    part, ends = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                    best, p = model.predict(part, ends)
                    ascii_ = np.append(0, np.cumsum(_ASCII_LETTER[part], dtype=np.int32))
                    for k in range(j - i):
                        if ascii_[ends[k]] < ascii_[ends[k + 1]] or _LETTER.search(part[ends[k] : ends[k + 1]].tobytes().decode()):
                            names[i + k], probs[i + k] = model.languages[best[k]], float(p[k])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(np.clip(probs, 0, 1), pa.float64())], [*keep, pred, score])

    return base.mapInArrow(run, schema)
