"""Toxicity with a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of hashed embeddings of the word, its first four and its first six
bytes (case folded for ASCII and Latin-1 letters). Filters one, two and three words wide run over the
text, the largest answer of each goes to a logistic layer. Training is in numpy on a bounded
sample; embeddings start from smoothed log-odds of the labels. A small naive Bayes head over
the same hashes guesses the language, and the score is shifted by a threshold calibrated for each
language, so that 0.7 is the operating point everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import extended, slices, text_bytes

BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
CUT = 0.7
_LEAD = 32

_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MIX = np.random.default_rng(11).integers(1, 1 << 32, (_LEAD, 256), dtype=np.uint64).astype(np.uint32)
_MIX[:, 0] = 0


def word_ids(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three bucket numbers for each word (n, 3), 0 being no word, and the n + 1 word offsets of the texts."""
    c = _FOLD[raw]
    if len(raw) > 1:
        upper = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        c[1:][upper] |= 0x20
    inside = c > 0
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros((0, 3), np.int32), np.zeros(len(offsets), np.int64)
    place = np.cumsum(inside, dtype=np.int64)
    first = place[starts] - 1
    body = c[inside]
    lens = np.diff(np.append(first, len(body)))
    within = np.minimum(np.arange(len(body)) - np.repeat(first, lens), _LEAD - 1)
    whole = np.add.reduceat(_MIX.ravel()[within * 256 + body], first, dtype=np.uint32) + lens.astype(np.uint32) * np.uint32(2654435761)
    lead = np.zeros(len(first), np.uint32)
    short = None
    for k in range(6):
        has = lens > k
        lead[has] += _MIX[k][body[first[has] + k]]
        if k == 3:
            short = lead.copy()
    ids = np.empty((len(first), 3), np.int32)
    for j, (h, salt) in enumerate(((whole, 1), (short, 2), (lead, 3))):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519) + np.uint32(salt * 40503)
        h ^= h >> np.uint32(13)
        ids[:, j] = (h % np.uint32(BUCKETS - 1) + np.uint32(1)).astype(np.int32)
    return ids, np.searchsorted(starts, offsets).astype(np.int64)


class WordConvNet:
    """Embeddings (3 tables in one), filters of widths 1 to 3, a logistic layer, a language head, thresholds."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.02, (3, BUCKETS, DIM)).astype(np.float32)
        self.w = rng.normal(0, 0.1, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32)
        self.w[0] += 0.5
        self.b = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.d = np.full(len(WIDTHS) * FILTERS, 1.0 / (len(WIDTHS) * FILTERS), np.float32)
        self.c = 0.0
        self.languages: list[str] = []
        self.lang_w = np.zeros((BUCKETS, 0), np.float32)
        self.threshold: dict[int, float] = {}
        self.default, self.slope = 0.0, 1.0

    def embed(self, ids: np.ndarray) -> np.ndarray:
        x = self.e[0].take(ids[:, 0], 0)
        x += self.e[1].take(ids[:, 1], 0)
        x += self.e[2].take(ids[:, 2], 0)
        return x

    def _answers(self, x: np.ndarray, n: int) -> np.ndarray:
        """Filter answers at the first n words of x; x has two rows more."""
        z = x @ self.w
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        col = 0
        for k, width in enumerate(WIDTHS):
            r = out[:, k * FILTERS : (k + 1) * FILTERS]
            r[:] = z[:n, col : col + FILTERS]
            for o in range(1, width):
                r += z[o : n + o, col + o * FILTERS : col + (o + 1) * FILTERS]
            col += width * FILTERS
        return out

    def pooled(self, ids: np.ndarray, offsets: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        """Largest answer of each filter in each text; texts do not see each other's words."""
        n_docs = len(offsets) - 1
        best = np.full((n_docs, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        doc = np.repeat(np.arange(n_docs), np.diff(offsets))
        gap = np.zeros((2, DIM), np.float32)
        for i in range(0, len(ids), block):
            j = min(len(ids), i + block)
            x = np.concatenate([self.embed(ids[i : min(len(ids), j + 2)]), gap])[: j - i + 2]
            a = self._answers(x, j - i)
            own = doc[i : j + 2]
            ends = np.flatnonzero(np.diff(np.append(own, -1)))  # last word of each text seen here
            z = x @ self.w
            for e in ends:
                for r, width in ((e, 2), (e, 3), (e - 1, 3)):
                    if 0 <= r < j - i and own[r] == own[e]:
                        self._alone(a, z, r, width, min(e - r + 1, width))
            cuts = np.flatnonzero(np.diff(np.append(-1, doc[i:j])))
            got = np.maximum.reduceat(a, cuts, 0)
            best[doc[i + cuts]] = np.maximum(best[doc[i + cuts]], got)
        best[~np.isfinite(best)] = 0
        return best + self.b

    def _alone(self, a: np.ndarray, z: np.ndarray, row: int, width: int, words: int) -> None:
        """Redo an answer at a text's end: only its own ``words`` words count."""
        k = WIDTHS.index(width)
        col = sum(w * FILTERS for w in WIDTHS[:k])
        a[row, k * FILTERS : (k + 1) * FILTERS] = sum(z[row + o, col + o * FILTERS : col + (o + 1) * FILTERS] for o in range(words))

    def guess_language(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.lang_w.shape[1] < 2:
            return np.zeros(len(offsets) - 1, np.int64)
        votes = np.zeros((len(offsets) - 1, self.lang_w.shape[1]), np.float64)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            votes[full] = np.add.reduceat(self.lang_w.take(ids[:, 0], 0), offsets[full], 0)
        return votes.argmax(1)

    def logits(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(ids, offsets), 0) @ self.d + self.c

    def score(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        lang = self.guess_language(ids, offsets)
        cut = np.array([self.threshold.get(int(k), self.default) for k in lang])
        z = self.slope * (self.logits(ids, offsets) - cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, docs: list[np.ndarray], y: np.ndarray, langs: list[str | None], epochs: int = 6, batch: int = 64, rate: float = 0.05, seed: int = 9) -> WordConvNet:
        """``docs``: word ids of each text. A fifth of them calibrates the thresholds; with fewer than 50 texts, or one label only in that fifth, the texts learned from do."""
        rng = np.random.default_rng(seed)
        n = len(docs)
        held = rng.random(n) < 0.2 if n >= 50 else np.zeros(n, bool)
        fit_rows = np.flatnonzero(~held)
        self._start(docs, y, langs, fit_rows)
        params = [self.w, self.b, self.d]
        acc = [np.full_like(p, 1e-2) for p in params]
        acc_e, acc_c = np.full(self.e.shape, 1e-2, np.float32), 1e-2
        pos = max(1, int(y[fit_rows].sum()))
        weight = np.where(y == 1, np.sqrt(max(1.0, (len(fit_rows) - pos) / pos)), 1.0)
        for _ in range(epochs):
            order = rng.permutation(fit_rows)
            for s in range(0, len(order), batch):
                rows = order[s : s + batch]
                g_out, grads = 0.0, [np.zeros_like(p) for p in params]
                touched: list[tuple[np.ndarray, np.ndarray]] = []
                for i in rows:
                    ids = docs[i]
                    if not len(ids):
                        continue
                    x = np.concatenate([self.embed(ids), np.zeros((2, DIM), np.float32)])
                    a = self._answers(x, len(ids))
                    at = a.argmax(0)
                    z = a[at, np.arange(a.shape[1])] + self.b
                    h = np.maximum(z, 0)
                    p = 1 / (1 + np.exp(-np.clip(h @ self.d + self.c, -30, 30)))
                    g = np.float32((p - y[i]) * weight[i] / len(rows))
                    g_out += g
                    grads[2] += g * h
                    gz = g * self.d * (z > 0)
                    grads[1] += gz
                    col = 0
                    for k, width in enumerate(WIDTHS):
                        f = np.arange(k * FILTERS, (k + 1) * FILTERS)
                        for o in range(width):
                            c = slice(col + o * FILTERS, col + (o + 1) * FILTERS)
                            grads[0][:, c] += x[at[f] + o].T * gz[f]
                            ok = at[f] + o < len(ids)
                            touched.append((ids[at[f][ok] + o], (self.w[:, c] * gz[f]).T[ok]))
                        col += width * FILTERS
                for p_, g_, a_ in zip(params, grads, acc):
                    a_ += g_ * g_
                    p_ -= rate * g_ / np.sqrt(a_)
                acc_c += g_out * g_out
                self.c -= rate * g_out / np.sqrt(acc_c)
                if touched:
                    ids, ge = np.concatenate([t[0] for t in touched]), np.concatenate([t[1] for t in touched])
                    for j in range(3):
                        rows_, back = np.unique(ids[:, j], return_inverse=True)
                        g_ = np.zeros((len(rows_), DIM), np.float32)
                        np.add.at(g_, back, ge)
                        acc_e[j][rows_] += g_ * g_
                        self.e[j][rows_] -= rate * g_ / np.sqrt(acc_e[j][rows_])
                        self.e[j][0] = 0
        self._calibrate(docs, y, np.flatnonzero(held) if held.any() and 0 < y[held].sum() < held.sum() else fit_rows)
        return self

    def _start(self, docs, y, langs, rows) -> None:
        """First embedding dimension: log-odds of the label among texts that have the bucket; language head."""
        self.languages = sorted({langs[i] for i in rows if langs[i] is not None})
        counts = np.zeros((2, 3, BUCKETS))
        words = np.full((BUCKETS, len(self.languages)), 0.5)
        for i in rows:
            for j in range(3):
                counts[y[i], j, np.unique(docs[i][:, j])] += 1
            if langs[i] is not None:
                np.add.at(words[:, self.languages.index(langs[i])], docs[i][:, 0], 1)
        n1, n0 = max(1, int((y[rows] == 1).sum())), max(1, int((y[rows] == 0).sum()))
        odds = np.log((counts[1] + 0.5) / (n1 + 1)) - np.log((counts[0] + 0.5 * n0 / n1) / (n0 + n0 / n1))
        self.e[:, :, 0] += np.where(counts.sum(0) >= 3, np.clip(odds, -3, 5), 0).astype(np.float32) / 3
        self.e[:, 0] = 0
        if self.languages:
            self.lang_w = np.log(words / words.sum(0)).astype(np.float32)
            self.lang_w -= self.lang_w.mean(1, keepdims=True)
            self.lang_w[0] = 0

    def _calibrate(self, docs, y, rows) -> None:
        """For each language the cut with the fewest mistakes; in the middle of the gap that has it."""
        z = np.array([self.logits(docs[i], np.array([0, len(docs[i])]))[0] for i in rows])
        lang = np.array([self.guess_language(docs[i], np.array([0, len(docs[i])]))[0] for i in rows])
        self.default = _best_cut(z, y[rows])
        for k in np.unique(lang):
            own = lang == k
            if y[rows][own].sum() >= 5 and (1 - y[rows][own]).sum() >= 5:
                self.threshold[int(k)] = _best_cut(z[own], y[rows][own])
        spread = np.median(np.abs(z - self.default)) if len(z) else 1.0
        self.slope = float(2.0 / max(spread, 1e-3))


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(z, kind="stable")
    zs, ys = z[order], y[order]
    if not len(zs):
        return 0.0
    wrong = np.concatenate([[0], np.cumsum(ys == 1)]) + np.concatenate([[int((ys == 0).sum())], (ys == 0).sum() - np.cumsum(ys == 0)])
    edges = np.concatenate([[zs[0] - 1], (zs[1:] + zs[:-1]) / 2, [zs[-1] + 1]])
    wide = np.concatenate([[0], np.diff(zs), [0]])
    best = np.flatnonzero(wrong == wrong.min())
    return float(edges[best[wide[best].argmax()]])


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, lang: str | None, per_class: int = 2500):
    """A bounded sample of labelled rows: about ``per_class`` of each label, by a hash of the key; word ids, not texts, come back.

    Rows without key or text, keys that ``docs`` lacks and labels other than 0 and 1 give nothing; of a key's labels the larger counts. What is broadcast are the drawn keys, what comes to the driver their word ids: both bounded by ``per_class``.
    """
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_y"))
    counts = {int(r[0]): r[1] for r in marked.groupBy("_y").count().collect()}
    if not counts:
        return [], np.zeros(0, np.int64), []
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_class / n)))])
    drawn = marked.select(F.col(key).alias("_k"), F.col("_y").cast("int").alias("_y")).where(F.pmod(F.xxhash64("_k"), F.lit(1 << 30)) < share[F.col("_y")] * (1 << 30))
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("_l"))
    rows = rows.join(F.broadcast(drawn), "_k").select("_k", "_t", "_l", "_y")

    def run(batches):
        for b in batches:
            raw, offsets = text_bytes(b.column(1))
            ids, at = word_ids(raw, offsets)
            packed = [ids[at[i] : at[i + 1]].astype("<i4").tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(packed, pa.binary()), b.column(2), b.column(3)], ["k", "w", "l", "y"])

    got = sorted(((r[0] or "", bytes(r[1]), r[2], r[3]) for r in rows.mapInArrow(run, "k string, w binary, l string, y int").collect()), key=lambda r: (r[0], r[1]))
    return [np.frombuffer(r[1], "<i4").reshape(-1, 3) for r in got], np.array([r[3] for r in got], np.int64), [r[2] for r in got]


def train(docs: list[np.ndarray], y: np.ndarray, langs: list[str | None]) -> WordConvNet | None:
    """The classifier learned from word ids, labels and languages (null: unknown), the same for the same rows; None unless both labels occur."""
    return WordConvNet().fit(docs, y, langs) if len(docs) and 0 < y.sum() < len(y) else None


def score_toxicity(df: DataFrame, model: WordConvNet | None, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from 0.7 on); earlier columns of these names are replaced.

    Null and empty texts, and texts without words, get the score of no evidence, which is below the cut;
    without a model (labels of one kind only) every score is 0.0. One pass over whole texts, no shuffle.
    """
    keep = [c for c in df.columns if c not in (score, predicted)]
    base = df.select(*keep)
    schema = extended(base, **{score: "double", predicted: "int"})
    at = keep.index(text)

    def run(batches):
        for b in batches:
            raw, offsets = text_bytes(b.column(at))
            s = np.zeros(b.num_rows)
            if model is not None:
                for i, j in slices(offsets, 1 << 20):
                    s[i:j] = model.score(*word_ids(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))], [*keep, score, predicted])

    return base.mapInArrow(run, schema)
