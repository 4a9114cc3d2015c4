"""Exact integer k-means with block-norm screening.

A vector is cut into segments, each kept as its mean (the part along the diagonal) and the norm of what is left, computed once: a compressed copy of
two numbers a segment. By Cauchy-Schwarz the inner product of two remainders is at most the product of their norms, so the squared distance of two compressed
vectors is a lower bound of that of the vectors. A vector gets exact integer distances only from centroids whose bound does not exceed the best distance met so far. Bounds are
floating point and are lowered by far more than they can err, so screening changes no result: nearest centroids, ties and sums are those of a full search.

Vectors are quantised, screened and written once; each round is one pass over that table whose partial sums meet in a JVM aggregation, and only
``k`` centroids reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import written

LONG_MAX = (1 << 63) - 1
#: Up to this size of a component, all squared distances of 64 components fit a long; larger ones are reckoned with Python's integers.
_PLAIN = 1 << 27
_SLICE = 4096


def quantised(vectors: DataFrame, key: str, column: str, dims: int, scale: int, segments: int) -> DataFrame:
    """key, q (components floor(scale * x) as longs), norms (the compressed vector).

    Only vectors of exactly ``dims`` finite components stay; a component of 2^62 or more after scaling ends the job, as it fits no long.
    """
    if dims % segments:
        raise ValueError("segments must divide the components")
    kind = vectors.schema[key].dataType

    def run(batches):
        for b in batches:
            ids, col = b.column(0), b.column(1)
            ok = pc.fill_null(pc.equal(pc.list_value_length(col), dims), False)
            ids, col = ids.filter(ok), col.filter(ok)
            flat = col.flatten().cast(pa.float64())
            missing = np.asarray(flat.is_null()).reshape(-1, dims).any(1)
            x = np.floor(scale * np.asarray(flat.fill_null(0.0), dtype=np.float64)).reshape(-1, dims)
            good = ~missing & np.isfinite(x).all(1)
            x = x[good]
            if len(x) and np.abs(x).max() >= 2.0**62:
                raise ValueError("a component does not fit a long")
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(good)), _lists(x.astype(np.int64), pa.int64()), _lists(compressed(x, segments), pa.float64())], [key, "q", "norms"])

    return vectors.select(key, column).mapInArrow(run, f"`{key}` {kind.simpleString()}, q array<bigint>, norms array<double>")


def compressed(x: np.ndarray, segments: int) -> np.ndarray:
    """Means (times the root of a segment's length) and norms of the remainders, of each row's segments."""
    parts = x.astype(np.float64).reshape(len(x), segments, x.shape[1] // segments)
    means = parts.mean(2)
    rest = np.sqrt(((parts - means[..., None]) ** 2).sum(2))
    return np.concatenate([means * np.sqrt(parts.shape[2]), rest], 1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel(), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _exact(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(1)


def nearest(q: np.ndarray, norms: np.ndarray, centroids: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number) and squared distance of each row, and how many exact distances that took."""
    large = max((int(np.abs(a).max()) for a in (q, centroids) if a.size), default=0) > _PLAIN
    if large:
        q, centroids = q.astype(object), centroids.astype(object)
    cn = compressed(centroids, segments)
    bounds = ((norms[:, None, :] - cn[None]) ** 2).sum(2)
    bounds -= 1e-9 * ((norms**2).sum(1)[:, None] + (cn**2).sum(1)[None])
    best = bounds.argmin(1)
    found = np.zeros(len(q), object if large else np.int64)
    for c in np.unique(best):
        rows = best == c
        found[rows] = _exact(q[rows], centroids[c])
    first, took = best.copy(), len(q)
    for c in range(len(centroids)):
        open_ = np.flatnonzero((bounds[:, c] <= found.astype(np.float64) * (1 + 1e-9)) & (first != c))
        if not len(open_):
            continue
        took += len(open_)
        d = _exact(q[open_], centroids[c])
        better = (d < found[open_]) | ((d == found[open_]) & (c < best[open_]))
        rows = open_[better.astype(bool)]
        found[rows], best[rows] = d[better.astype(bool)], c
    return best.astype(np.int32), found, took


def _assignments(batch: pa.RecordBatch, centroids: np.ndarray, segments: int):
    """(rows, nearest, distances) of slices of a batch, so that bounds stay small."""
    q, norms = _matrix(batch.column("q"), centroids.shape[1]), _matrix(batch.column("norms"), 2 * segments)
    for at in range(0, len(q), _SLICE):
        part = slice(at, at + _SLICE)
        yield q[part], *nearest(q[part], norms[part], centroids, segments)


def _round(vectors: DataFrame, centroids: np.ndarray, segments: int) -> np.ndarray:
    """Centroids after one assignment: exact floors of their vectors' means; those without a vector stay."""
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for b in batches:
            for q, best, _, _ in _assignments(b, centroids, segments):
                for c in np.unique(best):
                    own = q[best == c]
                    wide = own.astype(object) if np.abs(own).max() > _PLAIN else own
                    sums[c] += wide.sum(0)
                    counts[c] += len(own)
        used = np.flatnonzero(counts)
        # 31 bits below, the rest above: both add up to longs in any aggregation
        high, low = sums[used] >> 31, sums[used] & 0x7FFFFFFF
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()), _lists(high.astype(np.int64).reshape(-1, dims), pa.int64()), _lists(low.astype(np.int64).reshape(-1, dims), pa.int64())], ["c", "n", "high", "low"])

    part = vectors.select("q", "norms").mapInArrow(run, "c int, n bigint, high array<bigint>, low array<bigint>")
    long = part.select("c", "n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "s")).groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s.high").cast("decimal(38,0)")).alias("high"), F.sum("s.low").alias("low"))
    new = centroids.astype(object)
    for r in long.collect():
        new[r["c"], r["i"]] = ((int(r["high"]) << 31) + r["low"]) // r["n"]
    return new.astype(np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3", segments: int = 16) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_exact (exact distances of the last assignment, all vectors together).

    The first centroids are the vectors with the smallest sha256 of ``seed:key``; of rows that share a key, those with the smaller components; rows without key
    come last. With fewer than ``k`` vectors there are fewer centroids, without any no rows. Repeated rows count each. Distances or sums beyond a long are given as the largest long.
    """
    table = written(quantised(vectors, key, column, dims, scale, segments), "vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = table.select(name.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()
    centroids = np.array([r["q"] for r in first], np.int64).reshape(len(first), dims)
    kind = table.schema[key].dataType.simpleString()
    if not first:
        return table.select(key, *[F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"), ("n_exact", "long"))])
    for _ in range(rounds):
        centroids = _round(table, centroids, segments)

    def run(batches):
        for b in batches:
            parts = list(_assignments(b, centroids, segments))
            best = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)
            far = [min(int(d), LONG_MAX) for p in parts for d in p[2]]
            took = [p[3] if i == 0 else 0 for p in parts for i in range(len(p[0]))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int32()), pa.array(far, pa.int64()), pa.array(took, pa.int64())], [key, "cluster", "distance", "took"])

    last = written(table.mapInArrow(run, f"`{key}` {kind}, cluster int, distance bigint, took bigint"), "assigned")
    totals = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.sum("took").alias("t")).collect()
    sums = [0] * len(centroids)
    for r in totals:
        sums[r["cluster"]] = int(r["d"])
    hashes = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    at = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)
    return last.select(
        key,
        "cluster",
        "distance",
        at([min(s, LONG_MAX) for s in sums], "long").alias("cluster_inertia"),
        F.lit(min(sum(sums), LONG_MAX)).cast("long").alias("inertia"),
        at(hashes, "string").alias("centroid_sha256"),
        F.lit(sum(r["t"] for r in totals)).cast("long").alias("n_exact"),
    )
