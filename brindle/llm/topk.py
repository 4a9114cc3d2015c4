"""Exact top-k search by exhaustive term-at-a-time accumulation.

A block of candidates is held as postings, term by term: for each dimension the weights of its rows. A block of
sparse query rows takes its terms one after the other and scatters weight times posting into dense score arrays; a
partition selection keeps each query's best of the block. The blocks' are merged in two steps, of ``FAN_IN`` blocks at a time and then of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import shuffle_partitions, written

QUERY_BLOCK = 1 << 20
CANDIDATE_BLOCK = 8192
FAN_IN = 256


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """key and vec: floor(scale * x) of each component as a double. Rows with a null key, a null or non-finite component or no vector go."""
    v = F.col(vector).cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return df.where(good & F.col(key).isNotNull()).select(F.col(key), F.transform(v, lambda x: F.floor(x * scale)).alias("vec"))


class Postings:
    """Term-wise weights of a block of candidates; rows may differ in length."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        self.ids = ids
        terms = max(map(len, vectors), default=0)
        self.dense = np.zeros((terms, len(vectors)), np.int64)
        for j, v in enumerate(vectors):
            self.dense[: len(v), j] = v
        self.rows = [np.flatnonzero(w) for w in self.dense]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Dense accumulator after all of the query's terms."""
        acc = np.zeros(len(self.ids), np.int64)
        for term in np.flatnonzero(query[: len(self.dense)]):
            rows = self.rows[term]
            if 2 * len(rows) < len(acc):
                acc[rows] += query[term] * self.dense[term, rows]
            else:
                acc += query[term] * self.dense[term]
        return acc

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores but ``own``, ties to the smaller id."""
        acc = self.scores(query)
        keep = np.flatnonzero(self.ids != own)
        if len(keep) > k:
            s = acc[keep]
            cut = np.partition(s, len(s) - k)[len(s) - k]
            keep = keep[s >= cut]
        order = np.lexsort((self.ids[keep], -acc[keep]))[:k]
        return self.ids[keep[order]], acc[keep[order]]


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows by integer inner product.

    ``vectors`` has an integer key, not null, and an array of longs ``vec``; other columns are not read; an empty table gives no rows. Rows that repeat a key are candidates each, except for their own
    key's queries; a repeated query gives one result.

    One job over a grid: a cell is a block of about ``candidate_block`` candidates and one of at most about ``query_block`` queries. A task holds a cell's candidates and its queries stream by,
    so neither is ever on the driver or sent to all tasks. Candidates travel once for each block of queries, which is once unless there are more than ``query_block`` of them or fewer cells than partitions.
    """
    spark = vectors.sparkSession
    vectors = written(vectors.select(key, "vec"), "vectors")
    queries = written(vectors.where(is_query).groupBy(key).agg(F.min("vec").alias("vec")), "queries")
    total, asked, n = vectors.count(), queries.count(), shuffle_partitions(spark)
    blocks = max(1, -(-total // candidate_block))
    turns = max(1, -(-asked // query_block), min(asked, -(-n // blocks)))
    kind = vectors.schema[key].dataType.simpleString()
    one, every = lambda of: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(of)), lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long")))
    own = vectors.select(one(blocks).alias("block"), F.lit(0).alias("role"), F.col(key).cast("long").alias("id"), "vec").withColumn("turn", every(turns))
    asks = queries.select(one(turns).alias("turn"), F.lit(1).alias("role"), F.col(key).cast("long").alias("id"), "vec").withColumn("block", every(blocks))
    cells = own.unionByName(asks).repartition(max(n, blocks * turns // 4), "block", "turn").sortWithinPartitions("block", "turn", "role").select("block", "turn", "role", "id", "vec")

    def run(batches):
        held, postings, cell = [], None, None
        for b in batches:
            found: list[tuple] = []
            vec = b.column("vec")
            flat, ends = vec.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(vec.value_lengths().to_numpy(zero_copy_only=False))]
            rows = zip(*(b.column(c).to_pylist() for c in ("block", "turn", "role", "id")))
            for i, (block, turn, role, own_id) in enumerate(rows):
                if (block, turn) != cell:
                    cell, held, postings = (block, turn), [], None
                v = flat[ends[i] : ends[i + 1]]
                if not role:
                    held.append((own_id, v.copy()))
                    continue
                if postings is None:
                    postings = Postings(np.array([h[0] for h in held], np.int64), [h[1] for h in held])
                    held = []
                ids, scores = postings.best(v, own_id, k)
                if len(ids):
                    found.append((np.full(len(ids), own_id), ids, scores, np.full(len(ids), block)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], ["query_id", "id", "score", "block"])

    best = cells.mapInArrow(run, "query_id long, id long, score long, block long")
    best = best.select("query_id", F.struct((-F.col("score")).alias("s"), F.col("id").alias("v")).alias("one"), "block")
    first = lambda rows: F.slice(F.array_sort(rows), 1, k)
    best = best.groupBy("query_id", F.floor(F.col("block") / FAN_IN).alias("g")).agg(first(F.collect_list("one")).alias("top"))
    best = best.groupBy("query_id").agg(first(F.flatten(F.collect_list("top"))).alias("top")).select(F.col("query_id").cast(kind).alias("query_id"), F.posexplode("top"))
    return best.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.v").cast(kind).alias(key), (-F.col("col.s")).alias("score"))
