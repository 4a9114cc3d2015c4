"""Prefix trie of conversations by polynomial rolling fingerprints.

Texts are needed once: equal turns (role and text) get one exact number, a 64-bit hash and, should two turns share a hash, an ordinal. From there on rows are narrow.

The fingerprint of the first d turns is the sum of turn_i * B^i for i up to d, modulo 2^64, with an odd B. It is a cumulative sum, so turns in order of conversation are
scanned by numpy range by range; what a range lacks is one number of turns and one sum from the range before, so a conversation of any length spreads over many tasks. As
B has an inverse, the fingerprint of a spliced conversation (the head of one, the tail of another) follows from those of its parts without a second scan.

Rows of one depth and fingerprint are a group. Each member's turn and parent group are held against its representative's (the smallest conversation). If they agree
in every group, then by induction on depth all members of a group are equal turn by turn, and groups are the nodes. Members that differ leave their group, together with all that follow them
in their conversation, and groups are held against their representatives again.

Rollup: a conversation represents the nodes from some depth down to its end, a chain that hangs below its parent node. What a chain adds to a
subtree is summed along it, and every node sums the chains of its members, so no pass a level is needed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import shuffle_partitions, written

_BASE = 0x9E3779B97F4A7C15
_STEP = 4096
_NODE = ["depth", "g", "s"]


def _table(first: int) -> np.ndarray:
    out = np.full(_STEP, first, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = [_table(pow(_BASE, _STEP**i, 1 << 64)) for i in range(4)]
_INVERSE = _table(pow(_BASE, -1, 1 << 64))


def powers(k: np.ndarray) -> np.ndarray:
    """B^k modulo 2^64 of each k from 0 to 2^48."""
    k, out = k.astype(np.int64), np.ones(len(k), np.uint64)
    for t in _POWERS:
        out, k = out * t[k % _STEP], k // _STEP
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


@dataclass
class Trie:
    """nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, turn, ordinal. members: conv_id and depth of a node and each ``member``
    that has no turn beyond it. turns: turn, ordinal, role, text."""

    nodes: DataFrame
    members: DataFrame
    turns: DataFrame

    def texts(self) -> DataFrame:
        """nodes with role and text of their last turn (null at the root)."""
        return self.nodes.join(self.turns, ["turn", "ordinal"], "left").drop("turn", "ordinal")


def _exact_turns(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with role, text) with turn (hash) and ordinal (0 but for turns that share a hash with others), and the distinct turns."""
    rows = rows.withColumn("turn", F.shiftright(F.xxhash64("role", "text"), 64 - bits))
    distinct = rows.select("turn", "role", "text").distinct()
    shared = written(distinct.groupBy("turn").count().where("count > 1").select("turn"), "shared-hashes")
    if shared.isEmpty():
        return rows.withColumn("ordinal", F.lit(0)), distinct.withColumn("ordinal", F.lit(0))
    place = F.row_number().over(Window.partitionBy("turn").orderBy("role", "text")) - 1
    odd = written(distinct.join(shared, "turn", "left_semi").withColumn("_ordinal", place), "shared-turns")
    own = lambda df: df.join(odd, ["turn", "role", "text"], "left").withColumn("ordinal", F.coalesce("_ordinal", F.lit(0))).drop("_ordinal")
    return own(rows), own(distinct)


def _scanned(rows: DataFrame, family: Column) -> DataFrame:
    """conv_id, family, turn, ordinal, f (what is added up), size, n (place from 1) and total (fingerprint of the first n turns), by conversation in order.

    One narrow shuffle into ranges of (family, conv_id, order); equal rows may be in several ranges. Two rows a range come to the driver.
    """
    f = F.when(F.col("ordinal") == 0, F.col("turn")).otherwise(F.xxhash64("turn", "ordinal"))
    seq = rows.select("conv_id", family.alias("family"), "order", "role", F.left("text", F.lit(32)).alias("start"), "turn", "ordinal", f.alias("f"), F.octet_length("text").cast("long").alias("size"))
    seq = seq.withColumn("salt", F.monotonically_increasing_id())
    order = [F.col("family"), F.col("conv_id"), F.col("order").asc_nulls_first(), F.col("role"), F.col("start"), F.col("turn"), F.col("ordinal"), F.col("salt")]
    dealt = seq.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    names = ["conv_id", "family", "turn", "ordinal", "f", "size"]

    def scan(batches):
        part, conv, n, total, held = TaskContext.get().partitionId(), None, 0, np.uint64(0), None
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("conv_id").to_numpy()
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            which = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
            k = np.arange(len(ids)) - starts[which] + 1
            goes_on = conv is not None and ids[0] == conv
            if goes_on:
                k[which == 0] += n
            sums = np.cumsum(_unsigned(b.column("f")) * powers(k), dtype=np.uint64)
            before = np.r_[np.uint64(0), sums][starts]
            if goes_on:
                before[0] -= total
            sums = sums - before[which]
            conv, n, total = ids[-1], int(k[-1]), sums[-1]
            edge = np.zeros(len(ids), np.int32)
            if held is None:
                edge[0] = 1
            else:
                yield held[0](held[1])
            made = lambda e, b=b, k=k, sums=sums: pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(k, pa.int64()), _signed(sums), pa.array(np.full(len(k), part), pa.int32()), pa.array(e, pa.int32())], [*names, "n", "total", "part", "edge"])
            held = (made, edge)
        if held is not None:
            held[1][-1] += 2
            yield held[0](held[1])

    schema = "conv_id bigint, family bigint, turn bigint, ordinal int, f bigint, size bigint, n bigint, total bigint, part int, edge int"
    local = written(dealt.select(*names).mapInArrow(scan, schema), "turns")
    edges = sorted(local.where("edge > 0").select("part", "edge", "conv_id", "n", "total").collect())
    carries, last = {}, None  # part -> (conversation that goes on, turns before, their sum)
    for part, edge, conv, n, total in edges:
        if edge & 1 and last is not None and last[0] == conv:
            carries[part] = last
        if edge & 2:
            total &= (1 << 64) - 1
            if part in carries and carries[part][0] == conv:
                _, had, before = carries[part]
                n, total = n + had, (before + pow(_BASE, had, 1 << 64) * total) & (1 << 64) - 1
            last = (conv, n, total)

    def carried(batches):
        for b in batches:
            n, total = b.column("n").to_numpy().copy(), _unsigned(b.column("total")).copy()
            if carries:
                ids, parts = b.column("conv_id").to_numpy(), b.column("part").to_numpy()
                for part in np.unique(parts):
                    if (own := carries.get(int(part))) is not None:
                        rows_ = (parts == part) & (ids == own[0])
                        n[rows_] += own[1]
                        total[rows_] = np.uint64(own[2]) + np.uint64(pow(_BASE, own[1], 1 << 64)) * total[rows_]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(n, pa.int64()), _signed(total)], [*names, "n", "total"])

    return local.drop("edge").mapInArrow(carried, schema.rsplit(", part", 1)[0])


def _spliced(scanned: DataFrame, longest: int, cut: Column) -> DataFrame:
    """conv_id, family, cut (own turns left out), given (turns taken from the family's first conversation), add and sub (fingerprints of these) and length of each conversation.

    At most ``longest`` turns of a conversation are gathered in a row.
    """
    near = F.when(F.col("n") <= longest, F.struct("n", "total"))
    heads = scanned.groupBy("conv_id", "family").agg(F.max("n").alias("own"), F.collect_list(near).alias("head"))
    first = heads.where("conv_id = family").select("family", F.col("head").alias("given_head"))
    at = lambda head, n: F.coalesce(F.get(F.filter(head, lambda x: x["n"] == n), F.lit(0))["total"], F.lit(0).cast("long"))
    own = heads.join(first, "family", "left").withColumn("cut", F.when(F.col("conv_id") == F.col("family"), 0).otherwise(cut).cast("long"))
    own = own.withColumn("given", F.least("cut", F.coalesce(F.size("given_head"), F.lit(0)).cast("long")))
    return own.select("conv_id", "family", "cut", "given", at("given_head", F.col("given")).alias("add"), at("head", F.col("cut")).alias("sub"), (F.col("given") + F.greatest(F.col("own") - F.col("cut"), F.lit(0))).alias("length"))


def _paths(scanned: DataFrame, splices: DataFrame, longest: int, bits: int) -> DataFrame:
    """conv_id, depth, g and up (fingerprints here and one turn above), turn, ordinal, size, last for each prefix of each spliced conversation, the empty one included."""
    facts = ["conv_id", "n", "total", "turn", "ordinal", "f", "size", "cut", "given", "add", "sub", "length"]
    own = scanned.drop("family").join(splices.drop("family"), "conv_id").where("n > cut").select(*facts)
    zero = {c: F.lit(0).cast("long") for c in ("cut", "given", "add", "sub")}
    head = scanned.where((F.col("conv_id") == F.col("family")) & (F.col("n") <= longest)).drop("conv_id")
    taken = splices.where("given > 0").select("conv_id", "family", "length", F.col("given").alias("most")).join(head, "family").where("n <= most").withColumns(zero).select(*facts)
    roots = splices.select("conv_id", "length").withColumns({**zero, **{c: F.lit(0).cast("long") for c in ("n", "total", "turn", "f", "size")}, "ordinal": F.lit(0)}).select(*facts)
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        for b in batches:
            cut, given = b.column("cut").to_numpy(), b.column("given").to_numpy()
            depth = b.column("n").to_numpy() - cut + given
            g = _unsigned(b.column("add")) + _INVERSE[cut - given] * (_unsigned(b.column("total")) - _unsigned(b.column("sub")))
            up = g - _unsigned(b.column("f")) * powers(depth)
            last = depth == b.column("length").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(depth, pa.int64()), _signed(g & mask), _signed(up & mask), b.column("turn"), b.column("ordinal"), b.column("size"), pa.array(last)], ["conv_id", "depth", "g", "up", "turn", "ordinal", "size", "last"])

    return own.unionByName(taken).unionByName(roots).mapInArrow(run, "conv_id bigint, depth bigint, g bigint, up bigint, turn bigint, ordinal int, size bigint, last boolean")


def _verified(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths with s and up_s (what keeps sequences of equal fingerprint apart), and their groups: exact nodes.

    A group agrees with its representative where the least and greatest of each column are equal, which needs no join; only groups that don't are taken apart.
    """
    paths = paths.withColumn("s", F.lit(0).cast("long")).withColumn("up_s", F.lit(0).cast("long"))
    same = ["turn", "ordinal", "up", "up_s"]
    while True:
        groups = paths.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_most") for c in same])
        groups = written(groups, "groups")
        mixed = groups.where(" or ".join(f"{c} <> {c}_most" for c in same)).select(*_NODE, F.col("conv_id").alias("_first"))
        if mixed.isEmpty():
            return paths, groups.drop(*[f"{c}_most" for c in same])
        members = paths.join(mixed, _NODE)
        first = members.where("conv_id = _first").select(*_NODE, *[F.col(c).alias(f"_{c}") for c in same])
        leave = members.join(first, _NODE).where(" or ".join(f"{c} <> _{c}" for c in same)).groupBy("conv_id").agg(F.collect_list("depth").alias("_left"))
        left = lambda d: F.coalesce(F.size(F.filter("_left", lambda x: x <= d)), F.lit(0))
        moved = paths.join(leave, "conv_id", "left").withColumn("s", F.col("s") + left(F.col("depth"))).withColumn("up_s", F.col("up_s") + left(F.col("depth") - 1))
        paths = written(moved.drop("_left"), "paths")


def _chain_sums(nodes: DataFrame) -> DataFrame:
    """nodes with below (own and deeper weights of the conversation that a node is named after). Chains are summed in blocks of depths, then over blocks."""
    nodes = nodes.withColumn("_block", F.floor(F.col("depth") / _STEP))
    deeper = Window.partitionBy("conv_id").orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = nodes.groupBy("conv_id", "_block").agg(F.sum("weight").alias("_w")).select("conv_id", "_block", F.coalesce(F.sum("_w").over(deeper), F.lit(0)).alias("_later"))
    within = Window.partitionBy("conv_id", "_block").orderBy(F.col("depth").desc())
    return nodes.withColumn("_sum", F.sum("weight").over(within)).join(blocks, ["conv_id", "_block"]).withColumn("below", F.col("_sum") + F.col("_later")).drop("_block", "_sum", "_later")


def build(conversations: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", family: int = 5, cut: Column | None = None, longest: int = 8, bits: int = 64) -> Trie:
    """The trie of all conversations, each rebuilt from its family.

    Conversation c takes its first ``cut`` turns (default: crc32 of the decimal key modulo ``longest`` + 1; at most ``longest``) from conversation c - c % ``family``; its own turns follow after its own first
    ``cut``. Null role and text are empty; a null order comes first; turns of equal order stand by role, the first 32 characters and hash of the text, repeated rows beside each
    other. Rows without key take no part; % has the sign of c; an empty table has no nodes. ``bits`` shortens the hashes (to test that collisions are split).
    """
    rows = conversations.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv_id"), F.col(order).alias("order"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, turns = _exact_turns(rows, bits)
    scanned = _scanned(rows, F.col("conv_id") - F.col("conv_id") % family)
    cut = cut if cut is not None else F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    splices = written(_spliced(scanned, longest, cut), "splices")
    paths, groups = _verified(written(_paths(scanned, splices, longest, bits), "paths"))

    above = lambda df: df.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up").alias("g"), F.col("up_s").alias("s"))
    children = above(groups).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("g").alias("up"), F.col("s").alias("up_s"), F.col("conv_id").alias("parent_conv_id"))
    nodes = groups.join(children, _NODE, "left").join(parents, ["depth", "up", "up_s"], "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("weight", (F.col("n_convs") - 1) * F.col("size"))
    nodes = written(nodes, "nodes")
    chains = nodes.groupBy("conv_id").agg(F.sum("weight").alias("chain"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    sums = paths.join(chains, "conv_id").groupBy(*_NODE).agg(F.sum("chain").alias("chains"), F.sum("leaf").alias("n_leaves"))
    out = _chain_sums(nodes).join(sums, _NODE).join(chains.select("conv_id", "chain"), "conv_id")
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("below") + F.col("chains") - F.col("chain")).alias("saved_tokens"), "turn", "ordinal")
    members = paths.where("last").select(*_NODE, F.col("conv_id").alias("member")).join(nodes.select(*_NODE, "conv_id"), _NODE).select("conv_id", "depth", "member")
    return Trie(out, members, turns)


def ids_sha256(members: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256: SHA-256 of each node's ``member`` ids in order, comma-joined.

    Ranges of sorted ids are written out as text in parallel; what is sequential by nature, the hash of one node's text, streams through a task chunk by chunk.
    """
    n = shuffle_partitions(members.sparkSession)
    keys = ["conv_id", "depth"]

    def chunks(batches):
        for b in batches:
            c, d, m = (b.column(k).to_numpy() for k in ("conv_id", "depth", "member"))
            starts = np.flatnonzero(np.r_[np.ones(min(1, len(c)), bool), (c[1:] != c[:-1]) | (d[1:] != d[:-1])])
            ends = np.r_[starts[1:], len(c)]
            yield pa.RecordBatch.from_arrays([pa.array(c[starts]), pa.array(d[starts]), pa.array(m[starts]), pa.array([",".join(map(str, m[i:j].tolist())) for i, j in zip(starts, ends)], pa.string())], [*keys, "first", "ids"])

    def digests(batches):
        node, state = None, None
        for b in batches:
            out = []
            for c, d, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if (c, d) == node:
                    state.update(f",{ids}".encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (c, d), hashlib.sha256(ids.encode())
            yield _digests(out)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    parts = members.repartitionByRange(n, *keys, "member").sortWithinPartitions(*keys, "member").select(*keys, "member").mapInArrow(chunks, "conv_id bigint, depth bigint, first bigint, ids string")
    return parts.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digests, "conv_id bigint, depth bigint, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["conv_id", "depth", "ends_sha256"])
