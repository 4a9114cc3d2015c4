"""Exact near-duplicate components by a Jaccard join in metric space.

A document is its set of distinct word shingles; the Jaccard distance d is a metric and documents link within
r = 1 - threshold. Equal sets are one set throughout: a group of copies of any size costs one document. The join cuts the sets into
regions around pivots, replicates to a region what a triangle inequality allows to have a partner there, and joins regions recursively:

1. Counting. The difference |x - y| obeys the triangle inequality too, and with the empty set as pivot it says |x - y| <= w(x) = |x| - ceil((1 - r) |x|) for
   linked x, y. A set with more than w(x) shingles of its own is in no region. Counting is repeated on what is left.
2. Shingle pivots. All sets order their shingles alike, rare ones first. Of the first w(x) + 1 shingles of x at least one is
   in y, so the sets that hold a shingle among their first meet around it. Its pivot is the document nearest to the
   common stock among them. Shingles with one pivot make one region, so a region holds a set once, and near copies share nearly all their pivots.
3. Voronoi cells. A region too large for a task draws pivots; every set goes to the cell of its nearest one. What links to a pivot is known to be in
   its component. Pairs known to be connected need not meet: of a region's largest component, sets stay in their own cell only. Every other set x goes
   to all cells whose pivot is within d(x, nearest) + 2r, as d(x, c(y)) <= d(y, c(y)) + r <= d(y, c(x)) + r <= d(x, c(x)) + 2r. Cells that are still too large
   are cut again. Where all sets are about as far from all pivots, windows prune nothing: such a region is cut into blocks by hash, and every two blocks meet that
   are not both of the largest component.
4. A small region is joined by pivots in numpy: the first is the set nearest to the common stock, its ball is one component, and every set
   outside is compared with the sets of other components within the window |d(x, p) - d(y, p)| <= r.

Shingles travel as packed arrays by hash range, so counting costs a sort in numpy, not a row a shingle. Shingles that many
sampled sets have are certainly shared; they come last in the order and are dealt by shingle and set, so a passage of every document is no one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.common import discard, placement_keys, shuffle_partitions, slices, text_bytes, written

_P, _Q = np.uint64(0x100000001B3 * 0x9E3779B1 & (1 << 64) - 1 | 1), np.uint64(0xD6E8FEB86659FD93)
_K1, _K2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(23).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _K1
    x ^= x >> np.uint64(27)
    x *= _K2
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer words than ``words`` make one shingle, no words none."""
    n_docs = len(offsets) - 1
    none = np.zeros(0, np.uint64)
    inside = _INSIDE[raw]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return [none] * n_docs
    first = np.cumsum(inside, dtype=np.int64)[starts] - 1
    body = _BYTE[_LOWER[raw[inside]]]
    lens = np.diff(np.append(first, len(body)))
    within = np.arange(len(body)) - np.repeat(first, lens)
    word = _mix(np.add.reduceat(body * _powers(_P, int(lens.max()))[within], first) + lens.astype(np.uint64))
    at = np.searchsorted(starts, offsets)
    q = _powers(_Q, words)
    full = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for j in range(words):
        full += word[j : j + len(full)] * q[j]
    full = _mix(full)
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
        if j - i >= words:
            h = np.sort(full[i : j - words + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif j > i:
            out.append(_mix((word[i:j] * q[: j - i]).sum(keepdims=True) + np.full(1, j - i, np.uint64) * _K1))
        else:
            out.append(none)
    return out


def set_id(h: np.ndarray) -> int:
    """One signed 64-bit number for a set of hashes."""
    return int(_mix(_mix(h).sum(keepdims=True) + np.full(1, len(h), np.uint64) * _Q).astype(np.int64)[0])


def _sets_of(batches, words: int, most: int = 2 << 20):
    """(batch, first row, sets) for runs of rows of batches whose last column is the text."""
    for b in batches:
        raw, offsets = text_bytes(b.column(b.num_columns - 1))
        for i, j in slices(offsets, most):
            yield b, i, shingles(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)


_PACKED = "place long, sets binary, sizes binary, counts binary, hashes binary, extra binary"
_TYPES = ("<i8", "<i4", "<i4", "<u8", "<u8")
_HOT_DF = (1 << 31) - 1


def _packs(places: list[int], part: np.ndarray, sets: np.ndarray, sizes: np.ndarray, owner: np.ndarray, hashes: np.ndarray, extra: np.ndarray | None = None, most: int = 1 << 20):
    """Batches of packed arrays, a row for each part, about ``most`` entries at a time: entries of ``hashes`` belong to set number ``owner`` and go to ``part``."""
    order = np.lexsort((owner, part))
    part, owner, hashes = part[order], owner[order], hashes[order]
    extra = extra[order] if extra is not None else None
    del order
    cuts = np.flatnonzero(np.diff(np.append(-1, part)))
    rows: list[tuple] = []
    room = most
    for i, j in zip(cuts, np.append(cuts[1:], len(part))):
        if room <= 0:
            yield _packed_batch(rows)
            rows, room = [], most
        room -= j - i
        own = owner[i:j]
        heads = np.flatnonzero(np.diff(np.append(-1, own)))
        who = own[heads]
        rows.append((places[part[i]], sets[who].tobytes(), sizes[who].astype("<i4").tobytes(), np.diff(np.append(heads, j - i)).astype("<i4").tobytes(), hashes[i:j].tobytes(), extra[i:j].tobytes() if extra is not None else b""))
    if rows:
        yield _packed_batch(rows)


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["place", "sets", "sizes", "counts", "hashes", "extra"])


def _unpacked(batches) -> tuple[np.ndarray, ...] | None:
    """All entries of a partition: set and size of each owner, owner of each entry, hash, extra; None if there are none."""
    got: list[list] = [[], [], [], [], []]
    for b in batches:
        for k in range(5):
            got[k] += [v.as_py() for v in b.column(k + 1)]
    if not got[0]:
        return None
    arrays = []
    while got:
        arrays.append(np.frombuffer(b"".join(got.pop(0)), _TYPES[len(arrays)]))
    sets, sizes, counts, hashes, extra = arrays
    return sets, sizes, np.repeat(np.arange(len(sets), dtype=np.int32), counts), hashes, extra


def _by_hash(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _by_set(s: np.ndarray, n: int) -> np.ndarray:
    return _by_hash(_mix(s.astype(np.uint64)), n)


class Hot:
    """Shingles that many sampled sets hold, with the pivot of each; every set agrees on them."""

    def __init__(self, hashes: np.ndarray, heads: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.heads = hashes[order], heads[order]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is hot, and where it stands."""
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return (self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)), at

    def part(self, h: np.ndarray, sets: np.ndarray, n: int) -> np.ndarray:
        """Where entries meet: by shingle, hot ones by shingle and set."""
        return _by_hash(np.where(self.find(h)[0], _mix(h ^ _mix(sets.astype(np.uint64))), h), n)


def _pack_sets(ids: list[int], each: list[np.ndarray], sizes: list[int], places: list[int], n: int, hot: Hot):
    lens = np.array([len(h) for h in each])
    owner, numbers, hashes = np.repeat(np.arange(len(each)), lens), np.array(ids, np.int64), np.concatenate(each)
    return _packs(places, hot.part(hashes, numbers[owner], n), numbers, np.array(sizes), owner, hashes)


def _flushed(found, places: list[int], n: int, hot: Hot, most: int = 1 << 20):
    """Packs of (set, size, hashes), about ``most`` hashes at a time; a set that comes again meanwhile counts once."""
    held: dict[int, tuple] = {}
    room = most
    for number, size, h in found:
        if len(h) and number not in held:
            held[number] = (size, h)
            room -= len(h)
            if room <= 0:
                yield from _pack_sets(list(held), [h for _, h in held.values()], [k for k, _ in held.values()], places, n, hot)
                held, room = {}, most
    if held:
        yield from _pack_sets(list(held), [h for _, h in held.values()], [k for k, _ in held.values()], places, n, hot)


def hot_shingles(df: DataFrame, text: str, words: int, sample: int = 1 << 14, least: int = 16, most_bytes: int = 256 << 20) -> Hot:
    """Shingles in at least ``least`` distinct sets of rows drawn by hash; nothing but placement and order depends on them.

    About ``sample`` rows are drawn for every 32 partitions, so that what counts as hot stays a fixed share of a partition, but no more than about ``most_bytes`` of text: the driver
    holds at most 1 in ``least`` of these shingles, 8 bytes each. A shingle's pivot is the sampled set with the largest share of hot shingles.
    """
    spark = df.sparkSession
    total, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()
    share = min(1.0, sample * max(1, shuffle_partitions(spark) // 32) / max(total, 1), most_bytes / max(size, 1))
    drawn = df.select(text) if share == 1.0 else df.where(F.pmod(F.xxhash64(*df.columns, F.lit(words)), F.lit(1 << 40)) < int((1 << 40) * share)).select(text)
    n = max(1, min(shuffle_partitions(spark), 32))
    places, none = placement_keys(spark, n), Hot(np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def run(batches):
        yield from _flushed(((set_id(h), len(h), h) for _, _, sets in _sets_of(batches, words) for h in sets), places, n, none)

    def often(batches):
        got = _unpacked(batches)
        if got is None:
            return
        sets, _, owner, hashes, _ = got
        order = np.lexsort((sets[owner], hashes))
        h, s = hashes[order], sets[owner][order]
        new = np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])) if len(h) else np.zeros(0, bool)
        u, c = np.unique(h[new], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([u[c >= least].tobytes()], pa.binary())], ["hashes"])

    rows = drawn.mapInArrow(run, _PACKED).repartition(n, "place").mapInArrow(often, "hashes binary").collect()
    found = Hot(u := np.frombuffer(b"".join(r.hashes for r in rows), "<u8"), np.zeros(len(u), np.int64))
    if not len(u):
        return found

    def nearest(batches):
        best, heads = np.full(len(found.hashes), 2.0), np.zeros(len(found.hashes), np.int64)
        for _, _, sets in _sets_of(batches, words):
            for h in sets:
                hit, at = found.find(h)
                at, number, far = at[hit], set_id(h) if len(h) else 0, 1 - hit.mean() if len(h) else 1.0
                better = (far < best[at]) | (far == best[at]) & (number < heads[at])
                best[at[better]], heads[at[better]] = far, number
        yield pa.RecordBatch.from_arrays([pa.array([best.tobytes()], pa.binary()), pa.array([heads.tobytes()], pa.binary())], ["best", "heads"])

    best, heads = np.full(len(found.hashes), 2.0), np.zeros(len(found.hashes), np.int64)
    for r in drawn.repartition(min(n, 8)).mapInArrow(nearest, "best binary, heads binary").toLocalIterator():
        far, own = np.frombuffer(r.best, "<f8"), np.frombuffer(r.heads, "<i8")
        better = (far < best) | (far == best) & (own < heads)
        best, heads = np.where(better, far, best), np.where(better, own, heads)
    return Hot(found.hashes, heads)


def _counter(places: list[int], n: int, hot):
    """Counts the distinct sets of each shingle of a partition; shared shingles go back to their sets, with the count."""

    def count(batches):
        got = _unpacked(batches)
        if got is None:
            return
        sets, sizes, owner, hashes, _ = got
        ids, first, code = np.unique(sets, return_index=True, return_inverse=True)
        code = code.astype(np.int32)[owner]
        order = np.lexsort((code, hashes))
        h, c = hashes[order], code[order]
        del got, owner, hashes, code, order  # a partition's entries are most of what a task holds
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        h, c = h[new], c[new]
        cuts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        df = np.diff(np.append(cuts, len(h)))
        df = np.repeat(df, df)
        df[hot.value.find(h)[0]] = _HOT_DF
        more = df > 1
        h, c, df = h[more], c[more], df[more]
        yield from _packs(places, _by_set(ids[c], n), ids, sizes[first], c, h, df.astype("<u8"))

    return count


def _beside(count):
    """``count`` for the packed columns of batches whose first two columns are rows of another kind, which only pass."""

    def run(batches):
        kinds: list[pa.DataType] = []

        def packed():
            for b in batches:
                kinds[:] = [b.column(0).type, b.column(1).type]
                own = pa.compute.is_valid(b.column(3))
                if (rest := b.filter(pa.compute.invert(own))).num_rows:
                    passed.append(rest)
                if (rows := b.filter(own)).num_rows:
                    yield rows.select(rows.schema.names[2:])

        passed: list[pa.RecordBatch] = []
        for b in count(packed()):
            yield _with_empty(b, kinds)
        yield from passed

    return run


def _with_empty(b: pa.RecordBatch, kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.nulls(b.num_rows, k) for k in kinds), *b.columns], ["_key", "_own", *b.schema.names])


def _gathered(batches, keep_size):
    """(set, size, shared shingles, counts) of the sets of a partition that share as many as a partner takes, in order of shingles."""
    got = _unpacked(batches)
    if got is None:
        return
    sets, sizes, owner, hashes, dfs = got
    s, size = sets[owner], sizes[owner]
    order = np.lexsort((hashes, s))
    s, size, hashes, dfs = s[order], size[order], hashes[order], dfs[order]
    cuts = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(s)).astype(np.int64)
    for i, j in zip(cuts.tolist(), ends.tolist()):
        if j - i >= keep_size(int(size[i])):
            yield int(s[i]), int(size[i]), hashes[i:j], dfs[i:j]


def _in_batches(rows, schema: pa.Schema, most: int = 8 << 20):
    """Rows (tuples whose last item is bytes) as batches of about ``most`` bytes."""
    held: list[tuple] = []
    room = most
    for row in rows:
        held.append(row)
        room -= len(row[-1]) + 64
        if room <= 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, room = [], most
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def shared_sets(docs: DataFrame, words: int, keep_size, hot) -> DataFrame:
    """One shingling pass over ``docs`` (_key, _text): a row (_key, n, _set) for each document and a row (n, _set, hashes) for each set that may link.

    ``keep_size(n)``: shingles that a linked set shares at least. Rows of documents travel beside the packed shingles.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    places = placement_keys(spark, n)
    one = T.StructType([T.StructField("_key", docs.schema["_key"].dataType), *T._parse_datatype_string("_own long").fields, *T._parse_datatype_string(_PACKED).fields])
    two = T.StructType([one["_key"], *T._parse_datatype_string("n long, _set long, hashes binary").fields])

    def cut(batches):
        kind: list[pa.DataType] = []
        rows: list[pa.RecordBatch] = []

        def found():
            turn = 0
            for b, i, sets in _sets_of(batches, words):
                kind[:] = [b.column(0).type, pa.int64()]
                numbers = [set_id(h) if len(h) else None for h in sets]
                place = [places[(turn + j) % n] for j in range(len(sets))]
                sizes = pa.array([np.array([len(h)], "<i4").tobytes() for h in sets], pa.binary())
                none = pa.nulls(len(sets), pa.binary())
                rows.append(pa.RecordBatch.from_arrays([b.column(0).slice(i, len(sets)), pa.array(numbers, pa.int64()), pa.array(place, pa.int64()), none, sizes, none, none, none], ["_key", "_own", "place", "sets", "sizes", "counts", "hashes", "extra"]))
                turn += len(sets)
                for number, h in zip(numbers, sets):
                    if number is not None:
                        yield number, len(h), h

        for b in _flushed(found(), places, n, hot.value):
            yield _with_empty(b, kind)
            yield from rows
            rows.clear()
        yield from rows

    def gather(batches):
        held = []
        for b in batches:
            own = pa.compute.is_valid(b.column(3))
            held.append(b.filter(own).select(b.schema.names[2:]))
            if (rest := b.filter(pa.compute.invert(own))).num_rows:
                sizes = np.frombuffer(b"".join(v.as_py() for v in rest.column(4)), "<i4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([rest.column(0), pa.array(sizes), rest.column(1), pa.nulls(rest.num_rows, pa.binary())], ["_key", "n", "_set", "hashes"])
            kind = b.column(0).type
        schema = pa.schema([("n", pa.int64()), ("_set", pa.int64()), ("hashes", pa.binary())])
        for b in _in_batches(((size, s, h.tobytes()) for s, size, h, _ in _gathered(held, keep_size)), schema):
            yield pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, kind), *b.columns], ["_key", *schema.names])

    mid = docs.mapInArrow(cut, one).repartition(n, "place").mapInArrow(_beside(_counter(places, n, hot)), one)
    return mid.repartition(n, "place").mapInArrow(gather, two)


def windowed_sets(sets: DataFrame, keep_size, window_size, hot) -> DataFrame:
    """Counts again among ``sets`` (n, _set, hashes). Gives _set, n, shared (shingles that others here have), hashes (these, sorted) and window (its first ones).

    ``window_size(n)``: most shingles a linked set can have that its partner has not.
    """
    spark = sets.sparkSession
    n = shuffle_partitions(spark)
    places = placement_keys(spark, n)

    def pack(batches):
        yield from _flushed(((s.as_py(), k.as_py(), np.frombuffer(h.as_py(), "<u8")) for b in batches for s, k, h in zip(*b.columns)), places, n, hot.value)

    def gather(batches):
        def rows():
            for s, size, h, df in _gathered(batches, keep_size):
                room = window_size(size) - (size - len(h)) + 1
                yield s, size, len(h), h[np.lexsort((h, df))[:room]].tobytes(), h.tobytes()

        yield from _in_batches(rows(), pa.schema([("_set", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("window", pa.binary()), ("hashes", pa.binary())]))

    mid = sets.select("_set", "n", "hashes").mapInArrow(pack, _PACKED).repartition(n, "place").mapInArrow(_counter(places, n, hot), _PACKED)
    return mid.repartition(n, "place").mapInArrow(gather, "_set long, n long, shared long, window binary, hashes binary")


def regions(sets: DataFrame, hot) -> DataFrame:
    """(cell, _set) for the sets that meet around a shingle of their windows; cell is the number of the pivot there. A pair comes once."""
    spark = sets.sparkSession
    n = shuffle_partitions(spark)
    places = placement_keys(spark, n)

    def pack(batches):
        yield from _flushed(((s.as_py(), int((1 - shared.as_py() / k.as_py()) * (1 << 30)), np.frombuffer(w.as_py(), "<u8")) for b in batches for s, k, shared, w in zip(*b.columns)), places, n, hot.value)

    def head(batches):
        got = _unpacked(batches)
        if got is None:
            return
        sets_, far, owner, hashes, _ = got
        order = np.lexsort((sets_[owner], far[owner], hashes))
        h, owner = hashes[order], owner[order]
        cuts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        many = np.diff(np.append(cuts, len(h)))
        heads, many = np.repeat(sets_[owner[cuts]], many), np.repeat(many, many)
        hit, at = hot.value.find(h)
        if hit.any():
            heads = np.where(hit, hot.value.heads[at], heads)
        met = hit | (many > 1)
        yield from _packs(places, _by_set(sets_[owner[met]], n), sets_, far, owner[met], heads[met].astype(np.int64).view("<u8"))

    def once(batches):
        got = _unpacked(batches)
        if got is None:
            return
        sets_, _, owner, heads, _ = got
        s, p = sets_[owner], heads.view("<i8")
        order = np.lexsort((p, s))
        s, p = s[order], p[order]
        new = np.append(True, (s[1:] != s[:-1]) | (p[1:] != p[:-1])) if len(s) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(p[new]), pa.array(s[new])], ["cell", "_set"])

    mid = sets.select("_set", "n", "shared", "window").mapInArrow(pack, _PACKED).repartition(n, "place").mapInArrow(head, _PACKED)
    return mid.repartition(n, "place").mapInArrow(once, "cell long, _set long")


def ball_join(ids: np.ndarray, sizes: np.ndarray, labels: np.ndarray, each: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges between sets of different labels that, with the labels, connect every linked pair of one cell.

    Sets of the largest label, or of the first pivot's ball, need no comparing among themselves; every other set is compared with the sets of other labels.
    Distances to the first pivot sort the sets, so what the triangle leaves of them is a slice. Ties: smaller number first.
    """
    lens = np.array([len(h) for h in each])
    _, code, df = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
    starts = np.concatenate([[0], np.cumsum(lens)])
    common = np.add.reduceat(df[code], starts[:-1]) / sizes
    first = int(np.lexsort((ids, -common))[0])
    mark = np.zeros(len(df), bool)
    mark[code[starts[first] : starts[first + 1]]] = True
    inter = np.add.reduceat(mark[code], starts[:-1], dtype=np.int64)
    far = 1 - inter / (sizes + sizes[first] - inter)
    order = np.lexsort((ids, far))
    code = np.concatenate([code[starts[i] : starts[i + 1]] for i in order])
    ids, sizes, labels, far, starts = ids[order], sizes[order], labels[order], far[order], np.concatenate([[0], np.cumsum(lens[order])])
    _, kind = np.unique(labels, return_inverse=True)
    reach, edges = 1 - percent / 100 + 1e-9, []

    def star(x: int) -> None:
        low, high = int(np.searchsorted(far, far[x] - reach)), int(np.searchsorted(far, far[x] + reach, "right"))
        if (kind[low:high] == kind[x]).all():
            return
        mark[:] = False
        mark[code[starts[x] : starts[x + 1]]] = True
        got = np.add.reduceat(mark[code[starts[low] : starts[high]]], starts[low:high] - starts[low], dtype=np.int64)
        near = np.flatnonzero((100 * got >= percent * (sizes[low:high] + sizes[x] - got)) & (kind[low:high] != kind[x])) + low
        for other, at in zip(*np.unique(kind[near], return_index=True)):
            edges.append((int(ids[x]), int(ids[near[at]])))
        joined = np.isin(kind, np.append(kind[near], kind[x]))
        kind[joined] = major if len(near) and (kind[joined] == major).any() else kind[x]

    counts = np.bincount(kind)
    major = int(counts.argmax()) if counts.max() > 1 else int(kind[0])
    if counts.max() == 1:
        star(0)
    for x in range(len(ids)):
        if kind[x] != major:
            star(x)
    return edges


def _joined(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) inside the cells of ``rows`` (cell, _set, label), each of which fits in a task."""
    n = shuffle_partitions(rows.sparkSession)

    def run(batches):
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for b in batches:
            cell, number, label, size = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            cuts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
            for i, j in zip(cuts, np.append(cuts[1:], len(cell))):
                if held and held[0][0] != cell[i]:
                    out += _one_cell(held, percent)
                    held = []
                held += [(cell[k], number[k], label[k], size[k], np.frombuffer(b.column(4)[k].as_py(), "<u8")) for k in range(int(i), int(j))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if held and (out := _one_cell(held, percent)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    full = rows.join(sets.select("_set", "n", "hashes"), "_set").select("cell", "_set", "label", "n", "hashes")
    return full.repartition(n, "cell").sortWithinPartitions("cell", "_set").mapInArrow(run, "a long, b long")


def _one_cell(held: list[tuple], percent: int) -> list[tuple[int, int]]:
    _, ids, labels, sizes, each = zip(*held)
    if len(held) == 2:
        h = np.concatenate(each)
        h.sort()
        inter = int((h[1:] == h[:-1]).sum())
        return [(int(ids[0]), int(ids[1]))] if labels[0] != labels[1] and 100 * inter >= percent * (int(sizes[0]) + int(sizes[1]) - inter) else []
    return ball_join(np.array(ids), np.array(sizes), np.array(labels), list(each), percent)


def _to_pivots(batches, percent: int):
    """Distances of the members of each (cell, block) to its pivots, which come first."""
    at, pivots, numbers, sizes = None, [], [], []
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        rows: list[tuple] = []
        for k in range(b.num_rows):
            cell, block, role, number, size = (int(c[k]) for c in cols)
            if (cell, block) != at:
                at, pivots, numbers, sizes = (cell, block), [], [], []
            h = np.frombuffer(b.column(5)[k].as_py(), "<u8")
            if not role:
                pivots.append(h)
                numbers.append(number)
                sizes.append(size)
                continue
            inter = np.array([np.intersect1d(h, p, assume_unique=True).size for p in pivots], np.int64)
            union = np.array(sizes, np.int64) + size - inter
            rows.append((cell, number, list(numbers), (1 - inter / union).tolist(), (100 * inter >= percent * union).tolist()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())))], ["cell", "_set", "pivots", "d", "inside"])


def _cut(rows: DataFrame, sets: DataFrame, percent: int, max_sets: int, max_bytes: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Voronoi cells of regions too large for a task: the next (cell, _set, label, whole), and edges found on the way.

    ``rows``: cell, _set, label, m and w (sets and bytes of the region).
    """
    n, r = shuffle_partitions(rows.sparkSession), 1 - percent / 100
    big = written(rows.join(sets.select("_set", "n", "hashes"), "_set").withColumn("blocks", F.ceil(F.greatest(F.col("m") / max_sets, F.col("w") / max_bytes, F.lit(1.0)))), "large")
    draw = F.pmod(F.xxhash64("_set", "cell", F.lit(turn)), F.lit(1 << 40))
    least = big.groupBy("cell").agg(F.min(draw).alias("_least"))
    picked = (F.col("_draw") == F.col("_least")) | (F.col("_draw") < (1 << 40) * F.least(F.lit(64.0), 2.0 * F.col("blocks")) / F.col("m"))
    pivots = big.withColumn("_draw", draw).join(least, "cell").where(picked)
    pivots = pivots.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), "_set", "n", "hashes")
    members = big.select("cell", F.pmod(F.xxhash64("_set", F.lit(-1 - turn)), "blocks").alias("block"), F.lit(1).alias("role"), "_set", "n", "hashes")
    dealt = pivots.unionByName(members).repartition(n, "cell", "block").sortWithinPartitions("cell", "block", "role", "_set")
    dealt = written(dealt.mapInArrow(lambda batches: _to_pivots(batches, percent), "cell long, _set long, pivots array<bigint>, d array<double>, inside array<boolean>"), "dealt")
    edges = dealt.select(F.col("_set").alias("a"), F.explode(F.arrays_zip("pivots", "inside")).alias("p")).where("p.inside and p.pivots <> a").select("a", F.col("p.pivots").alias("b"))
    edges = written(edges.distinct(), "ball")
    known = big.select("cell", "_set", "label", "m", "w", (F.octet_length("hashes")).alias("bytes"))
    roots = components(edges.unionByName(known.where("label <> _set").select(F.col("_set").alias("a"), F.col("label").alias("b"))))
    tagged = dealt.join(known, ["cell", "_set"]).join(roots, "_set", "left").withColumn("label", F.coalesce("root", "_set")).drop("root")
    top = tagged.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("cell").agg(F.max(F.struct("c", "label")).alias("top"))
    tagged = tagged.join(top, "cell").withColumn("major", (F.col("top.c") > 1) & (F.col("label") == F.col("top.label"))).drop("top")
    near = F.transform(F.arrays_zip("d", "pivots"), lambda x: F.struct(x["d"].alias("d"), x["pivots"].alias("p")))
    tagged = tagged.withColumn("_near", near).withColumn("_first", F.array_min("_near"))
    targets = F.when(F.col("major"), F.array("_first.p")).otherwise(F.transform(F.filter("_near", lambda x: x["d"] <= F.col("_first.d") + 2 * r + 1e-9), lambda x: x["p"]))
    tagged = written(tagged.select("cell", "_set", "label", "m", "w", "bytes", "major", targets.alias("targets")), "tagged")
    moved = tagged.select("cell", "_set", "label", "m", "w", F.explode("targets").alias("to"))
    per = moved.groupBy("cell", "to").agg(F.count(F.lit(1)).alias("m2"), F.max("m").alias("m")).groupBy("cell").agg((F.sum("m2") <= 4 * F.max("m")).alias("lean"), (4 * F.max("m2") <= 3 * F.max("m")).alias("less"))
    per = written(per.select("cell", (F.col("lean") & F.col("less")).alias("cuts")), "cuts")
    voronoi = moved.join(per.where("cuts"), "cell").select(F.xxhash64("cell", "to", F.lit(turn)).alias("cell"), "_set", "label", F.lit(False).alias("whole"))
    dense = tagged.join(per.where("not cuts"), "cell")
    groups = lambda of: F.ceil(F.greatest(2.0 * F.sum(of.cast("long")) / max_sets, 2.0 * F.sum(F.when(of, F.col("bytes")).otherwise(0)) / max_bytes))
    count = dense.groupBy("cell").agg(groups(F.col("major")).alias("gx"), groups(~F.col("major")).alias("gy")).where("gy > 0")
    dense = dense.join(count, "cell").withColumn("i", F.pmod(F.xxhash64("_set", F.lit("block")), F.when(F.col("major"), F.col("gx")).otherwise(F.col("gy"))))
    upto = lambda g: F.when(F.col(g) > 0, F.sequence(F.lit(0).cast("long"), F.col(g) - 1)).otherwise(F.array().cast("array<bigint>"))
    name = lambda side, i, j: F.xxhash64("cell", F.lit(side), i, j)
    mixed = F.when(F.col("major"), F.transform(upto("gy"), lambda j: name("xy", F.col("i"), j))).otherwise(F.concat(F.transform(upto("gx"), lambda i: name("xy", i, F.col("i"))), F.transform(upto("gy"), lambda j: name("yy", F.least(F.col("i"), j), F.greatest(F.col("i"), j)))))
    blocks = dense.select(F.explode(F.array_distinct(mixed)).alias("cell"), "_set", "label", F.lit(True).alias("whole"))
    return voronoi.unionByName(blocks), edges


def links(cells: DataFrame, sets: DataFrame, percent: int, max_sets: int = 256, max_bytes: int = 4 << 20) -> DataFrame:
    """Edges (a, b) that connect every linked pair of sets that meet in a cell of ``cells`` (cell, _set).

    ``sets``: _set, n, shared, hashes. Cells of more than ``max_sets`` sets or ``max_bytes`` bytes of hashes are cut; no pair is left out. Empty input gives no edges.
    """
    rows, edges, turn = cells.select("cell", "_set", F.col("_set").alias("label"), F.lit(False).alias("whole")), None, 0
    while True:
        rows = written(rows, "cells")
        stats = rows.join(sets.select("_set", (8 * F.col("shared")).alias("bytes")), "_set").groupBy("cell")
        stats = stats.agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("w"), F.max("whole").alias("whole"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        stats = written(stats.where("lo <> hi").select("cell", "m", "w", (F.col("whole") | ((F.col("m") <= max_sets) & (F.col("w") <= max_bytes))).alias("fits")), "sizes")
        got = written(_joined(rows.join(stats.where("fits").select("cell"), "cell"), sets, percent), "edges")
        edges = got if edges is None else edges.unionByName(got)
        large = stats.where("not fits")
        if large.isEmpty():
            return edges
        rows, more = _cut(rows.join(large, "cell").select("cell", "_set", "label", "m", "w"), sets, percent, max_sets, max_bytes, turn)
        edges, turn = edges.unionByName(more), turn + 1


def components(edges: DataFrame) -> DataFrame:
    """_set and root (smallest set number reachable) for every set that has an edge: alternating star contraction, until only stars are left.

    Repeated edges and loops do no harm; no edges give no rows.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # a star has its smallest set in the middle: no set has two smaller neighbours, and no smaller neighbour has one
        off = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u").unionAll(e.join(e.select(F.col("v").alias("u")), "u", "left_semi").select("u"))
        if off.isEmpty():
            return e.select(F.col("u").alias("_set"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("_set"), F.col("v").alias("root")).distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        large = written(large.where("u <> v"), "large")
        least = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("w"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("w").alias("v"))
        small = written(small.where("u <> v").distinct(), "small")
        discard(e, large)
        e = small


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75, max_sets: int = 256, max_bytes: int = 4 << 20, sample: int = 1 << 14, least_hot: int = 16) -> DataFrame:
    """key, n_shingles and component_id of every row; no pair is sampled or left out. Shingles and whole sets are told apart by 64-bit hashes, so two of 10^10 sets may be taken for one.

    Words are runs of bytes other than space and \\t..\\r, with A-Z lowered. Two rows link when
    100 * |x n y| >= percent * |x u y|; component_id is the smallest key reachable. A null or wordless text has an empty set and is alone. Rows
    that repeat a key count as rows of their own and get the component of their text; an empty table gives no rows; other columns are not read.
    ``max_sets`` and ``max_bytes`` bound a region that one task joins; ``sample`` and ``least_hot`` say which shingles are dealt by shingle and set.
    No parameter but ``words`` and ``percent`` changes the result.
    """
    spark = df.sparkSession
    keep_size = lambda k: -(-k * percent // 100)
    window_size = lambda k: k - keep_size(k)
    docs = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    hot = spark.sparkContext.broadcast(hot_shingles(docs, "_text", words, sample, least_hot))
    both = written(shared_sets(docs, words, keep_size, hot), "shared")
    rows = both.where("hashes is null").select("_key", "n", "_set")
    sets = written(windowed_sets(both.where("hashes is not null"), keep_size, window_size, hot), "sets")
    roots = components(links(regions(sets, hot), sets, percent, max_sets, max_bytes))
    alone = rows.where("_set is not null").groupBy("_set").agg(F.min("_key").alias("_least")).join(roots, "_set", "left").withColumn("root", F.coalesce("root", "_set"))
    least = alone.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = written(alone.join(least, "root").select("_set", "component_id"), "components")
    discard(sets)
    out = rows.join(named, "_set", "left")
    return out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("_set").isNull(), F.col("_key")).otherwise(F.col("component_id")).alias("component_id"))
