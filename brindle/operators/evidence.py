"""Evidence by row and owner: rollups, thresholds, conflicts, verdicts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brindle.functions.measure import finite
from brindle.functions.text import overlap_ratio


def branch_key(branch: Column, owner: Column) -> Column:
    """Each retailer is a branch of its own; others go by branch."""
    return F.when(branch.isin("retailer", "retailer_group"), F.concat(F.lit("retailer:"), owner)).otherwise(F.coalesce(branch, owner, F.lit("unknown")))


def sale_status(available: Column, price: Column) -> Column:
    """An aggregate: buyable if any row is available at a price, listed if there are rows."""
    buyable = F.coalesce(F.bool_or(available & (price > 0)), F.lit(False))
    return F.when(F.count(F.lit(1)) == 0, "unknown").when(buyable, "buyable_now").otherwise("listed_unavailable")


def threshold(branch: Column, owner: Column, usable: Column, trusted: list[str]) -> Column:
    """An aggregate: a trusted branch among usable rows, or two owners."""
    return F.coalesce(F.bool_or(usable & branch.isin(trusted)), F.lit(False)) | (F.count_distinct(F.when(usable, owner)) >= 2)


def rollup(df: DataFrame, key: str, order: str, firsts: list[str], value: str, owner: str) -> DataFrame:
    """First non-null of each field in order, the sorted distinct values and the number of owners."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"first_{c}") for c in firsts]
    return df.groupBy(key).agg(*first, F.array_sort(F.collect_set(value)).alias("values"), F.count_distinct(F.when(F.col(value).isNotNull(), F.col(owner))).alias("owners"))


def observed(df: DataFrame, key: str, order: str, direct: str, per_g: str, weight: str, count: str, owner: str, source: str) -> DataFrame:
    """What a key's evidence says, rows in order: observed (the first direct strength, else one calculated), all values, their owners, the first strength by weight, and the calculation with its inputs and source.

    It is calculated, where no row states it, from the first row that has strength by weight, weight and a count above 0.
    """
    c, at = F.col, F.col(order)
    full = finite(c(per_g)) & finite(c(weight)) & finite(c(count)) & (c(count) > 0)
    stated = finite(c(direct))
    basis = F.struct(c(per_g).alias("per_g"), c(weight).alias("weight"), c(count).alias("count"), c(source).alias("source"), c(owner).alias("owner"))
    got = df.groupBy(key).agg(
        F.min_by(direct, F.when(stated, at)).alias("_direct"),
        F.array_sort(F.collect_set(F.when(stated, c(direct)))).alias("_values"),
        F.array_sort(F.collect_set(F.when(stated, c(owner)))).alias("_owners"),
        F.min_by(per_g, F.when(finite(c(per_g)), at)).alias("per_g"),
        F.min_by(basis, F.when(full, at)).alias("_basis"),
    )
    used = F.col("_direct").isNull() & F.col("_basis").isNotNull()
    result = F.col("_basis.per_g") * F.col("_basis.weight") / F.col("_basis.count")
    got = got.withColumn("calculation", F.when(used, F.struct("_basis.per_g", "_basis.weight", "_basis.count", result.alias("result"), "_basis.source")))
    owners = F.when(used & F.col("_basis.owner").isNotNull(), F.array_sort(F.array_union("_owners", F.array("_basis.owner")))).otherwise(F.col("_owners"))
    return got.select(key, F.coalesce("_direct", "calculation.result").alias("observed"), F.when(used, F.array("calculation.result")).otherwise(F.col("_values")).alias("values"), owners.alias("owners"), "per_g", "calculation")


def first_per_owner(df: DataFrame, key: str, owner: str, order: str) -> DataFrame:
    """One row for each key and owner, the first in order."""
    rest = [c for c in df.columns if c not in (key, owner)]
    got = df.groupBy(key, owner).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return got.select(*[F.col(c) if c in (key, owner) else F.col(f"_r.{c}").alias(c) for c in df.columns])


def by_owner_group(df: DataFrame, key: str, group: str, value: str, trusted: str) -> DataFrame:
    """key, values, groups, conflict, trusted, verified: more than one value from more than one group conflicts. Repeats go before anything is counted twice."""
    once = df.groupBy(key, group, value).agg(F.bool_or(F.col(trusted)).alias("_t"))
    got = once.groupBy(key).agg(F.count_distinct(value).alias("values"), F.count_distinct(group).alias("groups"), F.bool_or("_t").alias("trusted"))
    conflict = (F.col("values") > 1) & (F.col("groups") > 1)
    return got.withColumn("conflict", conflict).withColumn("verified", ~conflict & (F.col("trusted") | (F.col("groups") >= 2)))


def verdict(invalid: Column, duplicate_of: Column, conflict: Column, matched: Column, enough: Column, observed: Column, mg: Column) -> Column:
    """struct(existence, strength, decision, reason): invalid, duplicate, conflict, correction, matched, unverified in that order."""
    correction = ~conflict & enough & finite(observed) & (observed != mg)
    known = enough & finite(observed)
    return F.struct(
        F.when(invalid, "invalid").when(matched, "confirmed").otherwise("ambiguous").alias("existence"),
        F.when(invalid, "unverified").when(conflict, "conflicted").when(correction, "corrected").when(known, "verified").otherwise("unverified").alias("strength"),
        F.when(invalid | duplicate_of.isNotNull(), "remove").when(conflict, "review").otherwise("keep").alias("decision"),
        F.when(invalid, "invalid_catalog_row")
        .when(duplicate_of.isNotNull(), "exact_duplicate")
        .when(conflict, "strength_conflict")
        .when(correction, "verified_mg_correction")
        .when(matched, "matched_identity_mg_evidence_recorded")
        .otherwise("unverified_keep_conservative")
        .alias("reason"),
    )


def outcome(errors: Column, conflict: Column, verified: Column) -> Column:
    """pending unless there are no errors; then conflicted, verified, unresolved."""
    return F.when(F.size(errors) > 0, "pending").when(conflict, "conflicted").when(verified, "verified").otherwise("unresolved_after_complete_search")


def terminal_state(conflict: Column, enough: Column) -> Column:
    return F.when(conflict, "conflicted").when(enough, "verified").otherwise("exhausted_10m")


def candidate_class(exact: Column, overlap: Column, least: float = 0.5) -> Column:
    return F.when(exact, "exact_match").when(overlap >= least, "near_match").otherwise("wrong_variant")


def rolled_status(ok: Column) -> Column:
    """An aggregate over children: ok, partial or unavailable."""
    return F.when(F.bool_and(ok), "ok").when(F.bool_or(ok), "partial").otherwise("unavailable")


def top_candidates(rows: DataFrame, records: DataFrame, row: str, record: str, words: str, owner: str, least: float, k: int = 3, other: bool = False) -> DataFrame:
    """row, record, owner, score: the best record of each of the k best owners, ties to the smaller record. ``other``: a record of the row's own number does not count.

    Both sides carry distinct word arrays; rows and records with equal words are one set until the end (``set_scores``).
    """
    name = lambda c: set_name(F.col(c))
    a = rows.select(F.col(row), name(words).alias("_a"), F.col(words).alias("_need"))
    b = records.select(F.col(record).alias("_r"), F.col(owner).alias("_owner"), name(words).alias("_s"), F.col(words).alias("_have"))
    needs, haves = a.groupBy("_a").agg(F.any_value("_need").alias("_need")).where(F.size("_need") > 0), b.groupBy("_s").agg(F.any_value("_have").alias("_have"))
    scored = set_scores(needs, haves, least)
    first = b.groupBy("_s", "_owner").agg(F.min("_r").alias("_r1"))
    if other:
        second = b.join(first, ["_s", "_owner"]).where("_r <> _r1").groupBy("_s", "_owner").agg(F.min("_r").alias("_r2"))
        first = first.join(second, ["_s", "_owner"], "left").select("_s", "_owner", F.explode(F.array_compact(F.array("_r1", "_r2"))).alias("_r1"))
    entry = F.struct((-F.col("score")).alias("s"), F.col("_r1").alias("r"))
    owned = scored.join(first, "_s").select("_a", "_owner", entry.alias("_e"))
    place = F.row_number().over(Window.partitionBy("_a", "_owner").orderBy("_e"))
    owned = owned.withColumn("_n", place).where(F.col("_n") <= (2 if other else 1))
    mine = a.select(row, "_a").join(owned, "_a")
    mine = mine.where(F.col(row) != F.col("_e.r")) if other else mine
    best = mine.groupBy(row, "_owner").agg(F.min("_e").alias("_b"))
    rank = F.row_number().over(Window.partitionBy(row).orderBy("_b"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(row, F.col("_b.r").alias(record), F.col("_owner").alias(owner), (-F.col("_b.s")).alias("score"), F.col("rank").cast("long").alias("rank"))


def set_name(words: Column) -> Column:
    """A short name for a set of words: half of its SHA-256."""
    return F.unhex(F.left(F.sha2(F.array_join(F.array_sort(words), " "), 256), F.lit(32)))


def set_scores(needs: DataFrame, haves: DataFrame, least: float, most_words: int = 1_000_000) -> DataFrame:
    """_a, _s, score: the share of the words of each ``needs`` (_a, _need) that a ``haves`` (_s, _have) has, where it reaches ``least`` (above 0).

    Up to ``most_words`` words, counted first, the needs are sent to all tasks as lists of sets by word, and one pass over the haves counts what each of
    their words hits: no pair is shuffled. Beyond that sets meet by their rarest words.
    """
    size = needs.agg(F.coalesce(F.sum(F.size("_need")), F.lit(0))).first()[0]
    if size > most_words:
        return _scores_by_rare_words(needs, haves, least)
    sets = needs.select("_a", "_need").collect()
    places: dict[str, list[int]] = {}
    for i, r in enumerate(sets):
        for w in r["_need"]:
            places.setdefault(w, []).append(i)
    index = needs.sparkSession.sparkContext.broadcast(({w: np.array(p, np.int64) for w, p in places.items()}, np.array([len(r["_need"]) for r in sets], np.float64), [r["_a"] for r in sets]))
    schema = StructType([needs.schema["_a"], haves.schema["_s"], *StructType.fromDDL("score double").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lengths, names = index.value
        for b in batches:
            found: list[tuple] = []
            for s, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lists = [known[w] for w in words if w in known]
                if lists:
                    own, hits = np.unique(np.concatenate(lists), return_counts=True)
                    score = hits / lengths[own]
                    found += [(names[i], s, x) for i, x in zip(own[score >= least].tolist(), score[score >= least].tolist())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return haves.select("_s", "_have").mapInArrow(run, schema)


def _scores_by_rare_words(needs: DataFrame, haves: DataFrame, least: float) -> DataFrame:
    """A set that has ``least`` of the words lacks at most n - ceil(least * n), so it has one of the rarest n - ceil(least * n) + 1: only these are joined."""
    frequency = haves.select(F.explode("_have").alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_df"))
    ranked = needs.select("_a", F.size("_need").alias("_n"), F.explode("_need").alias("_w")).join(frequency, "_w", "left").groupBy("_a", "_n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_df", F.lit(0)).alias("d"), F.col("_w").alias("w")))).alias("_all"))
    rare = ranked.select("_a", F.explode(F.slice("_all", 1, (F.col("_n") - F.ceil(F.lit(least) * F.col("_n") - 1e-9) + 1).cast("int"))).alias("_x")).select("_a", F.col("_x.w").alias("_w"))
    pairs = rare.join(haves.select("_s", F.explode("_have").alias("_w")), "_w").select("_a", "_s").distinct()
    score = F.size(F.array_intersect("_need", "_have")) / F.size("_need")
    return pairs.join(needs, "_a").join(haves, "_s").select("_a", "_s", score.alias("score")).where(F.col("score") >= least)


def overlap(needed: Column, have: Column) -> Column:
    return overlap_ratio(needed, have)
