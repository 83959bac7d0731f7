"""Operator 11: documents mixed to target weights of their sources, by words.

Sources share a budget of words by weight; none takes more than a multiple of what it has. Whole
passes over a source come first; the rest of its target is a subset-sum problem over the counts of
its documents of each exact size: sizes take their share, rounded from the longest down with the
difference handed on, but for a reserve; a bounded-knapsack dynamic programme then picks, from the
documents left, those that come nearest to what is missing. Which documents of a size go is told by
a seeded hash of doc_id and text.

Rows are ranged by source, size and hash, so that the documents of one source, or of one size, lie
in many tasks; sizes are counted before anything is shuffled. A source's counts meet in one task:
a row for each distinct size, of which n words allow the square root of 2 n at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.operators.scoring import placed

from .shared import RANGE_BITS, in_order, landed, table

#: Words of a target that are left to the dynamic programme; its table has four times as many places at most.
RESERVE = 1 << 14
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``target`` of each row of ``sources`` (source, source_size): its words in the mix.

    Sources by code point, null last, have the weights in turn. What is above ``most`` times a
    source's size is shared again by weight among the others until none is above; each round is one
    sum over the sources, of which the driver gets a row.
    """
    given = landed(placed(sources, [F.asc_nulls_last("source")], "place"), "sources")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    given = given.select("source", "source_size", turn.alias("weight"), (F.col("source_size") * most).alias("limit"))
    level, before = 0.0, -1
    while True:
        full = F.col("limit") < F.lit(level) * F.col("weight")
        sums = given.agg(
            F.sum("source_size").alias("size"), F.count_if(full).alias("n_full"),
            F.sum(F.when(full, F.col("limit")).otherwise(0)).alias("taken"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if sums["n_full"] == before or not sums["weight"]:
            break
        before = sums["n_full"]
        level = (share * sums["size"] - sums["taken"]) / sums["weight"]
    target = F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight"))
    return given.select("source", "source_size", target.alias("target"))


def nearest(sizes: np.ndarray, counts: np.ndarray, budget: float, seed: int) -> np.ndarray:
    """How many documents of each size, of ``counts`` at most, have a sum nearest to ``budget``; the lesser of two.

    Sums of sizes up to the budget are found size by size, in an order drawn by ``seed``, and end
    once no sum can be nearer. A larger size can only be right alone.
    """
    taken = np.zeros(len(sizes), np.int64)
    if budget <= 0:
        return taken
    top, best = int(2 * budget), abs(round(budget) - budget)
    usable = np.flatnonzero((counts > 0) & (sizes > 0) & (sizes <= budget))
    usable = np.random.default_rng(seed).permutation(usable)
    # step: the place in ``usable`` of the size that first reached a sum, its last document being one of that size.
    step = np.full(top + 1 if len(usable) else 1, -1, np.int64)
    reached = np.zeros(len(step), bool)
    reached[0] = True
    for k, i in enumerate(usable):
        size, ahead = int(sizes[i]), reached.copy()
        for _ in range(int(min(counts[i], top // size))):
            new = ahead[:-size] & ~reached[size:]
            if not new.any():
                break
            step[size:][new] = k
            reached[size:] |= new
            ahead = np.zeros(len(step), bool)
            ahead[size:] = new
        if round(budget) <= top and reached[round(budget)]:
            break
    sums = np.flatnonzero(reached)
    total = int(sums[np.argmin(np.abs(sums - budget))])
    larger = np.flatnonzero((counts > 0) & (sizes > budget))
    if len(larger) and abs(total - budget) > best:
        alone = larger[np.argmin(sizes[larger])]
        if sizes[alone] - budget < abs(total - budget):
            taken[alone] = 1
            return taken
    while total:
        i = usable[step[total]]
        taken[i] += 1
        total -= int(sizes[i])
    return taken


def fitted(sizes: np.ndarray, counts: np.ndarray, budget: float, seed: int = 0, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each size are taken so that their words come to about ``budget``."""
    total = int((sizes * counts).sum())
    taken = np.zeros(len(sizes), np.int64)
    if not total or budget <= 0:
        return taken
    share = max(0.0, min(1.0, (budget - reserve) / total))
    ahead = 0.0
    if share:
        for i in np.argsort(-sizes).tolist():
            if size := int(sizes[i]):
                want = int(counts[i]) * share * size + ahead
                taken[i] = min(max(round(want / size), 0), int(counts[i]))
                ahead = want - int(taken[i]) * size
    return taken + nearest(sizes, counts - taken, budget - int((taken * sizes).sum()), seed)


QUOTAS = "source string, size long, passes long, chosen long, source_size long, target double"


def quotas(lengths: DataFrame, seed: int = 0, reserve: int = RESERVE) -> DataFrame:
    """Whole passes and the number of chosen documents for each row of (source, size, n, source_size, target)."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", kind="stable")
        sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = int(target // total) if total else 0
        chosen = fitted(sizes, counts, target - passes * total, seed, reserve)
        return group.assign(passes=passes, chosen=chosen)[[x.split()[0] for x in QUOTAS.split(", ")]]

    return lengths.groupBy("source").applyInPandas(fit, QUOTAS)


def same(left: str, right: str, names: Sequence[str]) -> Column:
    found = F.lit(True)
    for name in names:
        found = found & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return found


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 11, reserve: int = RESERVE) -> DataFrame:
    """For every row of ``docs`` (doc_id, text, source): its size in words, its source's size and
    target, how many times it is in the mix (``copies``) and the words that come of that (``taken``).

    Null texts have no words and are never taken; null sources are one source; a table without words
    takes nothing; rows that repeat, or share a doc_id, are documents of their own, and as many of
    rows alike in all are taken as of others; further columns, whatever their names, are left out; an
    empty table gives an empty one. Reruns, however rows are dealt out, take the same documents, but
    that of rows alike in doc_id and text any may stand for the other.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"), F.monotonically_increasing_id().alias("tie"),
    )
    rows = in_order(landed(sized, "sizes"), [F.asc_nulls_last("source"), F.col("size"), F.col("draw"), F.col("tie")], "at")
    of_range = F.shiftright("at", RANGE_BITS)
    counts = landed(rows.groupBy("source", "size", of_range.alias("range")).agg(F.count("*").alias("n"), F.min("at").alias("first")), "counts")
    lengths = landed(counts.groupBy("source", "size").agg(F.sum("n").alias("n")), "lengths")
    totals = lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    wanted = landed(targets(totals, weights, share, most), "targets")
    both = lengths.alias("a").join(wanted.alias("b"), same("a", "b", ["source"])).select("a.*", "source_size", "target")
    quota = landed(quotas(both, seed, reserve), "quotas")
    # A size's chosen documents are its first ones: they end in the range that the count falls into.
    before = F.sum("n").over(W.partitionBy("source", "size").orderBy("range")) - F.col("n")
    ends = counts.withColumn("before", before).alias("a").join(quota.alias("b"), same("a", "b", ["source", "size"]))
    ends = ends.where("chosen > before AND chosen <= before + n OR chosen = 0 AND before = 0")
    ends = landed(ends.select("b.*", (F.col("first") + F.col("chosen") - F.col("before")).alias("end")), "ends")
    found = rows.alias("a").join(ends.alias("b"), same("a", "b", ["source", "size"]))
    copies = F.when(F.col("a.size") > 0, F.col("passes") + (F.col("at") < F.col("end")).cast("long")).otherwise(0)
    found = found.select("doc_id", "a.source", "a.size", "source_size", "target", copies.alias("copies"))
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
