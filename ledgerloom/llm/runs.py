"""Operator 12: runs, stretches of words that repeat with a period, and texts without the repeats.

Each document is one row and is looked at whole. Words are numbered; Ukkonen suffix trees of the
words and of their reversal, with Euler tours and constant-time least ancestors, say how far two
places agree to the right and to the left. By the runs theorem every run starts a longest Lyndon
word, under the order of the words or the reversed order, at some place; these n words at most in
either order are the candidates, and each is extended both ways.

A run of 12 words or more with a period of half its length or less holds, at each of its first
words but for the last, a window of six words that comes again one period later, and such windows
cover it. So only stretches covered by windows that come twice in the same stretch are put into the
trees; what is left out can't be part of a run. The trees take memory in proportion to those
stretches of one document.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import batch, longs, over_batches, splitmix, table, texts_of

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 12, 2
#: A run of LEAST_WORDS words has a window of so many that comes again a period later.
WINDOW = LEAST_WORDS // LEAST_PERIODS
#: Rounds of narrowing before the trees are built; more would only leave less to do.
ROUNDS = 8
#: Entries of an Euler tour that share a row of the table of least depths.
ROW = 16
SENTINEL = 0
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Least:
    """Least of any stretch of an array in constant time: rows of 16, and powers of two of rows."""

    def __init__(self, values: np.ndarray):
        rows = -(-len(values) // ROW)
        padded = np.full(rows * ROW, np.iinfo(np.int64).max)
        padded[: len(values)] = values
        self.rows = padded.reshape(rows, ROW)
        self.head = np.minimum.accumulate(self.rows, axis=1)
        self.tail = np.minimum.accumulate(self.rows[:, ::-1], axis=1)[:, ::-1]
        levels = [self.head[:, -1]]
        while (step := 1 << (len(levels) - 1)) * 2 <= rows:
            wider = levels[0].copy()  # places past the end are never asked for
            wider[: rows - step] = np.minimum(levels[-1][: rows - step], levels[-1][step:])
            levels.append(wider)
        self.levels = np.stack(levels)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of each stretch, both ends included; ``first`` <= ``last``."""
        p, q = first // ROW, last // ROW
        out = np.minimum(self.tail[p, first % ROW], self.head[q, last % ROW])
        far = q - p > 1
        if far.any():
            a, b = p[far] + 1, q[far]
            level = np.frexp((b - a).astype(float))[1] - 1
            out[far] = np.minimum(out[far], np.minimum(self.levels[level, a], self.levels[level, b - (1 << level)]))
        same = p == q
        if same.any():
            at = np.arange(ROW)
            outside = (at < (first[same] % ROW)[:, None]) | (at > (last[same] % ROW)[:, None])
            out[same] = np.where(outside, np.iinfo(np.int64).max, self.rows[p[same]]).min(axis=1)
        return out


def ukkonen(s: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix tree of ``s``, whose last number is its own: for each node its parent, the first
    number on the edge to it, its depth in numbers, and the suffix that it ends (-1: inner nodes)."""
    n, width = len(s), max(s) + 1
    child: dict[int, int] = {}
    start, stop, link, depth, suffix = [0], [0], [0], [0], [-1]
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        waiting = 0  # an inner node made in this phase that has no link yet
        while rest:
            if not length:
                edge = i
            key = node * width + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i), stop.append(n), link.append(0), depth.append(n - (i - rest + 1)), suffix.append(i - rest + 1)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                size = stop[below] - start[below]
                if length >= size:
                    node, edge, length = below, edge + size, length - size
                    continue
                at = start[below] + length
                if s[at] == c:
                    if waiting:
                        link[waiting] = node
                    length += 1
                    break
                split = len(start)
                child[key] = split
                start.append(start[below]), stop.append(at), link.append(0), depth.append(rest - 1), suffix.append(-1)
                child[split * width + c] = split + 1
                start.append(i), stop.append(n), link.append(0), depth.append(n - (i - rest + 1)), suffix.append(i - rest + 1)
                start[below] = at
                child[split * width + s[at]] = below
                if waiting:
                    link[waiting] = split
                waiting = split
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    parent, symbol = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    parent[nodes], symbol[nodes] = keys // width, keys % width
    return parent, symbol, np.array(depth, np.int64), np.array(suffix, np.int64)


class Agreement:
    """How far the suffixes at two places agree, and the suffixes' ranks under both orders of the numbers."""

    def __init__(self, s: list[int]):
        parent, symbol, depth, suffix = ukkonen(s)
        m = len(parent)
        downwards = np.argsort(depth, kind="stable")
        size, up, down = [1] * m, parent.tolist(), downwards.tolist()
        for v in reversed(down[1:]):
            size[up[v]] += size[v]
        sizes = np.array(size, np.int64)
        # Nodes that come before a node among the children of its parent, in either order; the end comes first in both.
        order = np.lexsort((symbol[1:], parent[1:])) + 1
        ahead = np.cumsum(sizes[order]) - sizes[order]
        opens = np.flatnonzero(np.r_[True, parent[order][1:] != parent[order][:-1]])
        ahead -= np.repeat(ahead[opens], np.diff(np.r_[opens, len(order)]))
        ends = np.zeros(m, np.int64)
        ends[parent[1:][symbol[1:] == SENTINEL]] = 1
        before, behind = np.zeros(m, np.int64), np.zeros(m, np.int64)
        before[order] = ahead
        behind[order] = np.where(symbol[order] == SENTINEL, 0, sizes[parent[order]] - 1 - ahead - sizes[order] + ends[parent[order]])
        place, turned, level = [0] * m, [0] * m, [0] * m
        ahead_of, behind_of = before.tolist(), behind.tolist()
        for v in down[1:]:
            u = up[v]
            level[v] = level[u] + 1
            place[v] = place[u] + 1 + ahead_of[v]
            turned[v] = turned[u] + 1 + behind_of[v]
        first = 2 * np.array(place, np.int64) - np.array(level, np.int64)
        # The Euler tour has a node when it is entered, and again after each of its children.
        tour = np.zeros(2 * m - 1, np.int64)
        tour[first] = depth
        tour[(first + 2 * sizes - 1)[1:]] = depth[parent[1:]]
        self.least = Least(tour)
        leaves = np.flatnonzero(suffix >= 0)
        self.first = np.empty(len(s), np.int64)
        self.first[suffix[leaves]] = first[leaves]
        self.ranks = []
        for placed in (place, turned):
            rank = np.empty(len(s), np.int64)
            rank[suffix[leaves]] = np.array(placed, np.int64)[leaves]
            self.ranks.append(rank)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.first[i], self.first[j]
        return self.least.of(np.minimum(a, b), np.maximum(a, b))


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next suffix of a lower rank."""
    ranks = rank.tolist()
    n = len(ranks) - 1  # the last suffix is the end alone, the least of all
    after = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        mine, j = ranks[i], i + 1
        while ranks[j] > mine:
            j = after[j]
        after[i] = j
    return np.array(after[:n], np.int64) - np.arange(n)


def runs_in(numbers: np.ndarray, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs in an array of numbers, by start, then period."""
    n = len(numbers)
    if n < LEAST_PERIODS:
        return np.empty((0, 3), np.int64)
    symbols = np.unique(numbers, return_inverse=True)[1] + 1
    right = Agreement([*symbols.tolist(), SENTINEL])
    candidates = [np.arange(n) * (n + 1) + lyndon_lengths(rank) for rank in right.ranks]
    start, period = np.divmod(np.unique(np.concatenate(candidates)), n + 1)
    fits = period * LEAST_PERIODS <= n
    start, period = start[fits], period[fits]
    to_right = right.of(start, start + period)
    del right
    left = Agreement([*symbols[::-1].tolist(), SENTINEL])
    to_left = left.of(n - start, n - start - period)
    length = to_left + period + to_right
    good = length >= np.maximum(least_words, LEAST_PERIODS * period)
    found = np.stack([start - to_left, length, period], axis=1)[good]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(numbers: np.ndarray, part: np.ndarray) -> np.ndarray:
    """``part`` with -1 wherever a word can't be in a run; parts are stretches of words, -1 between them.

    A word stays while some window over it comes twice in its part, round by round.
    """
    part = part.copy()
    for _ in range(ROUNDS):
        at = np.flatnonzero(part[: max(0, len(part) - WINDOW + 1)] >= 0)
        at = at[part[at] == part[at + WINDOW - 1]]
        mixed = part[at].astype(np.uint64)
        for k in range(WINDOW):
            mixed = mixed * FACTOR + numbers[at + k].astype(np.uint64)
        mixed = splitmix(mixed)
        order = np.argsort(mixed)
        twice = mixed[order][1:] == mixed[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][twice]] = again[order[:-1][twice]] = True
        cover = np.zeros(len(part) + 1, np.int64)
        cover[at[again]] += 1
        cover[at[again] + WINDOW] -= 1
        covered = np.cumsum(cover[:-1]) > 0
        if covered.sum() == (part >= 0).sum():
            break
        opens = covered & ~np.r_[False, covered[:-1]]
        part = np.where(covered, np.cumsum(opens), -1)
        if not covered.any():
            break
    return part


#: Changes a document's words before runs are looked for: (doc_id, number of words) to the places of the words to read.
Rule = Callable[[object, int], np.ndarray | None]


def _look(records: Iterator[pa.RecordBatch], rule: Rule | None) -> Iterator[pa.RecordBatch]:
    for record in records:
        numbered: defaultdict[bytes, int] = defaultdict()
        numbered.default_factory = numbered.__len__
        words, numbers, places = [], [], [0]
        for doc_id, text in zip(record.column("doc_id").to_pylist(), texts_of(record), strict=True):
            own = text.encode().split()
            mine = np.fromiter(map(numbered.__getitem__, own), np.int64, len(own))
            if rule is not None and (read := rule(doc_id, len(own))) is not None:
                own, mine = [own[k] for k in read.tolist()], mine[read]
            words.append(own)
            numbers.append(np.r_[mine, -1])  # a place between documents
            places.append(places[-1] + len(own) + 1)
        joined = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        part = np.repeat(np.arange(len(words)), np.diff(places))
        part[np.array(places[1:], np.int64) - 1] = -1
        part = stretches(joined, part)
        runs, texts = [], []
        for k, own in enumerate(words):
            found, kept = _of_document(joined[places[k] : places[k + 1] - 1], part[places[k] : places[k + 1] - 1])
            runs.append([{"start": a, "length": b, "period": q} for a, b, q in found.tolist()])
            if len(found):
                own = [own[i] for i in np.flatnonzero(kept).tolist()]
            texts.append(b" ".join(own).decode())
        yield batch(
            doc_id=record.column("doc_id"), n_words=longs([len(x) for x in words]),
            runs=pa.array(runs, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))), collapsed=pa.array(texts, pa.string()),
        )


def _of_document(numbers: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one document and which words stay: all but those of runs after their first period."""
    kept = np.ones(len(numbers), bool)
    at = np.flatnonzero(part >= 0)
    if not len(at):
        return np.empty((0, 3), np.int64), kept
    # The stretches one after another, a number of its own between each two: no run crosses it.
    new = np.r_[False, part[at][1:] != part[at][:-1]]
    shift = np.cumsum(new)
    merged = np.empty(len(at) + shift[-1], np.int64)
    origin = np.full(len(merged), -1, np.int64)
    origin[np.arange(len(at)) + shift] = at
    merged[origin >= 0] = numbers[at]
    merged[origin < 0] = numbers.max() + 1 + np.arange(shift[-1])
    found = runs_in(merged)
    found[:, 0] = origin[found[:, 0]]
    gone = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return found, np.cumsum(gone[:-1]) == 0


def runs(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length and period in
    words, by start, then period) and collapsed, the words that stay joined by one space.

    Words are what ASCII white space parts. A word goes if a run holds it after the run's first
    period. Null texts have no words; rows that repeat or share a doc_id come back each for itself;
    further columns, whatever their names, are left out; an empty table gives an empty one. Texts
    are read whole: nothing is windowed.
    """
    given = docs.select(F.col("doc_id"), F.col("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return over_batches(
        given, partial(_look, rule=rule),
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def digests(found: DataFrame) -> DataFrame:
    """What ``runs`` has found in the columns of the registered query: counts, the longest run, digests."""

    def before(x: Column, y: Column) -> Column:
        key = lambda r: F.struct(-r["length"], r["start"], r["period"])
        return F.when(key(x) < key(y), -1).otherwise(1)

    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))))
    longest = F.try_element_at(F.array_sort("runs", before), F.lit(1))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"longest.{x}").alias(x) for x in ("start", "length", "period")),
        F.expr("1000 * longest.length DIV longest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The registered query's rule: by a checksum of doc_id, a tenth of the documents repeat one period to their end."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    read = np.arange(n)
    read[a:] = a + (read[a:] - a) % p
    return read


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(runs(table(spark, sf_dir, "documents"), planted))
