"""Operator 2: the similarity join of whole texts as sets of word n-grams, by chosen paths.

A set is sketched by minima of hash functions, its coordinates. From a root, a node of a run samples
coordinates by a hash of its path, and sets that agree on a sampled coordinate go on together: a
pair of similarity s shares the fraction s of its coordinates, so at 1 / threshold samples a node a
pair at the threshold is expected to stay together in one child of every node. Small buckets are
compared by brute force; sets of a large one that are alike anyway are tied to a pivot and compared
with the others, which are split on. Runs repeat until the target recall. What holds together by
sketches forms candidate groups, and within a group all pairs are compared exactly, tile by tile.
A tie by coordinates counts only if finer sketches of the two sets verify it: sets that share a
template but aren't alike don't run together into groups that grow with the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Forest, batch, binary_rows, connected, landed, longs, over_batches, splitmix, table, texts_of

N_WORDS, SIMILARITY, RECALL = 5, 0.8, 0.99
COORDINATES = 64
#: Ranges of hash values, of each of which a sketch has one byte more, by its least value: what ties are verified by.
BINS = 512
WORDS = COORDINATES + BINS // 4
#: Standard errors below the similarity at which the bytes of two sets still verify a tie.
DEVIATIONS = 4
#: Buckets of up to so many sets are compared by brute force; those of up to so many are split on
#: within a task, in about a megabyte of memory, larger ones by Spark.
LEAF, GATHER = 40, 2000
#: A tile of the exact comparison holds two blocks of up to about so many sets and n-grams each.
TILE_SETS, TILE_GRAMS = 256, 1 << 20


def least_equal(similarity: float) -> int:
    """Coordinates that sketches share at least to tie two sets: three standard errors below ``similarity``."""
    return math.ceil((similarity - 3 * math.sqrt(similarity * (1 - similarity) / COORDINATES)) * COORDINATES)


_FACTORS = splitmix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table_, have = np.ones(size, np.uint64), 1
            factor = np.uint64(base)
            with np.errstate(over="ignore"):
                while have < size:
                    table_[have : 2 * have] = table_[:have] * factor
                    have *= 2
                    factor = factor * factor
            _powers[k:k + 1] = [table_]
    return _powers[0], _powers[1]


def shingles(text: str, words: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's lower-cased word n-grams.

    A text with fewer words has one n-gram, all of it; one without words has none.
    """
    plain = " ".join(text.lower().split()).encode()
    if not plain:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(plain, np.uint8)
    powers, inverse = _power_tables(len(codes) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[: len(codes)], dtype=np.uint64)])
        blanks = np.nonzero(codes == 32)[0]
        starts = np.concatenate([[0], blanks + 1])
        ends = np.concatenate([blanks, [len(codes)]])
        n = min(words, len(starts))
        starts, ends = starts[: len(starts) - n + 1], ends[n - 1 :]
        return np.unique(splitmix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))


def sketch(grams: np.ndarray) -> np.ndarray:
    """The coordinates of a set (for each hash function, the least value, cut to 32 bits), and its bytes."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(grams), 1024):
            least = np.minimum(least, (grams[at : at + 1024, None] * _FACTORS).min(0))
    return np.concatenate([(least >> np.uint64(32)).astype("<u4"), _bytes(grams).view("<u4")])


_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)


def _bytes(grams: np.ndarray) -> np.ndarray:
    """A byte for each range of the sorted hashes: 1 to 255 by the least of them, 0 if there is none."""
    at = np.searchsorted(grams, _EDGES)
    full = np.append(at[1:], len(grams)) > at
    out = np.zeros(BINS, np.uint8)
    out[full] = grams[at[full]] % np.uint64(255) + np.uint64(1)
    return out


def verified(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the bytes of rows ``i`` of the sketches ``a`` and ``j`` of ``b`` let them be of that similarity.

    Of the ranges in which either set has a value, alike sets have the same least value in about the
    share of their similarity; other sets tie once in some millions of pairs at two thirds of it.
    """
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 4096):
        x, y = (np.ascontiguousarray(v[k[at : at + 4096], COORDINATES:]).view(np.uint8) for v, k in ((a, i), (b, j)))
        either = np.count_nonzero(x | y, axis=1)
        equal = np.count_nonzero((x == y) & (x != 0), axis=1)
        out[at : at + 4096] = equal >= similarity * either - DEVIATIONS * np.sqrt(similarity * (1 - similarity) * either)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, tie (a hash of the text), key (a 128-bit digest of the set, null if it has no word), n_grams and sketch of each text."""

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            sets = [shingles(text) for text in texts_of(record)]
            yield batch(
                doc_id=record.column("doc_id"), tie=record.column("tie"), key=binary_rows([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]),
                n_grams=longs([len(x) for x in sets]), sketch=binary_rows([sketch(x).tobytes() if len(x) else None for x in sets]),
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return over_batches(texts, rows, "doc_id long, tie long, key binary, n_grams long, sketch binary")


def runs_for(recall: float, depth: int = 3) -> int:
    """Runs that find a pair at the threshold with probability ``recall`` if it parts by ``depth`` splits."""
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-found)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def _coordinates(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(n, WORDS)


def _children(paths: np.ndarray, values: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) for each coordinate that a row's node samples: 1 / ``similarity`` on average, one at least."""
    with np.errstate(over="ignore"):
        draw = splitmix(paths[:, None] ^ splitmix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1 << 20)))
        chosen = draw < np.uint64(int(2**64 / (similarity * COORDINATES)))
        chosen[np.arange(len(paths)), draw.argmin(1)] = True
        row, at = np.nonzero(chosen)
        return row, splitmix(paths[row] ^ splitmix(values[row, at].astype(np.uint64) | (at.astype(np.uint64) << np.uint64(32))))


def _roots(runs: int, similarity: float):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            ids = record.column("rep").to_numpy()
            values = _coordinates(record.column("sketch"), len(ids))
            for run in range(runs):
                row, path = _children(np.full(len(ids), splitmix(np.array([run + 1], np.uint64))[0]), values, similarity)
                yield batch(path=longs(path.view(np.int64)), rep=longs(ids[row]))

    return rows


def in_reach(equal: np.ndarray, tied: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of tied and of other sets that can be alike, from how many coordinates each shares with the pivot.

    Unequal coordinates are a metric: alike sets differ in no more than ``COORDINATES - least``
    of what they share with the pivot.
    """
    apart = COORDINATES - least
    if tied.all() or not tied.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.nonzero(tied & (equal <= equal[~tied].max() + apart))[0], np.nonzero(~tied & (equal >= equal[tied].min() - apart))[0]


def partners(a: np.ndarray, b: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """(i, j): for each row j of the sketches ``b`` that is alike to any row of ``a``, the first such row i."""
    step, least = max(1, 2_000_000 // max(1, len(a))), least_equal(similarity)
    for at in range(0, len(b) if len(a) else 0, step):
        part = b[at : at + step]
        equal = np.zeros((len(part), len(a)), np.uint8)
        for c in range(COORDINATES):
            equal += part[:, c, None] == a[None, :, c]
        alike = equal >= least
        todo = np.nonzero(alike.any(1))[0]
        while len(todo):  # the first of each row; those that it isn't go on to their next
            first = alike[todo].argmax(1)
            fine = verified(a, first, part, todo, similarity)
            yield from zip(first[fine].tolist(), (at + todo[fine]).tolist(), strict=True)
            alike[todo, first] = False
            todo = todo[~fine]
            todo = todo[alike[todo].any(1)]


def _ties(path: int, ids: np.ndarray, values: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Edges of a bucket that is too large to compare by brute force: the rest of its recursion."""
    least, todo = least_equal(similarity), [(np.uint64(path), np.arange(len(ids)))]
    while todo:
        path, rows = todo.pop()
        if len(rows) <= LEAF:
            own = values[rows]
            alike = (own[:, None, :COORDINATES] == own[None, :, :COORDINATES]).sum(2) >= least
            forest, (left, right) = Forest(len(rows)), np.nonzero(np.triu(alike, 1))
            fine = verified(own, left, own, right, similarity)
            for i, j in zip(left[fine].tolist(), right[fine].tolist(), strict=True):
                forest.join(i, j)
            for i in range(len(rows)):
                if (first := forest.root(i)) != i:
                    yield ids[rows[first]], ids[rows[i]]
            continue
        pivot = rows[splitmix(ids[rows].view(np.uint64) ^ path).argmin()]
        equal = (values[rows][:, :COORDINATES] == values[pivot][:COORDINATES]).sum(1)
        tied = equal >= least
        tied[tied] = verified(values, rows[tied], values, np.full(tied.sum(), pivot), similarity)
        for i in rows[tied].tolist():
            yield ids[pivot], ids[i]
        on = rows[~tied]
        # What leaves is compared with what stays, or pairs of which one set only is tied would be parted.
        near, far = in_reach(equal, tied, least)
        yield from ((ids[rows[near[i]]], ids[rows[far[j]]]) for i, j in partners(values[rows[near]], values[rows[far]], similarity))
        if len(on) > 1:
            row, child = _children(np.full(len(on), path), values[on], similarity)
            order = np.argsort(child, kind="stable")
            starts = np.nonzero(np.concatenate([[True], child[order][1:] != child[order][:-1]]))[0]
            for part in np.split(order, starts[1:]):
                if len(part) > 1:
                    todo.append((child[part[0]], on[row[part]]))


def _bucket_edges(similarity: float):
    """Edges that tie the alike sets of each bucket; rows come sorted by path, of GATHER rows at most each."""
    least = least_equal(similarity)

    def edges(paths: np.ndarray, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        starts = np.nonzero(np.concatenate([[True], paths[1:] != paths[:-1]]))[0]
        sizes = np.diff(np.concatenate([starts, [len(paths)]]))
        found: list[tuple[int, int]] = []
        for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
            part = slice(start, start + size)
            found += _ties(paths[start : start + 1].view(np.uint64)[0], ids[part], values[part], similarity)
        few = np.repeat(sizes <= LEAF, sizes)
        paths, ids, values = paths[few], ids[few], values[few]
        forest = Forest(len(ids))
        for step in range(1, len(ids)):
            near = np.nonzero(paths[step:] == paths[:-step])[0]
            if not len(near):
                break
            for at in range(0, len(near), 4096):
                part = near[at : at + 4096]
                part = part[(values[part, :COORDINATES] == values[part + step, :COORDINATES]).sum(1) >= least]
                for i in part[verified(values, part, values, part + step, similarity)].tolist():
                    forest.join(i, i + step)
        # Every set hangs on the first of its bucket that it is tied to: stars need no further rounds.
        for i in range(len(ids)):
            if (first := forest.root(i)) != i:
                found.append((ids[first], ids[i]))
        # A worker's buckets tell the same pairs again and again.
        pairs = np.array([x for x in set(found) if x[0] != x[1]], np.int64).reshape(-1, 2)
        return batch(a=longs(pairs[:, 0]), b=longs(pairs[:, 1]))

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        for record in records:
            now = (record.column("path").to_numpy(), record.column("rep").to_numpy(), _coordinates(record.column("sketch"), record.num_rows))
            now = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last bucket may go on in the next batch
            if cut:
                yield edges(*(x[:cut] for x in now))
            held = tuple(x[cut:] for x in now)
        if held is not None and len(held[0]):
            yield edges(*held)

    return rows


def _split(similarity: float):
    """Rows of large buckets: an edge to the pivot if alike (``kind`` 0), else children (1).

    What is tied to a pivot needs no further splits of this bucket: the group that it is in is
    compared as a whole. It is (2) still compared with those sets of the bucket that go on and (3)
    may be alike to it, by what both share with the pivot (``c``).
    """
    least = least_equal(similarity)
    apart = COORDINATES - least

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            n = record.num_rows
            ids, paths, values = record.column("rep").to_numpy(), record.column("path").to_numpy(), _coordinates(record.column("sketch"), n)
            pivots = _coordinates(record.column("pivot_sketch"), n)
            equal = (values[:, :COORDINATES] == pivots[:, :COORDINATES]).sum(1).astype(np.int64)
            alike, every = equal >= least, np.arange(n)
            alike[alike] = verified(values, every[alike], pivots, every[alike], similarity)
            tied, on = every[alike], every[~alike]
            # Sets equal to the pivot in all of the sketch have no partner that isn't tied.
            near, far = tied[(values[tied] != pivots[tied]).any(1)], on[equal[on] >= least - apart]
            parts = [(0, ids[tied], record.column("pivot").to_numpy()[tied], equal[tied]), (2, paths[near], ids[near], equal[near]), (3, paths[far], ids[far], equal[far])]
            if len(on):
                row, path = _children(paths[on].view(np.uint64), values[on], similarity)
                parts.append((1, path.view(np.int64), ids[on][row], np.zeros(len(row), np.int64)))
            yield batch(
                kind=longs(np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in parts])), **{name: longs(np.concatenate([x[k] for x in parts])) for k, name in ((1, "a"), (2, "b"), (3, "c"))}
            )

    return rows


def _side_edges(similarity: float):
    """Edges from tied sets (``kind`` 2) to others (3) of each tile; rows come sorted by tile."""

    def edges(ids: np.ndarray, kinds: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        near, far = np.nonzero(kinds == 2)[0], np.nonzero(kinds == 3)[0]
        found = np.array([(ids[near[i]], ids[far[j]]) for i, j in partners(values[near], values[far], similarity)], np.int64).reshape(-1, 2)
        return batch(a=longs(found[:, 0]), b=longs(found[:, 1]))

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for record in records:
            tiles = np.stack([record.column(c).to_numpy() for c in ("path", "x", "y")], 1)
            now = [tiles, record.column("rep").to_numpy(), record.column("kind").to_numpy(), _coordinates(record.column("sketch"), record.num_rows)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            cuts = np.nonzero((now[0][1:] != now[0][:-1]).any(1))[0] + 1
            for start, end in zip([0, *cuts.tolist()], cuts.tolist(), strict=False):
                yield edges(*(x[start:end] for x in now[1:]))
            held = [x[cuts[-1] if len(cuts) else 0 :] for x in now]  # the last tile may go on in the next batch
        if held is not None and len(held[0]):
            yield edges(*held[1:])

    return rows


def side_edges(sides: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """(a, b): ties of what left large buckets with what stayed, from rows (kind, path, rep, c), by tiles."""
    apart = COORDINATES - least_equal(similarity)
    near, far = F.col("kind") == 2, F.col("kind") == 3
    reach = sides.groupBy("path").agg(F.min(F.when(near, F.col("c"))).alias("low"), F.max(F.when(far, F.col("c"))).alias("high"))
    reach = landed(reach.where("low IS NOT NULL AND high IS NOT NULL"), "reach")
    within = landed(sides.join(reach, "path").where((near & (F.col("c") <= F.col("high") + apart)) | (far & (F.col("c") >= F.col("low") - apart))).select("kind", "path", "rep"), "within")
    sizes = within.groupBy("path").agg(F.ceil(F.sum(F.when(near, 1).otherwise(0)) / GATHER).alias("xs"), F.ceil(F.sum(F.when(far, 1).otherwise(0)) / GATHER).alias("ys"))
    sizes = landed(sizes.where("xs > 0 AND ys > 0"), "sides")
    place = F.xxhash64("rep", "path")
    x, y = F.pmod(place, F.col("xs")), F.pmod(place, F.col("ys"))
    tiled = within.join(sizes, "path")
    tiled = tiled.where(near).select("path", x.alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ys") - 1)).alias("y"), "rep", "kind").unionByName(
        tiled.where(far).select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("xs") - 1)).alias("x"), y.alias("y"), "rep", "kind")
    )
    keys = ["path", "x", "y"]
    whole = tiled.join(reps, "rep").select(*keys, "rep", "kind", "sketch").repartition(*keys).sortWithinPartitions(*keys, "kind", "rep")
    return whole.mapInArrow(_side_edges(similarity), "a long, b long")


def candidate_edges(reps: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(a, b): ties between sets (rep, sketch) that sketches put in one candidate group."""
    rows = landed(reps.mapInArrow(_roots(runs_for(recall), similarity), "path long, rep long"), "paths")
    edges: list[DataFrame] = []
    small: DataFrame | None = None
    while True:
        # Landed, so that the joins below can split a path that very many sets share.
        buckets = landed(
            rows.groupBy("path").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep", "path")).alias("pivot")).where("n > 1"), "buckets"
        )
        found = rows.join(buckets.where(F.col("n") <= GATHER).select("path"), "path")
        small = found if small is None else small.unionByName(found)
        large = buckets.where(F.col("n") > GATHER)
        if large.isEmpty():
            break
        pivots = landed(
            large.join(reps.select(F.col("rep").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot").dropDuplicates(["path"]), "pivots"
        )
        parts = landed(rows.join(pivots, "path").join(reps, "rep").mapInArrow(_split(similarity), "kind long, a long, b long, c long"), "split")
        edges.append(parts.where("kind = 0").select("a", "b"))
        edges.append(side_edges(parts.where("kind > 1").select("kind", F.col("a").alias("path"), F.col("b").alias("rep"), "c"), reps, similarity))
        rows = parts.where("kind = 1").select(F.col("a").alias("path"), F.col("b").alias("rep"))
    # The buckets of all levels that a task can hold; paths of different levels don't meet.
    members = small.join(reps, "rep").select("path", "rep", "sketch")
    out = members.repartition("path").sortWithinPartitions("path", "rep").mapInArrow(_bucket_edges(similarity), "a long, b long")
    for more in edges:
        out = out.unionByName(more)
    return out.distinct()


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each pair of sets shares."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    if m <= 4:
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]]))
    often = np.bincount(column)[column] > 1
    owner, column = owner[often], column[often]
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        for low in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            part = np.zeros((m, 4096), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            out += (part @ part.T).astype(np.int64)
    return out


def _compare(similarity: float):
    """Exact links of each tile: (kind 0) the number of a set's links, (kind 1) edges that join what is linked."""

    def tile(ids: list[int], sides: list[int], grams: list[bytes]) -> Iterator[tuple[int, int, int]]:
        first = {x: k for k, x in reversed(list(enumerate(ids)))}  # rows of a table may repeat
        chosen = sorted(first.values())
        ids, sides = [ids[k] for k in chosen], np.array([sides[k] for k in chosen])
        sets = [np.frombuffer(grams[k], "<u8") for k in chosen]
        if len(sets) < 2:
            return
        shared = common(sets)
        sizes = np.array([len(x) for x in sets])
        linked = shared >= similarity * (sizes[:, None] + sizes - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if sides.min() != sides.max():  # pairs within a block are another tile's
            linked &= sides[:, None] != sides
        for x, n in zip(ids, linked.sum(1).tolist(), strict=True):
            if n:
                yield 0, x, n
        seen = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            if seen[i]:
                continue
            seen[i] = True
            front = np.array([i])
            while len(front):
                new = np.nonzero(linked[front].any(0) & ~seen)[0]
                seen[new] = True
                for j in new.tolist():
                    yield 1, ids[i], ids[j]
                front = new

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for record in records:
            out: list[tuple[int, int, int]] = []
            for row in zip(*(record.column(c).to_pylist() for c in ("root", "x", "y", "rep", "side", "grams")), strict=True):
                if held and row[:3] != held[0][:3]:
                    out += tile([r[3] for r in held], [r[4] for r in held], [r[5] for r in held])
                    held = []
                held.append(row)
            yield batch(**{name: longs([r[k] for r in out]) for k, name in enumerate(("kind", "a", "b"))})
        if held:
            out = list(tile([r[3] for r in held], [r[4] for r in held], [r[5] for r in held]))
            yield batch(**{name: longs([r[k] for r in out]) for k, name in enumerate(("kind", "a", "b"))})

    return rows


def _grams(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for record in records:
        grams = [shingles(x) for x in texts_of(record)]
        yield batch(rep=record.column("rep"), root=record.column("root"), blocks=record.column("blocks"), grams=binary_rows([x.astype("<u8").tobytes() for x in grams]))


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``near_duplicates`` with tie, a hash of the text, and class, a number of the class of its own."""
    # Sets and rows are known by numbers that are landed with them: doc_ids may be null or come again.
    all_rows = landed(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    filled = all_rows.where("key IS NOT NULL")
    sets = landed(
        filled.groupBy("key").agg(F.min("row").alias("rep"), F.count("*").alias("n_copies"), F.min("doc_id").alias("least"), F.min("n_grams").alias("n_grams")), "sets"
    )
    reps = landed(all_rows.join(sets.select("rep"), F.col("row") == F.col("rep")).select("rep", "sketch"), "reps")
    groups = landed(connected(candidate_edges(reps, similarity, recall), "groups"), "groups")
    # A group of more than a tile is dealt into blocks by its sets and n-grams; each pair of blocks is a tile.
    members = groups.select(F.col("node").alias("rep"), "root").join(sets.select("rep", "n_grams"), "rep")
    sizes = landed(members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / TILE_SETS), F.ceil(F.sum("n_grams") / TILE_GRAMS)).cast("int").alias("blocks")), "sizes")
    members = landed(members.join(sizes, "root").select("rep", "root", "blocks"), "members")
    # One row with its text for each set that is in a group.
    wanted = members.join(all_rows.select(F.col("row").alias("rep"), "doc_id", "tie"), "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc_id"), F.xxhash64("text").alias("_tie"), "text")
    texts = texts.join(wanted, (F.col("_tie") == F.col("tie")) & F.col("_doc_id").eqNullSafe(F.col("doc_id")))
    grams = over_batches(texts.select("rep", "root", "blocks", "text"), _grams, "rep long, root long, blocks int, grams binary")
    tiled = (
        grams.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("root", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "rep", "side", "grams")
    )
    keys = ["root", "x", "y"]
    compared = tiled.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(_compare(similarity), "kind long, a long, b long")
    found = landed(compared, "links")
    links = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("n_links"))
    linked = connected(found.where("kind = 1").select("a", "b"), "classes").select(F.col("node").alias("rep"), "root")
    known = landed(
        sets.join(links, "rep", "left").join(linked, "rep", "left").select(
            "key", "least", F.coalesce("root", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies"
        ), "known",
    )
    first = landed(known.groupBy("class").agg(F.min("least").alias("class_id")), "first")
    known = landed(known.join(first, "class").drop("least"), "classes")
    usual = filled.select("doc_id", "tie", "key").join(known, "key").select("doc_id", "tie", "class", "class_id", "n_links", "n_copies")
    apart = all_rows.where("key IS NULL").select(
        "doc_id", "tie", F.col("row").alias("class"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies")
    )
    return usual.unionByName(apart)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, class_id, n_links, n_copies.

    ``class_id`` is the least doc_id among all that links and equal sets connect; ``n_links`` counts
    the other sets (texts with different n-grams) at ``similarity`` or more; ``n_copies`` the rows
    with the same set, this one included. Texts without words (null, empty) are alike to nothing:
    a class of their own. Rows that share a doc_id are apart unless their texts are alike, and a
    null doc_id takes part like any other: its class_id is null only where all of the class are.
    Texts are read whole, however long; other columns are left out; an empty table gives an empty one.
    """
    return classes(docs, similarity, recall).select("doc_id", "class_id", "n_links", "n_copies")


def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
