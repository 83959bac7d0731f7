"""Operator 9: benchmark items in documents, up to a number of edits.

An item with an error budget of k edits is cut into k + 1 pieces, so that one of them at least stays
whole in any passage within the budget. All pieces are looked for at once by an Aho-Corasick
automaton over the whole text; around each hit, Myers' bit-parallel algorithm finds the least
distance of the item to any passage there. Texts and items are lower-cased, with one blank for each
run of white space. A passage is any part of a text, whatever stands around it, and one rule holds
for items of any length: a very short one has a budget of no edits and is found within words, too.

The items are the stated query set. They reach the executors in blocks of bounded size; a larger set
takes more passes over the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import over_batches, table, texts_of

#: Edits that an item may have, as a share of its characters.
ERROR_RATE = 0.08
#: Characters of items in a block: what a broadcast and a worker's automaton hold.
BLOCK_CHARS = 2_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, rate: float = ERROR_RATE) -> list[tuple[int, str]]:
    """(place, piece): the item cut evenly into one piece more than its budget."""
    k = budget(item, rate) + 1
    cuts = [len(item) * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def least_distance(pattern: str, text: str) -> tuple[int, int]:
    """Myers' algorithm: the least edit distance of ``pattern`` to any substring of ``text``, and where the first such ends."""
    m = len(pattern)
    all_, top = (1 << m) - 1, 1 << (m - 1)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    up, down, score, best, end = all_, 0, m, m, 0
    for j, c in enumerate(text):
        eq = equal.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (all_ & ~(xh | up)), up & xh
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & all_, (minus << 1) & all_
        up, down = minus | (all_ & ~(xv | plus)), plus & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """The automaton of a block of items, (item_id, normal text) pairs."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = items
        self.budgets = [budget(x, rate) for _, x in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            for at, piece in pieces(item, rate):
                places.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) in the normal text; one for each place where an item's hits cluster."""
        if not self.any:
            return []
        windows: dict[int, list[list[int]]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for k, at in where:
                start = last + 1 - length - at
                slack, size = self.budgets[k], len(self.items[k][1])
                low, high = max(0, start - slack), min(len(text), start + size + slack)
                if high - low < size - slack:
                    continue
                mine = windows.setdefault(k, [])
                # Windows that start near each other are one; a piece's text may also stand elsewhere in its item, so hits of other windows may lie between.
                for window in reversed(mine):
                    if abs(low - window[0]) <= 2 * slack:
                        window[0], window[1] = min(window[0], low), max(window[1], high)
                        break
                    if window[1] + size + 2 * slack < low:  # windows before it are farther still, or nearly so: a new one loses nothing
                        mine.append([low, high])
                        break
                else:
                    mine.append([low, high])
        out = []
        for k, mine in windows.items():
            item_id, item = self.items[k]
            for low, high in mine:
                distance, end = least_distance(item, text[low:high])
                if distance > self.budgets[k]:
                    continue
                _, back = least_distance(item[::-1], text[low : low + end][::-1])
                out.append((item_id, distance, low + end - back, low + end))
        return sorted(set(out), key=lambda x: (x[2], x[0]))


_matchers: dict[str, Matcher] = {}

MATCHES = T.ArrayType(
    T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def with_matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (a text and any other columns) with ``matches``: item_id, distance, start, end of each passage found.

    Null texts are empty and match nothing. Items that are null or have no word are left out; items
    that are alike match alike, each under its own id. The count of blocks follows the items' size.
    """
    spark = docs.sparkSession
    items = benchmark.where(F.trim("text") != "").select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    out = docs.drop("matches")
    names = out.columns
    out = out.withColumn("matches", F.lit(None).cast(MATCHES))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        block = sorted({(r.item_id, text) for r in rows if (text := normal(r.text))}, key=lambda x: (x[0] is not None, x))
        shared = spark.sparkContext.broadcast(block)

        def found(records: Iterator[pa.RecordBatch], shared=shared, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            if name not in _matchers:  # one automaton for each Python worker and block
                _matchers.clear()
                _matchers[name] = Matcher(shared.value, rate)
            matcher = _matchers[name]
            for record in records:
                before = record.column("matches").to_pylist()
                now = [[*(old or ()), *({"item_id": a, "distance": b, "start": c, "end": d} for a, b, c, d in matcher.matches(normal(text)))]
                       for old, text in zip(before, texts_of(record), strict=True)]
                yield pa.RecordBatch.from_arrays([*(record.column(x) for x in names), pa.array(now, _ARROW)], names=[*names, "matches"])

        out = over_batches(out, found, out.schema)
    return out


def op9_edit_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each passage of a document that is a benchmark item within its budget of edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.distance", "m.start", "m.end")
