"""Operator 8: best-fit decreasing packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import batch, landed, longs, over_batches, table, texts_of
from .tokens import encoder, vocabulary

SEQUENCE_TOKENS = 4096
#: Pieces that one task packs. Each task ends with about one sequence that isn't full, one in
#: thousands, so packing the groups apart costs next to nothing.
GROUP_PIECES = 1 << 17


class OpenBins:
    """A segment tree over remaining capacities: how many bins are open below each node.

    Leaf ``c`` counts the bins with exactly ``c`` tokens left; ``tightest(n)`` walks down to the
    least capacity that is ``n`` or more and has a bin, in logarithmic time.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, left: int, which: int) -> None:
        self.bins[left].append(which)
        node = left + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """(capacity left, bin), taken out of the tree, or None if nothing fits."""
        count, node = self.count, need + self.size
        if not count[node]:
            # Up to the first right-hand sibling that has a bin, then down its left-most side.
            while True:
                while node & 1:
                    node >>= 1
                    if node <= 1:
                        return None
                if count[node + 1]:
                    node += 1
                    break
                node >>= 1
                if node <= 1:
                    return None
            while node < self.size:
                node *= 2
                if not count[node]:
                    node += 1
        left = node - self.size
        which = self.bins[left].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return left, which


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each length, longest first, and the number of bins."""
    bins, offsets, opened = [0] * len(lengths), [0] * len(lengths), 0
    tree = OpenBins(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.tightest(lengths[i])
        if found is None:
            found = (capacity, opened)
            opened += 1
        left, bins[i] = found
        offsets[i] = capacity - left
        if left > lengths[i]:
            tree.put(left - lengths[i], bins[i])
    return bins, offsets, opened


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, kind: str = "word") -> DataFrame:
    """Each document's ids and the end id; longer ones in pieces of ``capacity``. Null texts are empty."""

    def pieces(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer, kind).ids
        end = np.array([end_id], "<u4").tobytes()
        for record in records:
            rows: list[tuple] = []
            for doc_id, ids in zip(record.column("doc_id").to_pylist(), ids_of(texts_of(record)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            a, b, c, d, e = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield batch(doc_id=longs(a), piece=pa.array(b, pa.int32()), start=longs(c), length=longs(d), ids_crc32=longs(e))

    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), pieces, PIECES)


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns, with length from 1 to ``capacity``) with sequence_id and offset.

    Pieces are dealt evenly into groups of about ``group_pieces`` rows, whatever their keys, and
    each group is packed by best-fit decreasing in one task. The number of sequences is within one
    a group of what packing each group needs. An empty table gives an empty result.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packed(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(records)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        bins, offsets, _ = best_fit(rows.column("length").to_pylist(), capacity)
        ids = np.array(bins, np.int64) + (TaskContext.get().partitionId() << 32)
        yield from rows.append_column("sequence_id", longs(ids)).append_column("offset", longs(offsets)).combine_chunks().to_batches()

    return pieces.repartition(groups).mapInArrow(packed, schema)


def packed_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(landed(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity, group_pieces)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
