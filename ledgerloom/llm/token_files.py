"""Operator 1: token ids of a corpus in Simple-8b blocks, written and read by Spark.

The files are a Parquet dataset, so that any store Spark can reach takes them and a lost executor's
task is simply run again. A row is a block of whole documents: shard, block, ids of the shard before
it, doc ids, lengths, and the coded payload. Shards ascend by doc_id, and so do rows within a shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.session import shared_path

from . import simple8b
from .shared import batch, binary_rows, landed, longs, over_batches, texts_of
from .tokens import encoder

BLOCK_IDS = 1 << 17
#: Bytes of text that a shard takes, about: what a task sorts and encodes; the least number of shards, and the
#: most, beyond which shards grow: a range is sampled for each, and the sums of all shards go to every task.
SHARD_BYTES, LEAST_SHARDS, MOST_SHARDS = 32 << 20, 8, 1 << 15
BLOCKS = "shard int, block int, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, kind: str = "byte", block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs`` (doc_id, text; other columns are left out) to ``path`` in ascending doc_id order.

    Null texts count as empty and give the end id alone. A null doc_id comes first. Rows with one
    doc_id are kept, all of them, ordered by a hash of the text. An empty table gives empty files.
    """

    def blocks(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer, kind).ids
        end = np.array([end_id], "<u4").tobytes()
        shard, block, first, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids: list[int] = []
        parts: list[bytes] = []

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            return batch(
                shard=pa.array([shard], pa.int32()), block=pa.array([block], pa.int32()), first_id=longs([first]), n_ids=longs([len(ids)]),
                doc_ids=pa.array([doc_ids], pa.list_(pa.int64())), lengths=pa.array([[len(x) // 4 for x in parts]], pa.list_(pa.int64())),
                payload=binary_rows([simple8b.encode(ids)]),
            )

        for record in records:
            for doc_id, ids in zip(record.column("doc_id").to_pylist(), ids_of(texts_of(record)), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(parts[-1]) // 4
                if held >= block_ids:
                    yield row()
                    block, first, held, doc_ids, parts = block + 1, first + held, 0, [], []
        if parts:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(_shards(rows), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    coded = over_batches(ordered.select("doc_id", "text"), blocks, BLOCKS)
    # The payload hardly compresses: no codec spends time on it.
    coded.write.option("compression", "none").parquet(path)


def _shards(rows: DataFrame) -> int:
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(LEAST_SHARDS, -(-size // SHARD_BYTES)), MOST_SHARDS)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' documents: doc_id, start, n_tokens, ids_crc32 and ids (array<long>, end id included)."""
    blocks = _placed(spark, path)

    def documents(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, lengths, ids in _decoded(records):
            at = np.concatenate([[0], np.cumsum(lengths)])
            yield batch(
                doc_id=longs(doc_ids), start=longs(starts), n_tokens=longs(lengths), ids_crc32=longs(_crc(ids, at)),
                ids=pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64))),
            )

    return blocks.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_tokens``, without the ids themselves."""
    blocks = _placed(spark, path)

    def documents(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, lengths, ids in _decoded(records):
            at = np.concatenate([[0], np.cumsum(lengths)])
            yield batch(doc_id=longs(doc_ids), start=longs(starts), n_tokens=longs(lengths), ids_crc32=longs(_crc(ids, at)))

    return blocks.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``base``, the ids of all shards before.

    The sums are one row for each shard, two numbers each, ``MOST_SHARDS`` of them at most, so they go
    to the blocks. The payloads stay where they are.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = landed(sums.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base")), "shards")
    return blocks.join(F.broadcast(before), "shard").select("base", "first_id", "doc_ids", "lengths", "payload")


def _decoded(records: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    for record in records:
        for row in record.to_pylist():
            ids = simple8b.decode(row["payload"]).astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            yield row["doc_ids"], row["base"] + row["first_id"] + np.cumsum(lengths) - lengths, lengths, ids


def _crc(ids: np.ndarray, at: np.ndarray) -> list[int]:
    view = memoryview(ids).cast("B")
    return [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, as read back from its token files."""
    from .shared import table
    from .tokens import vocabulary

    path = shared_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_digest(spark, path)
