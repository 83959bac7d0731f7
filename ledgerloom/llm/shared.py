"""Helpers that the operators share: tables in the shared folder, Arrow batches and union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import shared_path

#: Rows of whole texts that a Python worker has in hand at once.
TEXT_BATCH_ROWS = 1000


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    This cuts the lineage: later steps read the files, whichever executors are lost meanwhile.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a number given by ``in_order`` that count rows within a range.
RANGE_BITS = 33


def in_order(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``name``: longs that rise in the order ``by``, landed; its bits above RANGE_BITS number the range of the row.

    Rows are dealt out by ranges of the order, so no task holds more than a range, whatever they
    have in common; where rows may be alike in all of ``by``, a column that tells them apart belongs
    to it. ``df`` should be landed, as its rows are sampled first.
    """
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return landed(ranged.withColumn(name, F.monotonically_increasing_id()), "ordered")


def over_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` in which ``function`` sees few enough whole texts at once.

    Spark bounds the bytes of a batch; here its rows are bounded, too, by what a worker makes of them.
    """

    def few(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            if record.num_rows <= TEXT_BATCH_ROWS:
                yield record
            else:
                for at in range(0, record.num_rows, TEXT_BATCH_ROWS):
                    yield record.slice(at, TEXT_BATCH_ROWS)

    return df.mapInArrow(lambda records: function(few(records)), schema)


def batch(**columns: pa.Array | list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns)
    )


def texts_of(record: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts; null counts as empty."""
    return [x or "" for x in record.column(column).to_pylist()]


def binary_rows(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def longs(values: object) -> pa.Array:
    return pa.array(values, type=pa.int64())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def set_aside(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with every column but those of ``used`` under a name by its place, which no operator
    gives, and a function that brings the old names and their order back, further columns of a result last."""
    names = [c if c in used else f"further_column_{k}" for k, c in enumerate(docs.columns)]

    def back(df: DataFrame, *more: str) -> DataFrame:
        return df.select(*names, *more).toDF(*docs.columns, *more)

    return docs.toDF(*names), back


class Forest:
    """Union-find over dense integers; the smallest member is the root."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """True if the two were apart."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) longs: (node, root), root the smallest node of the component.

    Alternating large-star and small-star steps; each round is written to the shared folder, and
    rounds end when every node hangs on one root. Both steps tell the neighbours of a node its
    smallest neighbour by joins with grouped minima, never by a list, so a hub stays distributed;
    the minima are landed, so that both sides of a join have exchanges of their own and Spark can
    split the rows of a hub.
    """
    now = landed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    while not _stars(now):
        # Large star: each larger neighbour of a node is tied to the smallest of its neighbours and itself.
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = landed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = landed(large.where("a <> b").distinct(), name)
        # Small star: each smaller neighbour and the node itself are tied to the smallest of them.
        smallest = landed(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = (
            large.join(smallest, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(smallest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = landed(small, name)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(edges: DataFrame) -> bool:
    """Does every node hang on one root that hangs on nothing? Edges are distinct, larger node first."""
    ends = edges.groupBy("a").agg(F.count("*").alias("n")).unionByName(edges.select(F.col("b").alias("a")).distinct().withColumn("n", F.lit(1).cast("long")))
    return ends.groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").isEmpty()


def splitmix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
