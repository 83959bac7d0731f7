"""New batch files as a stream: each file counts once, merged by key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.tables import keep_one, newest_first
from ledgerloom.schemas import TableSpec
from ledgerloom.sources.versions import file_system, names, rename_new, step


def arrivals(spark: SparkSession, path: str, spec: TableSpec, files_at_once: int | None = None) -> DataFrame:
    """A stream of the rows of new files; the checkpoint is the ledger of those already read.

    ``files_at_once`` flushes by size: a micro-batch takes so many files at most.
    """
    reader = spark.readStream.schema(spec.schema).option("recursiveFileLookup", "true")
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(path)


def merged_stream(stream: DataFrame, folder: str, spec: TableSpec, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write each micro-batch, one row for each key, as a delta of its own; ``merged`` reads the table.

    A micro-batch costs what it holds, however large the table is, and one that runs again after a
    failure writes the same delta again. ``every`` ("10 seconds") flushes by time and goes on; without
    it the stream stops when nothing is left.
    """

    def write(batch: DataFrame, number: int) -> None:
        keep_one(batch, list(spec.keys), newest_first(spec.order)).write.mode("overwrite").parquet(f"{folder}/delta={number}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _numbers(spark: SparkSession, folder: str) -> tuple[int | None, list[int]]:
    """The newest compacted base, and the deltas after it."""
    found = names(spark, folder)
    base = max((int(x[5:]) for x in found if x.startswith("base=")), default=None)
    return base, sorted(n for x in found if x.startswith("delta=") and (n := int(x[6:])) > (-1 if base is None else base))


def merged(spark: SparkSession, folder: str, spec: TableSpec) -> DataFrame:
    """The table that the deltas make: of each key the row of the last delta, whenever it came.

    A compacted base counts as the delta that it goes up to.
    """
    base, deltas = _numbers(spark, folder)
    paths = [f"{folder}/delta={n}" for n in deltas] + ([] if base is None else [f"{folder}/base={base}"])
    if not paths:
        return spark.createDataFrame([], spec.schema)
    number = F.regexp_extract("_metadata.file_path", "/(?:delta|base)=([0-9]+)/", 1).cast("long")
    rows = spark.read.schema(spec.schema).parquet(*paths).select("*", number.alias("_delta"))
    return keep_one(rows, list(spec.keys), [F.col("_delta"), *newest_first(spec.order)]).select(*spec.columns)


def compact(spark: SparkSession, folder: str, spec: TableSpec) -> int | None:
    """Put all deltas so far into a base that goes up to the last of them; its number, None if there is nothing.

    The base is written aside and gets its name by one rename; from then on readers leave out the
    deltas that it holds, which go after that. Whatever step this stops after, readers see every row.
    """
    base, deltas = _numbers(spark, folder)
    last = deltas[-1] if deltas else base
    if deltas:
        aside = f"{folder}/compacting-{uuid.uuid4().hex}"
        step("write a base")
        merged(spark, folder, spec).write.parquet(aside)
        step("name a base")
        rename_new(spark, aside, f"{folder}/base={last}")
    for name in names(spark, folder):  # what an earlier run that stopped has left, too
        kind, _, number = name.partition("=")
        if kind == "delta" and int(number) <= last or kind == "base" and int(number) < last or kind.startswith("compacting-"):
            step(f"remove a {kind}")
            system, where = file_system(spark, f"{folder}/{name}")
            system.delete(where, True)
    return last


def append_once(stream: DataFrame, path: str, checkpoint: str, keys: list[str], event_time: str, delay: str = "1 day") -> StreamingQuery:
    """For feeds that only append: a key's first row, while state for it is held.

    The watermark lies ``delay`` behind the greatest event time of earlier micro-batches. Rows older
    than it go, late ones that aren't stay, and repeats of a key within the delay go; what is
    remembered of a key is forgotten once the watermark has passed it, so the state is bounded by the
    keys of one delay.
    """
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counters(stream: DataFrame, event_time: str, success: str, delay: str = "1 day") -> DataFrame:
    """Attempts and successes of each day, closed by the watermark."""
    days = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, "1 day"))
    counts = days.agg(F.count("*").alias("attempted"), F.count_if(F.expr(success)).alias("fetched"))
    return counts.select(F.to_date("window.start").alias("fetch_date"), "attempted", "fetched")
