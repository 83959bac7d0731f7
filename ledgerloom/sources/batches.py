"""Parquet batches of tables: written once, read by name, listed, checked and published."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalars import batch_id_of_file
from ledgerloom.operators.tables import keep_one, newest_first, swap_guard, with_keys
from ledgerloom.schemas import TABLES, TableSpec
from ledgerloom.session import shared_path

from . import versions
from .versions import Version, commit, file_system, names, rename_new

#: The name under which versions of a folder keep its batches, and that of a table replaced as a whole.
BATCHES, WHOLE = "batches", "table"


def batch_paths(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Where each batch of a folder lies, below it: where it was landed, or where the newest version has it
    since it was written again or restricted. None if the folder holds no batches but plain files."""
    landed = {x.removeprefix("batch_id="): x for x in names(spark, path) if x.startswith("batch_id=")}
    changed = versions.latest(spark, path).tables.get(BATCHES, {})
    return {k: x for k, x in (landed | changed).items() if x} if landed or changed else None


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """All batches of a table under one folder, with the declared columns."""
    paths = batch_paths(spark, path)
    if paths is None:
        return spark.read.schema(spec.schema).option("recursiveFileLookup", "true").parquet(path)
    return spark.read.schema(spec.schema).parquet(*(f"{path}/{x}" for x in paths.values())) if paths else spark.createDataFrame([], spec.schema)


def read_batches(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """As ``read_table``, with the batch_id of each row."""
    rows = read_table(spark, path, spec)
    if not rows.inputFiles():
        return rows.withColumn("batch_id", F.lit(None).cast("string"))
    return rows.select("*", batch_id_of_file("_metadata.file_path").alias("batch_id"))


def prepared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns with its types; what can't be cast is null, what isn't there is null."""
    return df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema))


class BatchMismatch(ValueError):
    """What was read back of a batch isn't what was to be written."""


class RuleBroken(ValueError):
    """Rows of a batch break a rule; ``broken`` has how many for each."""

    def __init__(self, message: str, broken: dict[str, int]):
        super().__init__(message)
        self.broken = broken


def spec_rules(spec: TableSpec) -> dict[str, Column]:
    """What every row of a table must meet: its key parts and required columns are there."""
    return {f"{x} null": F.col(x).isNull() for x in dict.fromkeys((*spec.keys, *spec.required))}


def append_batch(df: DataFrame, path: str, spec: TableSpec, batch_id: str, rules: dict[str, Column] | None = None) -> int:
    """Write one batch under its own id and return its rows; an empty one writes nothing.

    Rows are counted, and those that break a rule (name to a test that finds them), while they are
    written, beside the table: no second scan. Written files are counted once more by what they say
    of themselves. If a rule is broken or the counts differ, what was written goes, and
    ``RuleBroken`` or ``BatchMismatch`` is raised; otherwise the batch takes its place as a whole, by
    one rename, or by a new version of the folder if the batch is there already, which it replaces.
    """
    spark = df.sparkSession
    out = prepared(df, spec)
    staged = f"{path}-staging/batch_id={batch_id}-{uuid.uuid4().hex}"
    counted = Observation(f"batch-{uuid.uuid4().hex}")
    tests = {f"rule_{i}": F.count_if(F.coalesce(bad, F.lit(False))) for i, bad in enumerate((rules or {}).values())}
    versions.step("stage a batch")
    out.observe(counted, F.count("*").alias("n"), *(x.alias(name) for name, x in tests.items())).write.parquet(staged)
    found = counted.get
    broken = {name: n for i, name in enumerate(rules or {}) if (n := found[f"rule_{i}"])}
    seen = found["n"]
    read = spark.read.schema(spec.schema).parquet(staged).count()
    if broken or read != seen or not seen:
        rollback(spark, staged)
        if broken:
            raise RuleBroken(f"{spec.name}, batch {batch_id}: {broken}", broken)
        if read != seen:
            raise BatchMismatch(f"{spec.name}, batch {batch_id}: {seen} rows written, {read} read")
        return 0
    there = batch_paths(spark, path)
    now = versions.latest(spark, path)
    if (there and batch_id in there) or batch_id in now.tables.get(BATCHES, {}):
        system, folder = file_system(spark, f"{path}/data")
        system.mkdirs(folder)
        place = f"data/{uuid.uuid4().hex}-batch_id={batch_id}"
        versions.step("move a batch")
        rename_new(spark, staged, f"{path}/{place}")
        commit(spark, path, Version(now.number + 1, now.tables | {BATCHES: now.tables.get(BATCHES, {}) | {batch_id: place}}, now.buckets))
    else:
        system, folder = file_system(spark, path)
        system.mkdirs(folder)
        versions.step("move a batch")
        rename_new(spark, staged, f"{path}/batch_id={batch_id}")
    return read


def rollback(spark: SparkSession, *paths: str) -> None:
    """Take written batches away again."""
    for path in paths:
        system, where = file_system(spark, path)
        system.delete(where, True)


#: How rows alike by key are settled in one batch: these tables keep every different row, others one for each key.
BY_WHOLE_ROW = ("tickers", "former_names")


def settled(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A batch without rows that lack a key part, and without repeats by its table's rule: whole rows, or the last of each key."""
    whole = with_keys(df, spec.required or spec.keys)
    return whole.distinct() if spec.name in BY_WHOLE_ROW else keep_one(whole, list(spec.keys), newest_first(spec.order), spec.nocase)


def fan_out(rows: dict[str, DataFrame], folder: str, batch_id: str) -> dict[str, int]:
    """Write the frames of one parse to their tables, settled; if one fails, the batch goes from all of them."""
    written: dict[str, int] = {}
    try:
        for name, df in rows.items():
            written[name] = append_batch(settled(prepared(df, TABLES[name]), TABLES[name]), f"{folder}/{name}", TABLES[name], batch_id)
    except Exception:
        for name in written:
            rollback(df.sparkSession, f"{folder}/{name}/batch_id={batch_id}")
        raise
    return written


def write_by_date(
    df: DataFrame, path: str, column: str = "filed_date", partitions: int | None = None, lookups: Sequence[str] = (), group_bytes: int | None = None
) -> None:
    """Sorted by ranges of a date, so that readers of a range skip most row groups by their least and greatest.

    Columns of ``lookups`` get Bloom filters: readers of one value, of a column that isn't sorted, skip
    the row groups that can't have it. ``group_bytes`` sets the size of a row group.
    """
    dealt = df.repartitionByRange(partitions, column) if partitions else df.repartitionByRange(column)
    out = dealt.sortWithinPartitions(column).write.mode("overwrite")
    for name in lookups:
        out = out.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if group_bytes:
        out = out.option("parquet.block.size", str(group_bytes)).option("parquet.page.size.row.check.min", "100")
    out.parquet(path)


def bucket_count(rows: int, each: int = 500_000) -> int:
    """Buckets for so many rows: eight at least, and of about ``each`` rows, so that a task's share stays the same however large a table is."""
    return max(8, -(-rows // each))


def stored_in_buckets(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Land ``df`` in buckets of its keys, sorted within them: tables of the same keys and as many buckets join without a shuffle.

    Rows are dealt out by bucket first, so that a bucket is one file. The table's name is its own in
    the session's catalogue; its files lie in the shared folder.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    out = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    out.option("path", shared_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def write_failures(df: DataFrame, path: str) -> None:
    df.select("ticker", "error").write.mode("overwrite").option("sep", "\t").csv(path)


def processed_ciks(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, TABLES["companies"]).select("cik").where("cik IS NOT NULL").distinct()


def processed_filings(filings: DataFrame) -> DataFrame:
    """Accession numbers of each company."""
    return filings.dropna(subset=["cik", "accession_number"]).groupBy("cik").agg(F.collect_set("accession_number").alias("accession_numbers"))


def inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below a folder, without reading them: table, file, batch_id, length, modified."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    parts = F.split(F.col("path"), "/")
    return files.select(
        F.element_at(parts, -2).alias("table"), F.element_at(parts, -1).alias("file"), batch_id_of_file("path").alias("batch_id"), "length",
        F.col("modificationTime").alias("modified"), "path",
    )


def table_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("table").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def partial_batches(files: DataFrame, now: Column, age_hours: int = 24, least_files: int = 3) -> DataFrame:
    """Batches older than the cutoff with too few files. They are only listed."""
    groups = files.where("batch_id <> ''").groupBy("batch_id").agg(F.count("*").alias("files"), F.max("modified").alias("modified"))
    return groups.where((F.col("modified") < now - F.expr(f"INTERVAL {int(age_hours)} HOURS")) & (F.col("files") < least_files))


def batch_ids(files: DataFrame) -> DataFrame:
    return files.where("batch_id <> ''").select("batch_id").distinct()


def directory_report(spark: SparkSession, path: str) -> DataFrame:
    """Of the Parquet files below a folder: all, those that can be read (without rows, too), the others, and all rows;
    ``errors`` has a line for each file that can't be read, by its path."""
    return file_report(spark, path).agg(
        F.count("*").alias("files"), F.count_if(F.col("error").isNull()).alias("valid"), F.count("error").alias("invalid"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.concat(F.lit("Invalid file "), "file", F.lit(": "), "error")))).alias("errors"),
    )


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """Each Parquet file below a folder: path, file, n_rows, error (null if the file can be read).

    A row is counted if a reader finds it. Files that give none are told apart by their footers, each
    read where it lies by the task that has its name. Names of files reach the driver, as they do for
    any read; rows and footers don't.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").schema("_any string").parquet(path)
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count("*").alias("n_rows"))
    plain = lambda c: F.regexp_replace(F.col(c), "^[a-z0-9]+:/*", "/")
    index = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    # The reader's own list of files: files of no length have no row in it.
    places = spark.createDataFrame([(x,) for x in index.inputFiles()], "place string")
    listed = places.select("place", plain("place").alias("path"), F.element_at(F.split("place", "/"), -1).alias("file"))
    joined = listed.join(by_file.select(plain("p").alias("path"), "n_rows"), "path", "left")

    def footers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for frame in frames:
            errors = []
            for place, n in zip(frame["place"], frame["n_rows"], strict=True):
                error = None
                if n != n or n is None:  # no row came of it
                    try:
                        system, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", place))
                        pq.ParquetFile(system.open_input_file(where))
                    except Exception as e:
                        error = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
                errors.append(error)
            yield frame.drop(columns="place").assign(n_rows=frame["n_rows"].fillna(0).astype("int64"), error=errors)

    return joined.mapInPandas(footers, "path string, file string, n_rows bigint, error string")


def publish(df: DataFrame, folder: str, version: str, existing: DataFrame | None = None, keys: list[str] | None = None) -> str | None:
    """Write a new version of a table beside the old; its path, or None if the guard holds it back.

    Readers move to the path as a whole, so they see the old table or the new one.
    """
    if df.isEmpty():
        return None
    if existing is not None and not swap_guard(existing, df, keys).first().may_swap:
        return None
    path = f"{folder}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a table by what a query gives; ``replaced`` reads it. The query may read the table itself.

    Readers see the old rows or the new, whatever step this stops after.
    """
    return versions.publish({WHOLE: df}, path)


def replaced(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return versions.read(spark, path, WHOLE, schema)


def restrict_batches(spark: SparkSession, path: str, spec: TableSpec, universe: DataFrame, key: str = "cik") -> list[str]:
    """Take the rows whose key isn't in ``universe`` out of the stored batches; a batch without others goes.

    Only batches that have such rows are written anew, all at once by a new version of the folder.
    Returns their ids.
    """
    known = universe.select(key).distinct()
    stored = read_batches(spark, path, spec)
    lost = sorted(r.batch_id for r in stored.join(known, key, "left_anti").select("batch_id").distinct().collect())  # names of batches
    if not lost:
        return []
    now = versions.latest(spark, path)
    rest = stored.where(F.col("batch_id").isin(lost)).join(known, key, "left_semi")
    parts = versions.write_parts(rest.select(*spec.columns, "batch_id"), path, BATCHES, F.col("batch_id"))
    batches = now.tables.get(BATCHES, {}) | dict.fromkeys(lost, "") | parts
    commit(spark, path, Version(now.number + 1, now.tables | {BATCHES: batches}, now.buckets))
    return lost


def rebuild(tables: dict[str, DataFrame], folder: str, main: list[str]) -> int | None:
    """All tables of a build in one version, whose number is returned; nothing is written if all main inputs are empty.

    Readers ask for the newest version, so they see all tables of the old build or all of the new one.
    """
    return None if all(tables[name].isEmpty() for name in main) else versions.publish(tables, folder)


def current(spark: SparkSession, folder: str) -> int | None:
    """The number of a folder's newest version, or None before the first build."""
    return versions.latest(spark, folder).number or None
