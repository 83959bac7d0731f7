"""Incremental merges of landed batch files, with a ledger of the files that have been merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.tables import unprocessed
from ledgerloom.schemas import TABLES

from . import versions
from .batches import inventory

LEDGER = TABLES["parquet_file_log"]
#: Landings whose ledger rows are kept as parts of their own, before they are put into one.
LEDGER_PARTS = 50


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The files merged so far: table_name, file_name, processed_at."""
    return versions.read(spark, folder, LEDGER.name, LEDGER.schema)


def new_files(spark: SparkSession, sources: dict[str, str], folder: str) -> DataFrame:
    """(table_name, file_name) of the files below each table's source that aren't in the ledger: what a dry run lists."""
    found = spark.createDataFrame([], "table_name string, file_name string")
    for name, path in sources.items():
        found = found.unionByName(inventory(spark, path).select(F.lit(name).alias("table_name"), F.col("path").alias("file_name")))
    return unprocessed(found, ledger(spark, folder), ["table_name", "file_name"])


def merged_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as of its last merge."""
    return versions.read(spark, folder, name, TABLES[name].schema)


def merge_new_files(spark: SparkSession, sources: dict[str, str], folder: str, now: str, buckets: int = 64) -> list[dict]:
    """Merge the new files of each table by key, and note them in the ledger; one outcome for each table.

    Tables are cut into ``buckets`` by their keys, and a landing reads and writes only those that its
    keys fall into. A table's new buckets and the ledger's new rows appear in one version: each file
    counts once, whatever step a merge stops after. A table that fails keeps its rows and its files
    stay new; the other tables go on.
    """
    todo = new_files(spark, sources, folder).collect()  # names of files, not their rows
    outcomes = []
    for name in sources:
        files = sorted(r.file_name for r in todo if r.table_name == name)
        outcome = {"table_name": name, "files": len(files), "error": None}
        outcomes.append(outcome)
        if not files:
            continue
        try:
            state = versions.latest(spark, folder)
            parts, n = versions.merged(spark.read.parquet(*files), folder, TABLES[name], state, buckets)
            noted = spark.createDataFrame([(name, x) for x in files], "table_name string, file_name string").withColumn("processed_at", F.lit(now).cast("timestamp"))
            before = state.tables.get(LEDGER.name, {})
            if len(before) >= LEDGER_PARTS:
                noted, before = versions.read(spark, folder, LEDGER.name, LEDGER.schema, state).unionByName(noted), {}
            written = versions.write_parts(noted.coalesce(1), folder, LEDGER.name)
            tables = state.tables | {LEDGER.name: before | {str(state.number + 1): written["all"]}}
            tables[name] = state.tables.get(name, {}) | parts
            versions.commit(spark, folder, versions.Version(state.number + 1, tables, state.buckets | {name: n}))
        except Exception as e:  # one table's failure is its own
            outcome["error"] = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
    return outcomes
