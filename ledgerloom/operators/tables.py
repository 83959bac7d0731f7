"""Keeping one row for each key, merging batches, and guarding what is published."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import iso_date
from ledgerloom.schemas import TableSpec


def newest_first(order: list[str] | tuple[str, ...]) -> list[Column]:
    """What ``keep_one`` compares: of several rows that with the greatest of these, null least."""
    return [F.col(c) for c in order]


def keep_one(df: DataFrame, keys: list[str], greatest: list[Column] | None = None, nocase: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: that with the ``greatest`` values, ties broken by all columns, so that a
    winner doesn't depend on how rows are dealt out. Null is less than any value, and null keys are a key.

    Rows are compared where they are before any are dealt out by key: a key that very many rows have
    is one row of each task by then.
    """
    by = [(F.lower(F.col(k)) if k in nocase else F.col(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
    if re.search(r"\b(map<|variant)", df.schema.simpleString()):  # such columns have no order: they go along
        comparable = [f.name for f in df.schema if not re.search(r"\b(map<|variant)", f.dataType.simpleString())]
        best = F.max_by(F.struct(*df.columns), F.struct(*(x.alias(f"_{i}") for i, x in enumerate([*(greatest or []), *map(F.col, comparable)]))))
        return df.groupBy(*by).agg(best.alias("_row")).select("_row.*")
    row = F.struct(*(x.alias(f"_{i}") for i, x in enumerate(greatest or [])), F.struct(*df.columns).alias("row"))
    return df.groupBy(*by).agg(F.max(row).alias("_best")).select("_best.row.*")


def keep_latest(df: DataFrame, spec: TableSpec) -> DataFrame:
    return keep_one(df, list(spec.keys), newest_first(spec.order), spec.nocase)


def with_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows whose key parts are all there."""
    return df.dropna(subset=list(keys))


def merge(base: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Union of both, one row for each key: the greatest ``order``; without one, or at a tie, the batch's."""
    both = base.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, [*newest_first(order or []), F.col("_batch")]).drop("_batch")


def upsert(base: DataFrame, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``base`` with rows of ``batch`` in place of those with the same key; other rows stay untouched."""
    new = keep_one(batch, keys, order)
    return base.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*base.columns))


def insert_new(base: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``batch`` whose keys ``base`` doesn't have, one for each key: what is to be appended."""
    return keep_one(batch.join(base.select(*keys), keys, "left_anti"), keys)


def unprocessed(found: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return found.join(ledger.select(*keys), keys, "left_anti")


def swap_guard(existing: DataFrame, staging: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: counts of both sides and whether the staging rows may take the place of the existing.

    They may not if there are fewer rows (none included), or, with ``keys``, fewer distinct keys.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        distinct = F.count_distinct(*(F.col(k) for k in keys)) if keys else F.lit(None).cast("long")
        return df.agg(F.count("*").alias(f"{name}_rows"), distinct.alias(f"{name}_keys"))

    # Two one-row tables: a cross join of counts, not of rows.
    both = counted(existing, "existing").crossJoin(F.broadcast(counted(staging, "staging")))
    fine = (F.col("staging_rows") >= F.col("existing_rows")) & (F.col("staging_rows") > 0)
    if keys:
        fine = fine & (F.col("staging_keys") >= F.col("existing_keys"))
    return both.withColumn("may_swap", fine)


def add_counters(base: DataFrame, new: DataFrame) -> DataFrame:
    """Daily counters with new counts added to those of the same day."""
    return base.unionByName(new).groupBy("fetch_date").agg(F.sum("attempted").alias("attempted"), F.sum("fetched").alias("fetched"))


def repaired(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A table that lost its key: no row without one, and one row for each."""
    return keep_latest(with_keys(df, spec.keys), spec)


def upsert_by_spec(base: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """``upsert`` of a stored table by column name: the newest row of each key of the batch replaces; absent columns are null."""
    named = batch.select(*((F.col(f.name).try_cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema))
    return upsert(base, with_keys(named, spec.keys), list(spec.keys), newest_first(spec.order))


def mark_untrackable(base: DataFrame, failures: DataFrame, now: str) -> DataFrame:
    """``base`` (ticker, reason, last_failed_timestamp) with a row for each failed ticker (ticker, reason), whatever its case, as of now.

    Of several reasons the greatest counts.
    """
    new = failures.where("ticker IS NOT NULL").groupBy(F.upper("ticker").alias("ticker")).agg(F.max("reason").alias("reason"))
    new = new.withColumn("last_failed_timestamp", F.lit(now).cast("timestamp"))
    kept = base.join(new.select(F.col("ticker").alias("_new")), F.upper("ticker") == F.col("_new"), "left_anti")
    return kept.unionByName(new.select(*base.columns))


def counters(results: DataFrame, day: Column, success: Column, empty: Column | None = None) -> DataFrame:
    """Attempts, successes and, if ``empty`` tells them, empty results of each day."""
    more = [F.count_if(empty).alias("empty")] if empty is not None else []
    return results.groupBy(day.alias("fetch_date")).agg(F.count("*").alias("attempted"), F.count_if(success).alias("fetched"), *more)


def unpivot_statement(df: DataFrame, ids: list[str], items: list[str], value: str = "item_value") -> DataFrame:
    """Item columns to rows (ids, item_name, value); null values go."""
    return df.unpivot(ids, items, "item_name", value).where(F.col(value).isNotNull())


def statement_rows(df: DataFrame, ids: list[str], item: str = "item_name") -> DataFrame:
    """A financial statement, items down and report dates across, as (ids, report_date, item_name, item_value).

    Columns whose name is no date give no rows, and neither do null values.
    """
    dates = [c for c in df.columns if c not in (*ids, item)]
    cells = df.select(*ids, F.col(item).alias("item_name"), *(F.col(f"`{c}`").try_cast("double").alias(c) for c in dates))
    rows = cells.unpivot([*ids, "item_name"], dates, "_date", "_value").withColumn("report_date", iso_date("_date"))
    return rows.where("report_date IS NOT NULL AND _value IS NOT NULL").select(*ids, "report_date", "item_name", F.col("_value").cast("bigint").alias("item_value"))
