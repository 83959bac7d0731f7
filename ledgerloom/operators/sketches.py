"""Distinct keys by mergeable sketches: what a table's batches have stored of their keys answers how many there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two, and the relative standard error of the estimate of merged sketches.
LOG_REGISTERS = 14
ERROR = 1.04 / (1 << LOG_REGISTERS) ** 0.5
#: Estimates farther apart than so many standard errors tell which is greater.
DEVIATIONS = 5
SKETCH = "rows bigint, keys binary"


def _key(keys: list[str]) -> Column:
    """One number for a key; rows that lack a part of it have none, as for a distinct count."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return F.when(whole, F.xxhash64(*keys))


def sketch(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows there are, and a sketch of their distinct keys."""
    return df.agg(F.count("*").alias("rows"), F.hll_sketch_agg(_key(keys), F.lit(LOG_REGISTERS)).alias("keys"))


def united(sketches: DataFrame) -> DataFrame:
    """One row of several: rows added up, keys counted once, and their ``estimate``."""
    both = sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.hll_union_agg("keys").alias("keys"))
    return both.withColumn("estimate", F.coalesce(F.hll_sketch_estimate("keys"), F.lit(0)))


def sketched_guard(existing: DataFrame, staging: DataFrame) -> DataFrame:
    """One row of two frames of stored sketches: both sides' rows and estimated keys, whether the staging rows
    may take the place of the existing (``may_swap``, null if the sketches can't tell).

    Fewer rows never may, nor none. Keys are compared by their estimates where these are farther apart
    than ``DEVIATIONS`` standard errors of both; otherwise the keys themselves must be counted.
    """
    sides = [united(df).select(F.col("rows").alias(f"{name}_rows"), F.col("estimate").alias(f"{name}_keys")) for name, df in (("existing", existing), ("staging", staging))]
    both = sides[0].crossJoin(F.broadcast(sides[1]))  # two one-row tables
    apart = F.abs(F.col("staging_keys") - F.col("existing_keys")) > DEVIATIONS * ERROR * (F.col("staging_keys") + F.col("existing_keys"))
    fewer = (F.col("staging_rows") < F.col("existing_rows")) | (F.col("staging_rows") == 0)
    return both.withColumn("may_swap", F.when(fewer, False).when(apart, F.col("staging_keys") > F.col("existing_keys")))
