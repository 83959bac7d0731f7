"""Which date ranges are missing, and the jobs that would fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.functions.scalars import clamp_start, dotted_ticker


def day(x: str | Column) -> Column:
    return F.lit(x).cast("date") if isinstance(x, str) else x.cast("date")


def missing_intervals(rows: DataFrame, wanted: DataFrame, key: str = "ticker", spellings: bool = True) -> DataFrame:
    """Calendar ranges of ``wanted`` (key, start, end) in which ``rows`` (key, date) has no row.

    A key without rows misses its whole range. Ranges of one key that overlap or touch are one; others
    are apart. With ``spellings``, a key with hyphens has the rows with points in their place, too.
    Ranges and rows meet by key, and what follows needs no other order of rows than that.
    """
    wanted = ranges_merged(wanted.select(key, F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end")), key)
    held = rows.select(F.col(key).alias("_spelt"), F.col("date").cast("date").alias("date"))
    if spellings:
        # A row stands for its own spelling, and for those keys whose hyphens it has as points.
        names = wanted.where(F.contains(F.col(key), F.lit("-"))).select(key, dotted_ticker(key).alias("_spelt")).distinct()
        held = held.unionByName(held.join(names, "_spelt").select(F.col(key).alias("_spelt"), "date"))
    own = (F.col(key) == F.col("_spelt")) & F.col("date").between(F.col("start"), F.col("end"))
    found = wanted.join(held, own, "left").select(key, "start", "end", "date")
    place = W.partitionBy(key, "start").orderBy("date")
    found = found.withColumns({"_before": F.coalesce(F.lag("date").over(place), F.date_sub("start", 1)), "_after": F.lead("date").over(place)})
    gap = lambda a, b: F.struct(a.alias("gap_start"), b.alias("gap_end"))
    ahead = gap(F.date_add("_before", 1), F.coalesce(F.date_sub("date", 1), F.col("end")))
    behind = F.when(F.col("_after").isNull() & F.col("date").isNotNull(), gap(F.date_add("date", 1), F.col("end")))
    gaps = found.select(key, F.explode(F.array(ahead, behind)).alias("g")).where("g IS NOT NULL")
    return gaps.select(key, "g.gap_start", "g.gap_end").where("gap_start <= gap_end")


def jobs_from_plan(plan: DataFrame, years: int) -> DataFrame:
    """Ranges of a plan without null or inverted ones, none longer than ``years``; ``clamped`` marks those cut."""
    fine = plan.where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull() & (F.col("start_date") <= F.col("end_date")))
    start = clamp_start("start_date", "end_date", 365 * years)
    return fine.withColumn("_start", start).withColumn("clamped", F.col("_start") > F.col("start_date")).withColumn("start_date", F.col("_start")).drop("_start")


def jobs_to_append(tickers: DataFrame, latest: DataFrame, end: str, lookback_days: int) -> DataFrame:
    """From the day after the last, or the whole lookback where there is none; nothing if that is past the end."""
    start = F.coalesce(F.date_add("last_date", 1), F.date_sub(day(end), lookback_days))
    found = tickers.select("ticker").join(latest, "ticker", "left").select("ticker", start.alias("start_date"), day(end).alias("end_date"))
    return found.where("start_date <= end_date")


def jobs_for_gaps(tickers: DataFrame, rows: DataFrame, start: str, end: str, append: bool = False) -> DataFrame:
    """A job for each range from ``start`` to ``end`` in which a ticker, under either spelling, has no row of ``rows`` (ticker, date).

    With ``append`` a ticker that has rows begins on the day after its last one; it is left out if
    that is past the end. Tickers without a gap have no job.
    """
    from .integrity import dual_lookup

    wanted = tickers.select("ticker").distinct()
    if append:
        latest = rows.groupBy("ticker").agg(F.max("date").alias("last_date"))
        wanted = wanted.join(dual_lookup(wanted, latest).select("ticker", "last_date"), "ticker", "left")
    else:
        wanted = wanted.withColumn("last_date", F.lit(None).cast("date"))
    wanted = wanted.select("ticker", F.coalesce(F.date_add("last_date", 1), day(start)).alias("start"), day(end).alias("end")).where("start <= end")
    return missing_intervals(rows, wanted).select("ticker", F.col("gap_start").alias("start_date"), F.col("gap_end").alias("end_date"))


def jobs_of_feed(tickers: DataFrame, latest: DataFrame, end: str, override: str | None = None, earliest: str = "1990-01-01") -> DataFrame:
    start = F.coalesce(day(override) if override else F.lit(None).cast("date"), F.date_add("last_date", 1), day(earliest))
    found = tickers.select("ticker").join(latest, "ticker", "left").select("ticker", start.alias("start_date"), day(end).alias("end_date"))
    return found.where("start_date <= end_date")


def to_refresh(tickers: DataFrame, fetched: DataFrame, now: str, days: int, force: bool = False) -> DataFrame:
    """Tickers never fetched, or fetched before the cutoff; exactly at the cutoff is fresh."""
    if force:
        return tickers.select("ticker")
    last = fetched.groupBy("ticker").agg(F.max("fetch_timestamp").alias("_last"))
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    return tickers.join(last, "ticker", "left").where(F.col("_last").isNull() | (F.col("_last") < cutoff)).select("ticker")


def unexpired(untrackable: DataFrame, now: str, expiry_days: int = 365) -> DataFrame:
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(expiry_days)} DAYS")
    return untrackable.where(F.col("last_failed_timestamp") >= cutoff)


def within_budget(jobs: DataFrame, used: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """The first jobs by ``order`` that a budget of ``limit``, less what is ``used`` (one row: used), leaves."""
    from .scoring import placed

    left = used.agg(F.greatest(F.lit(0), F.lit(limit) - F.coalesce(F.sum("used"), F.lit(0))).alias("_left"))
    return placed(jobs, order, "_place").crossJoin(F.broadcast(left)).where("_place <= _left").drop("_place", "_left")


def ranges_merged(wanted: DataFrame, key: str = "ticker") -> DataFrame:
    """Ranges of each key (key, start, end) that overlap or touch, as one."""
    own = W.partitionBy(key).orderBy("start", "end")
    last = F.max("end").over(own.rowsBetween(W.unboundedPreceding, -1))
    parts = wanted.where("start <= end").withColumn("_new", F.when(F.col("start") <= F.date_add(last, 1), 0).otherwise(1))
    return parts.withColumn("_part", F.sum("_new").over(own)).groupBy(key, "_part").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_part")


def gap_jobs(rows: DataFrame, wanted: DataFrame, years: int, key: str = "ticker") -> DataFrame:
    """The jobs that fill the missing ranges, none longer than ``years``."""
    gaps = missing_intervals(rows, wanted, key).select(key, F.col("gap_start").alias("start_date"), F.col("gap_end").alias("end_date"))
    return jobs_from_plan(gaps, years)


def worklist(scores: DataFrame, fetched: DataFrame, untrackable: DataFrame, now: str, days: int, limit: int) -> DataFrame:
    """By score, without the fresh, cut to the limit, and then without the untrackable."""
    from .integrity import without

    due = scores.join(to_refresh(scores, fetched, now, days), "ticker", "left_semi")
    first = due.orderBy(F.desc("score"), "ticker").limit(limit)
    return without(first, unexpired(untrackable, now))
