"""Scores and ranks of what to fetch next. Time is an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerloom.session import shared_path

# Parts of tag names whose presence counts, and the presets of weights.
KEY_METRICS = ["Assets", "Liabilities", "StockholdersEquity", "Revenue", "NetIncome", "OperatingIncome", "CashAndCashEquivalents", "EarningsPerShare"]
BACKLOG = {"xbrl_richness": 0.25, "key_metrics": 0.15, "stock_data_need": 0.45, "filing_activity": 0.15}
STOCK = {"xbrl_richness": 0.35, "key_metrics": 0.25, "stock_data_need": 0.25, "filing_activity": 0.15}
HYBRID = {"filings_recent": 0.6, "filings_total": 0.25, "company_recency": 0.15}
EARLIEST, UNKNOWN_DAYS = "1990-01-01", 1_000_000.0
#: Lower bits of a number by ``monotonically_increasing_id``, which count within a range.
IN_RANGE = 33


def weights(given: dict[str, float] | str | None, preset: dict[str, float] = BACKLOG) -> dict[str, float]:
    """Given weights (also as "name=value,…") scaled to sum to one, missing ones at their share in the preset."""
    if not given:
        return dict(preset)
    if isinstance(given, str):
        parts = [x.partition("=") for x in given.split(",") if x.strip()]
        if bad := [k for k, sep, _ in parts if not sep]:
            raise ValueError(f"a weight is name=value, not {bad[0]!r}")
        given = {k.strip(): float(v) for k, _, v in parts}
    if unknown := sorted(set(given) - set(preset)):
        raise ValueError(f"no such weight: {', '.join(unknown)}")
    if (total := sum(given.values())) <= 0:
        raise ValueError("weights must sum to more than 0")
    share = sum(preset.values())
    return {k: given[k] / total if k in given else preset[k] / share for k in preset}


def weights_json(w: dict[str, float]) -> Column:
    """The weights as JSON, the same in every row."""
    return F.to_json(F.struct(*(F.lit(x).alias(name) for name, x in w.items())))


def fact_metrics(facts: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Distinct tags, and how many key metrics have a tag, of each company."""
    tags = facts.select("cik", "tag_name").distinct()  # few of a company's facts have a tag of their own
    flags = [F.max(F.when(F.col("tag_name").contains(m), 1).otherwise(0)) for m in metrics or KEY_METRICS]
    total = flags[0]
    for flag in flags[1:]:
        total = total + flag
    return tags.groupBy("cik").agg(F.count("tag_name").alias("unique_tag_count"), total.alias("key_metric_count"))


def coverage(history: DataFrame) -> DataFrame:
    """Last date and rows of each ticker."""
    return history.groupBy("ticker").agg(F.max("date").alias("last_date"), F.count("*").alias("record_count"))


def recent_counts(filings: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    recent = filings.where(F.col("filing_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return recent.groupBy("cik").agg(F.count("*").alias("recent_filings"))


def need_score(last: Column, rows: Column, as_of: str) -> Column:
    """How much a ticker needs prices: none at all, then stale, then few rows, then by age."""
    age = F.datediff(F.lit(as_of).cast("date"), last)
    return (
        F.when(last.isNull(), F.lit(1000))
        .when(age > 7, 500 + age)
        .when(F.coalesce(rows, F.lit(0)) < 365, 250 + (365 - F.coalesce(rows, F.lit(0))))
        .otherwise(F.greatest(F.lit(0), age))
    )


def over_max(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New columns: values over the greatest of all rows. The maxima are one row that goes to every task."""
    most = df.agg(*(F.max(c).alias(f"_max_{c}") for c in columns))
    joined = df.crossJoin(F.broadcast(most))
    for c, new in columns.items():
        joined = joined.withColumn(new, F.try_divide(F.col(c).cast("double"), F.nullif(F.col(f"_max_{c}"), F.lit(0))))
    return joined.drop(*(f"_max_{c}" for c in columns))


def scored(base: DataFrame, as_of: str, w: dict[str, float]) -> DataFrame:
    base = base.withColumn("stock_need_score", need_score(F.col("last_date"), F.col("record_count"), as_of).cast("long"))
    base = base.withColumn("staleness_days", F.datediff(F.lit(as_of).cast("date"), "last_date"))
    normal = over_max(base, {"unique_tag_count": "xbrl_norm", "key_metric_count": "key_norm", "stock_need_score": "need_norm", "recent_filings": "filing_norm"})
    parts = zip(w.values(), ("xbrl_norm", "key_norm", "need_norm", "filing_norm"), strict=True)
    total = F.lit(0.0)
    for weight, name in parts:
        total = total + F.lit(round(weight, 6)) * F.coalesce(F.col(name), F.lit(0.0))
    return normal.withColumn("score", total).drop("xbrl_norm", "key_norm", "need_norm", "filing_norm")


def backlog(
    info: DataFrame, facts: DataFrame, history: DataFrame, filings: DataFrame, as_of: str,
    untrackable: DataFrame | None = None, given: dict[str, float] | str | None = None, metrics: list[str] | None = None, digits: int | None = None, ranks: bool = True,
) -> DataFrame:
    """Tickers of companies with facts, by need of prices, richness of facts and filing activity.

    ``rank`` orders by score, then ticker. Values are measured against the greatest before tickers
    without need are dropped. Suggested dates: five years back, or from the day after the last.
    ``digits``: scores are rounded before they are ranked. ``weights_json`` says what was weighed.
    Without ``ranks`` there is no rank and no global order: a plan of few rows counts theirs.
    """
    from .integrity import without

    base = (
        info.where("ticker IS NOT NULL").select("ticker", "cik")
        .join(fact_metrics(facts, metrics), "cik")
        .join(coverage(history), "ticker", "left")
        .join(recent_counts(filings, as_of), "cik", "left")
        .withColumn("recent_filings", F.coalesce("recent_filings", F.lit(0)))
    )
    if untrackable is not None:
        base = without(base, untrackable)
    day = F.lit(as_of).cast("date")
    w = weights(given)
    out = scored(base, as_of, w).where("stock_need_score > 0").withColumn("weights_json", weights_json(w))
    if digits is not None:
        out = out.withColumn("score", F.round("score", digits))
    start = F.when(F.col("last_date").isNotNull() & (F.col("staleness_days") > 7), F.date_add("last_date", 1)).otherwise(F.add_months(day, -60))
    return (ranked(out, ["score"]) if ranks else out).withColumn("start_date", start).withColumn("end_date", F.date_sub(day, 1))


def placed(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``name``: place of each row in the order ``by`` over all rows, from 1.

    Rows are dealt out by ranges of the order, as many as their size asks for, and sorted and numbered
    within their range as they are landed; the ranges are counted, and the rows of those before are
    added. No task holds more than a range, and rows are shuffled once. What is landed holds the
    numbers, so they stay the same, whichever executors are lost.
    """
    path = shared_path(df.sparkSession, "ranges")
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    dealt = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])).parquet(path)
    of_range = F.shiftright("_at", IN_RANGE)
    before = dealt.groupBy(of_range.alias("_range")).agg(F.count("*").alias("_n"))
    before = before.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))
    found = dealt.withColumn("_range", of_range).join(F.broadcast(before), "_range")
    own = F.col("_at") - F.shiftleft("_range", IN_RANGE)
    return found.withColumn(name, own + F.col("_before") + 1).drop("_range", "_before", "_at")


def ranked(df: DataFrame, order: list[str], tie: str = "ticker") -> DataFrame:
    """``rank``: place by ``order`` descending, then ``tie``."""
    return placed(df, [F.desc_nulls_last(c) for c in order] + [F.asc_nulls_last(tie)], "rank")


def stock_priority(tickers: DataFrame, links: DataFrame, facts: DataFrame, history: DataFrame, filings: DataFrame, as_of: str, given: dict[str, float] | None = None,
    metrics: list[str] | None = None) -> DataFrame:
    """Scores of a given list of tickers; those without a company score by their need alone."""
    base = (
        tickers.select("ticker").distinct()
        .join(links.groupBy("ticker").agg(F.min("cik").alias("cik")), "ticker", "left")
        .join(fact_metrics(facts, metrics), "cik", "left").join(coverage(history), "ticker", "left").join(recent_counts(filings, as_of), "cik", "left")
        .fillna(0, ["unique_tag_count", "key_metric_count", "recent_filings"])
    )
    return scored(base, as_of, weights(given, STOCK)).select("ticker", "score")


def hybrid_priority(tickers: DataFrame, links: DataFrame, filings: DataFrame, as_of: str, days: int = 365, given: dict[str, float] | None = None) -> DataFrame:
    """Scores by recent filings, all filings and how lately the company filed."""
    w = weights(given, HYBRID)
    day = F.lit(as_of).cast("date")
    counts = filings.groupBy("cik").agg(
        F.count_if(F.col("filing_date") >= F.date_sub(day, days)).alias("recent"), F.count("*").alias("total"), F.datediff(day, F.max("filing_date")).alias("age")
    )
    base = (
        tickers.select("ticker").distinct()
        .join(links.groupBy("ticker").agg(F.min("cik").alias("cik")), "ticker", "left").join(counts, "cik", "left")
        .fillna(0, ["recent", "total"]).withColumn("age", F.coalesce(F.col("age").cast("double"), F.lit(UNKNOWN_DAYS)))
    )
    normal = over_max(base, {"recent": "a", "total": "b", "age": "c"})
    late = F.when(F.col("c").isNull() | (F.col("age") >= UNKNOWN_DAYS), 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("c")))
    score = w["filings_recent"] * F.coalesce("a", F.lit(0.0)) + w["filings_total"] * F.coalesce("b", F.lit(0.0)) + w["company_recency"] * late
    return normal.select("ticker", score.alias("score"))


def fetch_plan(backlog_rows: DataFrame, history: DataFrame, as_of: str, end: str, limit: int, stale_days: int = 7, least_rows: int = 365) -> DataFrame:
    """The best-ranked tickers that have no history, a stale or an incomplete one, with dates to fetch.

    The first ``limit`` rows are taken by score, and their ranks counted against all scores: the
    backlog (without a rank) is landed once, and nothing is sorted as a whole.
    """
    spark = backlog_rows.sparkSession
    path, columns = shared_path(spark, "scores"), ["ticker", "cik", "score"]
    backlog_rows.select(*columns).write.parquet(path)
    scores = spark.read.schema(backlog_rows.select(*columns).schema).parquet(path)
    rows = scores.join(coverage(history), "ticker", "left")
    age = F.datediff(F.lit(as_of).cast("date"), "last_date")
    status = (
        F.when(F.col("last_date").isNull(), "no_history").when(age > stale_days, "stale")
        .when(F.coalesce("record_count", F.lit(0)) < least_rows, "incomplete").otherwise("fresh")
    )
    start = F.coalesce(F.date_add("last_date", 1), F.lit(EARLIEST).cast("date"))
    plan = rows.withColumn("status", status).withColumn("start_date", start).withColumn("end_date", F.lit(end).cast("date"))
    first = plan.where("status <> 'fresh'").orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("ticker")).limit(limit)
    chosen = shared_path(spark, "plan")
    first.write.parquet(chosen)  # ``limit`` rows, which are read twice below
    return ranks_among(spark.read.schema(first.schema).parquet(chosen), scores)


def ranks_among(first: DataFrame, scores: DataFrame) -> DataFrame:
    """``first`` (few rows, of which a list goes to every task) with ``rank``: one more than the rows of ``scores`` before it, by score and then ticker."""
    before = lambda a, b: (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (a["ticker"] < b["ticker"]))
    listed = first.agg(F.collect_list(F.struct("score", "ticker")).alias("_list"))
    each = F.struct("score", "ticker")
    # How many of the list a row comes before or is: it counts for the last so many of them.
    own = scores.crossJoin(F.broadcast(listed)).select(F.size(F.filter("_list", lambda x: before(each, x))).alias("_below"))
    counts = own.groupBy("_below").agg(F.count("*").alias("_n"))
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("score"), F.desc_nulls_last("ticker")))  # of few rows, the last first
    sums = counts.select("_below", F.sum("_n").over(W.orderBy(F.desc("_below"))).alias("_above"))
    placed_rows = first.withColumn("_place", place)
    joined = placed_rows.join(F.broadcast(sums), F.col("_below") >= F.col("_place"), "left")
    keys = first.columns
    return joined.groupBy(*keys).agg(F.coalesce(F.max("_above"), F.lit(0)).alias("_above")).withColumn("rank", F.col("_above") + 1).drop("_above").select("ticker", "cik", "rank",
        "score", *(c for c in keys if c not in ("ticker", "cik", "score")))


def plan_status(plan: DataFrame) -> DataFrame:
    """How many rows of a plan have each status."""
    return plan.groupBy("status").agg(F.count("*").alias("n_rows"))
