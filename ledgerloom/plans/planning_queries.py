"""Queries of scores, ranks, gaps and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import integrity, normalize, planning, scoring

from .registry import query
from .views import EVENTS_DAY, Views

METRICS = ["N", "A", "R", "O", "F"]
DAY = f"DATE '{EVENTS_DAY}'"


def info(v: Views) -> DataFrame:
    """Users as tickers; each belongs to the company of the same number."""
    return v.table("events").where("user_id IS NOT NULL").select(F.col("user_id").cast("string").alias("ticker"), F.col("user_id").cast("string").alias("cik")).distinct()


INFO = "info AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker, CAST(user_id AS VARCHAR) AS cik FROM events WHERE user_id IS NOT NULL)"
FLAGS = " + ".join(f"max(CASE WHEN tag_name LIKE '%{m}%' THEN 1 ELSE 0 END)" for m in METRICS)
NEED = f"""CASE WHEN last_date IS NULL THEN 1000 WHEN date_diff('day', last_date, {DAY}) > 7 THEN 500 + date_diff('day', last_date, {DAY})
WHEN coalesce(record_count, 0) < 365 THEN 250 + 365 - coalesce(record_count, 0) ELSE greatest(0, date_diff('day', last_date, {DAY})) END"""
PARTS = f"""{INFO},
metrics AS (SELECT cik, count(DISTINCT tag_name) AS unique_tag_count, {FLAGS} AS key_metric_count FROM facts GROUP BY cik),
history AS (SELECT ticker, max(date) AS last_date, count(*) AS record_count FROM prices GROUP BY ticker),
recent AS (SELECT cik, count(*) AS recent_filings FROM filings WHERE filing_date >= {DAY} - 3000 GROUP BY cik)"""


def recent_filings_view(v: Views) -> DataFrame:
    """Filings moved so that a year before the events' day holds the last of them."""
    return v.filings().withColumn("filing_date", F.date_add("filing_date", 3000 - 365))


BACKLOG = f"""{PARTS},
base AS (SELECT i.ticker, i.cik, unique_tag_count, key_metric_count, last_date, record_count, coalesce(recent_filings, 0) AS recent_filings, CAST({NEED} AS BIGINT) AS stock_need_score
FROM info i JOIN metrics m ON m.cik = i.cik LEFT JOIN history h ON h.ticker = i.ticker LEFT JOIN recent r ON r.cik = i.cik
WHERE i.ticker NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error' AND user_id % 5 = 0 AND user_id IS NOT NULL)),
normal AS (SELECT *, coalesce(0.25 * unique_tag_count / nullif(max(unique_tag_count) OVER (), 0), 0) + coalesce(0.15 * key_metric_count / nullif(max(key_metric_count) OVER (), 0), 0)
+ coalesce(0.45 * stock_need_score / nullif(max(stock_need_score) OVER (), 0), 0) + coalesce(0.15 * recent_filings / nullif(max(recent_filings) OVER (), 0), 0) AS score FROM base)"""


def backlog_rows(v: Views, ranks: bool = True) -> DataFrame:
    bad = v.table("events").where("event_type = 'error' AND user_id % 5 = 0").select(F.col("user_id").cast("string").alias("ticker"))
    return scoring.backlog(info(v), v.facts(), v.prices(), recent_filings_view(v), EVENTS_DAY, bad, None, METRICS, digits=9, ranks=ranks)


@query(f"""+{BACKLOG}
SELECT ticker, cik, unique_tag_count, CAST(key_metric_count AS INTEGER) AS key_metric_count, last_date, record_count, recent_filings, stock_need_score,
CAST(date_diff('day', last_date, {DAY}) AS INTEGER) AS staleness_days, round(score, 9) AS score,
CASE WHEN last_date IS NOT NULL AND date_diff('day', last_date, {DAY}) > 7 THEN last_date + 1 ELSE CAST({DAY} - INTERVAL 60 MONTH AS DATE) END AS start_date,
CAST({DAY} - 1 AS DATE) AS end_date, row_number() OVER (ORDER BY round(score, 9) DESC, ticker) AS rank,
'{{"xbrl_richness":0.25,"key_metrics":0.15,"stock_data_need":0.45,"filing_activity":0.15}}' AS weights_json FROM normal WHERE stock_need_score > 0""")
def backlog_score(v: Views) -> DataFrame:
    return backlog_rows(v)


@query(f"""+{BACKLOG}, r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, ticker) AS rank FROM normal WHERE stock_need_score > 0)
SELECT ticker, cik, rank, round(score, 9) AS score, last_date, record_count, CASE WHEN last_date IS NULL THEN 'no_history' WHEN date_diff('day', last_date, {DAY}) > 1 THEN 'stale'
WHEN coalesce(record_count, 0) < 28 THEN 'incomplete' ELSE 'fresh' END AS status, coalesce(last_date + 1, DATE '1990-01-01') AS start_date, {DAY} AS end_date FROM r
WHERE last_date IS NULL OR date_diff('day', last_date, {DAY}) > 1 OR coalesce(record_count, 0) < 28 ORDER BY rank LIMIT 50""")
def fetch_plan(v: Views) -> DataFrame:
    return scoring.fetch_plan(backlog_rows(v, ranks=False), v.prices(), EVENTS_DAY, EVENTS_DAY, 50, stale_days=1, least_rows=28)


@query(f"""+{INFO}, counts AS (SELECT cik, count(*) FILTER (WHERE filing_date >= {DAY} - 3000) AS recent, count(*) AS total, date_diff('day', max(filing_date) + 2635,
{DAY}) AS age FROM filings GROUP BY 1),
base AS (SELECT i.ticker, coalesce(recent, 0) AS recent, coalesce(total, 0) AS total, coalesce(CAST(age AS DOUBLE), 1000000.0) AS age FROM info i LEFT JOIN counts c ON c.cik = i.cik)
SELECT ticker, round(0.6 * coalesce(recent / nullif(max(recent) OVER (), 0), 0) + 0.25 * coalesce(total / nullif(max(total) OVER (), 0), 0)
+ 0.15 * CASE WHEN age >= 1000000 THEN 0 ELSE greatest(0, coalesce(1 - age / nullif(max(age) OVER (), 0), 0)) END, 9) AS score FROM base""")
def hybrid_priority(v: Views) -> DataFrame:
    found = scoring.hybrid_priority(info(v), info(v), recent_filings_view(v), EVENTS_DAY)
    return found.withColumn("score", F.round("score", 9))


@query(f"""+{PARTS}, base AS (SELECT i.ticker, coalesce(unique_tag_count, 0) AS t, coalesce(key_metric_count, 0) AS k, coalesce(recent_filings, 0) AS f, {NEED} AS n
FROM info i LEFT JOIN metrics m ON m.cik = i.cik LEFT JOIN history h ON h.ticker = i.ticker LEFT JOIN recent r ON r.cik = i.cik)
SELECT ticker, round(0.35 * t / nullif(max(t) OVER (), 0) + 0.25 * k / nullif(max(k) OVER (), 0) + 0.25 * n / nullif(max(n) OVER (),
0) + coalesce(0.15 * f / nullif(max(f) OVER (), 0), 0), 9) AS score FROM base""")
def stock_priority(v: Views) -> DataFrame:
    found = scoring.stock_priority(info(v), info(v), v.facts(), v.prices(), recent_filings_view(v), EVENTS_DAY, metrics=METRICS)
    return found.withColumn("score", F.round("score", 9))


WANTED = "wanted AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker, DATE '2023-12-28' AS s, DATE '2024-02-02' AS e FROM events WHERE user_id IS NOT NULL UNION SELECT 'none', DATE '2024-01-01', DATE '2024-01-05')"


def wanted(v: Views) -> DataFrame:
    s, e = (F.lit(x).cast("date") for x in ("2023-12-28", "2024-02-02"))
    own = info(v).select("ticker", s.alias("start"), e.alias("end"))
    lone = v.spark.range(1).select(F.lit("none").alias("ticker"), F.lit("2024-01-01").cast("date").alias("start"), F.lit("2024-01-05").cast("date").alias("end"))
    return own.unionByName(lone)


@query(f"""+{WANTED}, marks AS (SELECT w.ticker, p.date FROM prices p JOIN wanted w ON w.ticker = p.ticker AND p.date BETWEEN s AND e UNION ALL SELECT ticker, s - 1
FROM wanted UNION ALL SELECT ticker, e + 1 FROM wanted),
pairs AS (SELECT ticker, date, lead(date) OVER (PARTITION BY ticker ORDER BY date) AS n FROM marks)
SELECT ticker, CAST(date + 1 AS DATE) AS gap_start, CAST(n - 1 AS DATE) AS gap_end FROM pairs WHERE date + 1 <= n - 1""")
def missing_intervals(v: Views) -> DataFrame:
    return planning.missing_intervals(v.prices(), wanted(v))


@query("""SELECT cik AS ticker, greatest(min(filing_date), max(filing_date) - 365) AS start_date, max(filing_date) AS end_date,
max(filing_date) - 365 > min(filing_date) AS clamped FROM filings GROUP BY cik""")
def interval_clamp(v: Views) -> DataFrame:
    plan = v.filings().groupBy(F.col("cik").alias("ticker")).agg(F.min("filing_date").alias("start_date"), F.max("filing_date").alias("end_date"))
    return planning.jobs_from_plan(plan, 1).select("ticker", "start_date", "end_date", "clamped")


LAST = "latest AS (SELECT ticker, max(date) AS last_date FROM prices WHERE date < DATE '2024-01-25' GROUP BY 1)"


@query(f"""+{LAST}, jobs AS (SELECT t.ticker, coalesce(last_date + 1, DATE '2024-01-28' - 100) AS start_date, DATE '2024-01-28' AS end_date
FROM (SELECT cik AS ticker FROM companies) t LEFT JOIN latest l ON l.ticker = t.ticker) SELECT ticker, CAST(start_date AS DATE) AS start_date, end_date FROM jobs WHERE start_date <= end_date""")
def jobs_to_append(v: Views) -> DataFrame:
    latest = v.prices().where("date < DATE '2024-01-25'").groupBy("ticker").agg(F.max("date").alias("last_date"))
    return planning.jobs_to_append(v.companies().select(F.col("cik").alias("ticker")), latest, "2024-01-28", 100)


@query(f"""+{LAST} SELECT t.ticker, CAST(coalesce(last_date + 1, DATE '1990-01-01') AS DATE) AS start_date, DATE '2024-01-24' AS end_date
FROM (SELECT cik AS ticker FROM companies) t LEFT JOIN latest l ON l.ticker = t.ticker WHERE coalesce(last_date + 1, DATE '1990-01-01') <= DATE '2024-01-24'""")
def jobs_of_feed(v: Views) -> DataFrame:
    latest = v.prices().where("date < DATE '2024-01-25'").groupBy("ticker").agg(F.max("date").alias("last_date"))
    return planning.jobs_of_feed(v.companies().select(F.col("cik").alias("ticker")), latest, "2024-01-24")


def fetched(v: Views) -> DataFrame:
    return v.table("events").where("user_id IS NOT NULL").select(F.col("user_id").cast("string").alias("ticker"), F.col("ts").alias("fetch_timestamp"))


@query("""SELECT cik AS ticker FROM companies c LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS u, max(ts) AS last FROM events GROUP BY 1) e ON e.u = c.cik
WHERE last IS NULL OR last < TIMESTAMP '2024-01-31' - INTERVAL 2 DAY""")
def refresh_filter(v: Views) -> DataFrame:
    return planning.to_refresh(v.companies().select(F.col("cik").alias("ticker")), fetched(v), "2024-01-31 00:00:00", 2)


ERRORS = "errors AS (SELECT CAST(user_id AS VARCHAR) AS ticker, max(ts) AS last_failed_timestamp FROM events WHERE event_type = 'error' AND user_id IS NOT NULL GROUP BY 1)"


def errors(v: Views) -> DataFrame:
    e = v.table("events").where("event_type = 'error' AND user_id IS NOT NULL")
    return e.groupBy(F.col("user_id").cast("string").alias("ticker")).agg(F.max("ts").alias("last_failed_timestamp"))


@query(f"+{ERRORS} SELECT cik AS ticker FROM companies WHERE cik NOT IN (SELECT ticker FROM errors WHERE last_failed_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 3 DAY)")
def untrackable_exclusion(v: Views) -> DataFrame:
    return integrity.without(v.companies().select(F.col("cik").alias("ticker")), planning.unexpired(errors(v), "2024-01-31 00:00:00", 3))


@query(f"""+{ERRORS}, last AS (SELECT CAST(user_id AS VARCHAR) AS ticker, max(ts) AS t FROM events GROUP BY 1),
due AS (SELECT c.cik AS ticker, length(c.primary_name) + CAST(c.cik AS BIGINT) % 97 AS score FROM companies c LEFT JOIN last l ON l.ticker = c.cik
WHERE t IS NULL OR t < TIMESTAMP '2024-01-31' - INTERVAL 2 DAY),
first AS (SELECT * FROM due ORDER BY score DESC, ticker LIMIT 100) SELECT ticker, score FROM first WHERE ticker NOT IN (SELECT ticker FROM errors
WHERE last_failed_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY)""")
def ordered_worklist(v: Views) -> DataFrame:
    scores = v.companies().select(F.col("cik").alias("ticker"), (F.length("primary_name") + F.col("cik").cast("long") % 97).alias("score"))
    return planning.worklist(scores, fetched(v), errors(v), "2024-01-31 00:00:00", 2, 100).withColumn("ticker", F.col("ticker"))


@query("""+ n AS (SELECT greatest(0, 5000 - (SELECT count(*) FROM events WHERE event_type = 'error')) AS budget), r AS (SELECT event_id, user_id, ts,
row_number() OVER (ORDER BY ts, event_id) AS k FROM events)
SELECT event_id, user_id, ts FROM r, n WHERE k <= budget""")
def budget_trim(v: Views) -> DataFrame:
    e = v.table("events")
    used = e.where("event_type = 'error'").agg(F.count("*").alias("used"))
    return planning.within_budget(e.select("event_id", "user_id", "ts"), used, 5000, [F.asc_nulls_last("ts"), F.asc("event_id")])


STATUS = f"CASE WHEN last_date IS NULL THEN 'no_history' WHEN date_diff('day', last_date, {DAY}) > 1 THEN 'stale' WHEN coalesce(record_count, 0) < 28 THEN 'incomplete' ELSE 'fresh' END"


@query(f"""+{BACKLOG}, plan AS (SELECT {STATUS} AS status, round(score, 9) AS score, ticker FROM normal WHERE stock_need_score > 0 ORDER BY score DESC, ticker)
SELECT status, count(*) AS n_rows FROM (SELECT * FROM plan WHERE status <> 'fresh' LIMIT 400) GROUP BY 1""")
def plan_status(v: Views) -> DataFrame:
    """Statuses of a plan of 400 tickers."""
    return scoring.plan_status(scoring.fetch_plan(backlog_rows(v, ranks=False), v.prices(), EVENTS_DAY, EVENTS_DAY, 400, stale_days=1, least_rows=28))


@query(f"""+{WANTED}, marks AS (SELECT w.ticker, p.date FROM prices p JOIN wanted w ON w.ticker = p.ticker AND p.date BETWEEN s AND e UNION ALL SELECT ticker, s - 1
FROM wanted UNION ALL SELECT ticker, e + 1 FROM wanted),
pairs AS (SELECT ticker, date, lead(date) OVER (PARTITION BY ticker ORDER BY date) AS n FROM marks)
SELECT ticker, CAST(date + 1 AS DATE) AS start_date, CAST(n - 1 AS DATE) AS end_date, false AS clamped FROM pairs WHERE date + 1 <= n - 1""")
def gap_jobs(v: Views) -> DataFrame:
    """Jobs for the missing ranges; a range asked for twice, or in two parts that touch, is one."""
    whole = wanted(v)
    half = F.lit("2024-01-10").cast("date")
    parts = whole.where("ticker = 'none'").unionByName(whole.where("ticker <> 'none'").withColumn("end", half)).unionByName(whole.where("ticker <> 'none'").withColumn("start", F.date_add(half, 1)))
    return planning.gap_jobs(v.prices(), parts.unionByName(parts), 5)


@query("SELECT cik FROM companies WHERE cik NOT IN (SELECT cik FROM filings WHERE status = 'F') ORDER BY cik LIMIT 50")
def parse_work_list(v: Views) -> DataFrame:
    return normalize.work_list(v.companies(), v.filings().where("status = 'F'"), limit=50)


#: Prices under a spelling with a point for every other ticker, wanted under one with a hyphen.
SPELT = """spelt AS (SELECT CASE WHEN CAST(ticker AS BIGINT) % 2 = 0 THEN 'U.' ELSE 'U-' END || ticker AS ticker, date FROM prices),
asked AS (SELECT 'U-' || c_custkey AS ticker FROM customer), held AS (SELECT replace(ticker, '.', '-') AS ticker, date FROM spelt)"""


def spelt(v: Views) -> tuple[DataFrame, DataFrame]:
    mark = F.when(F.col("ticker").cast("long") % 2 == 0, "U.").otherwise("U-")
    return v.prices().select(F.concat(mark, "ticker").alias("ticker"), "date"), v.table("customer").select(F.concat(F.lit("U-"), "c_custkey").alias("ticker"))


@query(f"""+{SPELT}, w AS (SELECT ticker, DATE '2024-01-03' AS s, DATE '2024-01-20' AS e FROM asked),
marks AS (SELECT w.ticker, h.date FROM w JOIN held h ON h.ticker = w.ticker AND h.date BETWEEN s AND e UNION ALL SELECT ticker, s - 1 FROM w UNION ALL SELECT ticker, e + 1 FROM w),
pairs AS (SELECT ticker, date, lead(date) OVER (PARTITION BY ticker ORDER BY date) AS n FROM marks)
SELECT ticker, CAST(date + 1 AS DATE) AS start_date, CAST(n - 1 AS DATE) AS end_date FROM pairs WHERE date + 1 <= n - 1""")
def gaps_of_both_spellings(v: Views) -> DataFrame:
    """Jobs for the gaps of tickers whose prices go under either spelling."""
    rows, tickers = spelt(v)
    return planning.jobs_for_gaps(tickers, rows, "2024-01-03", "2024-01-20")


@query(f"""+{SPELT}, last AS (SELECT a.ticker, max(date) AS d FROM asked a LEFT JOIN (SELECT * FROM held WHERE date < DATE '2024-01-25') h ON h.ticker = a.ticker GROUP BY 1)
SELECT ticker, CAST(coalesce(d + 1, DATE '2024-01-03') AS DATE) AS start_date, DATE '2024-01-23' AS end_date FROM last WHERE coalesce(d + 1, DATE '2024-01-03') <= DATE '2024-01-23'""")
def gaps_to_append(v: Views) -> DataFrame:
    """As above, from the day after each ticker's last price; those that have later ones have no job."""
    rows, tickers = spelt(v)
    return planning.jobs_for_gaps(tickers, rows.where("date < '2024-01-25'"), "2024-01-03", "2024-01-23", append=True)
