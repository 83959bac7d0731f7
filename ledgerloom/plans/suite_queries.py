"""Queries of the suites over feeds, facts and prices, and of orphans and what they recommend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality

from .quality_queries import one
from .registry import query
from .views import EVENTS_DAY, Views


def suite_facts(v: Views) -> DataFrame:
    """Facts with a taxonomy, some without unit, number or date, and with tags of their own."""
    f = v.facts()
    tag = F.when(F.col("tag_name") == "AF", "Assets").when(F.col("tag_name") == "NO", "Revenues").otherwise(F.col("tag_name"))
    return f.select(
        "cik", F.when(F.col("fp") != "7", F.col("accession_number")).alias("accession_number"), F.lit("us-gaap").alias("taxonomy"), tag.alias("tag_name"),
        F.when(F.col("fp") == "6", "").otherwise(F.col("unit")).alias("unit"), "form", F.when(F.col("period_end_date") > F.lit("1998-09-01").cast("date"), F.col("filed_date")).alias("filed_date"),
        F.when(F.col("value_numeric") > 2000, F.col("value_numeric") * 1e9).alias("value_numeric"),
    )


SUITE_FACTS = """suite_facts AS (SELECT cik, CASE WHEN fp <> '7' THEN accession_number END AS accession_number, CASE tag_name WHEN 'AF' THEN 'Assets'
WHEN 'NO' THEN 'Revenues' ELSE tag_name END AS tag_name,
CASE WHEN fp = '6' THEN '' ELSE unit END AS unit, CASE WHEN period_end_date > DATE '1998-09-01' THEN filed_date END AS filed_date, CASE
WHEN value_numeric > 2000 THEN value_numeric * 1e9 END AS value_numeric FROM facts)"""


@query(f"+{SUITE_FACTS} " + " UNION ALL ".join([
    one("xbrl_facts null keys", "SELECT count(*) FROM suite_facts WHERE accession_number IS NULL", "n <= 0"),
    one("xbrl_facts monetary without number", "SELECT count(*) FROM suite_facts WHERE unit IN ('USD', 'EUR') AND value_numeric IS NULL", "n <= 0"),
    one("xbrl_facts.filed_date null", "SELECT count(*) FROM suite_facts WHERE filed_date IS NULL", "n <= 0"),
    one("xbrl_facts without unit", "SELECT count(*) FROM suite_facts WHERE unit IS NULL OR unit = ''", "n <= 1000", "warning"),
    *(one(f"xbrl_facts outliers of {t}", f"SELECT count(*) FROM suite_facts WHERE tag_name = '{t}' AND abs(value_numeric) > 1e14", "n <= 0", "warning") for t in ("Assets",
    "Revenues", "NetIncomeLoss")),
]))
def facts_suite(v: Views) -> DataFrame:
    return quality.facts_suite(suite_facts(v))


ORPHANED = "orphaned AS (SELECT * FROM facts WHERE accession_number NOT IN (SELECT accession_number FROM filings WHERE status = 'F'))"


def orphaned(v: Views) -> DataFrame:
    return v.facts().join(v.filings().where("status = 'F'").select("accession_number"), "accession_number", "left_anti")


#: Some orphans under another company than their filing's: a filing of their accession alone isn't theirs.
MOVED = "moved AS (SELECT accession_number, CASE WHEN fp = '3' THEN cik || 'x' ELSE cik END AS cik FROM orphaned)"


@query(f"+{ORPHANED}, {MOVED} " + " UNION ALL ".join([
    one("xbrl_facts_orphaned rows", "SELECT count(*) FROM moved", "n <= 1000", "warning"),
    one("xbrl_facts_orphaned with a filing", "SELECT count(*) FROM moved o JOIN filings f ON o.accession_number = f.accession_number AND o.cik = f.cik WHERE f.status <> 'P'", "n = 0"),
]))
def orphan_suite(v: Views) -> DataFrame:
    moved = orphaned(v).withColumn("cik", F.when(F.col("fp") == "3", F.concat("cik", F.lit("x"))).otherwise(F.col("cik")))
    return quality.orphan_suite(moved, v.filings().where("status <> 'P'"))


@query(f"+{ORPHANED} SELECT DISTINCT accession_number, cik FROM orphaned ORDER BY 1, 2 LIMIT 10")
def orphan_samples(v: Views) -> DataFrame:
    filings = v.filings().where("status = 'F'")
    return quality.orphan_samples(v.facts(), ["accession_number", "cik"], filings, ["accession_number", "cik"], 10)


PROFILES = (("taxonomy",), ("cik",), ("form",), ("taxonomy", "tag_name"))


def profile_sql(columns: tuple[str, ...]) -> str:
    names = ("taxonomy", "cik", "form", "tag_name")
    picked = ", ".join(x if x in columns else f"CAST(NULL AS VARCHAR) AS {x}" for x in names)
    return f"(SELECT '{','.join(columns)}' AS \"by\", {picked}, count(*) AS n_rows FROM o GROUP BY {', '.join(columns)} ORDER BY n_rows DESC, {', '.join(columns)} LIMIT 10)"


@query(f"+{ORPHANED}, o AS (SELECT unit AS taxonomy, cik, form, tag_name FROM orphaned) " + " UNION ALL ".join(map(profile_sql, PROFILES)))
def orphan_profile(v: Views) -> DataFrame:
    """Units stand in for taxonomies, of which the given tables have none."""
    return quality.orphan_profile(orphaned(v).withColumn("taxonomy", F.col("unit")))


@query(f"+{ORPHANED} SELECT accession_number, filed_date, cik, fp FROM orphaned ORDER BY filed_date, accession_number, cik, fp LIMIT 1")
def first_orphan(v: Views) -> DataFrame:
    return quality.first_orphan(orphaned(v).select("accession_number", "filed_date", "cik", "fp"))


@query("+ tags AS (SELECT DISTINCT tag_name, unit FROM facts WHERE fp = '7' OR tag_name = 'NO') " + one("xbrl_facts.tag_name,unit without parent",
    "SELECT count(*) FROM facts f WHERE NOT EXISTS (SELECT 1 FROM tags t WHERE t.tag_name = f.tag_name AND t.unit = f.unit)", "n = 0"))
def fk_two_columns(v: Views) -> DataFrame:
    """A reference of two columns: the tag and unit of every fact among those of some."""
    tags = v.facts().where("fp = '7' OR tag_name = 'NO'")
    return quality.foreign_key(v.facts(), "xbrl_facts", ["tag_name", "unit"], tags, ["tag_name", "unit"])


LISTED = "listed AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer UNION ALL SELECT 'none-' || s_suppkey FROM supplier)"
HISTORY = """h AS (SELECT ticker, date, CASE WHEN volume % 5 = 0 THEN close END AS open, CASE WHEN volume % 3 > 0 THEN close END AS close, CASE WHEN volume % 7 = 0 THEN close END AS adj_close,
CASE WHEN volume % 11 > 0 THEN volume - 2 END AS volume FROM prices)"""


@query(f"+ {LISTED}, {HISTORY} " + " UNION ALL ".join([
    one("stock_history null key", "SELECT count(*) FROM h WHERE ticker IS NULL OR date IS NULL", "n = 0"),
    one("stock_history negative volume", "SELECT count(*) FROM h WHERE volume < 0", "n = 0"),
    one("stock_history volume without price", "SELECT count(*) FROM h WHERE (open IS NULL AND close IS NULL AND adj_close IS NULL) AND volume IS NOT NULL", "n <= 1", "warning"),
    one("tickers without recent prices", f"""SELECT count(*) FROM (SELECT t.ticker FROM listed t LEFT JOIN
    (SELECT DISTINCT ticker FROM h WHERE date BETWEEN DATE '{EVENTS_DAY}' - 7 AND DATE '{EVENTS_DAY}') s ON t.ticker = s.ticker WHERE s.ticker IS NULL)""", "n <= 100", "warning"),
]))
def price_suite(v: Views) -> DataFrame:
    """Prices some of which have no open, close or adjusted close, and listed tickers some of which never had one."""
    n, price = F.col("volume"), F.col("close")
    history = v.prices().select(
        "ticker", "date", F.when(n % 5 == 0, price).alias("open"), F.when(n % 3 > 0, price).alias("close"), F.when(n % 7 == 0, price).alias("adj_close"), F.when(n % 11 > 0, n - 2).alias("volume"),
    )
    listed = v.table("customer").select(F.col("c_custkey").cast("string").alias("ticker")).union(v.table("supplier").select(F.concat(F.lit("none-"), "s_suppkey")))
    return quality.price_suite(history, listed, EVENTS_DAY)


FEED_TABLES = ("stock_history", "yf_profile_metrics", "yf_stock_actions", "yf_major_holders", "yf_recommendations")


@query("""+ known AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT CAST(s_suppkey AS VARCHAR) FROM supplier),
e AS (SELECT CASE WHEN event_id % 13 > 0 THEN CAST(user_id AS VARCHAR) END AS ticker, event_id % 5 AS k FROM events) """ + " UNION ALL ".join(
    one(f"{name} tickers not listed", f"SELECT count(t1.ticker) FROM (SELECT * FROM e WHERE k = {k}) t1 LEFT JOIN known t2 ON t1.ticker = t2.ticker WHERE t2.ticker IS NULL", "n = 0")
    for k, name in enumerate(FEED_TABLES)
))
def ticker_suite(v: Views) -> DataFrame:
    """Five tables of a feed against two lists of tickers."""
    e = v.table("events").select(F.when(F.col("event_id") % 13 > 0, F.col("user_id").cast("string")).alias("ticker"), (F.col("event_id") % 5).alias("k"))
    building = v.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("ticker"))
    return quality.ticker_suite({name: e.where(F.col("k") == k) for k, name in enumerate(FEED_TABLES)}, building, v.table("supplier").select(F.col("s_suppkey").cast("string").alias("ticker")))


def macro_rows(v: Views) -> DataFrame:
    return v.table("events").select(F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("series_id"), F.to_date("ts").alias("date"), F.when(F.col("user_id") % 9 != 0,
        F.col("value")).alias("value"))


@query("""+ m AS (SELECT CASE WHEN event_id % 50 <> 0 THEN event_type END AS series_id, CAST(ts AS DATE) AS date, CASE WHEN user_id % 9 <> 0 THEN value END AS value FROM events),
r AS (SELECT DISTINCT date, series_id AS factor_model, CASE WHEN month(date) > 0 THEN value END AS mkt_minus_rf FROM m) """ + " UNION ALL ".join([
    one("macro_economic_data null key", "SELECT count(*) FROM m WHERE series_id IS NULL OR date IS NULL", "n <= 0"),
    one("macro_economic_data.value null", "SELECT count(*) FROM m WHERE value IS NULL", "n = 0"),
    one("macro_economic_data series", "SELECT count(DISTINCT series_id) FROM m", "n >= 1"), one("macro_economic_data days", "SELECT date_diff('day', min(date), max(date)) FROM m", "n >= 0"),
    one("market_risk_factors null key", "SELECT count(*) FROM r WHERE date IS NULL OR factor_model IS NULL", "n <= 0"),
    one("market_risk_factors.mkt_minus_rf null", "SELECT count(*) FROM r WHERE mkt_minus_rf IS NULL", "n = 0"),
    one("market_risk_factors models", "SELECT count(DISTINCT factor_model) FROM r", "n >= 1"),
]))
def macro_suite(v: Views) -> DataFrame:
    m = macro_rows(v)
    return quality.macro_suite(m, m.select("date", F.col("series_id").alias("factor_model"), F.col("value").alias("mkt_minus_rf")).distinct())


@query("""+ s AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal / 8000 AS share, c_mktsegment AS kind, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS firm,
CASE WHEN c_custkey % 4 > 0 THEN 1 END AS fetched FROM customer) """ + " UNION ALL ".join([
    one("yf_profile_metrics null key or time", "SELECT count(*) FROM s WHERE ticker IS NULL OR fetched IS NULL", "n = 0"),
    one("yf_profile_metrics cik length", "SELECT count(*) FROM s WHERE length(ticker) + 7 <> 10", "n = 0"),
    one("yf_major_holders null key or time", "SELECT count(*) FROM s WHERE ticker IS NULL OR fetched IS NULL", "n = 0"),
    one("yf_major_holders share out of range", "SELECT count(*) FROM s WHERE share < 0 OR share > 1 OR share / 2 < 0 OR share / 2 > 1", "n = 0"),
    one("yf_stock_actions null key", "SELECT count(*) FROM s WHERE ticker IS NULL OR kind IS NULL", "n = 0"),
    one("yf_recommendations null key", "SELECT count(*) FROM s WHERE firm IS NULL", "n = 0"),
]))
def supplementary_suite(v: Views) -> DataFrame:
    c = v.table("customer").withColumn("ticker", F.col("c_custkey").cast("string")).withColumn("day", F.lit(EVENTS_DAY).cast("date"))
    share, fetched = F.col("c_acctbal") / 8000, F.when(F.col("c_custkey") % 4 > 0, F.col("day")).alias("fetch_timestamp")
    return quality.supplementary_suite(
        c.select("ticker", F.concat(F.lit("0000000"), "ticker").alias("cik"), fetched), c.select("ticker", share.alias("pct_insiders"), (share / 2).alias("pct_institutions"), fetched),
        c.select("ticker", F.col("day").alias("action_date"), F.col("c_mktsegment").alias("action_type")),
        c.select("ticker", F.col("day").alias("recommendation_timestamp"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("firm")),
    )


@query("SELECT event_type AS kind, count(*) AS n_rows FROM events GROUP BY 1")
def kinds(v: Views) -> DataFrame:
    return quality.kinds(v.table("events"), "event_type")


@query(" UNION ALL ".join([
    one("stock_fetch_errors rows", "SELECT count(*) FROM events WHERE event_type = 'error'", "n = 0", "warning"),
    one("yf_info_fetch_errors rows", "SELECT count(*) FROM events WHERE event_type <> 'error' AND value IS NULL", "n = 0", "warning"),
]))
def error_tables(v: Views) -> DataFrame:
    e = v.table("events")
    return quality.error_tables({"stock_fetch_errors": e.where("event_type = 'error'"), "yf_info_fetch_errors": e.where("event_type <> 'error' AND value IS NULL")})


@query(" UNION ALL ".join([
    *(f"SELECT '{t} exists' AS \"check\", {str(there).lower()} AS passed, '{state}' AS severity, {int(there)} AS value" for t, there,
    state in (("orders", True, "ok"), ("customer", True, "ok"), ("stock_history", False, "error"), ("yf_stock_actions", False, "warning"))),
    one("orders rows", "SELECT count(*) FROM orders", "n >= 1"), one("customer rows", "SELECT count(*) FROM customer", "n >= 1"),
]))
def table_presence(v: Views) -> DataFrame:
    """Tables of the catalogue: those that are missing are errors, or warned of if they are optional."""
    for name in ("orders", "customer"):
        v.table(name).createOrReplaceTempView(f"presence_{name}")
    found = quality.in_catalog(v.spark, ["presence_orders", "presence_customer", "presence_stock_history", "presence_yf_stock_actions"])
    return quality.counts_of(v.spark, {k.removeprefix("presence_"): df for k, df in found.items()}, optional=("yf_stock_actions",))


@query("""SELECT c.cik, f.filings FROM companies c JOIN (SELECT cik, count(*) AS filings FROM filings WHERE form IN ('1-URGENT', '2-HIGH') GROUP BY 1) f ON f.cik = c.cik
WHERE c.cik NOT IN (SELECT cik FROM facts WHERE tag_name = 'AF' AND filed_date > DATE '1998-01-01')""")
def without_facts(v: Views) -> DataFrame:
    """What the join report recommends: companies with filings of some forms and no late facts of a tag."""
    return quality.without_facts(v.companies(), v.filings(), v.facts().where("tag_name = 'AF' AND filed_date > DATE '1998-01-01'"), ["1-URGENT", "2-HIGH"])


@query("""SELECT count(DISTINCT t.ticker) AS tickers, count(DISTINCT c.cik) AS companies_matched, count(DISTINCT t.cik) AS ciks,
round(count(DISTINCT c.cik) / count(DISTINCT t.cik), 6) AS share FROM tickers t LEFT JOIN (SELECT * FROM companies WHERE category <> 'BUILDING') c ON t.cik = c.cik""")
def ticker_companies(v: Views) -> DataFrame:
    """Tickers against the companies of all but one category."""
    return quality.ticker_companies(v.tickers(), v.companies().where("category <> 'BUILDING'"))


@query("SELECT t.ticker, t.cik, count(f.accession_number) AS n_filings FROM tickers t LEFT JOIN filings f ON t.cik = f.cik GROUP BY t.ticker, t.cik")
def ticker_filings(v: Views) -> DataFrame:
    return quality.ticker_filings(v.tickers(), v.filings())


@query("""SELECT t.ticker, t.cik, count(DISTINCT f.tag_name) AS n_tags, count(f.cik) AS n_facts, count(DISTINCT f.tag_name) > 0 AS has_facts
FROM tickers t LEFT JOIN (SELECT * FROM facts WHERE unit = 'EUR' AND fp = '1') f ON t.cik = f.cik GROUP BY t.ticker, t.cik""")
def ticker_facts(v: Views) -> DataFrame:
    """Tickers against some of the facts, which not every company has."""
    return quality.ticker_facts(v.tickers(), v.facts().where("unit = 'EUR' AND fp = '1'"))


@query("""+ x AS (SELECT accession_number, CASE WHEN fp = '3' THEN cik || 'x' ELSE cik END AS cik, tag_name FROM facts WHERE unit = 'EUR')
SELECT f.cik, count(DISTINCT f.accession_number) AS filings, count(DISTINCT x.accession_number) AS with_facts, count(DISTINCT x.tag_name) AS n_tags,
round(count(DISTINCT x.accession_number) / count(DISTINCT f.accession_number), 6) AS share, min(t.ticker) AS ticker
FROM filings f LEFT JOIN x ON f.cik = x.cik AND f.accession_number = x.accession_number LEFT JOIN tickers t ON t.cik = f.cik GROUP BY f.cik""")
def filing_facts(v: Views) -> DataFrame:
    """Filings against facts on both keys; some facts have the accession alone."""
    x = v.facts().where("unit = 'EUR'").withColumn("cik", F.when(F.col("fp") == "3", F.concat("cik", F.lit("x"))).otherwise(F.col("cik")))
    return quality.filing_facts(v.filings(), x, v.tickers())
