"""Queries of the checks, coverages and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality

from .registry import query
from .views import Views


def one(name: str, value: str, fine: str, severity: str = "error") -> str:
    """A check in SQL: ``value`` a scalar, ``fine`` a test of n."""
    return f"SELECT '{name}' AS \"check\", {fine} AS passed, CASE WHEN {fine} THEN 'ok' ELSE '{severity}' END AS severity, n AS value FROM (SELECT CAST(({value}) AS BIGINT) AS n)"


FK = [
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey"),
]


@query(" UNION ALL ".join(one(f"{a}.{b} without parent", f"SELECT count(*) FROM {a} WHERE {b} IS NULL OR {b} NOT IN (SELECT {d} FROM {c})", "n = 0") for a, b, c, d in FK))
def fk_checks(v: Views) -> DataFrame:
    return quality.suite(*(quality.foreign_key(v.table(a), a, [b], v.table(c), [d]) for a, b, c, d in FK))


KEYS = [("customer", ["c_custkey"]), ("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("part", ["p_partkey"]), ("events", ["event_id"]), ("events", ["user_id", "ts"])]


@query(" UNION ALL ".join(one(f"{t} duplicates on {','.join(k)}", f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)", "n = 0") for t, k in KEYS))
def dup_keys(v: Views) -> DataFrame:
    return quality.suite(*(quality.unique_key(v.table(t), t, k) for t, k in KEYS))


@query(" UNION ALL ".join(one(f"{t} key {','.join(k)}",
    f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1 OR {' OR '.join(f'{x} IS NULL' for x in k)})", "n = 0") for t, k in KEYS))
def primary_keys(v: Views) -> DataFrame:
    return quality.suite(*(quality.primary_key(v.table(t), t, k) for t, k in KEYS))


NULLS = [("customer", "c_name"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "user_id"), ("events", "value"), ("documents", "text"), ("pages", "html")]


@query(" UNION ALL ".join(one(f"{t}.{c} null", f"SELECT count(*) FROM {t} WHERE {c} IS NULL", "n <= 0") for t, c in NULLS))
def null_checks(v: Views) -> DataFrame:
    return quality.suite(*(quality.no_nulls(v.table(t), t, c) for t, c in NULLS))


RANGES = [("lineitem", "l_discount", 0.0, 0.05), ("lineitem", "l_quantity", 1.0, 50.0), ("customer", "c_acctbal", 0.0, 9999.0), ("events", "value", 0.0, 50.0)]


@query(" UNION ALL ".join(one(f"{t}.{c} out of range", f"SELECT count(*) FROM {t} WHERE {c} < {a} OR {c} > {b}", "n <= 0") for t, c, a, b in RANGES))
def range_checks(v: Views) -> DataFrame:
    return quality.suite(*(quality.in_range(v.table(t), t, c, a, b) for t, c, a, b in RANGES))


@query(one("facts.period_end_date before filed_date", "SELECT count(*) FROM facts WHERE period_end_date < filed_date", "n <= 0"))
def date_order(v: Views) -> DataFrame:
    return quality.dates_in_order(v.facts(), "facts", "filed_date", "period_end_date")


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]


@query(" UNION ALL ".join(one(f"{t} rows", f"SELECT count(*) FROM {t}", "n >= 100") for t in TABLES))
def row_counts(v: Views) -> DataFrame:
    return quality.suite(*(quality.row_count(v.table(t), t, 100) for t in TABLES))


SUMMARY = [
    one("dup", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)", "n = 0"),
    one("null", "SELECT count(*) FROM customer WHERE c_name IS NULL", "n <= 0"),
    one("warn", "SELECT count(*) FROM events WHERE event_type = 'error'", "n <= 10", "warning"),
]


@query(f"""SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings,
CASE WHEN count(*) FILTER (WHERE severity = 'error') > 0 THEN 'failed' WHEN count(*) FILTER (WHERE severity = 'warning') > 0 THEN 'passed with warnings' ELSE 'passed' END AS verdict,
round(count(*) FILTER (WHERE passed) * 100 / count(*), 2) AS pass_rate FROM ({' UNION ALL '.join(SUMMARY)})""")
def quality_summary(v: Views) -> DataFrame:
    checks = quality.suite(
        quality.unique_key(v.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]), quality.no_nulls(v.table("customer"), "customer", "c_name"),
        quality.at_most(v.table("events"), "errors", F.col("event_type") == "error", 10),
    )
    return quality.overall(checks)


@query(f"""SELECT *, CASE WHEN passed THEN 'Passed' WHEN severity = 'warning' THEN 'Above Its Threshold' ELSE 'Failed' END || ': ' || "check" || ', ' || value || ' found' AS message
FROM ({' UNION ALL '.join(SUMMARY)})""".replace("'dup'", "'lineitem duplicates on l_orderkey,l_linenumber'").replace("'null'", "'customer.c_name null'").replace("'warn'", "'errors'"))
def described_checks(v: Views) -> DataFrame:
    return quality.described(quality.suite(
        quality.unique_key(v.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]), quality.no_nulls(v.table("customer"), "customer", "c_name"),
        quality.at_most(v.table("events"), "errors", F.col("event_type") == "error", 10),
    ))


def missing(table: str, wanted: list[str]) -> str:
    return f"SELECT {len(wanted)} - count(*) FROM (DESCRIBE SELECT * FROM {table}) WHERE column_name IN ({', '.join(map(repr, wanted))})"


COMPANY_COLUMNS, FILING_COLUMNS = ["cik", "primary_name", "entity_type", "sic", "sic_description"], ["accession_number", "cik", "filing_date", "form"]


@query("+ described AS (SELECT cik, primary_name, category AS entity_type FROM companies) " + " UNION ALL ".join([
    *(one(f"{t} exists", f"SELECT {int(t != 'xbrl_tags')}", "n = 1") for t in ("companies", "tickers", "former_names", "filings", "xbrl_tags", "xbrl_facts")),
    one("companies columns", missing("described", COMPANY_COLUMNS), "n = 0"), one("filings columns", missing("filings", FILING_COLUMNS), "n = 0"),
    one("companies key cik", "SELECT count(*) FROM (SELECT 1 FROM companies GROUP BY cik HAVING count(*) > 1 OR cik IS NULL)", "n = 0"),
    one("filings key accession_number", "SELECT count(*) FROM (SELECT 1 FROM filings GROUP BY accession_number HAVING count(*) > 1 OR accession_number IS NULL)", "n = 0"),
    one("companies duplicates on cik", "SELECT count(*) FROM (SELECT 1 FROM companies GROUP BY cik HAVING count(*) > 1)", "n = 0"),
    one("filings duplicates on accession_number", "SELECT count(*) FROM (SELECT 1 FROM filings GROUP BY accession_number HAVING count(*) > 1)", "n = 0"),
    one("tickers duplicates on ticker,exchange", "SELECT count(*) FROM (SELECT 1 FROM tickers GROUP BY ticker, exchange HAVING count(*) > 1)", "n = 0"),
    one("companies.cik null", "SELECT count(*) FROM companies WHERE cik IS NULL", "n <= 0"),
    *(one(f"filings.{c} null", f"SELECT count(*) FROM filings WHERE {c} IS NULL", "n <= 0") for c in ("accession_number", "cik", "form")),
    *(one(f"{n}.cik without parent", f"SELECT count(*) FROM {t} WHERE cik IS NULL OR cik NOT IN (SELECT cik FROM companies)", "n = 0") for n,
    t in (("filings", "filings"), ("tickers", "tickers"), ("former_names", "former_names"), ("xbrl_facts", "facts"))),
    one("xbrl_facts.accession_number without parent", "SELECT count(*) FROM facts WHERE accession_number NOT IN (SELECT accession_number FROM filings)", "n = 0"),
    one("companies rows", "SELECT count(*) FROM companies", "n >= 1"), one("filings rows", "SELECT count(*) FROM filings", "n >= 1"),
]))
def core_suite(v: Views) -> DataFrame:
    """The suite of the core tables; two columns of companies, and the tags, aren't in the given tables."""
    companies = v.companies().withColumnRenamed("category", "entity_type")
    return quality.core_suite(companies, v.tickers(), v.former_names(), v.filings(), v.facts())


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS \"join\", count(*) AS keys, count(b.k) AS matched, round(count(b.k) / count(*), 6) AS share FROM (SELECT DISTINCT {k} AS k FROM {a}) a LEFT JOIN (SELECT DISTINCT {k} AS k FROM {t}) b ON a.k = b.k"
    for n, a, t, k in (("ticker to company", "tickers", "companies", "cik"), ("ticker to filing", "tickers", "filings", "cik"),
        ("company to ticker", "companies", "tickers", "cik"), ("filing to fact", "filings", "facts", "accession_number"))
))
def join_coverage(v: Views) -> DataFrame:
    pairs = (
        ("ticker to company", v.tickers(), v.companies(), "cik"), ("ticker to filing", v.tickers(), v.filings(), "cik"),
        ("company to ticker", v.companies(), v.tickers(), "cik"), ("filing to fact", v.filings(), v.facts(), "accession_number"),
    )
    return quality.suite(*(quality.coverage_of_join(a, b, [k], n) for n, a, b, k in pairs))


@query("""SELECT g.cik, count(DISTINCT g.accession_number) AS filings, count(DISTINCT f.accession_number) AS with_facts, round(count(DISTINCT f.accession_number) /
count(DISTINCT g.accession_number), 6) AS share
FROM filings g LEFT JOIN facts f ON f.accession_number = g.accession_number AND f.cik = g.cik AND f.unit = 'EUR' GROUP BY 1""")
def facts_coverage(v: Views) -> DataFrame:
    have = v.facts().where("unit = 'EUR'").select("accession_number", "cik", F.col("accession_number").alias("hit")).distinct()
    joined = v.filings().join(have, ["accession_number", "cik"], "left").groupBy("cik")
    n, hit = F.count_distinct("accession_number"), F.count_distinct("hit")
    return joined.agg(n.alias("filings"), hit.alias("with_facts"), F.round(F.try_divide(hit.cast("double"), n), 6).alias("share"))


@query("""SELECT min(length(c_name)) AS shortest, max(length(c_name)) AS longest, count(DISTINCT c_name) AS names, count(*) AS n_rows FROM customer""")
def key_format(v: Views) -> DataFrame:
    n = F.length("c_name").cast("long")
    return v.table("customer").agg(F.min(n).alias("shortest"), F.max(n).alias("longest"), F.count_distinct("c_name").alias("names"), F.count("*").alias("n_rows"))


@query("SELECT form, tag_name, count(*) AS n_rows FROM facts WHERE accession_number NOT IN (SELECT accession_number FROM filings WHERE status = 'F') GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def topk_orphans(v: Views) -> DataFrame:
    lone = v.facts().join(v.filings().where("status = 'F'").select("accession_number"), "accession_number", "left_anti")
    return quality.top_groups(lone, ["form", "tag_name"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE abs(l_extendedprice) > 90000 ORDER BY abs(l_extendedprice) DESC, 1, 2, 3 LIMIT 5")
def outliers_topk(v: Views) -> DataFrame:
    high = v.table("lineitem").where(F.abs("l_extendedprice") > 90000).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return high.orderBy(F.abs("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(5)


@query("""SELECT DISTINCT o_custkey AS ticker FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT user_id
FROM events WHERE user_id IS NOT NULL)""")
def ticker_consistency(v: Views) -> DataFrame:
    building = v.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("ticker"))
    users = v.table("events").where("user_id IS NOT NULL").select(F.col("user_id").alias("ticker"))
    return quality.unknown_tickers(v.table("orders").select(F.col("o_custkey").alias("ticker")), building, users)


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-26')")
def recent_gap(v: Views) -> DataFrame:
    late = v.table("orders").where("o_orderdate >= TIMESTAMP '2001-07-26'").select(F.col("o_custkey").alias("c_custkey"))
    return v.table("customer").select("c_custkey").distinct().join(late, "c_custkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def duplicate_profile(v: Views) -> DataFrame:
    return quality.duplicate_groups(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT accession_number, period_end_date, filed_date FROM facts WHERE period_end_date > filed_date + 1 ORDER BY filed_date, accession_number, period_end_date LIMIT 10""")
def date_anomalies(v: Views) -> DataFrame:
    return quality.late_periods(v.facts()).select("accession_number", "period_end_date", "filed_date")


@query("SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT event_type) AS series, count(*) FILTER (WHERE value IS NULL) AS nulls FROM events")
def macro_profile(v: Views) -> DataFrame:
    return v.table("events").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_distinct("event_type").alias("series"), F.count_if(F.col("value").isNull()).alias("nulls"))
