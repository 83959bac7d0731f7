"""Queries of nested documents, feeds, scalar functions and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scalars
from ledgerloom.operators import analysis, normalize
from ledgerloom.sources import batches, feeds

from .registry import query
from .views import ORDERS_DAY, Views


def submission_texts(v: Views) -> DataFrame:
    """One JSON document for each company, made of its orders."""
    o = v.filings().groupBy("cik").agg(F.array_sort(F.collect_list(F.struct("accession_number", F.col("filing_date").cast("string").alias("d"), "form"))).alias("f"))
    recent = F.struct(F.col("f.accession_number").alias("accessionNumber"), F.col("f.d").alias("filingDate"), F.col("f.form").alias("form"))
    doc = F.struct(
        "cik", F.col("primary_name").alias("name"), F.array(F.concat(F.lit("T-"), F.col("cik"))).alias("tickers"), F.array("category", F.lit("extra")).alias("exchanges"),
        F.struct(recent.alias("recent")).alias("filings"),
    )
    return v.companies().join(o, "cik").select(F.to_json(doc).alias("value"))


PAD = "CASE WHEN length(cik) < 10 THEN lpad(cik, 10, '0') ELSE cik END"


@query(f"SELECT accession_number, {PAD} AS cik, filing_date, form FROM filings")
def json_explode_filings(v: Views) -> DataFrame:
    return normalize.filings(normalize.submissions(submission_texts(v))).select("accession_number", "cik", "filing_date", "form")


@query(f"SELECT {PAD} AS cik, 'T-' || c.cik AS ticker, c.category AS exchange, 'submissions.json' AS source FROM companies c WHERE EXISTS (SELECT 1 FROM filings f WHERE f.cik = c.cik)")
def json_explode_tickers(v: Views) -> DataFrame:
    return normalize.tickers(normalize.submissions(submission_texts(v)))


@query(f"SELECT {PAD} AS cik, primary_name, '' AS fiscal_year_end FROM companies c WHERE EXISTS (SELECT 1 FROM filings f WHERE f.cik = c.cik)")
def json_companies(v: Views) -> DataFrame:
    return normalize.companies(normalize.submissions(submission_texts(v)), F.lit("2024-01-01")).select("cik", "primary_name", "fiscal_year_end")


def facts_texts(v: Views) -> DataFrame:
    """One JSON document for each company: taxonomy, tag, unit, facts. Facts are dealt out by company once, which serves all three groupings.

    A task takes about 100,000 of them: small when compressed, but each is composed and parsed as JSON.
    """
    one = F.struct(
        F.col("value_numeric").cast("string").alias("val"), F.col("accession_number").alias("accn"), F.col("period_end_date").cast("string").alias("end"),
        F.lit("2000").alias("fy"), "fp", "form", F.col("filed_date").cast("string").alias("filed"),
    )
    by_unit = v.facts().repartition(batches.bucket_count(v.table("lineitem").count(), each=100_000), "cik").groupBy("cik", "tag_name", "unit").agg(F.collect_list(one).alias("list"))
    by_tag = by_unit.groupBy("cik", "tag_name").agg(F.map_from_entries(F.collect_list(F.struct("unit", "list"))).alias("units"))
    tag = F.struct(F.col("tag_name").alias("label"), F.col("units").alias("units"))
    by_cik = by_tag.groupBy("cik").agg(F.map_from_entries(F.collect_list(F.struct("tag_name", tag))).alias("tags"))
    doc = F.struct("cik", F.lit("Name").alias("entityName"), F.create_map(F.lit("us-gaap"), F.col("tags")).alias("facts"))
    return by_cik.select(F.to_json(doc).alias("value"))


@query(f"""SELECT {PAD} AS cik, accession_number, 'us-gaap' AS taxonomy, tag_name, unit, period_end_date, value_numeric, CAST(NULL AS VARCHAR) AS value_text, 2000 AS fy,
fp, form, filed_date, '' AS frame FROM facts""")
def json_explode_facts(v: Views) -> DataFrame:
    return normalize.facts(normalize.company_facts(facts_texts(v)))


@query("SELECT DISTINCT 'us-gaap' AS taxonomy, tag_name, tag_name AS label, CAST(NULL AS VARCHAR) AS description FROM facts")
def json_explode_tags(v: Views) -> DataFrame:
    return normalize.tags(normalize.company_facts(facts_texts(v)))


#: Values of the JSON member isXBRL by turns, and what they mean: false and "false", 0 and "0" differ.
TRUTHS = [("false", "false"), ('"false"', "true"), ("0", "false"), ('"0"', "true"), ("1", "true"), ("true", "true"), ('""', "false"), ("null", "NULL"), ("0.0", "false"), ("[]",
    "false"), ('{"a": 0}', "true")]


@query(f"""SELECT accession_number, CASE CAST(accession_number AS BIGINT) % {len(TRUTHS)} {' '.join(f"WHEN {k} THEN {truth}" for k, (_, truth) in enumerate(TRUTHS))} END AS is_xbrl,
CASE WHEN CAST(accession_number AS BIGINT) % 2 = 0 THEN CAST(accession_number AS BIGINT) END AS size FROM filings""")
def json_typed_truth(v: Views) -> DataFrame:
    """Documents whose flags are of any JSON type, and sizes of which half are no whole number."""
    n = F.col("accession_number").cast("long")
    flag = F.element_at(F.array(*(F.lit(x) for x, _ in TRUTHS)), (n % len(TRUTHS)).cast("int") + 1)
    size = F.concat("accession_number", F.when(n % 2 == 1, ".5").otherwise(""))
    one = F.struct(F.to_json(F.struct("accession_number", F.col("filing_date").cast("string").alias("d"), "form")).alias("j"), flag.alias("flag"), size.alias("size"),
        "accession_number", "form", F.col("filing_date").cast("string").alias("d"))
    f = v.filings().groupBy("cik").agg(F.collect_list(one).alias("f"))

    def listed(name: str, quote: str = "") -> F.Column:
        return F.concat(F.lit("["), F.array_join(F.transform("f", lambda x: F.concat(F.lit(quote), x[name], F.lit(quote))), ","), F.lit("]"))

    parts = [("accessionNumber", listed("accession_number", '"')), ("filingDate", listed("d", '"')), ("form", listed("form", '"')), ("isXBRL", listed("flag")), ("size", listed("size"))]
    members = F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), x) for name, x in parts))
    texts = f.select(F.concat(F.lit('{"cik":"'), "cik", F.lit('","filings":{"recent":{'), members, F.lit("}}}")).alias("value"))
    return normalize.filings(normalize.submissions(texts)).select("accession_number", "is_xbrl", "size")


#: Values of the JSON member val by turns, as (JSON, number, text); # stands for the row's price.
VALUES = [("#", "#", None), ('"#"', "#", None), ("true", "1", None), ('"true"', None, "true"), ("false", "0", None), ('"NaN"', None, "NaN"), ('"-Infinity"', None, "-Infinity"),
    ("null", None, None), ('"12 apples"', None, "12 apples"), ('{"a":1}', None, '{"a":1}'), ("1.5e3", "1500", None)]
YEARS = [("2023", "2023"), ('"2023"', "2023"), ('"FY23"', "NULL"), ("2023.9", "2023"), ("null", "NULL")]


@query(f"""+ l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_orderkey % {len(VALUES)} AS k, l_partkey % {len(YEARS)} AS y FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber || '-' || l_partkey AS accession_number,
CASE k {' '.join(f"WHEN {k} THEN {'CAST(NULL AS DOUBLE)' if number is None else 'CAST(l_extendedprice AS DOUBLE)' if number == '#' else f'CAST({number} AS DOUBLE)'}" for k, (_, number, _) in enumerate(VALUES))} END AS value_numeric,
CASE k {' '.join(f"WHEN {k} THEN {'CAST(NULL AS VARCHAR)' if text is None else repr(text)}" for k, (_, _, text) in enumerate(VALUES))} END AS value_text,
CASE y {' '.join(f"WHEN {k} THEN CAST({year} AS INTEGER)" for k, (_, year) in enumerate(YEARS))} END AS fy FROM l""")
def json_typed_values(v: Views) -> DataFrame:
    """Facts whose values and years are of any JSON type: numbers stay numbers, text stays text."""
    pick = lambda rows, n: F.element_at(F.array(*(F.lit(x[0]) for x in rows)), (n % len(rows)).cast("int") + 1)
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    accession = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    fact = F.concat(
        F.lit('{"val":'), F.replace(pick(VALUES, F.col("l_orderkey")), F.lit("#"), price), F.lit(',"fy":'), pick(YEARS, F.col("l_partkey")),
        F.lit(',"accn":"'), accession, F.lit('","form":"10-K"}'),
    )
    lists = v.table("lineitem").groupBy("l_suppkey").agg(F.array_join(F.collect_list(fact), ",").alias("facts"))
    texts = lists.select(F.concat(F.lit('{"cik":'), "l_suppkey", F.lit(',"facts":{"us-gaap":{"Assets":{"units":{"USD":['), "facts", F.lit("]}}}}}")).alias("value"))
    return normalize.facts(normalize.company_facts(texts)).select("accession_number", "value_numeric", "value_text", "fy")


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_props(v: Views) -> DataFrame:
    return v.table("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT event_id, unnest(json_keys(props)) AS key FROM events WHERE json_array_length(json_keys(props)::JSON) > 0")
def json_key_unnest(v: Views) -> DataFrame:
    keys = v.table("events").select("event_id", F.json_object_keys("props").alias("keys")).where(F.size("keys") > 0)
    return keys.select("event_id", F.explode("keys").alias("key"))


LITERALS = ["NaN", "Infinity", "-Infinity", "abc", "1d", "0x1p3", "1_000", "1e400", "1e5", " 12 ", "-3.50", "", "+7", ".5", "5."]


@query(f"""+ v AS (SELECT CAST(l_extendedprice AS VARCHAR) AS s FROM lineitem UNION SELECT unnest({LITERALS!r})),
n AS (SELECT s, CASE WHEN regexp_full_match(s, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*') THEN TRY_CAST(trim(s) AS DOUBLE) END AS d FROM v)
SELECT s, CASE WHEN isfinite(d) THEN d END AS value_numeric, CASE WHEN d IS NULL OR NOT isfinite(d) THEN s END AS value_text FROM n""")
def fact_value_split(v: Views) -> DataFrame:
    values = v.table("lineitem").select(F.col("l_extendedprice").cast("decimal(18,2)").cast("double").cast("string").alias("s"))
    literals = v.spark.range(1).select(F.explode(F.array(*(F.lit(x) for x in LITERALS))).alias("s"))
    s = values.union(literals).distinct()
    return s.select("s", scalars.numeric_value("s").alias("value_numeric"), scalars.text_value("s").alias("value_text"))


@query(f"""SELECT o_orderkey, {PAD.replace('cik', 'CAST(o_custkey AS VARCHAR)')} AS cik, 'https://data/CIK' || {PAD.replace('cik', 'CAST(o_custkey AS VARCHAR)')} || '.json' AS url,
'https://archive.example/' || o_custkey || '/' || replace(o_orderpriority, '-', '') || '/a.htm' AS filing_url, replace(o_orderpriority, '-', '.') AS dotted,
CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_DAY}') AS INTEGER) AS age, CAST(o_orderdate + INTERVAL 60 MONTH AS DATE) AS later,
greatest(CAST(o_orderdate AS DATE), DATE '{ORDERS_DAY}' - 1000) AS clamped,
substr(o_orderpriority, 1, 3) AS head FROM orders""")
def scalar_functions(v: Views) -> DataFrame:
    o = v.table("orders")
    cik, day = scalars.pad_cik("o_custkey"), F.to_date("o_orderdate")
    end = F.lit(ORDERS_DAY).cast("date")
    return o.select(
        "o_orderkey", cik.alias("cik"), scalars.url("https://data/CIK{cik}.json", cik=cik).alias("url"),
        scalars.filing_url("https://archive.example", F.col("o_custkey").cast("string"), "o_orderpriority", F.lit("a.htm")).alias("filing_url"),
        scalars.dotted_ticker("o_orderpriority").alias("dotted"),
        F.datediff(end, day).alias("age"), F.add_months(day, 60).alias("later"), scalars.clamp_start(day, end, 1000).alias("clamped"), scalars.window_text("o_orderpriority", 3).alias("head"),
    )


MESSAGES = ["429 Client Error: Too Many Requests", "404 Not Found", "400 Bad Request", "timeout", "unable to open database file", "500 Server Error", "401 Client Error"]
MESSAGE = f"list_extract({MESSAGES!r}, CAST(event_id % {len(MESSAGES)} AS INTEGER) + 1)"


@query(f"""+ m AS (SELECT event_id, {MESSAGE} AS message FROM events)
SELECT event_id, message, (regexp_matches(message, '400|Bad Request|404|Not Found|Client Error') AND NOT regexp_matches(message, '(?i)429|too many requests')) AS permanent,
regexp_matches(message, '(?i)429|too many requests|unable to open database file') AS retryable,
CASE WHEN regexp_matches(message, '404|(?i)not found') THEN '404' WHEN regexp_matches(message, '(?i)429|too many requests') THEN '429' ELSE 'other' END AS bucket FROM m""")
def error_classes(v: Views) -> DataFrame:
    message = F.element_at(F.array(*(F.lit(x) for x in MESSAGES)), (F.col("event_id") % len(MESSAGES)).cast("int") + 1)
    m = v.table("events").select("event_id", message.alias("message"))
    return m.select("*", scalars.permanent_error("message").alias("permanent"), scalars.retryable_error("message").alias("retryable"), scalars.error_bucket("message").alias("bucket"))


@query("""SELECT event_type AS series_id, CAST(ts AS DATE) AS date, value FROM events WHERE value IS NOT NULL AND event_type <> 'error'""")
def macro_assemble(v: Views) -> DataFrame:
    e = v.table("events").select(F.col("event_type").alias("series_id"), F.to_date("ts").alias("date"), "value")
    notes = v.spark.range(1).select(F.lit("error").alias("series_id"), F.lit("Copyright, all of it").alias("notes"))
    return feeds.macro([e], notes)  # series by column: one scan, however many there are


@query("""+ d AS (SELECT CAST(ts AS DATE) AS date, max(value) AS m, min(value) AS r FROM events GROUP BY 1)
SELECT date, k AS factor_model, m / 100 AS mkt_minus_rf, CAST(NULL AS DOUBLE) AS smb, CAST(NULL AS DOUBLE) AS hml, CAST(NULL AS DOUBLE) AS rmw,
CAST(NULL AS DOUBLE) AS cma, r / 100 AS rf FROM d, (SELECT unnest(['3', '5']) AS k)""")
def risk_assemble(v: Views) -> DataFrame:
    d = v.table("events").groupBy(F.to_date("ts").alias("Date")).agg(F.max("value").alias("Mkt-RF"), F.min("value").alias("RF"))
    return feeds.risk_factors({"3": d, "5": d.union(d)})


@query("""SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, value AS open, value + 1 AS high, value - 1 AS low, value AS close, value AS adj_close,
CAST(event_id AS BIGINT) AS volume FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL""")
def bars_conform(v: Views) -> DataFrame:
    e = v.table("events").where("user_id IS NOT NULL AND value IS NOT NULL")
    bar = F.struct(F.col("event_id").alias("v"), F.col("value").alias("o"), (F.col("value") + 1).alias("h"), (F.col("value") - 1).alias("l"), F.col("value").alias("c"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"))
    texts = e.groupBy(F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("day")).agg(F.to_json(F.collect_list(bar)).alias("results"))
    return feeds.bars(texts)


@query("""SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, value AS close, CAST(event_id AS BIGINT) AS volume FROM events WHERE
CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def daily_prices(v: Views) -> DataFrame:
    frame = v.table("events").select(F.col("user_id").cast("string").alias("ticker"), F.col("ts").cast("date").cast("string").alias("Date"), F.col("value").alias("Close"),
        F.col("event_id").alias("Volume"))
    return feeds.daily_prices(frame, "2024-01-05", "2024-01-09").select("ticker", "date", "close", "volume")


CLEAN = "regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<table\\b.*?</table\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _old, _new in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    CLEAN = f"replace({CLEAN}, '{_old}', '{_new}')"
CLEAN = f"trim(regexp_replace({CLEAN}, '\\s+', ' ', 'g'))"


@query(f"SELECT page_id, md5({CLEAN}) AS text_md5, CAST(length({CLEAN}) AS BIGINT) AS n_chars FROM pages")
def html_text(v: Views) -> DataFrame:
    text = scalars.html_text("html")
    return v.table("pages").select("page_id", F.md5(text.cast("binary")).alias("text_md5"), F.length(text).cast("long").alias("n_chars"))


@query(f"""SELECT accession_number, left({CLEAN}, 4000) AS text, 'https://archive.example/' || cik || '/' || accession_number || '/a.htm' AS url,
CAST(NULL AS VARCHAR) AS summary_text, 'none' AS summary_model FROM filings f JOIN pages p ON CAST(p.page_id AS VARCHAR) = f.accession_number WHERE form = '1-URGENT'
AND filing_date >= DATE '{ORDERS_DAY}' - 2000""")
def summary_corpus(v: Views) -> DataFrame:
    pages = v.table("pages").select(F.col("page_id").cast("string").alias("accession_number"), "html")
    filings = v.filings().withColumn("primary_document", F.lit("a.htm"))
    none = v.filings().where("1 = 0")
    return analysis.summary_corpus(filings, pages, none, ["1-URGENT"], ORDERS_DAY, 2000).select("accession_number", "text", "url", "summary_text", "summary_model")


@query("""SELECT 'companies' AS "table", CAST(count(DISTINCT category) AS INTEGER) AS files, CAST(count(DISTINCT category) AS INTEGER) AS valid, 0 AS invalid, count(*) AS n_rows
FROM companies UNION ALL SELECT 'filings', count(DISTINCT status || form), count(DISTINCT status || form), 0, count(*) FROM filings""")
def batch_inventory(v: Views) -> DataFrame:
    """Files and rows of two tables, written as a file for each kind of row, by what lies in their folder."""
    from ledgerloom.session import shared_path

    folder = shared_path(v.spark, "inventory")
    for name, df, kinds in (("companies", v.companies(), ["category"]), ("filings", v.filings(), ["status", "form"])):
        df.repartition(*kinds).write.partitionBy(*kinds).parquet(f"{folder}/{name}")
    reports = [batches.directory_report(v.spark, f"{folder}/{name}").withColumn("table", F.lit(name)) for name in ("companies", "filings")]
    counts = (F.col(x).cast("int").alias(x) for x in ("files", "valid", "invalid"))
    return reports[0].unionByName(reports[1]).select("table", *counts, "n_rows")
