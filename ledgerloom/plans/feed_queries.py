"""Queries of documents, feeds and reference tables beyond the core parse."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scalars
from ledgerloom.operators import integrity, normalize, tables
from ledgerloom.schemas import TABLES
from ledgerloom.session import shared_path
from ledgerloom.sources import archives, batches, feeds

from .document_queries import PAD, facts_texts
from .registry import query
from .views import Views

STAMP = "TIMESTAMP '2024-01-31 00:00:00'"


@query(f"SELECT DISTINCT {PAD} AS cik FROM companies")
def ticker_universe(v: Views) -> DataFrame:
    """CIKs of ticker files, one for each nation and 250,000 keys, so that a file has a bounded number of keys however many there are."""
    entry = F.struct(F.col("c_custkey").cast("string").alias("k"), F.struct(F.col("c_custkey").alias("cik_str"), F.col("c_name").alias("title")).alias("e"))
    c = v.table("customer").select("c_nationkey", F.expr("c_custkey div 250000").alias("block"), entry.alias("entry"))
    texts = c.unionAll(c).groupBy("c_nationkey", "block").agg(F.to_json(F.map_from_entries(F.collect_set("entry"))).alias("value"))
    return feeds.universe(texts)


@query("""SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS cik, n_name AS name, i - 1 AS place, list_extract(['A' || n_nationkey, 'B' || n_nationkey], CAST(i AS INTEGER)) AS ticker
FROM nation, (SELECT unnest([1, 2]) AS i)""")
def typed_file_scan(v: Views) -> DataFrame:
    """JSON files with declared columns; the key is in the path, and an array is numbered."""
    key = F.lpad(F.col("n_nationkey").cast("string"), 4, "0")
    doc = F.to_json(F.struct(F.col("n_name").alias("name"), F.array(F.concat(F.lit("A"), "n_nationkey"), F.concat(F.lit("B"), "n_nationkey")).alias("tickers")))
    path = shared_path(v.spark, "typed")
    v.table("nation").select(doc.alias("value"), F.concat(F.lit("CIK"), key, F.lit(".json")).alias("file")).write.partitionBy("file").text(path)
    docs = v.spark.read.schema("name string, tickers array<string>").json(path).select(scalars.cik_of_file("_metadata.file_path").alias("cik"), "name", "tickers")
    return docs.select("cik", "name", F.posexplode("tickers").alias("place", "ticker"))


@query("""SELECT CAST(user_id AS VARCHAR) AS series_id, CASE WHEN event_id % 4 > 0 THEN CAST(ts AS DATE) END AS date, CASE WHEN event_id % 5 > 0 THEN value END AS value
FROM events WHERE user_id % 3 < 2""")
def file_list_scan(v: Views) -> DataFrame:
    """Two of three batches by their paths, written with 'nan' and 'None' for nulls and columns in another order."""
    e = v.table("events")
    day = F.when(F.col("event_id") % 4 > 0, F.to_date("ts").cast("string")).otherwise("nan")
    value = F.when(F.col("event_id") % 5 > 0, F.col("value").cast("string")).otherwise("None")
    rows = e.select("user_id", value.alias("value"), F.col("user_id").cast("string").alias("series_id"), day.alias("date"))
    folder = shared_path(v.spark, "listed")
    for k in range(3):
        rows.where(F.col("user_id") % 3 == k).drop("user_id").write.parquet(f"{folder}/batch-{k}")
    return feeds.batches_normalized(v.spark, [f"{folder}/batch-{k}" for k in range(2)], "macro_economic_data")


def details_texts(v: Views) -> DataFrame:
    c = v.table("customer")
    address = F.struct(F.col("c_name").alias("address1"), F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("string").alias("postal_code"))
    stamp = F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("2024-01-"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00.123Z"))).otherwise("no time")
    doc = F.struct(
        F.when(F.col("c_custkey") % 11 > 0, F.concat(F.lit("T-"), "c_custkey")).alias("ticker"), F.col("c_name").alias("name"), (F.col("c_custkey") % 2 == 0).alias("active"),
        F.col("c_acctbal").alias("market_cap"),
        F.col("c_custkey").alias("total_employees"), stamp.alias("last_updated_utc"), address.alias("address"), F.struct(F.col("c_name").alias("logo_url")).alias("branding"),
    )
    return c.select(F.to_json(doc).alias("value"))


DETAIL_STAMP = "CASE WHEN c_custkey % 3 > 0 THEN CAST('2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00' AS TIMESTAMP) END"


@query(f"""SELECT 'T-' || c_custkey AS ticker, c_name AS name, c_custkey % 2 = 0 AS active, c_acctbal AS market_cap, c_custkey AS total_employees,
{STAMP} AS fetch_timestamp, {DETAIL_STAMP} AS last_updated_utc,
c_name AS address_1, c_mktsegment AS city, CAST(NULL AS VARCHAR) AS state, CAST(c_nationkey AS VARCHAR) AS postal_code, c_name AS logo_url,
CAST(NULL AS VARCHAR) AS icon_url FROM customer WHERE c_custkey % 11 > 0""")
def details_flatten(v: Views) -> DataFrame:
    rows = feeds.ticker_details(details_texts(v), "2024-01-31 00:00:00")
    return rows.select("ticker", "name", "active", "market_cap", "total_employees", "fetch_timestamp", "last_updated_utc", "address_1", "city", "state", "postal_code", "logo_url", "icon_url")


@query(f"""SELECT 'T-' || c_custkey AS ticker, c_name AS name, c_custkey % 2 = 0 AS active, CAST(NULL AS VARCHAR) AS cik, 'landed' AS source, {STAMP} AS fetched_at,
{DETAIL_STAMP} AS last_updated_utc FROM customer WHERE c_custkey % 11 > 0""")
def reference_flatten(v: Views) -> DataFrame:
    return feeds.ticker_reference(details_texts(v), "2024-01-31 00:00:00").select("ticker", "name", "active", "cik", "source", "fetched_at", "last_updated_utc")


@query("""+ f AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CASE WHEN user_id % 4 > 0 THEN CAST(ts AS DATE) END AS d FROM events WHERE user_id % 3 > 0),
n AS (SELECT ticker, count(d) AS dated, count(*) FILTER (WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-06') AS within FROM f GROUP BY 1)
SELECT r.ticker, CASE WHEN dated IS NULL THEN 'no data' WHEN dated = 0 THEN 'no valid dates' ELSE 'no data in range' END AS error
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker FROM events WHERE user_id IS NOT NULL) r LEFT JOIN n ON n.ticker = r.ticker WHERE dated IS NULL OR dated = 0 OR within = 0""")
def price_frame_errors(v: Views) -> DataFrame:
    e = v.table("events").where("user_id IS NOT NULL").withColumn("ticker", F.col("user_id").cast("string"))
    day = F.when(F.col("user_id") % 4 > 0, F.to_date("ts").cast("string")).otherwise("not a date")
    return feeds.price_errors(e, e.where("user_id % 3 > 0").select(F.col("ticker").alias("Ticker"), day.alias("Date")), "2024-01-05", "2024-01-06")


@query("SELECT CAST(n_nationkey AS VARCHAR) || '.json' AS member, n_name AS text, CAST(n_regionkey AS VARCHAR) || '.zip' AS archive FROM nation")
def zip_round_trip(v: Views) -> DataFrame:
    """Archives, one for each region with a member for each nation, written and read member by member."""
    import io
    import zipfile

    import pandas as pd
    from pyarrow import fs

    folder = shared_path(v.spark, "archives")
    plain = folder if "://" in folder else f"file://{folder}"

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("readme.txt", "no member")
            for key, name in zip(pdf["n_nationkey"], pdf["n_name"], strict=True):
                z.writestr(f"{key}.json", name)
        system, where = fs.FileSystem.from_uri(f"{plain}/{pdf['n_regionkey'].iloc[0]}.zip")
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(where) as out:
            out.write(held.getvalue())
        return pd.DataFrame({"n": [len(pdf)]})

    v.table("nation").groupBy("n_regionkey").applyInPandas(packed, "n long").count()
    rows = feeds.zip_members(v.spark, folder)
    return rows.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", "text")


@query("SELECT CAST(doc_id AS VARCHAR) || '.json' AS member, md5(coalesce(text, '')) AS text_md5, source || '.zip' AS archive FROM documents")
def zip_documents(v: Views) -> DataFrame:
    """All documents as members of archives, one for each source, read back by the source of Spark that knows such archives."""
    import pandas as pd

    folder = shared_path(v.spark, "zipped")
    plain = folder if "://" in folder else f"file://{folder}"

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of one source after another; an archive is written member by member."""
        import zipfile

        from pyarrow import fs

        open_for = z = out = None
        for frame in frames:
            for source, doc_id, text in zip(frame["source"], frame["doc_id"], frame["text"], strict=True):
                if source != open_for:
                    if z:
                        z.close(), out.close()
                    system, where = fs.FileSystem.from_uri(f"{plain}/{source}.zip")
                    system.create_dir(where.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(where)
                    z, open_for = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED), source
                    z.writestr("readme.txt", "no member")
                z.writestr(f"{doc_id}.json", text or "")
            yield pd.DataFrame({"n": [len(frame)]})
        if z:
            z.close(), out.close()

    v.table("documents").repartition("source").sortWithinPartitions("source", "doc_id").mapInPandas(packed, "n long").agg(F.sum("n")).collect()
    archives.register(v.spark)
    rows = v.spark.read.format("zip_members").option("path", plain).load()
    return rows.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def named_documents(v: Views) -> DataFrame:
    """A submission document for each company, with what it was called before: its supplier's name, and an entry without one."""
    names = v.former_names().select("cik", F.array(F.struct(F.col("former_name").alias("name"), F.lit("2001-02-03T00:00:00.000Z").alias("from"), F.lit("bad").alias("to")),
        F.struct(F.lit("").alias("name"), F.lit("2001-02-03").alias("from"), F.lit("").alias("to"))).alias("formerNames"))
    doc = F.struct("cik", F.col("primary_name").alias("name"), "formerNames", F.array(F.concat(F.lit("T-"), "cik")).alias("tickers"), F.array("category").alias("exchanges"))
    return v.companies().join(names, "cik", "left").select(F.to_json(doc).alias("value"))


@query(f"SELECT {PAD} AS cik, former_name, TIMESTAMP '2001-02-03 00:00:00' AS date_from, CAST(NULL AS TIMESTAMP) AS date_to FROM former_names WHERE cik IN (SELECT cik FROM companies)")
def former_names(v: Views) -> DataFrame:
    return normalize.former_names(normalize.submissions(named_documents(v)))


@query(f"SELECT accession_number, {PAD} AS cik, filing_date, form FROM filings WHERE status <> 'F'")
def new_filings(v: Views) -> DataFrame:
    """Filings of the documents that aren't processed yet."""
    from .document_queries import submission_texts

    docs = normalize.submissions(submission_texts(v))
    return normalize.filings(docs, v.filings().where("status = 'F'")).select("accession_number", "cik", "filing_date", "form")


@query(f"""SELECT {PAD.replace('cik', 'c.cik')} AS cik, primary_name, CASE WHEN c.cik IN (SELECT cik FROM facts) THEN 'Name' END AS entity_name_cf, '' AS fiscal_year_end,
CAST(NULL AS VARCHAR) AS phone, {STAMP} AS last_parsed_timestamp FROM companies c""")
def companies_named(v: Views) -> DataFrame:
    """Companies with the entity names of their facts documents."""
    rows = normalize.companies(normalize.submissions(named_documents(v)), F.lit("2024-01-31 00:00:00"), normalize.company_facts(facts_texts(v)))
    return rows.select("cik", "primary_name", "entity_name_cf", "fiscal_year_end", "phone", "last_parsed_timestamp")


@query(f"""+ left_ AS (SELECT cik, 1 AS n_tickers, CASE WHEN cik IN (SELECT cik FROM former_names) THEN 2 ELSE 0 END AS n_former_names FROM companies WHERE CAST(cik AS BIGINT) % 2 = 0),
right_ AS (SELECT cik, count(*) AS n_facts, count(DISTINCT tag_name) AS n_tags FROM facts GROUP BY 1)
SELECT CASE WHEN length(coalesce(l.cik, r.cik)) < 10 THEN lpad(coalesce(l.cik, r.cik), 10, '0') ELSE coalesce(l.cik, r.cik) END AS cik, coalesce(n_tickers,
0) AS n_tickers, coalesce(n_former_names, 0) AS n_former_names, 0 AS n_filings,
coalesce(n_facts, 0) AS n_facts, coalesce(n_tags, 0) AS n_tags FROM left_ l FULL JOIN right_ r ON l.cik = r.cik""")
def parse_summary(v: Views) -> DataFrame:
    """What the documents of each company hold, whichever of the two kinds there is."""
    docs = normalize.submissions(named_documents(v)).where(F.col("cik").cast("long") % 2 == 0)
    return normalize.parse_summary(docs, normalize.company_facts(facts_texts(v)))


WHEN = "strftime(o_orderdate, '%Y-%m-%d')"
TIMES = f"""CASE o_orderkey % 6 WHEN 0 THEN {WHEN} || 'T05:06:07.123Z' WHEN 1 THEN {WHEN} || 'T05:06:07Z' WHEN 2 THEN {WHEN} || 'T05:06:07+02:00' WHEN 3 THEN {WHEN}
WHEN 4 THEN 'not a time' ELSE {WHEN} || 'T25:00:00' END"""
SIZES = "list_extract(['12', '', '12.5', '-3', '007', 'x1', '0', 'false'], CAST(o_orderkey % 8 AS INTEGER) + 1)"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderdate AS DATE) + INTERVAL '5:06:07' HOUR WHEN 1 THEN CAST(o_orderdate AS DATE) + INTERVAL '5:06:07' HOUR
WHEN 2 THEN CAST(o_orderdate AS DATE) + INTERVAL '3:06:07' HOUR WHEN 3 THEN CAST(o_orderdate AS TIMESTAMP) END AS stamp,
CASE WHEN regexp_full_match({SIZES}, '[0-9]+') THEN CAST({SIZES} AS BIGINT) END AS size, {SIZES} NOT IN ('', '0', '0.0', 'false') AS truth,
'20240105_0607' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS batch_id, TIMESTAMP '2024-01-05 06:07:00' + to_seconds(o_orderkey % 60) AS batch_time FROM orders""".replace("INTERVAL '5:06:07' HOUR", "INTERVAL 18367 SECOND").replace("INTERVAL '3:06:07' HOUR", "INTERVAL 11167 SECOND"))
def lenient_scalars(v: Views) -> DataFrame:
    """Times, sizes, truths and batch ids from strings that hold them in many ways, or don't."""
    o = v.table("orders")
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 6
    forms = ["T05:06:07.123Z", "T05:06:07Z", "T05:06:07+02:00", "", None, "T25:00:00"]
    text = F.lit("not a time")
    for i, form in enumerate(forms):
        if form is not None:
            text = F.when(k == i, F.concat(day, F.lit(form))).otherwise(text)
    size = F.element_at(F.array(*(F.lit(x) for x in ["12", "", "12.5", "-3", "007", "x1", "0", "false"])), (F.col("o_orderkey") % 8).cast("int") + 1)
    file = F.concat(F.lit("/a/b/facts_20240105_0607"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"), F.lit(".parquet"))
    return o.select("o_orderkey", scalars.utc_timestamp(text).alias("stamp"), scalars.digits(size).alias("size"), scalars.truthy(size).alias("truth"),
        scalars.batch_id_of_file(file).alias("batch_id"), scalars.batch_time_of_file(file).alias("batch_time"))


@query("""+ cells AS (SELECT o_custkey AS ticker, o_orderpriority AS item_name, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY ALL)
SELECT ticker, make_date(y, 12, 31) AS report_date, item_name, CAST(trunc(s) AS BIGINT) AS item_value FROM cells WHERE y IN (1996, 1997) AND s IS NOT NULL""")
def statement_rows(v: Views) -> DataFrame:
    """Statements with a column for each report date, one of which is no date.

    Prices are added as decimals: a sum of doubles depends on their order, and one just below a whole number is cut to another.
    """
    price = F.col("o_totalprice").cast("decimal(18,2)")
    o = v.table("orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderpriority").alias("item_name"), F.year("o_orderdate").alias("y"), price.alias("price"))
    wide = o.groupBy("ticker", "item_name").agg(*(F.sum(F.when(F.col("y") == y, F.col("price"))).alias(name) for y,
        name in ((1996, "1996-12-31"), (1997, "1997-12-31"), (1998, "1998-13-31"), (1999, "TTM"))))
    return tables.statement_rows(wide, ["ticker"])


@query("""+ t AS (SELECT CAST(c_custkey AS VARCHAR) AS cik, 'T' || c_nationkey AS ticker, lower(c_mktsegment) AS exchange FROM customer),
once AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lower(ticker), lower(exchange) ORDER BY cik DESC) = 1)
SELECT cik, ticker, exchange FROM once WHERE cik IN (SELECT cik FROM filings)""")
def dedupe_then_fk(v: Views) -> DataFrame:
    """One row of each ticker and exchange, whatever their case; after that those of unknown companies go."""
    t = v.table("customer").select(F.col("c_custkey").cast("string").alias("cik"), F.concat(F.lit("T"), "c_nationkey").alias("ticker"), F.lower("c_mktsegment").alias("exchange"))
    return integrity.referenced(tables.keep_one(t, ["ticker", "exchange"], nocase=("ticker", "exchange")), v.filings(), "cik")


@query("""SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date, max(value) AS value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL""")
def repair_key(v: Views) -> DataFrame:
    """A table that lost its key, with one row for each again."""
    e = v.table("events").select(F.col("user_id").cast("string").alias("series_id"), F.to_date("ts").alias("date"), "value")
    return tables.repaired(e, TABLES["macro_economic_data"])


@query("""+ i AS (SELECT 'T-' || c_custkey AS ticker, c_name AS name, c_acctbal AS market_cap, c_custkey AS k FROM customer)
SELECT ticker, CASE WHEN k % 2 = 0 THEN upper(name) ELSE name END AS name, CASE WHEN k % 2 = 0 THEN market_cap + 1 ELSE market_cap END AS market_cap,
CASE WHEN k % 2 = 0 THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS fetch_timestamp, CAST(NULL AS VARCHAR) AS city FROM i WHERE k % 2 = 0 OR k % 3 = 0""")
def info_upsert(v: Views) -> DataFrame:
    """Reference rows of every third customer, and a batch for every other one with a few columns, twice, the newer to win."""
    c = v.table("customer").select("c_custkey", F.concat(F.lit("T-"), "c_custkey").alias("ticker"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("market_cap"))
    spec = TABLES["updated_ticker_info"]
    base = batches.prepared(c.where("c_custkey % 3 = 0").withColumn("fetch_timestamp", F.lit("2024-01-01 00:00:00")), spec)
    new = c.where("c_custkey % 2 = 0").select("ticker", F.upper("name").alias("name"), (F.col("market_cap") + 1).alias("market_cap"), F.lit("2024-01-31 00:00:00").alias("fetch_timestamp"))
    older = new.withColumn("fetch_timestamp", F.lit("2024-01-30 00:00:00")).withColumn("name", F.lit("older"))
    return tables.upsert_by_spec(base, older.unionByName(new), spec).select("ticker", "name", "market_cap", "fetch_timestamp", "city")


@query("""+ e AS (SELECT 'U' || user_id AS ticker, max(event_type) AS reason FROM events WHERE event_type IN ('error', 'click') AND user_id % 2 = 0 GROUP BY 1),
b AS (SELECT DISTINCT 'u' || user_id AS ticker, 'before' AS reason, TIMESTAMP '2024-01-01 00:00:00' AS last_failed_timestamp FROM events WHERE user_id % 3 = 0)
SELECT * FROM b WHERE upper(ticker) NOT IN (SELECT ticker FROM e) UNION ALL SELECT ticker, reason, TIMESTAMP '2024-01-31 00:00:00' FROM e""")
def mark_untrackable(v: Views) -> DataFrame:
    e = v.table("events")
    base = e.where("user_id % 3 = 0").select(F.concat(F.lit("u"), "user_id").alias("ticker"), F.lit("before").alias("reason"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("last_failed_timestamp")).distinct()
    failures = e.where("event_type IN ('error', 'click') AND user_id % 2 = 0").select(F.concat(F.lit("u"), "user_id").alias("ticker"), F.col("event_type").alias("reason"))
    return tables.mark_untrackable(base, failures, "2024-01-31 00:00:00")


@query("""SELECT 'T-' || c_custkey AS ticker, CASE WHEN c_custkey % 11 > 0 THEN 'landed' ELSE 'old' END AS source, CASE WHEN c_custkey % 11 > 0 THEN c_name END AS name
FROM customer WHERE c_custkey % 11 > 0 OR c_custkey % 22 = 0""")
def ticker_enrichment(v: Views) -> DataFrame:
    """Reference rows of landed documents over those that a table has."""
    spec = TABLES["massive_tickers"]
    old = v.table("customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("T-"), "c_custkey").alias("ticker"), F.lit("old").alias("source"), F.lit("2023-01-01 00:00:00").alias("fetched_at"))
    new = feeds.ticker_reference(details_texts(v), "2024-01-31 00:00:00")
    return tables.upsert_by_spec(batches.prepared(old, spec), new, spec).select("ticker", "source", "name")
