"""Queries that write tables, move them to their place, and read them back."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import integrity, sketches, tables
from ledgerloom.schemas import TABLES, TableSpec
from ledgerloom.session import shared_path
from ledgerloom.sources import batches, ledger, versions
from ledgerloom.streaming import ingest

from .registry import query
from .views import Views


@query("""SELECT 'tickers' AS "table", count(*) AS n_rows FROM (SELECT DISTINCT cik, ticker, exchange FROM tickers)
UNION ALL SELECT 'filings', count(*) FROM filings WHERE form IS NOT NULL UNION ALL SELECT 'former_names', count(*) FROM former_names
UNION ALL SELECT 'filings of the last', count(*) FROM filings""")
def fan_out_rules(v: Views) -> DataFrame:
    """One parse to three tables: different rows of tickers and names stay, of a filing's rows the one filed last."""
    folder, batch = shared_path(v.spark, "fan-out"), "20240131_000000"
    filings = v.filings()
    frames = {
        "tickers": v.tickers().unionAll(v.tickers()), "filings": filings.unionByName(filings.withColumn("filing_date", F.date_sub("filing_date", 9))),
        "former_names": v.former_names().withColumn("date_from", F.lit("2001-01-01").cast("timestamp")),
    }
    batches.fan_out(frames, folder, batch)
    stored = {name: batches.read_table(v.spark, f"{folder}/{name}", TABLES[name]) for name in frames}
    found = [df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows")) for name, df in stored.items()]
    last = stored["filings"].join(filings.select("accession_number", "filing_date"), ["accession_number", "filing_date"], "left_semi")
    found.append(last.agg(F.lit("filings of the last").alias("table"), F.count("*").alias("n_rows")))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("""SELECT '2024010' || (CAST(n % 3 AS INTEGER) + 1) || '_000000' AS batch_id, count(*) AS n_rows, sum(value) AS total
FROM (SELECT user_id AS n, CAST(ts AS DATE) AS d, max(value) AS value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def validated_batches(v: Views) -> DataFrame:
    """Batches written beside a table, counted, and moved to it; one is written twice and counts once."""
    path, spec = shared_path(v.spark, "validated"), TABLES["macro_economic_data"]
    rows = v.prices().select(F.col("ticker").alias("series_id"), "date", F.col("close").alias("value"))
    for k in (1, 2, 3, 2):
        batches.append_batch(rows.where(F.col("series_id").cast("long") % 3 == k - 1), path, spec, f"2024010{k}_000000")
    ids = batches.batch_ids(batches.inventory(v.spark, path))
    return batches.read_batches(v.spark, path, spec).join(ids, "batch_id").groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))


@query("""SELECT '20240101_0000' || lpad(CAST(o_custkey % 40 AS VARCHAR), 2, '0') AS batch_id, CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS files
FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) < 3""")
def partial_batches(v: Views) -> DataFrame:
    """Forty batches with a file for each status that their orders have: those with fewer than three are partial once they are old."""
    folder = shared_path(v.spark, "partial")
    batch = F.concat(F.lit("20240101_0000"), F.lpad((F.col("o_custkey") % 40).cast("string"), 2, "0"))
    rows = v.table("orders").withColumn("batch_id", batch).repartition("batch_id", "o_orderstatus")
    rows.write.partitionBy("batch_id", "o_orderstatus").parquet(folder)
    found = batches.partial_batches(batches.inventory(v.spark, folder), F.current_timestamp() + F.expr("INTERVAL 2 DAYS"))
    return found.select("batch_id", F.col("files").cast("int").alias("files"))


@query("SELECT CAST(event_id AS VARCHAR) AS ticker, 'failed: ' || event_type AS error FROM events WHERE event_type = 'error'")
def failures_round_trip(v: Views) -> DataFrame:
    path = shared_path(v.spark, "failures")
    failed = v.table("events").where("event_type = 'error'").select(F.col("event_id").cast("string").alias("ticker"), F.concat(F.lit("failed: "), "event_type").alias("error"), "value")
    batches.write_failures(failed, path)
    return v.spark.read.schema("ticker string, error string").option("sep", "\t").csv(path)


@query("SELECT DISTINCT cik FROM filings")
def processed_ciks(v: Views) -> DataFrame:
    """The companies that earlier batches hold, whichever and however often."""
    path, spec = shared_path(v.spark, "parsed"), TABLES["companies"]
    done = v.companies().join(v.filings().select("cik"), "cik", "left_semi")
    for k in range(2):
        batches.append_batch(done.where(f"cik % 3 >= {k}"), path, spec, f"20240101_00000{k}")
    return batches.processed_ciks(v.spark, path)


@query("""SELECT '2' AS version, 'companies' AS "table", count(*) AS n_rows FROM companies UNION ALL SELECT '2', 'filings', count(*) FROM filings WHERE status = 'F'""")
def rebuild_swap(v: Views) -> DataFrame:
    """Two builds and one that is held back: the pointer names the second."""
    folder = shared_path(v.spark, "build")
    none, filings = v.companies().where("1 = 0"), v.filings()
    batches.rebuild({"companies": v.companies(), "filings": filings}, folder, ["companies"])
    batches.rebuild({"companies": v.companies(), "filings": filings.where("status = 'F'")}, folder, ["companies"])
    batches.rebuild({"companies": none, "filings": filings}, folder, ["companies"])
    now = str(batches.current(v.spark, folder))
    stored = {name: versions.read(v.spark, folder, name, df.schema) for name, df in (("companies", v.companies()), ("filings", filings))}
    found = [df.agg(F.lit(now).alias("version"), F.lit(name).alias("table"), F.count("*").alias("n_rows")) for name, df in stored.items()]
    return found[0].unionByName(found[1])


LEDGERED = """+ e AS (SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date, event_type AS kind, max(value) AS value FROM events
WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
first_ AS (SELECT series_id, date, max(value) AS value FROM e WHERE kind <> 'click' GROUP BY ALL), second_ AS (SELECT series_id, date, max(value) AS value FROM e WHERE kind = 'click' GROUP BY ALL)"""


@query(f"{LEDGERED} SELECT series_id, date, value FROM second_ UNION ALL SELECT f.* FROM first_ f WHERE NOT EXISTS (SELECT 1 FROM second_ s WHERE s.series_id = f.series_id AND s.date = f.date)")
def ledger_merge(v: Views) -> DataFrame:
    """Two landings and three merges: later files replace rows by key, files in the ledger aren't merged again, a dry run changes nothing."""
    folder = shared_path(v.spark, "ledgered")
    source, spec = f"{folder}/landed", TABLES["macro_economic_data"]
    e = v.table("events").where("user_id IS NOT NULL AND ts IS NOT NULL").select(F.col("user_id").cast("string").alias("series_id"), F.to_date("ts").alias("date"), "value", "event_type")
    for late in (False, True):
        part = e.where((F.col("event_type") == "click") == late).groupBy("series_id", "date").agg(F.max("value").alias("value"))
        part.select(*spec.columns).write.mode("append").parquet(source)
        ledger.new_files(v.spark, {spec.name: source}, f"{folder}/stored").count()
        ledger.merge_new_files(v.spark, {spec.name: source}, f"{folder}/stored", "2024-01-31 00:00:00", buckets=8)
    ledger.merge_new_files(v.spark, {spec.name: source}, f"{folder}/stored", "2024-01-31 00:00:00", buckets=8)
    return ledger.merged_table(v.spark, f"{folder}/stored", spec.name)


@query("""SELECT CAST(ts AS DATE) AS fetch_date, count(*) AS attempted, count(*) FILTER (WHERE event_type <> 'error') AS fetched,
count(*) FILTER (WHERE value IS NULL OR value < 10) AS empty FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def counters_with_empty(v: Views) -> DataFrame:
    e = v.table("events").where("ts IS NOT NULL")
    return tables.counters(e, F.to_date("ts"), F.col("event_type") != "error", F.coalesce(F.col("value") < 10, F.lit(True)))


@query("SELECT CAST(ts AS DATE) AS fetch_date, count(*) AS attempted, count(*) FILTER (WHERE event_type <> 'error') AS fetched FROM events WHERE ts IS NOT NULL GROUP BY 1")
def stream_counters(v: Views) -> DataFrame:
    """Daily counters of a stream, each day's as of the last micro-batch that had any."""
    schema = v.table("events").schema
    stream = v.spark.readStream.schema(schema).parquet(f"{v.folder}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = shared_path(v.spark, "counted")
    counts = ingest.daily_counters(stream.where("ts IS NOT NULL"), "ts", "event_type <> 'error'", "400 days")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    done = v.spark.read.option("basePath", folder).schema("fetch_date date, attempted bigint, fetched bigint, batch int").parquet(f"{folder}/batch=*")
    return tables.keep_one(done, ["fetch_date"], [F.col("batch")]).drop("batch")


@query("SELECT ticker, date, close FROM prices")
def stream_compacted(v: Views) -> DataFrame:
    """A stream flushed file by file, stopped, compacted to one delta, and read."""
    from ledgerloom.schemas import TableSpec

    spec = TableSpec("prices", "ticker string, date date, close double", ("ticker", "date"), ("close",), upsert=True)
    folder = shared_path(v.spark, "compacted")
    rows = v.table("events").where("user_id IS NOT NULL AND ts IS NOT NULL").select(F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("date"), F.col("value").alias("close"))
    rows.groupBy("ticker", "date").agg(F.max("close").alias("close")).repartition(3, "ticker").write.parquet(f"{folder}/landed")
    stream = ingest.arrivals(v.spark, f"{folder}/landed", spec, files_at_once=1)
    ingest.merged_stream(stream, folder, spec, f"{folder}/checkpoint").awaitTermination()
    ingest.compact(v.spark, folder, spec)
    return ingest.merged(v.spark, folder, spec)


@query("SELECT o_orderpriority AS form, CAST(count(*) * 2 AS BIGINT) AS n_rows FROM orders GROUP BY 1")
def replace_from_query(v: Views) -> DataFrame:
    """A table made by one query and replaced by another that reads it."""
    path, schema = shared_path(v.spark, "replaced"), "form string, n_rows bigint"
    batches.replace_table(v.filings().groupBy("form").agg(F.count("*").alias("n_rows")), path)
    batches.replace_table(batches.replaced(v.spark, path, schema).withColumn("n_rows", F.col("n_rows") * 2), path)
    return batches.replaced(v.spark, path, schema)


@query("""SELECT cik, primary_name, '20240101_00000' || CAST(CAST(cik AS BIGINT) % 3 AS INTEGER) AS batch_id FROM companies WHERE category = 'BUILDING' AND CAST(cik AS BIGINT) % 3 <> 2""")
def restricted_batches(v: Views) -> DataFrame:
    """Stored batches less the companies that aren't in the universe; one batch has no others and goes."""
    path, spec = shared_path(v.spark, "restricted"), TABLES["companies"]
    for k in range(3):
        batches.append_batch(v.companies().where(F.col("cik").cast("long") % 3 == k), path, spec, f"20240101_00000{k}")
    batches.restrict_batches(v.spark, path, spec, v.companies().where("category = 'BUILDING' AND CAST(cik AS BIGINT) % 3 <> 2"))
    return batches.read_batches(v.spark, path, spec).select("cik", "primary_name", "batch_id")


@query("SELECT ticker, date, close FROM prices")
def stream_replayed(v: Views) -> DataFrame:
    """The source files are the copies to recover from: a stream that lost its checkpoint reads them again and makes the same table."""
    from ledgerloom.schemas import TableSpec

    spec = TableSpec("prices", "ticker string, date date, close double", ("ticker", "date"), ("close",), upsert=True)
    folder = shared_path(v.spark, "replayed")
    rows = v.table("events").where("user_id IS NOT NULL AND ts IS NOT NULL").select(F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("date"), F.col("value").alias("close"))
    rows.groupBy("ticker", "date").agg(F.max("close").alias("close")).repartition(2, "ticker").write.parquet(f"{folder}/landed")
    for checkpoint in ("first", "second"):
        ingest.merged_stream(ingest.arrivals(v.spark, f"{folder}/landed", spec), folder, spec, f"{folder}/{checkpoint}").awaitTermination()
    return ingest.merged(v.spark, folder, spec)


@query("""SELECT 32 AS buckets, 1 AS changed_by_one_key, count(*) AS n_rows, sum(CASE WHEN ticker = '1' THEN 1.5 ELSE close END) AS total FROM prices WHERE close IS NOT NULL""")
def bucketed_merge(v: Views) -> DataFrame:
    """A table of 32 buckets of tickers: a landing of one ticker's days writes one of them, whatever the others hold."""
    spec = TableSpec("days", "ticker string, days array<struct<date:date,close:double>>", ("ticker",), upsert=True)
    folder = shared_path(v.spark, "bucketed")
    rows = v.prices().where("close IS NOT NULL").groupBy("ticker").agg(F.collect_list(F.struct("date", "close")).alias("days"))
    versions.merge(rows, folder, spec, buckets=32)
    first = versions.latest(v.spark, folder)
    stored = versions.read(v.spark, folder, "days", spec.schema, first)
    changed = stored.where("ticker = '1'").withColumn("days", F.transform("days", lambda x: F.struct(x["date"].alias("date"), F.lit(1.5).alias("close"))))
    versions.merge(changed, folder, spec)
    now = versions.latest(v.spark, folder)
    n = sum(path != first.tables["days"].get(part) for part, path in now.tables["days"].items())
    each = versions.read(v.spark, folder, "days", spec.schema).select(F.explode("days").alias("d"))
    return each.agg(F.lit(now.buckets["days"]).alias("buckets"), F.lit(n).alias("changed_by_one_key"), F.count("*").alias("n_rows"), F.sum("d.close").alias("total"))


@query("""+ r AS (SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date, value, event_type AS kind FROM events),
b AS (SELECT kind, count(*) AS n, count(*) FILTER (WHERE series_id IS NULL) AS no_key, count(*) FILTER (WHERE value IS NULL) AS no_value, count(*) FILTER (WHERE value < 5) AS low FROM r GROUP BY 1)
SELECT kind, no_key, no_value, low, CASE WHEN no_key + no_value + low = 0 THEN n ELSE 0 END AS written FROM b
UNION ALL SELECT 'fine', 0, 0, 0, count(*) FROM r WHERE series_id IS NOT NULL AND value >= 5""")
def checked_batches(v: Views) -> DataFrame:
    """A batch of each kind of event, its rules checked while it is written: those with a broken rule leave no file."""
    path, spec = shared_path(v.spark, "checked"), TABLES["macro_economic_data"]
    rows = v.table("events").select(F.col("user_id").cast("string").alias("series_id"), F.to_date("ts").alias("date"), "value", F.col("event_type").alias("kind"))
    rules = {"key": F.col("series_id").isNull(), "value": F.col("value").isNull(), "low": F.col("value") < 5}
    kinds = sorted(r.kind for r in rows.select("kind").distinct().collect())
    outcomes = []
    for k, kind in enumerate([*kinds, "fine"]):
        batch = rows.where(F.col("kind") == kind) if kind != "fine" else rows.where("series_id IS NOT NULL AND value >= 5")
        try:
            written, broken = batches.append_batch(batch, path, spec, f"20240101_{k:06}", rules), {}
        except batches.RuleBroken as e:
            written, broken = 0, e.broken
        outcomes.append((kind, *(broken.get(x, 0) for x in rules), f"20240101_{k:06}", written))
    said = v.spark.createDataFrame(outcomes, "kind string, no_key long, no_value long, low long, batch_id string, said long")
    stored = batches.read_batches(v.spark, path, spec).groupBy("batch_id").agg(F.count("*").alias("written"))
    return said.join(stored, "batch_id", "left").select("kind", "no_key", "no_value", "low", F.coalesce("written", F.lit(0)).alias("written"))


@query("""SELECT md5(CAST(o_orderkey AS VARCHAR)) AS accession_number, o_custkey AS cik, CAST(o_orderdate AS DATE) AS filed_date FROM orders
WHERE md5(CAST(o_orderkey AS VARCHAR)) IN (SELECT md5(CAST(min(o_orderkey) AS VARCHAR)) FROM orders UNION SELECT md5(CAST(max(o_orderkey) AS VARCHAR)) FROM orders)""")
def bloom_lookup(v: Views) -> DataFrame:
    """Filings stored by ranges of their date, with a Bloom filter of their accession numbers, and two of them looked up."""
    path = shared_path(v.spark, "looked-up")
    orders = v.table("orders")
    rows = orders.select(F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("accession_number"), F.col("o_custkey").alias("cik"), F.to_date("o_orderdate").alias("filed_date"))
    batches.write_by_date(rows, path, lookups=["accession_number"])
    ends = orders.agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b")).first()
    names = [hashlib.md5(str(x).encode(), usedforsecurity=False).hexdigest() for x in ends]
    return v.spark.read.schema(rows.schema).parquet(path).where(F.col("accession_number").isin(names))


@query("""SELECT f.cik, f.accession_number, tag_name, value_numeric, g.filing_date AS filed_date FROM facts f JOIN filings g ON f.accession_number = g.accession_number
WHERE g.status = 'F' AND g.cik IN (SELECT cik FROM companies)""")
def bucketed_facts(v: Views) -> DataFrame:
    """Facts and filings stored in buckets of their accession number, joined without a shuffle of either."""
    n = batches.bucket_count(v.table("lineitem").count())
    facts = batches.stored_in_buckets(v.facts(), "facts", ["accession_number"], n)
    filings = batches.stored_in_buckets(v.filings().where("status = 'F'"), "filings", ["accession_number"], n)
    return integrity.valid_facts(facts, filings, v.companies()).select("cik", "accession_number", "tag_name", "value_numeric", "filed_date")


GUARDED = """+ g AS (SELECT 'all for all' AS swap, count(*) AS a, count(*) AS b, count(DISTINCT o_custkey) AS x, count(DISTINCT o_custkey) AS y FROM orders
UNION ALL SELECT 'more keys', (SELECT count(*) FROM orders WHERE o_custkey % 2 = 0), count(*), (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 2 = 0),
count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'fewer keys', count(*), count(*), count(DISTINCT o_custkey), count(DISTINCT o_custkey % 7) FROM orders
UNION ALL SELECT 'fewer rows', count(*), (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), count(DISTINCT o_custkey), (SELECT count(DISTINCT o_custkey) FROM orders
WHERE o_orderstatus = 'F') FROM orders)"""


@query(f"""{GUARDED} SELECT swap, a AS existing_rows, b AS staging_rows, b >= a AND b > 0 AND y >= x AS may_swap, CASE WHEN swap = 'all for all' THEN 'keys' ELSE 'sketches' END AS told_by FROM g""")
def sketched_universe(v: Views) -> DataFrame:
    """The guard of a universe of keys over what batches have stored of them; keys are counted only where sketches can't tell."""
    orders, folder = v.table("orders"), shared_path(v.spark, "sketched")
    even, seven = orders.where("o_custkey % 2 = 0"), orders.withColumn("o_custkey", F.col("o_custkey") % 7)
    swaps = {"all for all": (orders, orders), "more keys": (even, orders), "fewer keys": (orders, seven), "fewer rows": (orders, orders.where("o_orderstatus = 'F'"))}
    out = None
    for k, (name, (existing, staging)) in enumerate(swaps.items()):
        for side, df in (("existing", existing), ("staging", staging)):
            for part in range(2):  # two batches of each side
                sketches.sketch(df.where(F.col("o_orderkey") % 2 == part), ["o_custkey"]).write.mode("append").parquet(f"{folder}/{k}/{side}")
        stored = [v.spark.read.schema(sketches.SKETCH).parquet(f"{folder}/{k}/{side}") for side in ("existing", "staging")]
        row = sketches.sketched_guard(*stored).select("existing_rows", "staging_rows", "may_swap", F.lit("sketches").alias("told_by"))
        if row.first().may_swap is None:
            row = tables.swap_guard(existing, staging, ["o_custkey"]).select("existing_rows", "staging_rows", "may_swap", F.lit("keys").alias("told_by"))
        row = row.select(F.lit(name).alias("swap"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("""+ e AS (SELECT event_id, ts FROM events WHERE ts IS NOT NULL), a AS (SELECT DISTINCT event_id, ts FROM e WHERE ts < TIMESTAMP '2024-01-11'),
m AS (SELECT date_trunc('millisecond', max(ts)) AS m FROM a), n AS (SELECT max(event_id) - min(event_id) + 1 AS n FROM e)
SELECT event_id, ts FROM a UNION ALL SELECT DISTINCT event_id + 2 * n, ts FROM a, m, n WHERE ts > m - INTERVAL 2 DAY
UNION ALL SELECT DISTINCT event_id, ts FROM e WHERE ts >= TIMESTAMP '2024-01-11'""")
def stream_once(v: Views) -> DataFrame:
    """Three landings: new rows; repeats, rows that come late but within two days, and rows that come too late; new rows and repeats.

    Late rows have ids of their own, beyond all of the table's. A watermark counts whole milliseconds.
    """
    folder, border = shared_path(v.spark, "once"), "2024-01-11"
    e = v.table("events").where("ts IS NOT NULL").select("event_id", F.col("ts").cast("timestamp").alias("ts")).distinct()
    early, late = e.where(F.col("ts") < border), e.where(F.col("ts") >= border)
    newest = F.max(F.when(F.col("ts") < border, F.col("ts")))
    bounds = e.agg(F.date_trunc("millisecond", newest).alias("m"), (F.max("event_id") - F.min("event_id") + 1).alias("n"))
    near, far = (early.crossJoin(F.broadcast(bounds)).where(x).drop("m") for x in ("ts > m - INTERVAL 2 DAYS", "ts <= m - INTERVAL 2 DAYS"))
    middle, end = late.where(F.col("ts") < "2024-01-21"), late.where(F.col("ts") >= "2024-01-21")
    shifted = lambda df, times: df.select((F.col("event_id") + times * F.col("n")).alias("event_id"), "ts")
    landings = [early, middle.unionByName(near.drop("n")).unionByName(shifted(near, 2)).unionByName(shifted(far, 1)), end.unionByName(middle.where(F.col("ts") >= "2024-01-20"))]
    for landing in landings:  # each run goes on from the checkpoint of the one before
        landing.write.mode("append").parquet(f"{folder}/landed")
        ingest.append_once(v.spark.readStream.schema(e.schema).parquet(f"{folder}/landed"), f"{folder}/kept", f"{folder}/checkpoint", ["event_id"], "ts", "2 days").awaitTermination()
    return v.spark.read.schema(e.schema).parquet(f"{folder}/kept")


@query("SELECT ticker, date, close FROM prices")
def stream_timed(v: Views) -> DataFrame:
    """A stream that flushes by time and goes on: what lands while it runs is in the table once it has been taken up."""
    spec = TableSpec("prices", "ticker string, date date, close double", ("ticker", "date"), ("close",), upsert=True)
    folder = shared_path(v.spark, "timed")
    rows = v.prices().select("ticker", "date", "close")
    rows.where("date < '2024-01-15'").write.parquet(f"{folder}/landed")
    running = ingest.merged_stream(ingest.arrivals(v.spark, f"{folder}/landed", spec), folder, spec, f"{folder}/checkpoint", every="100 milliseconds")
    rows.where("date >= '2024-01-15'").write.mode("append").parquet(f"{folder}/landed")
    running.processAllAvailable()
    running.stop()
    return ingest.merged(v.spark, folder, spec)


@query("""SELECT 3 AS versions, count(*) AS n_rows, count(DISTINCT o_custkey) AS keys FROM orders""")
def universe_published(v: Views) -> DataFrame:
    """A universe of keys published again and again: one without some of its keys, and one of fewer rows, are held back by stored sketches."""
    orders, folder = v.table("orders").select("o_orderkey", "o_custkey"), shared_path(v.spark, "universe")
    versions.publish_guarded(orders.where("o_custkey % 3 = 0"), folder, "orders", ["o_custkey"])
    versions.publish_guarded(orders.where("o_custkey % 3 < 2"), folder, "orders", ["o_custkey"])
    versions.publish_guarded(orders.withColumn("o_custkey", F.col("o_custkey") % 5), folder, "orders", ["o_custkey"])
    versions.publish_guarded(orders, folder, "orders", ["o_custkey"])
    versions.publish_guarded(orders.where("o_orderkey % 2 = 0"), folder, "orders", ["o_custkey"])
    stored = versions.read(v.spark, folder, "orders", orders.schema)
    return stored.agg(F.lit(versions.latest(v.spark, folder).number).alias("versions"), F.count("*").alias("n_rows"), F.count_distinct("o_custkey").alias("keys"))
