import datetime as dt

from ledgerloom.schemas import TABLES
from ledgerloom.streaming import ingest


def test_files_count_once_and_late_rows_replace(spark, tmp_path):
    spec = TABLES["stock_history"]
    source, folder = f"{tmp_path}/in", f"{tmp_path}/out"

    def land(*rows):
        df = spark.createDataFrame([(t, dt.date(2024, 1, d), c) for t, d, c in rows], "ticker string, date date, close double")
        for name in spec.columns:
            if name not in df.columns:
                df = df.selectExpr("*", f"CAST(NULL AS {spec.schema[name].dataType.simpleString()}) AS {name}")
        df.select(*spec.columns).coalesce(1).write.mode("append").parquet(source)

    def run():
        ingest.merged_stream(ingest.arrivals(spark, source, spec), folder, spec, f"{tmp_path}/checkpoint").awaitTermination()

    land(("A", 1, 10.0), ("A", 2, 11.5))
    run()
    land(("A", 2, 12.0), ("B", 2, 5.0))
    run()
    run()  # nothing new: no new version
    want = [("A", 1, 10.0), ("A", 2, 12.0), ("B", 2, 5.0)]
    rows = lambda: sorted((r.ticker, r.date.day, r.close) for r in ingest.merged(spark, folder, spec).collect())
    assert rows() == want
    import os

    deltas = lambda: sorted(x for x in os.listdir(folder) if x.startswith("delta"))
    assert deltas() == ["delta=0", "delta=1"]
    assert ingest.compact(spark, folder, spec) == 1 and deltas() == [] and rows() == want
    land(("B", 2, 6.0))
    run()
    assert deltas() == ["delta=2"] and rows() == [*want[:2], ("B", 2, 6.0)]


def test_small_files_are_flushed_one_by_one(spark, tmp_path):
    spec = TABLES["macro_economic_data"]
    for day in (1, 2, 3):
        spark.createDataFrame([("gdp", dt.date(2024, 1, day), float(day))], spec.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.arrivals(spark, f"{tmp_path}/in", spec, files_at_once=1)
    ingest.merged_stream(stream, f"{tmp_path}/out", spec, f"{tmp_path}/checkpoint").awaitTermination()
    import os

    assert sum(x.startswith("delta") for x in os.listdir(f"{tmp_path}/out")) == 3 and ingest.merged(spark, f"{tmp_path}/out", spec).count() == 3


def test_ledgered_merge(spark, tmp_path):
    from ledgerloom.sources import ledger

    sources = {"macro_economic_data": f"{tmp_path}/macro", "market_risk_factors": f"{tmp_path}/risk"}

    def land(day, value):
        row = spark.createDataFrame([("gdp", dt.date(2024, 1, day), value)], "series_id string, date date, value double")
        row.coalesce(1).write.mode("append").parquet(sources["macro_economic_data"])

    land(1, 1.0)
    (tmp_path / "risk").mkdir()
    (tmp_path / "risk" / "broken.parquet").write_bytes(b"no parquet")
    folder = f"file://{tmp_path}/stored"
    assert sorted(r.table_name for r in ledger.new_files(spark, sources, folder).collect()) == sorted(sources)
    got = {x["table_name"]: x for x in ledger.merge_new_files(spark, sources, folder, "2024-01-02 00:00:00")}
    assert got["macro_economic_data"]["error"] is None and got["market_risk_factors"]["error"]
    assert [r.table_name for r in ledger.new_files(spark, sources, folder).collect()] == ["market_risk_factors"]
    land(1, 2.0)
    land(2, 3.0)
    assert ledger.merge_new_files(spark, sources, folder, "2024-01-03 00:00:00")[0]["files"] == 2
    assert ledger.merge_new_files(spark, sources, folder, "2024-01-03 00:00:00")[0]["files"] == 0
    assert sorted((r.date.day, r.value) for r in ledger.merged_table(spark, folder, "macro_economic_data").collect()) == [(1, 2.0), (2, 3.0)]
    assert ledger.ledger(spark, folder).count() == 3


def test_repeats_and_late_rows(spark, tmp_path):
    """Each run goes on from the checkpoint: repeats and rows behind the watermark go, late ones within it stay."""

    def land(*rows):
        df = spark.createDataFrame([(k, dt.datetime(2024, 1, d)) for k, d in rows], "k int, ts timestamp")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k int, ts timestamp").parquet(f"{tmp_path}/in")
        ingest.append_once(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["k"], "ts", "2 days").awaitTermination()
        return sorted((r.k, r.ts.day) for r in spark.read.schema("k int, ts timestamp").parquet(f"{tmp_path}/out").collect())

    assert land((1, 1), (2, 9), (2, 9), (3, 10)) == [(1, 1), (2, 9), (3, 10)]
    want = [(1, 1), (2, 9), (3, 10), (4, 9), (6, 12)]
    assert land((3, 10), (4, 9), (5, 7), (6, 12), (2, 9)) == want  # 3 and 2 again, 4 late, 5 too late
    assert land((6, 12), (4, 11)) == want  # 4 was seen within two days
    assert land((1, 20), (8, 20)) == sorted([*want, (1, 20), (8, 20)])  # 1 was forgotten


def test_flush_by_time(spark, tmp_path):
    import time

    spec = TABLES["macro_economic_data"]
    land = lambda day: spark.createDataFrame([("gdp", dt.date(2024, 1, day), float(day))], spec.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    land(1)
    running = ingest.merged_stream(ingest.arrivals(spark, f"{tmp_path}/in", spec), f"{tmp_path}/out", spec, f"{tmp_path}/checkpoint", every="200 milliseconds")
    running.processAllAvailable()
    land(2)
    until = time.time() + 60
    while ingest.merged(spark, f"{tmp_path}/out", spec).count() < 2 and time.time() < until:
        time.sleep(0.2)  # nobody asks it to: the trigger does
    assert running.isActive and ingest.merged(spark, f"{tmp_path}/out", spec).count() == 2
    running.stop()


def test_daily_counters(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, 5), "ok"), (dt.datetime(2024, 1, 1, 6), "error"), (dt.datetime(2024, 1, 9), "ok")]
    spark.createDataFrame(rows, "ts timestamp, status string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, status string").parquet(f"{tmp_path}/in")
    query = ingest.daily_counters(stream, "ts", "status = 'ok'").writeStream.format("memory").queryName("counted").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r.fetch_date.day, r.attempted, r.fetched) for r in spark.sql("SELECT * FROM counted").collect()) == [(1, 2, 1), (9, 1, 1)]
