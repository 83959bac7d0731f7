import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import analysis, integrity, normalize, planning, tables
from ledgerloom.schemas import TABLES
from ledgerloom.sources import batches, feeds

D = dt.date


def test_directory_report_and_normalised_batches(spark, tmp_path):
    spec = TABLES["macro_economic_data"]
    for k, rows in enumerate(([("gdp", "2024-01-01", "1.5"), ("gdp", "nan", "2.5")], [("cpi", "2024-02-01", "None")])):
        spark.createDataFrame(rows, "series_id string, date string, value string").coalesce(1).write.parquet(f"{tmp_path}/batch_id=20240101_00000{k}")
    (tmp_path / "batch_id=20240101_000002").mkdir()
    (tmp_path / "batch_id=20240101_000002" / "part-broken.parquet").write_bytes(b"no parquet at all")
    report = batches.directory_report(spark, str(tmp_path)).first()
    assert (report.files, report.valid, report.invalid, report.n_rows) == (3, 2, 1, 3)
    got = feeds.batches_normalized(spark, [str(tmp_path)], "macro_economic_data")
    assert got.schema == spec.schema
    assert sorted(map(str, ((r.series_id, r.date, r.value) for r in got.collect()))) == sorted(map(str, [("gdp", D(2024, 1, 1), 1.5), ("gdp", None, 2.5), ("cpi", D(2024, 2, 1), None)]))


def test_daily_prices_are_clipped(spark):
    frame = spark.createDataFrame([("A", "2024-01-01", 1.0), ("A", "bad", 2.0), ("A", "2024-02-01", 3.0)], "Ticker string, Date string, Close double")
    got = feeds.daily_prices(frame, "2024-01-01", "2024-01-31").collect()
    assert [(r.ticker, r.date, r.close, r.volume) for r in got] == [("A", D(2024, 1, 1), 1.0, None)]


def test_macro_leaves_out_copyright(spark):
    series = [spark.createDataFrame([(name, "2024-01-01", x)], "series_id string, date string, value double") for name, x in (("a", 1.0), ("b", 2.0), ("c", None))]
    notes = spark.createDataFrame([("b", "COPYRIGHT 2020"), ("a", None)], "series_id string, notes string")
    assert [r.series_id for r in feeds.macro(series, notes).collect()] == ["a"]


def test_archive_catalogue_keeps_the_newest_and_staging_at_ties(spark):
    old = spark.createDataFrame([("p1", dt.datetime(2024, 1, 2), "a"), ("p2", None, "a"), ("p3", dt.datetime(2024, 1, 1), "a")], "file_path string, downloaded_at timestamp, status string")
    new = spark.createDataFrame([("p1", dt.datetime(2024, 1, 1), "b"), ("p2", None, "b"), ("p3", dt.datetime(2024, 1, 1), "b")], old.schema)
    got = {r.file_path: r.status for r in tables.merge(old, new, ["file_path"], ["downloaded_at"]).collect()}
    assert got == {"p1": "a", "p2": "b", "p3": "b"}


def test_work_list(spark):
    universe, done = spark.createDataFrame([("3",), ("1",), ("2",), ("1",)], "cik string"), spark.createDataFrame([("2",)], "cik string")
    assert [r.cik for r in normalize.work_list(universe, done).collect()] == ["1", "3"]
    assert [r.cik for r in normalize.work_list(universe, done, limit=1).collect()] == ["1"]
    assert [r.cik for r in normalize.work_list(universe, done, only="2").collect()] == ["2"]


def test_worklist_cuts_before_it_excludes(spark):
    scores = spark.createDataFrame([("A", 3.0), ("b", 2.0), ("C", 1.0)], "ticker string, score double")
    fetched = spark.createDataFrame([("X", dt.datetime(2024, 1, 1))], "ticker string, fetch_timestamp timestamp")
    bad = spark.createDataFrame([("B", dt.datetime(2024, 1, 5)), ("A", dt.datetime(2020, 1, 1))], "ticker string, last_failed_timestamp timestamp")
    got = planning.worklist(scores, fetched, bad, "2024-01-08 00:00:00", 7, 2).collect()
    assert [r.ticker for r in got] == ["A"]
    assert integrity.without(scores, bad.limit(0)).count() == 3


def test_summary_corpus_takes_a_vectorised_summariser(spark):
    filings = spark.createDataFrame([("a-1", "7", D(2024, 1, 5), "10-K", "x.htm"), ("a-2", "7", D(2020, 1, 5), "10-K", "x.htm")], "accession_number string, cik string, filing_date date, form string, primary_document string")
    pages = spark.createDataFrame([("a-1", "<p>Hello   <b>there</b></p>")], "accession_number string, html string")
    none = spark.createDataFrame([], "accession_number string")
    row = analysis.summary_corpus(filings, pages, none, ["10-K"], "2024-01-31", 365, 5, F.upper, "upper").first()
    assert (row.accession_number, row.text, row.summary_text, row.summary_model) == ("a-1", "Hello", "HELLO", "upper")
    assert row.url.endswith("/7/a1/x.htm")


def test_batches_are_validated_moved_and_rolled_back(spark, tmp_path, monkeypatch):
    import os

    import pytest

    spec = TABLES["macro_economic_data"]
    df = spark.createDataFrame([("gdp", "2024-01-01", "1.5"), ("gdp", "bad", "2.5")], "series_id string, date string, value string")
    path = f"{tmp_path}/macro"
    assert batches.append_batch(df, path, spec, "20240101_000000") == 2 and batches.append_batch(df, path, spec, "20240101_000000") == 2
    assert batches.append_batch(df.limit(0), path, spec, "20240102_000000") == 0
    assert sorted(x for x in os.listdir(path) if not x.startswith(".")) == ["batch_id=20240101_000000", "data", "versions"]
    assert [tuple(r) for r in batches.read_batches(spark, path, spec).groupBy("batch_id").count().collect()] == [("20240101_000000", 2)]
    real = batches.prepared
    with pytest.raises(batches.BatchMismatch):  # a read that finds less than was written
        with monkeypatch.context() as m:
            m.setattr(type(spark.read), "parquet", lambda self, *a, **k: df.limit(1))
            batches.append_batch(df, path, spec, "20240103_000000")
    assert not [x for x in os.listdir(f"{path}-staging") if "20240103" in x] and batches.prepared is real
    rows = {"macro_economic_data": df, "tickers": spark.createDataFrame([("1", "A", "X"), ("1", "A", "X"), ("2", "A", "X"), ("3", None, "X")], "cik string, ticker string, exchange string")}
    assert batches.fan_out(rows, f"{tmp_path}/all", "20240101_000000") == {"macro_economic_data": 1, "tickers": 2}
    with pytest.raises(Exception):
        batches.fan_out(rows | {"no_such_table": df}, f"{tmp_path}/all", "20240105_000000")
    assert "batch_id=20240105_000000" not in os.listdir(f"{tmp_path}/all/tickers")


def read_rows(df):
    """Rows that the scans of an executed frame gave out: what row groups weren't skipped hold."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            n += node.metrics().apply("numOutputRows").value()
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_ranges_and_lookups_skip_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("accession_number"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 4000).cast("int")).alias("filed_date"))
    with_filter, without = f"{tmp_path}/filtered", f"{tmp_path}/plain"
    batches.write_by_date(rows, with_filter, partitions=4, lookups=["accession_number"], group_bytes=1 << 18)
    batches.write_by_date(rows, without, partitions=4, group_bytes=1 << 18)
    name = rows.first().accession_number
    wanted = lambda path: spark.read.parquet(path).where(F.col("accession_number") == name)
    assert wanted(with_filter).count() == wanted(without).count() == 1
    assert read_rows(wanted(without)) > 150_000 and read_rows(wanted(with_filter)) < 60_000
    some_days = spark.read.parquet(with_filter).where("filed_date BETWEEN '2003-01-01' AND '2003-01-31'")
    assert some_days.count() == 31 * 50 and read_rows(some_days) < 60_000


def test_joins_of_buckets_shuffle_nothing(spark):
    from ledgerloom.operators import integrity

    facts = spark.range(2000).selectExpr("CAST(id % 300 AS STRING) AS accession_number", "CAST(id % 7 AS STRING) AS cik", "current_date() AS filed_date")
    filings = spark.range(250).selectExpr("CAST(id AS STRING) AS accession_number", "CAST(id % 7 AS STRING) AS cik", "DATE '2024-01-01' AS filing_date")
    companies = spark.range(5).selectExpr("CAST(id AS STRING) AS cik")
    a, b = (batches.stored_in_buckets(df, name, ["accession_number"], 4) for df, name in ((facts, "facts"), (filings, "filings")))
    once = integrity.valid_facts(a, b, companies)
    assert sorted(once.collect()) == sorted(integrity.valid_facts(facts, filings, companies).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # however large both sides are
        plan = a.join(b.select("accession_number", "filing_date"), "accession_number")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_archives_as_a_source(spark, tmp_path):
    import zipfile

    from ledgerloom.sources import archives

    def pack(name, *members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("readme.txt", "no member")
            for m in members:
                z.writestr(f"{m}.json", f"text of {m}")

    pack("a.zip", *(f"a{i}" for i in range(7)))
    pack("b.zip", "b0")
    pack("empty.zip")
    archives.register(spark)
    frame = spark.read.format("zip_members").option("path", str(tmp_path)).option("members", 3).load()
    got = sorted((r.archive.rsplit("/", 1)[1], r.member, r.text) for r in frame.collect())
    assert got == [("a.zip", f"a{i}.json", f"text of a{i}") for i in range(7)] + [("b.zip", "b0.json", "text of b0")]
    assert frame.rdd.getNumPartitions() == 4
    assert spark.read.format("zip_members").option("path", f"{tmp_path}/none").load().count() == 0

    def run():
        stream = spark.readStream.format("zip_members").option("path", f"file://{tmp_path}").load()
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.member for r in spark.read.parquet(f"{tmp_path}/out").collect())

    first = run()
    assert len(first) == 8
    pack("c.zip", "c0", "c1")
    assert run() == [*first, "c0.json", "c1.json"]  # archives that were read aren't read again


def test_sketches_count_keys(spark):
    from ledgerloom.operators import sketches

    for n in (0, 1, 1000, 60_000):
        df = spark.range(3 * n).select((F.col("id") % max(n, 1)).alias("k"))
        parts = [sketches.sketch(df.where(F.col("k") % 3 == i), ["k"]) for i in range(3)] + [sketches.sketch(df, ["k"])]
        got = sketches.united(parts[0].union(parts[1]).union(parts[2]).union(parts[3])).first()
        assert got.rows == 6 * n and abs(got.estimate - n) <= 4 * sketches.ERROR * n
    many, few = (sketches.sketch(spark.range(n).withColumnRenamed("id", "k"), ["k"]) for n in (20_000, 10_000))
    assert [sketches.sketched_guard(a, b).first().may_swap for a, b in ((few, many), (many, few), (many, many))] == [True, False, None]
    repeated = sketches.sketch(spark.range(20_000).select((F.col("id") % 5000).alias("k")), ["k"])
    assert sketches.sketched_guard(many, repeated).first().may_swap is False


def test_rebuild_has_one_pointer(spark, tmp_path):
    from ledgerloom.sources import versions

    a, b = spark.range(3), spark.range(2)
    folder = f"file://{tmp_path}/build"
    assert batches.current(spark, folder) is None
    assert batches.rebuild({"a": a.limit(0), "b": b}, folder, ["a"]) is None and batches.current(spark, folder) is None
    assert batches.rebuild({"a": a, "b": b}, folder, ["a"]) == 1 == batches.current(spark, folder)
    assert batches.rebuild({"a": b, "b": a}, folder, ["a"]) == 2 == batches.current(spark, folder)
    assert versions.read(spark, folder, "b", "id long").count() == 3
