import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import integrity, tables
from ledgerloom.schemas import SPECS, TABLES
from ledgerloom.sources import batches

D = dt.date


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_one_is_total_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 5, "q")], "k string, o int, v string")
    assert sorted((str(r.k), r.v) for r in tables.keep_one(df, ["k"], [F.col("o")]).collect()) == [("None", "q"), ("a", "y")]


def test_nocase_keys(spark):
    df = spark.createDataFrame([("AAPL", "NYSE", 1), ("aapl", "nyse", 2)], "ticker string, exchange string, v int")
    assert tables.keep_one(df, ["ticker", "exchange"], nocase=("ticker", "exchange")).count() == 1


def test_upsert_replaces_by_key(spark):
    base = spark.createDataFrame([("A", D(2024, 1, 1), 10.0), ("A", D(2024, 1, 2), 11.5)], "ticker string, date date, close double")
    batch = spark.createDataFrame([("A", D(2024, 1, 2), 12.0), ("B", D(2024, 1, 2), 5.0)], base.schema)
    assert rows(tables.upsert(base, batch, ["ticker", "date"])) == [("A", D(2024, 1, 1), 10.0), ("A", D(2024, 1, 2), 12.0), ("B", D(2024, 1, 2), 5.0)]
    empty = batch.where("1 = 0")
    assert rows(tables.upsert(base, empty, ["ticker", "date"])) == rows(base)
    assert tables.upsert(empty, batch, ["ticker", "date"]).count() == 2


def test_merge_prefers_batch_at_a_tie(spark):
    base = spark.createDataFrame([(1, 5, "old"), (2, 9, "old")], "k int, t int, v string")
    batch = spark.createDataFrame([(1, 5, "new"), (2, 8, "new")], base.schema)
    assert rows(tables.merge(base, batch, ["k"], ["t"]).select("k", "v")) == [(1, "new"), (2, "old")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=20), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=20))
def test_upsert_keys(spark, base, batch):
    a, b = (spark.createDataFrame(x, "k int, v int") for x in (base, batch))
    out = tables.upsert(tables.keep_one(a, ["k"]), b, ["k"])
    assert sorted(r.k for r in out.collect()) == sorted({k for k, _ in base} | {k for k, _ in batch})


def test_guards(spark):
    old = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert tables.swap_guard(old, old).first().may_swap
    assert not tables.swap_guard(old, old.limit(2)).first().may_swap
    assert not tables.swap_guard(old.limit(0), old.limit(0)).first().may_swap
    same = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert tables.swap_guard(old, same).first().may_swap and not tables.swap_guard(old, same, ["k"]).first().may_swap


def test_orphans(spark):
    facts = spark.createDataFrame([("a1", "c1", None), ("a2", "c1", None), ("a1", "c9", None)], "accession_number string, cik string, filed_date date")
    filings = spark.createDataFrame([("a1", "c1", D(2024, 5, 1))], "accession_number string, cik string, filing_date date")
    companies = spark.createDataFrame([("c1",)], "cik string")
    assert sorted(r.cik for r in integrity.valid_facts(facts, filings, companies).collect()) == ["c1", "c9"]
    assert rows(integrity.orphan_facts(facts, filings, companies).select("accession_number", "cik")) == [("a2", "c1")]
    assert integrity.orphan_facts(facts, filings, companies, strict=True).count() == 1


def test_dual_lookup(spark):
    tickers = spark.createDataFrame([("BRK-B",), ("X",)], "ticker string")
    latest = spark.createDataFrame([("BRK.B", D(2024, 1, 5)), ("BRK-B", D(2024, 1, 3))], "ticker string, last_date date")
    assert {r.ticker: r.last_date for r in integrity.dual_lookup(tickers, latest).collect()} == {"BRK-B": D(2024, 1, 5), "X": None}


def test_every_spec_is_sound():
    for spec in SPECS:
        assert set(spec.keys) | set(spec.order) | set(spec.nocase) | set(spec.required) <= set(spec.columns), spec.name
    assert len(TABLES["updated_ticker_info"].columns) == 34


def test_batches_publish_and_inventory(spark, tmp_path):
    spec = TABLES["stock_history"]
    df = spark.createDataFrame([("A", "2024-01-01", "1.5", "x")], "ticker string, date string, open string, volume string")
    assert batches.append_batch(df, f"{tmp_path}/stock_history", spec, "20240101_000000") == 1
    assert batches.append_batch(df.limit(0), f"{tmp_path}/stock_history", spec, "20240102_000000") == 0
    got = batches.read_table(spark, f"{tmp_path}/stock_history", spec).first()
    assert (got.ticker, got.date, got.open, got.volume) == ("A", D(2024, 1, 1), 1.5, None)
    files = batches.inventory(spark, str(tmp_path))
    assert [r.batch_id for r in batches.batch_ids(files).collect()] == ["20240101_000000"]
    assert batches.partial_batches(files, F.current_timestamp() + F.expr("INTERVAL 48 HOURS")).count() == 1
    assert batches.partial_batches(files, F.current_timestamp()).count() == 0
    old = spark.range(3)
    assert batches.publish(spark.range(5), f"{tmp_path}/t", "2", old) and batches.publish(spark.range(2), f"{tmp_path}/t", "3", old) is None
    assert batches.rebuild({"a": spark.range(0), "b": spark.range(0)}, f"{tmp_path}/b", ["a", "b"]) is None
    assert batches.rebuild({"a": spark.range(1), "b": spark.range(0)}, f"{tmp_path}/b", ["a", "b"]) == 1


def test_keep_one_carries_columns_without_an_order(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"y": 2}), (None, 3, None)], "k string, o int, m map<string,int>")
    assert sorted((str(r.k), r.o, r.m) for r in tables.keep_one(df, ["k"], [F.col("o")]).collect()) == [("None", 3, None), ("a", 2, {"y": 2})]
