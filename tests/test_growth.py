"""Results and plans of registered queries on tables that the given ones are too small to stand for."""

import datetime as dt

import duckdb
import pytest

from ledgerloom.plans import registry


def by_sql(folder, name, *tables):
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    for table in ("customer", "supplier", "orders", "lineitem", "events"):  # the other views name them, too
        if table not in tables:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    return [d[0] for d in found.description], found.fetchall()


@pytest.mark.parametrize("prices", [(0.1, 0.2, 0.7), (0.7, 0.2, 0.1), (0.2, 0.7, 0.1)])
def test_statement_sums_in_any_order(spark, tmp_path, prices):
    """0.7 + 0.2 + 0.1 is just below 1 in doubles; a cell without a price gives no row."""
    orders = [(i, 5, "F", p, dt.datetime(1996, 3, 1), "LOW") for i, p in enumerate(prices)] + [(9, 6, "F", None, dt.datetime(1996, 3, 1), "LOW")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, schema).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    columns, want = by_sql(tmp_path, "statement_rows", "orders")
    got = [tuple(r) for r in registry.queries()["statement_rows"](spark, str(tmp_path)).select(*columns).collect()]
    assert got == want == [(5, dt.date(1996, 12, 31), "LOW", 1)]


def test_late_rows_have_ids_of_their_own(spark, tmp_path):
    """Ids two milliards apart, and a row that is late by less than a millisecond."""
    day = lambda d, **x: dt.datetime(2024, 1, d, 12, 0, 0, **x)
    events = [(7, day(10, microsecond=500)), (2_000_000_007, day(9)), (8, day(8, microsecond=400)), (9, day(3)), (1_000_000_009, day(15)), (11, day(22)), (12, day(25))]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT *, 1 AS user_id, 1.0 AS value FROM '{tmp_path}/events.parquet/*.parquet'")
    for table in ("customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    want = sorted(con.execute(registry.oracle_sql()["stream_once"]).fetchall())
    got = sorted((r.event_id, r.ts) for r in registry.queries()["stream_once"](spark, str(tmp_path)).selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts").collect())
    assert got == want and len(got) == len(events) + 3


def test_ticker_files_are_bounded(spark, tmp_path):
    """60,000 companies of one nation in a second, not by comparing each entry with each; files don't grow with the table."""
    from ledgerloom.sources import feeds

    n = 60_000
    customers = spark.range(n).selectExpr("id * 20 AS c_custkey", "concat('Customer#', id) AS c_name", "3 AS c_nationkey", "1.0D AS c_acctbal", "'M' AS c_mktsegment")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    seen = {}
    universe = feeds.universe
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(feeds, "universe", lambda texts: seen.setdefault("found", universe(seen.setdefault("texts", texts))))
        registry.queries()["ticker_universe"](spark, str(tmp_path))
    assert "array_distinct" not in seen["texts"]._jdf.queryExecution().optimizedPlan().toString()
    assert [r[0] for r in seen["texts"].selectExpr("size(json_object_keys(value))").collect()] != [n]
    assert [r.cik for r in seen["found"].collect()] == [f"{20 * i:010}" for i in range(n)]


@pytest.mark.parametrize("name", ["orphan_facts", "orphan_facts_strict"])
def test_orphans_are_found_before_lines_are_joined(spark, name):
    """Lines, by far the most rows, are dealt out for one join only."""
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" :+-") for line in plan.splitlines() if "Join " in line]
    assert joins[0].startswith("Join Inner") and any("LeftAnti" in x for x in joins[1:])


def test_buckets_grow_in_number(spark, monkeypatch):
    """Twice as many rows make twice as many buckets, not larger ones."""
    from ledgerloom.sources import batches

    assert [batches.bucket_count(n) for n in (0, 600_000, 36_000_000, 72_000_000)] == [8, 8, 72, 144]
    count = batches.bucket_count
    monkeypatch.setattr(batches, "bucket_count", lambda rows: count(rows, each=500))
    used = []
    stored = batches.stored_in_buckets
    monkeypatch.setattr(batches, "stored_in_buckets", lambda df, name, keys, buckets: used.append(buckets) or stored(df, name, keys, buckets))
    assert registry.queries()["bucketed_facts"](spark, "/root/testdata/sf0.001").count() > 0
    assert used == [12, 12]


@pytest.mark.parametrize("name", ["json_explode_facts", "parse_summary"])
def test_facts_are_dealt_out_by_company_once(spark, name):
    """One shuffle for the three groupings of documents, and each value's type looked up once."""
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(cik" in x and "tag_name" in x and "taxonomy" not in x]
    assert plan.count("schema_of_variant") <= 4
