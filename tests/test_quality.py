import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import analysis, quality
from ledgerloom.schemas import TABLES

D = dt.date


def value(df):
    r = df.first()
    return r.passed, r.value


def test_checks(spark):
    df = spark.createDataFrame([("a", 1, D(2024, 1, 2), D(2024, 1, 1)), ("a", None, None, None), (None, 9, D(2024, 1, 1), D(2024, 1, 1))], "k string, n int, s date, e date")
    parents = spark.createDataFrame([("a",)], "p string")
    assert value(quality.unique_key(df, "t", ["k"])) == (False, 1)
    assert value(quality.primary_key(df, "t", ["k"])) == (False, 2)
    assert value(quality.no_nulls(df, "t", "k")) == (False, 1)
    assert value(quality.foreign_key(df, "t", ["k"], parents, ["p"])) == (False, 1)
    assert value(quality.foreign_key(df, "t", ["k"], parents, ["p"], allow_null=True)) == (True, 0)
    assert value(quality.in_range(df, "t", "n", 0, 5)) == (False, 1)
    assert value(quality.dates_in_order(df, "t", "s", "e")) == (False, 1)
    assert value(quality.row_count(df, "t", 1, 2)) == (False, 3)
    assert value(quality.columns_match(df, "t", ["K", "N", "S", "E", "X"])) == (False, 1)
    assert value(quality.table_exists(spark, "no_such_table")) == (False, 0)


def test_overall(spark):
    df = spark.range(5)
    warn = quality.at_most(df, "warn", F.col("id") > 2, 1)
    assert warn.first().severity == "warning"
    assert quality.overall(quality.suite(warn, quality.row_count(df, "t", 1))).first().verdict == "passed with warnings"
    assert quality.overall(quality.row_count(df, "t", 9)).first().verdict == "failed"


def test_suites_run_on_empty_tables(spark):
    empty = {name: spark.createDataFrame([], spec.schema) for name, spec in TABLES.items()}
    suites = [
        quality.core_suite(empty["companies"], empty["tickers"], empty["former_names"], empty["filings"], empty["xbrl_facts"]),
        quality.facts_suite(empty["xbrl_facts"]), quality.orphan_suite(empty["xbrl_facts_orphaned"], empty["filings"]),
        quality.price_suite(empty["stock_history"], empty["tickers"], "2024-01-31"), quality.macro_suite(empty["macro_economic_data"], empty["market_risk_factors"]),
        quality.supplementary_suite(empty["yf_profile_metrics"], empty["yf_major_holders"], empty["yf_stock_actions"], empty["yf_recommendations"]),
        quality.spec_checks(empty["filings"], TABLES["filings"]),
    ]
    assert [s.count() for s in suites] == [24, 7, 2, 4, 7, 6, 6]


def found(suite):
    return {r.check: (r.value, r.severity) for r in suite.collect()}


def test_orphans_have_a_filing_by_both_keys(spark):
    orphaned = spark.createDataFrame([("a1", "1"), ("a1", "2"), ("a2", "1")], "accession_number string, cik string")
    filings = spark.createDataFrame([("a1", "1"), ("a9", "1")], "accession_number string, cik string")
    assert found(quality.orphan_suite(orphaned, filings)) == {"xbrl_facts_orphaned rows": (3, "ok"), "xbrl_facts_orphaned with a filing": (1, "error")}
    assert found(quality.orphan_suite(orphaned.where("cik = '2'"), filings))["xbrl_facts_orphaned with a filing"] == (0, "ok")


def test_prices_of_all_listed_tickers(spark):
    spec = TABLES["stock_history"]
    rows = [("A", D(2024, 1, 30), 1.0, None, None, 5), ("B", D(2024, 1, 1), None, None, None, 5), ("B", D(2024, 1, 2), None, None, None, None), ("C", D(2024, 2, 5), None, 2.0, None, 0), ("A", D(2024, 1, 2), None, None, 1.0, 7)]
    prices = spark.createDataFrame(rows, "ticker string, date date, open double, close double, adj_close double, volume bigint")
    listed = spark.createDataFrame([(x, "N") for x in "ABCD"] + [("D", "X")], "ticker string, exchange string")
    got = found(quality.price_suite(prices, listed, "2024-01-31"))
    assert got["stock_history volume without price"] == (1, "ok") and got["tickers without recent prices"] == (4, "ok")
    many = spark.range(101).selectExpr("CAST(id AS STRING) AS ticker")
    assert found(quality.price_suite(spark.createDataFrame([], spec.schema), many, "2024-01-31"))["tickers without recent prices"] == (101, "warning")


def test_null_values_are_errors(spark):
    macro = spark.createDataFrame([("gdp", D(2024, 1, 1), None)], "series_id string, date date, value double")
    risk = spark.createDataFrame([("3", D(2024, 1, 1), None)], "factor_model string, date date, mkt_minus_rf double")
    got = found(quality.macro_suite(macro, risk))
    assert got["macro_economic_data.value null"] == (1, "error") and got["market_risk_factors.mkt_minus_rf null"] == (1, "error")
    feed = spark.createDataFrame([("A", None, 0.5, 1.5, "123", None, None, None, None)], "ticker string, fetch_timestamp timestamp, pct_insiders double, pct_institutions double, cik string, action_date date, action_type string, recommendation_timestamp timestamp, firm string")
    got = found(quality.supplementary_suite(feed, feed, feed, feed))
    assert {k: v for k, (v, _) in got.items()} == dict.fromkeys(got, 1) and len(got) == 6


def test_tickers_not_listed(spark):
    feed = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "ticker string")
    listed, more = (spark.createDataFrame([(x,)], "ticker string") for x in "AC")
    assert found(quality.ticker_suite({"x": feed, "y": feed.where("ticker = 'A'")}, listed, more)) == {"x tickers not listed": (2, "error"), "y tickers not listed": (0, "ok")}


def test_orphans_are_profiled_in_one_pass(spark):
    rows = [(f"t{i % 13}", str(i % 40), None if i % 5 == 0 else f"f{i % 3}", f"tag{i % 30}") for i in range(500)]
    orphaned = spark.createDataFrame(rows, "taxonomy string, cik string, form string, tag_name string")
    profile = quality.orphan_profile(orphaned)
    got = profile.collect()
    for columns in quality.PROFILED:
        import collections

        places = [("taxonomy", "cik", "form", "tag_name").index(c) for c in columns]
        counts = collections.Counter(tuple(r[k] for k in places) for r in rows)
        want = sorted(counts.items(), key=lambda x: (-x[1], [(y is None, y) for y in x[0]]))[:10]
        assert sorted(((tuple(r[c] for c in columns), r.n_rows) for r in got if r.by == ",".join(columns)), key=str) == sorted(want, key=str)
    plan = profile._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Expand") == 1 and plan.count("Scan ExistingRDD") == 1 and "WindowGroupLimit" in plan


def test_join_report(spark):
    tickers = spark.createDataFrame([("A", "1"), ("B", "1"), ("C", "2"), ("D", "9")], "ticker string, cik string")
    companies = spark.createDataFrame([("1",), ("2",), ("3",)], "cik string")
    filings = spark.createDataFrame([("a1", "1"), ("a2", "1"), ("a3", "3")], "accession_number string, cik string")
    facts = spark.createDataFrame([("a1", "1", "x"), ("a1", "1", "y"), ("a2", "2", "x")], "accession_number string, cik string, tag_name string")
    assert tuple(quality.ticker_companies(tickers, companies).first()) == (4, 2, 3, 0.666667)
    assert {r.ticker: r.n_filings for r in quality.ticker_filings(tickers, filings).collect()} == {"A": 2, "B": 2, "C": 0, "D": 0}
    assert {r.ticker: (r.n_tags, r.n_facts, r.has_facts) for r in quality.ticker_facts(tickers, facts).collect()} == {"A": (2, 2, True), "B": (2, 2, True), "C": (1, 1, True), "D": (0, 0, False)}
    assert {r.cik: (r.filings, r.with_facts, r.n_tags, r.share, r.ticker) for r in quality.filing_facts(filings, facts, tickers).collect()} == {"1": (2, 1, 2, 0.5, "A"), "3": (1, 0, 0, 0.0, None)}


def test_ratios(spark):
    rows = [("1", D(2024, 1, 1), "L", 10.0), ("1", D(2024, 1, 1), "E", 4.0), ("1", D(2024, 2, 1), "L", 3.0), ("1", D(2024, 3, 1), "L", 3.0), ("1", D(2024, 3, 1), "E", 0.0), ("1", None, "E", 1.0)]
    facts = spark.createDataFrame(rows, "cik string, period_end_date date, tag_name string, value_numeric double")
    got = {r.period_end_date.month: r.debt_to_equity for r in analysis.ratios(facts, "L", "E", ["period_end_date"]).collect()}
    assert got == {1: 2.5, 2: None, 3: None}


def test_lookup(spark):
    tickers = spark.createDataFrame([("2", "aapl"), ("1", "AAPL")], "cik string, ticker string")
    companies = spark.createDataFrame([("1", "Apple Inc")], "cik string, primary_name string")
    assert [r.cik for r in analysis.company_cik(" aapl", tickers, companies).collect()] == ["1"]
    assert [r.cik for r in analysis.company_cik("APPLE", tickers, companies, "name").collect()] == ["1"]
    assert analysis.company_cik("x", tickers, companies, "isin").count() == 0
    assert analysis.financial_facts(spark.createDataFrame([], TABLES["xbrl_facts"].schema), "1", []).count() == 0
