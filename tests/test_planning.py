import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import planning, scoring

D = dt.date


def test_missing_intervals(spark):
    held = spark.createDataFrame([("A", D(2024, 1, d)) for d in (2, 3, 6, 6)], "ticker string, date date")
    wanted = spark.createDataFrame([("A", D(2024, 1, 1), D(2024, 1, 8)), ("B", D(2024, 1, 1), D(2024, 1, 2))], "ticker string, start date, end date")
    got = sorted(tuple(r) for r in planning.missing_intervals(held, wanted).collect())
    assert got == [("A", D(2024, 1, 1), D(2024, 1, 1)), ("A", D(2024, 1, 4), D(2024, 1, 5)), ("A", D(2024, 1, 7), D(2024, 1, 8)), ("B", D(2024, 1, 1), D(2024, 1, 2))]


def test_gaps_under_both_spellings(spark):
    rows = [("BH-A", D(2024, 1, 1)), ("BH.A", D(2024, 1, 3)), ("BH.A", D(2024, 1, 3)), ("BH.B", D(2024, 1, 2)), ("BH.A", None), ("C", D(2024, 1, 9))]
    held = spark.createDataFrame(rows, "ticker string, date date")
    tickers = spark.createDataFrame([("BH-A",), ("BH.A",), ("BH-B",), ("C",), ("NEW",), ("C",)], "ticker string")
    got = lambda **more: sorted((r.ticker, r.start_date.day, r.end_date.day) for r in planning.jobs_for_gaps(tickers, held, "2024-01-01", "2024-01-04", **more).collect())
    assert got() == [("BH-A", 2, 2), ("BH-A", 4, 4), ("BH-B", 1, 1), ("BH-B", 3, 4), ("BH.A", 1, 2), ("BH.A", 4, 4), ("C", 1, 4), ("NEW", 1, 4)]
    assert got(append=True) == [("BH-A", 4, 4), ("BH-B", 3, 4), ("BH.A", 4, 4), ("NEW", 1, 4)]
    one = spark.createDataFrame([("BH-A", D(2024, 1, 1), D(2024, 1, 4))], "ticker string, start date, end date")
    assert planning.missing_intervals(held, one, spellings=False).count() == 1
    plan = planning.missing_intervals(held, one)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") <= 6


def test_ranks_of_a_few_rows(spark):
    rows = [(f"t{i:03}", "c", float(i * 7 % 10)) for i in range(200)]
    scores = spark.createDataFrame(rows, "ticker string, cik string, score double")
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    picked = [order[k] for k in (0, 1, 50, 51, 199)]
    got = {r.ticker: r["rank"] for r in scoring.ranks_among(spark.createDataFrame(picked, scores.schema), scores).collect()}
    assert got == {r[0]: order.index(r) + 1 for r in picked}
    assert scoring.ranks_among(scores.limit(0), scores).count() == 0


def test_jobs_from_plan(spark):
    plan = spark.createDataFrame([("A", D(2000, 1, 1), D(2024, 1, 1)), ("B", None, D(2024, 1, 1)), ("C", D(2024, 1, 2), D(2024, 1, 1)), ("E", D(2024, 1, 1), D(2024, 1, 1))], "ticker string, start_date date, end_date date")
    got = {r.ticker: (r.start_date, r.clamped) for r in planning.jobs_from_plan(plan, 1).collect()}
    assert got == {"A": (D(2023, 1, 1), True), "E": (D(2024, 1, 1), False)}


def test_refresh_cutoff_is_fresh(spark):
    tickers = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    fetched = spark.createDataFrame([("A", dt.datetime(2024, 1, 1)), ("B", dt.datetime(2023, 12, 31, 23, 59))], "ticker string, fetch_timestamp timestamp")
    assert sorted(r.ticker for r in planning.to_refresh(tickers, fetched, "2024-01-08 00:00:00", 7).collect()) == ["B", "C"]
    assert planning.to_refresh(tickers, fetched, "2024-01-08 00:00:00", 7, force=True).count() == 3


def test_weights():
    assert scoring.weights(None) == scoring.BACKLOG
    assert scoring.weights("xbrl_richness=2, key_metrics=2")["xbrl_richness"] == 0.5
    for bad in ("nope=1", "xbrl_richness", "xbrl_richness=0"):
        with pytest.raises(ValueError):
            scoring.weights(bad)


def test_need_score(spark):
    df = spark.createDataFrame([(None, None), (D(2024, 1, 1), 400), (D(2024, 1, 30), 100), (D(2024, 1, 30), 400)], "d date, n int")
    assert [r[0] for r in df.select(scoring.need_score(F.col("d"), F.col("n"), "2024-01-31")).collect()] == [1000, 530, 515, 1]


def test_rank_is_global(spark):
    df = spark.createDataFrame([(f"t{i:03}", float(i % 7)) for i in range(200)], "ticker string, score double").repartition(8)
    got = scoring.ranked(df, ["score"]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 201))
    assert [(r.score, r.ticker) for r in got] == sorted(((r.score, r.ticker) for r in got), key=lambda x: (-x[0], x[1]))


def test_hybrid_scores_zero_without_company(spark):
    tickers = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    links = spark.createDataFrame([("A", "1"), ("B", "2")], "ticker string, cik string")
    filings = spark.createDataFrame([("1", D(2024, 1, 1)), ("1", D(2023, 12, 1)), ("2", D(2020, 1, 1))], "cik string, filing_date date")
    got = {r.ticker: r.score for r in scoring.hybrid_priority(tickers, links, filings, "2024-01-31").collect()}
    assert got["A"] > got["B"] > got["C"] == 0.0


def test_budget(spark):
    jobs = spark.createDataFrame([(i,) for i in range(10)], "j int")
    used = spark.createDataFrame([(3,), (1,)], "used int")
    assert sorted(r.j for r in planning.within_budget(jobs, used, 7, [F.asc("j")]).collect()) == [0, 1, 2]
    assert planning.within_budget(jobs, used, 2, [F.asc("j")]).count() == 0


def test_places_over_all_rows(spark):
    rows = [(f"t{i:04}", None if i % 50 == 0 else float(i * 7 % 10)) for i in range(2000)] + [("t0001", 7.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "ticker string, score double").repartition(5)
    got = {(r.ticker, r.score, r["rank"]) for r in scoring.ranked(df, ["score"]).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is None, r[0] or ""))
    assert got == {(*r, k + 1) for k, r in enumerate(order)}
    assert scoring.ranked(df.limit(0), ["score"]).count() == 0


def test_metrics_of_facts(spark):
    rows = [("1", "AssetsNet"), ("1", "AssetsNet"), ("1", "Revenues"), ("1", None), ("2", None), (None, "Liabilities"), (None, "x")]
    facts = spark.createDataFrame(rows, "cik string, tag_name string")
    got = {r.cik: (r.unique_tag_count, r.key_metric_count) for r in scoring.fact_metrics(facts).collect()}
    assert got == {"1": (2, 2), "2": (0, 0), None: (2, 1)}
