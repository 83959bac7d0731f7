import datetime as dt
import json
import zipfile

from pyspark.sql import functions as F

from ledgerloom.operators import normalize
from ledgerloom.sources import feeds

SUBMISSION = {
    "cik": "4711", "name": "Acme", "entityType": "", "fiscalYearEnd": None, "tickers": ["A", "", "C"], "exchanges": ["X", "Y"],
    "addresses": {"mailing": {"city": "Here"}, "business": None}, "formerNames": [{"name": "Old", "from": "2001-02-03T00:00:00.000Z", "to": None}, {"name": ""}],
    "filings": {"recent": {"accessionNumber": ["a1", "a2", "a3"], "filingDate": ["2024-01-02", "bad", "2024-01-04"], "form": ["10-K", "10-Q", None], "size": [5, "x", 7], "isXBRL": [1, 0, 0]}},
}
FACTS = {"cik": 4711, "entityName": "ACME INC", "facts": {"us-gaap": {"Assets": {"label": "Assets", "units": {"USD": [
    {"val": 1000000, "accn": "a1", "end": "2023-12-31", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-01-02", "frame": "CY2023"},
    {"val": "NaN", "accn": "a1", "end": "2023-12-31", "fy": "x", "form": "10-K", "filed": "2024-01-02"}, {"val": 1, "form": "10-K"}, {"val": 1, "accn": "a9"}]}}}}}


def texts(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_submission(spark):
    docs = normalize.submissions(texts(spark, SUBMISSION, "not json", "[1]", {"name": "no cik"}))
    assert docs.count() == 1
    company = normalize.companies(docs, F.lit("2024-01-01"), normalize.company_facts(texts(spark, FACTS))).first()
    assert (company.cik, company.primary_name, company.entity_type, company.fiscal_year_end, company.mailing_city, company.entity_name_cf) == ("0000004711", "Acme", None, "", "Here", "ACME INC")
    assert [(r.ticker, r.exchange) for r in normalize.tickers(docs).collect()] == [("A", "X")]
    names = normalize.former_names(docs).collect()
    assert [(r.former_name, r.date_from, r.date_to) for r in names] == [("Old", dt.datetime(2001, 2, 3), None)]
    filings = normalize.filings(docs).collect()
    assert [(r.accession_number, r.filing_date, r.size, r.is_xbrl, r.items) for r in filings] == [("a1", dt.date(2024, 1, 2), 5, True, None)]
    done = spark.createDataFrame([("a1",)], "accession_number string")
    assert normalize.filings(docs, done).count() == 0


def test_malformed_filings_keep_the_company(spark):
    uneven = SUBMISSION | {"filings": {"recent": {"accessionNumber": ["a1"], "filingDate": ["2024-01-02", "2024-01-03"], "form": ["10-K"]}}}
    scalar = SUBMISSION | {"cik": "2", "filings": {"recent": {"accessionNumber": "a1", "filingDate": ["2024-01-02"], "form": ["10-K"]}}}
    docs = normalize.submissions(texts(spark, uneven, scalar))
    assert normalize.companies(docs, F.lit("2024-01-01")).count() == 2 and normalize.filings(docs).count() == 0


def test_facts(spark):
    docs = normalize.company_facts(texts(spark, FACTS, "", {"cik": "5"}))
    got = sorted(normalize.facts(docs).collect(), key=lambda r: r.value_text or "")
    assert [(r.value_numeric, r.value_text, r.fy, r.frame) for r in got] == [(1e6, None, 2023, "CY2023"), (None, "NaN", None, "")]
    assert [tuple(r) for r in normalize.tags(docs).collect()] == [("us-gaap", "Assets", "Assets", None)]
    summary = normalize.parse_summary(normalize.submissions(texts(spark, SUBMISSION)), docs).first()
    assert (summary.n_filings, summary.n_facts, summary.n_tags) == (1, 2, 1)


def test_values_keep_their_types(spark):
    """false and "false", 0 and "0" differ; company fields that are false are null; values split by what they are."""
    flags = [False, "false", 0, "0", 1, True, "", None, [], {"a": 0}]
    recent = {"accessionNumber": [f"a{i}" for i in range(10)], "filingDate": ["2024-01-02"] * 10, "form": ["10-K"] * 10, "isXBRL": flags, "isInlineXBRL": flags[::-1]}
    doc = SUBMISSION | {"sic": 0, "category": False, "phone": "false", "flags": 17, "ein": "0", "filings": {"recent": recent}}
    docs = normalize.submissions(texts(spark, doc))
    got = {r.accession_number: (r.is_xbrl, r.is_inline_xbrl) for r in normalize.filings(docs).collect()}
    want = [None if x is None else bool(x) for x in flags]
    assert [got[f"a{i}"] for i in range(10)] == list(zip(want, want[::-1], strict=True))
    company = normalize.companies(docs, F.lit("2024-01-01")).first()
    assert (company.sic, company.category, company.phone, company.flags, company.ein) == (None, None, "false", "17", "0")
    values = [1, "2", True, False, "true", "NaN", "Infinity", "", None, 1.5, {"a": 1}, 10**20]
    years = [2023, "2023", "x", 2023.9, None, "", True, "20 23", 0, "007", [], -1]
    facts = [{"val": v, "fy": y, "accn": f"a{i:02}", "form": "10-K"} for i, (v, y) in enumerate(zip(values, years, strict=True))]
    rows = normalize.facts(normalize.company_facts(texts(spark, {"cik": 1, "facts": {"t": {"Tag": {"units": {"USD": facts}}}}}))).orderBy("accession_number").collect()
    assert [r.value_numeric for r in rows] == [1.0, 2.0, 1.0, 0.0, None, None, None, None, None, 1.5, None, 1e20]
    assert [r.value_text for r in rows] == [None, None, None, None, "true", "NaN", "Infinity", "", None, None, '{"a":1}', None]
    assert [r.fy for r in rows] == [2023, 2023, None, 2023, None, None, 1, None, 0, 7, None, -1]


def test_feeds(spark, tmp_path):
    universe = feeds.universe(texts(spark, {"0": {"cik_str": 5}, "1": {"cik_str": 4711}, "2": {"cik_str": 5}}))
    assert [r.cik for r in universe.collect()] == ["0000000005", "0000004711"]
    bars = spark.createDataFrame([("A", json.dumps([{"v": 10, "o": 1, "h": 3, "l": 0.5, "c": 2, "t": 1704153600000}]))], "ticker string, results string")
    assert [tuple(r) for r in feeds.bars(bars).collect()] == [("A", dt.date(2024, 1, 2), 1.0, 3.0, 0.5, 2.0, 2.0, 10)]
    details = {"ticker": "A", "cik": "1", "active": True, "market_cap": 1.5, "address": {"city": "Here"}, "last_updated_utc": "2024-01-02T00:00:00Z", "delisted_utc": "bad"}
    row = feeds.ticker_details(texts(spark, details, "broken"), "2024-01-03").first()
    assert (row.ticker, row.city, row.logo_url, row.delisted_utc, row.last_updated_utc) == ("A", "Here", None, None, dt.datetime(2024, 1, 2))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("CIK1.json", "{}")
        z.writestr("skip.txt", "x")
    assert [(r.member, r.text) for r in feeds.zip_members(spark, str(tmp_path)).collect()] == [("CIK1.json", "{}")]
    risk = feeds.risk_factors({"3": spark.createDataFrame([("2024-01-01", "1.5", "x")], "Date string, `Mkt-RF` string, SMB string")})
    assert [(r.factor_model, r.mkt_minus_rf, r.smb) for r in risk.collect()] == [("3", 0.015, None)]
