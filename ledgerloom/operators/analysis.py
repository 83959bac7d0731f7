"""Questions about companies: identity, facts, ratios, cash flow, and texts to summarise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import filing_url, html_text, lookup_ticker, window_text

from .integrity import needs_summary
from .tables import keep_one

FACT_COLUMNS = ["cik", "form", "filed_date", "period_end_date", "fp", "tag_name", "value_numeric", "unit"]


def company_cik(identifier: str, tickers: DataFrame, companies: DataFrame, kind: str = "ticker") -> DataFrame:
    """One row with the CIK of a ticker or of a part of a name, the least if several; none for other kinds."""
    if kind == "ticker":
        found = tickers.where(F.upper("ticker") == lookup_ticker(F.lit(identifier)))
    elif kind == "name":
        found = companies.where(F.col("primary_name").ilike(f"%{identifier}%"))
    else:
        found = companies.where(F.lit(False))
    return found.select("cik").orderBy("cik").limit(1)


def financial_facts(facts: DataFrame, cik: str | None, tags: list[str], forms: list[str] | None = None) -> DataFrame:
    """Facts of a company (or of all) for some tags; no tags, no rows."""
    found = facts.where(F.col("tag_name").isin(tags)) if tags else facts.where(F.lit(False))
    if cik is not None:
        found = found.where(F.col("cik") == cik)
    if forms:
        found = found.where(F.col("form").isin(forms))
    return found.select(*FACT_COLUMNS)


def in_time(facts: DataFrame) -> DataFrame:
    return facts.orderBy(F.asc_nulls_last("period_end_date"), F.asc_nulls_last("filed_date"))


def cash_flow(facts: DataFrame, cik: str | None, tags: list[str], forms: list[str] | None = None, unit: str = "USD") -> DataFrame:
    return financial_facts(facts, cik, tags, forms).where(F.col("unit") == unit)


def pivot_facts(facts: DataFrame, tags: list[str], by: list[str]) -> DataFrame:
    """Mean value of each tag in a column of its own; groups with a null key go. One pass: tags are given."""
    means = [F.avg(F.when(F.col("tag_name") == t, F.col("value_numeric"))).alias(t) for t in tags]
    return facts.dropna(subset=by).groupBy(*by).agg(*means)


def ratios(facts: DataFrame, debt: str, equity: str, by: list[str]) -> DataFrame:
    """Debt to equity by period; null where a part is missing or equity is zero."""
    wide = pivot_facts(facts.where(F.col("tag_name").isin(debt, equity)), [debt, equity], by)
    return wide.withColumn("debt_to_equity", F.try_divide(F.col(debt), F.col(equity)))


def latest_filed(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Of each period and tag, the value filed last."""
    return keep_one(facts, keys, [F.col("filed_date")])


def by_form(facts: DataFrame, keys: list[str], annual: str = "10-K", quarterly: str = "10-Q") -> DataFrame:
    """Latest values with ``span``: annual or quarterly, by form."""
    span = F.when(F.col("form") == annual, "annual").when(F.col("form") == quarterly, "quarterly")
    return latest_filed(facts, keys).withColumn("span", span).where("span IS NOT NULL")


def trend(facts: DataFrame, tags: list[str], keys: list[str]) -> DataFrame:
    """Series of each tag by period, latest values only."""
    chosen = latest_filed(facts.where(F.col("tag_name").isin(tags)), keys)
    return chosen.select("cik", "tag_name", "period_end_date", "value_numeric").orderBy("cik", "tag_name", "period_end_date")


def summary_corpus(
    filings: DataFrame, pages: DataFrame, summaries: DataFrame, forms: list[str], as_of: str, days: int, chars: int = 4000,
    summarise: Callable[[Column], Column] | None = None, model: str = "none", base: str = "https://archive.example",
) -> DataFrame:
    """Text of recent filings without a summary: accession_number, url, text, summary columns.

    ``pages``: accession_number and html. ``summarise`` maps the text column to a summary column,
    a vectorised function of the caller's; without one the summary is null. ``base``: where documents lie.
    """
    due = needs_summary(filings, summaries, forms, as_of, days).join(pages, "accession_number")
    text = window_text(html_text("html"), chars)
    out = due.select("accession_number", filing_url(base, "cik", "accession_number", "primary_document").alias("url"), text.alias("text"))
    summary = summarise(F.col("text")) if summarise else F.lit(None).cast("string")
    return out.withColumn("summary_text", summary).withColumn("summary_model", F.lit(model)).withColumn("summary_date", F.lit(as_of).cast("timestamp"))
