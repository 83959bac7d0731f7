"""Joins that split, restrict and look up rows by reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_facts(facts: DataFrame, filings: DataFrame, companies: DataFrame) -> DataFrame:
    """Facts with a filing whose company is known; filed_date becomes the filing's date."""
    known = filings.select("accession_number", F.col("cik").alias("_cik"), "filing_date")
    known = known.join(companies.select(F.col("cik").alias("_cik")), "_cik", "left_semi")
    return facts.join(known, "accession_number").withColumn("filed_date", F.col("filing_date")).select(*facts.columns)


def orphan_facts(facts: DataFrame, filings: DataFrame, companies: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Facts of known companies without a filing of the same accession and company.

    ``strict`` takes all facts that ``valid_facts`` leaves out, so that the two are a partition.
    """
    if strict:
        kept = filings.join(companies.select("cik"), "cik", "left_semi") if companies is not None else filings
        return facts.join(kept.select("accession_number"), "accession_number", "left_anti")
    if companies is not None:
        facts = facts.join(companies.select("cik"), "cik", "left_semi")
    return facts.join(filings.select("accession_number", "cik"), ["accession_number", "cik"], "left_anti")


def referenced(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the parents'."""
    return rows.join(parents.select(key), key, "left_semi")


def without(rows: DataFrame, excluded: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows whose key, whatever its case, isn't excluded; null keys stay."""
    gone = excluded.select(F.lower(key).alias("_gone")).distinct()
    return rows.join(gone, F.lower(rows[key]) == F.col("_gone"), "left_anti")


def dual_lookup(tickers: DataFrame, latest: DataFrame) -> DataFrame:
    """The latest date of each ticker, found under its own spelling or with dots for hyphens."""
    names = tickers.select("ticker", F.explode(F.array_distinct(F.array("ticker", F.replace(F.col("ticker"), F.lit("-"), F.lit("."))))).alias("_name"))
    found = names.join(latest.withColumnRenamed("ticker", "_name"), "_name", "left")
    return found.groupBy("ticker").agg(F.max("last_date").alias("last_date"))


def any_ticker(companies: DataFrame, tickers: DataFrame) -> DataFrame:
    """Each company with one ticker of its own, the least, or null."""
    return companies.join(tickers.groupBy("cik").agg(F.min("ticker").alias("any_ticker")), "cik", "left")


def needs_summary(filings: DataFrame, summaries: DataFrame, forms: list[str], as_of: str, days: int) -> DataFrame:
    """Recent filings of the given forms that have no summary yet."""
    recent = filings.where(F.col("form").isin(forms) & (F.col("filing_date") >= F.date_sub(F.lit(as_of).cast("date"), days)))
    return recent.join(summaries.select("accession_number"), "accession_number", "left_anti")
