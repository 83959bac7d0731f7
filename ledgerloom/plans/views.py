"""The library's tables as seen in the given ones: companies, filings, facts, prices, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_DAY, EVENTS_DAY = "2001-08-02", "2024-01-31"


class Views:
    """Frames over the Parquet tables of one folder; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def companies(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").cast("string").alias("cik"), F.col("c_name").alias("primary_name"), F.col("c_mktsegment").alias("category"))

    def tickers(self) -> DataFrame:
        """Every customer but each seventh has a ticker, spelt with a hyphen."""
        c = self.table("customer").where("c_custkey % 7 <> 0")
        return c.select(F.col("c_custkey").cast("string").alias("cik"), F.concat(F.lit("T-"), F.col("c_custkey")).alias("ticker"), F.col("c_mktsegment").alias("exchange"))

    def former_names(self) -> DataFrame:
        """Suppliers as what the company of the same number was called before."""
        return self.table("supplier").select(F.col("s_suppkey").cast("string").alias("cik"), F.col("s_name").alias("former_name"))

    def filings(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("accession_number"), F.col("o_custkey").cast("string").alias("cik"),
            F.to_date("o_orderdate").alias("filing_date"), F.col("o_orderpriority").alias("form"), F.col("o_orderstatus").alias("status"),
        )

    def headers(self) -> DataFrame:
        """What all facts of an order share, their keys among it."""
        return self.table("orders").select(
            "o_orderkey", F.col("o_custkey").cast("string").alias("cik"), F.col("o_orderkey").cast("string").alias("accession_number"),
            F.col("o_orderpriority").alias("form"), F.to_date("o_orderdate").alias("filed_date"),
        )

    def facts(self, headers: DataFrame | None = None) -> DataFrame:
        """All facts, or those of some ``headers``: rows chosen by these keys are chosen before the lines are joined, which are dealt out once then."""
        h = self.headers() if headers is None else headers
        return self.table("lineitem").join(h, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "cik", "accession_number",
            F.concat("l_returnflag", "l_linestatus").alias("tag_name"), F.when(F.col("l_tax") < 0.04, "USD").otherwise("EUR").alias("unit"),
            F.to_date("l_shipdate").alias("period_end_date"), F.col("l_extendedprice").alias("value_numeric"), F.col("l_linenumber").cast("string").alias("fp"),
            "form", "filed_date",
        )

    def prices(self) -> DataFrame:
        """A row for each user and day with events."""
        return self.table("events").where("user_id IS NOT NULL AND ts IS NOT NULL").groupBy(
            F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("date")
        ).agg(F.max("value").alias("close"), F.count("*").alias("volume"))


SQL = """
companies AS (SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS primary_name, c_mktsegment AS category FROM customer),
tickers AS (SELECT CAST(c_custkey AS VARCHAR) AS cik, 'T-' || c_custkey AS ticker, c_mktsegment AS exchange FROM customer WHERE c_custkey % 7 <> 0),
former_names AS (SELECT CAST(s_suppkey AS VARCHAR) AS cik, s_name AS former_name FROM supplier),
filings AS (SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, CAST(o_custkey AS VARCHAR) AS cik, CAST(o_orderdate AS DATE) AS filing_date,
  o_orderpriority AS form, o_orderstatus AS status FROM orders),
facts AS (SELECT CAST(o_custkey AS VARCHAR) AS cik, CAST(l_orderkey AS VARCHAR) AS accession_number, l_returnflag || l_linestatus AS tag_name,
  CASE WHEN l_tax < 0.04 THEN 'USD' ELSE 'EUR' END AS unit, CAST(l_shipdate AS DATE) AS period_end_date, l_extendedprice AS value_numeric,
  CAST(l_linenumber AS VARCHAR) AS fp, o_orderpriority AS form, CAST(o_orderdate AS DATE) AS filed_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
prices AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, max(value) AS close, count(*) AS volume FROM events
  WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
"""
