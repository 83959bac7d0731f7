"""The tables of the library: columns, keys and which row wins when a key comes twice."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """``ddl``: columns; ``keys``: what a row is known by; ``order``: columns of which the greatest wins.

    ``nocase`` names the key columns that are compared without regard to case. ``upsert`` tables
    take batches by key; the others are replaced as a whole.
    """

    name: str
    ddl: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    nocase: tuple[str, ...] = ()
    upsert: bool = False
    required: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


# The columns of the stored tables, by name and type.
_ADDRESS = ", ".join(f"{kind}_{part} string" for kind in ("mailing", "business") for part in ("street1", "street2", "city", "state_or_country", "zip_code"))
_FACTS = (
    "cik string, accession_number string, taxonomy string, tag_name string, unit string, period_end_date date, value_numeric double, "
    "value_text string, fy int, fp string, form string, filed_date date, frame string"
)
_FACT_KEYS = ("cik", "accession_number", "taxonomy", "tag_name", "unit", "period_end_date", "frame")
_REFERENCE = (
    "ticker string, cik string, name string, market string, locale string, primary_exchange string, type string, active boolean, currency_name string, "
    "currency_symbol string, base_currency_name string, base_currency_symbol string, composite_figi string, share_class_figi string"
)
_STATEMENT = "ticker string, report_date date, item_name string, item_value bigint"

SPECS = [
    TableSpec("companies", "cik string, primary_name string, entity_name_cf string, entity_type string, sic string, sic_description string, ein string, description string, category string, fiscal_year_end string, state_of_incorporation string, phone string, flags string, " + _ADDRESS + ", first_added_timestamp timestamp, last_parsed_timestamp timestamp", ("cik",), ("last_parsed_timestamp",)),
    TableSpec("tickers", "cik string, ticker string, exchange string, source string", ("ticker", "exchange"), nocase=("ticker", "exchange")),
    TableSpec("massive_tickers", _REFERENCE + ", last_updated_utc timestamp, delisted_utc timestamp, source string, fetched_at timestamp", ("ticker",), ("fetched_at",), nocase=("ticker",), upsert=True),
    TableSpec("former_names", "cik string, former_name string, date_from timestamp, date_to timestamp", ("cik", "former_name", "date_from")),
    TableSpec("filings", "accession_number string, cik string, filing_date date, report_date date, acceptance_datetime timestamp, act string, form string, file_number string, film_number string, items string, size bigint, is_xbrl boolean, is_inline_xbrl boolean, primary_document string, primary_doc_description string", ("accession_number",), ("filing_date",), required=("accession_number", "form", "filing_date", "cik")),
    TableSpec("filing_summaries", "accession_number string, summary_text string, summary_model string, summary_date timestamp", ("accession_number",), ("summary_date",), upsert=True),
    TableSpec("xbrl_tags", "taxonomy string, tag_name string, label string, description string", ("taxonomy", "tag_name"), nocase=("taxonomy",)),
    TableSpec("xbrl_facts", _FACTS, _FACT_KEYS, ("filed_date",)),
    TableSpec("xbrl_facts_orphaned", _FACTS, _FACT_KEYS, ("filed_date",)),
    TableSpec("stock_history", "ticker string, date date, open double, high double, low double, close double, adj_close double, volume bigint", ("ticker", "date"), nocase=("ticker",), upsert=True),
    TableSpec("stock_fetch_errors", "cik string, ticker string, error_timestamp timestamp, error_type string, error_message string, start_date_req date, end_date_req date", ("ticker", "error_timestamp", "error_type"), nocase=("ticker",), upsert=True),
    TableSpec("yf_profile_metrics", "ticker string, fetch_timestamp timestamp, cik string, sector string, industry string, country string, market_cap bigint, beta double, trailing_pe double, forward_pe double, enterprise_value bigint, book_value double, price_to_book double, trailing_eps double, forward_eps double, peg_ratio double", ("ticker",), ("fetch_timestamp",), nocase=("ticker",)),
    TableSpec("yf_recommendations", "ticker string, recommendation_timestamp timestamp, firm string, grade_from string, grade_to string, action string", ("ticker", "recommendation_timestamp", "firm"), nocase=("ticker",)),
    TableSpec("yf_major_holders", "ticker string, fetch_timestamp timestamp, pct_insiders double, pct_institutions double", ("ticker",), ("fetch_timestamp",), nocase=("ticker",)),
    TableSpec("yf_stock_actions", "ticker string, action_date date, action_type string, value double", ("ticker", "action_date", "action_type"), nocase=("ticker",)),
    TableSpec("yf_info_fetch_errors", "ticker string, error_timestamp timestamp, error_message string", ("ticker", "error_timestamp"), nocase=("ticker",)),
    TableSpec("yf_income_statement", _STATEMENT, ("ticker", "report_date", "item_name"), nocase=("ticker",)),
    TableSpec("yf_balance_sheet", _STATEMENT, ("ticker", "report_date", "item_name"), nocase=("ticker",)),
    TableSpec("yf_cash_flow", _STATEMENT, ("ticker", "report_date", "item_name"), nocase=("ticker",)),
    TableSpec("yf_untrackable_tickers", "ticker string, reason string, last_failed_timestamp timestamp", ("ticker",), ("last_failed_timestamp",), nocase=("ticker",), upsert=True),
    TableSpec("polygon_untrackable_tickers", "ticker string, reason string, last_failed_timestamp timestamp", ("ticker",), ("last_failed_timestamp",), nocase=("ticker",), upsert=True),
    TableSpec("macro_economic_data", "series_id string, date date, value double", ("series_id", "date"), upsert=True),
    TableSpec("market_risk_factors", "date date, factor_model string, mkt_minus_rf double, smb double, hml double, rmw double, cma double, rf double", ("date", "factor_model"), upsert=True),
    TableSpec("updated_ticker_info", _REFERENCE + ", description string, homepage_url string, total_employees bigint, list_date string, sic_code string, sic_description string, ticker_root string, source_feed string, market_cap double, weighted_shares_outstanding bigint, round_lot int, fetch_timestamp timestamp, last_updated_utc timestamp, delisted_utc timestamp, address_1 string, city string, state string, postal_code string, logo_url string, icon_url string", ("ticker",), ("fetch_timestamp",), nocase=("ticker",), upsert=True),
    TableSpec("downloaded_archives", "file_path string, archive_name string, url string, size_bytes bigint, downloaded_at timestamp, status string", ("file_path",), ("downloaded_at",), upsert=True),
    TableSpec("parquet_file_log", "table_name string, file_name string, processed_at timestamp", ("table_name", "file_name"), ("processed_at",), upsert=True),
    TableSpec("yf_fetch_status", "fetch_date date, attempted bigint, fetched bigint", ("fetch_date",), upsert=True),
]
TABLES = {x.name: x for x in SPECS}
