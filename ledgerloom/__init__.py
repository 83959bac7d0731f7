"""Filings and market-data analytics as Spark jobs, with operators for training data beside them."""
