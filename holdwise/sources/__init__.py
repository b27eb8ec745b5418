"""Scans of landed files and catalog tables."""

from holdwise.sources.files import path_exists, read_holidays, read_price_table, read_prices, read_rate_series, read_statements
from holdwise.sources.catalog import run_sql, table

__all__ = ["path_exists", "read_holidays", "read_price_table", "read_prices", "read_rate_series", "read_statements", "run_sql", "table"]
