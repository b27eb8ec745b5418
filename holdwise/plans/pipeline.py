"""The whole build as one lazy composition of model functions.

Models that several others read (products, the ledger) are plain DataFrames
here; ``build_all(..., persist_dir=...)`` writes them once and continues from
the written files, which also cuts their lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise.operators.calendar import build_dim_date
from holdwise.operators.compounding import cdi_daily, ipca_monthly
from holdwise.operators.holdings import fact_daily_ownership
from holdwise.operators.ledger import build_ledger
from holdwise.operators.prices import close_intervals, fill_daily_close, stage_prices, with_split_factor
from holdwise.operators.products import build_dim_product, build_products, product_names, stage_transactions, synonym_rules


@dataclass
class RawInputs:
    statements: DataFrame
    prices: DataFrame  # raw quotes without the split factor
    cdi: DataFrame
    ipca: DataFrame
    holidays: DataFrame  # a ``date`` column
    selic: DataFrame | None = None  # stored in the raw layer, in no model
    rules: list[tuple[str, str]] | None = None


def _checkpoint(df: DataFrame, persist_dir: str | None, name: str) -> DataFrame:
    if persist_dir is None:
        return df
    path = f"{persist_dir}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_all(
    spark: SparkSession,
    raw: RawInputs,
    as_of: dt.date,
    calendar_start: dt.date,
    calendar_end: dt.date,
    persist_dir: str | None = None,
) -> dict[str, DataFrame]:
    """Every model of the warehouse, keyed by its table name."""
    rules = raw.rules if raw.rules is not None else synonym_rules()
    dim_date = build_dim_date(spark, calendar_start, calendar_end, raw.holidays)
    staged_tx = _checkpoint(stage_transactions(raw.statements), persist_dir, "statements")
    products = _checkpoint(build_products(staged_tx, rules), persist_dir, "products")
    ledger = _checkpoint(build_ledger(staged_tx, rules), persist_dir, "ledger")
    prices = _checkpoint(stage_prices(with_split_factor(raw.prices)), persist_dir, "prices")
    daily_close = fill_daily_close(prices, dim_date, as_of)
    fact = fact_daily_ownership(ledger, close_intervals(prices, as_of), dim_date, as_of)
    return {
        "dim_date": dim_date,
        "b3__staging__financial_transactions": staged_tx,
        "b3__staging__products": products,
        "b3__staging__stock_transactions_with_avg_cost": ledger.drop("product_code"),
        "central_bank__staging__cdi_daily": cdi_daily(raw.cdi, dim_date, as_of),
        "central_bank__staging__ipca_monthly": ipca_monthly(raw.ipca),
        "yfinance__staging__stock_price_history": prices,
        "yfinance__staging__daily_stock_close_price": daily_close,
        "dim_product": build_dim_product(products),
        "dim_product_names": product_names(products),
        "fact_daily_stock_ownership": fact,
    }


def inputs_from_test_tables(spark: SparkSession, sf_dir: str) -> RawInputs:
    """Raw inputs derived from the generic test tables (see ``adapters``)."""
    from holdwise.plans import adapters as A

    return RawInputs(
        statements=A.raw_transactions(spark, sf_dir),
        prices=A.raw_prices(spark, sf_dir),
        cdi=A.raw_daily_rates(spark, sf_dir),
        ipca=A.raw_monthly_rates(spark, sf_dir),
        holidays=A.raw_holidays(spark, sf_dir).select(F.to_date("date").alias("date")),
    )
