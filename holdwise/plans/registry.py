"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, derives the raw inputs from the whole test
tables and returns a lazy DataFrame whose columns match the oracle SQL of the
same name (``holdwise.plans.oracle``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.functions import mul, parse_dmy, round_half_away
from holdwise.functions.sql import register_functions
from holdwise.operators.calendar import build_dim_date
from holdwise.operators.compounding import cdi_daily, ipca_monthly, percent_to_rate
from holdwise.operators.holdings import HOLDING_COLUMNS, daily_holdings, fact_daily_ownership
from holdwise.operators.ledger import LEDGER_COLUMNS, ORDERED_COLUMNS, build_ledger, order_ledger
from holdwise.operators.ordering import written
from holdwise.operators.prices import (
    close_intervals,
    fill_daily_close,
    stage_prices,
    tickers_of_interest,
    with_split_factor,
)
from holdwise.operators.products import (
    build_dim_product,
    build_products,
    product_names,
    stage_transactions,
    synonym_rules,
)
from holdwise.plans import adapters as A
from holdwise.plans import landing
from holdwise.sinks import drop_table, replace_partitions, save_prices, save_table
from holdwise.sources import read_holidays, read_price_table, read_prices, read_rate_series, read_statements, run_sql, table
from holdwise.sources.files import PRICE_TABLE, RATE_TABLE, read_rate_table

PRICE_WINDOW = (dt.date(1997, 1, 1), dt.date(2000, 1, 1))


def _holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.raw_holidays(spark, sf_dir).select(F.to_date("date").alias("date"))


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_date(spark, A.CALENDAR_START, A.CALENDAR_END, _holidays(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_transactions(A.raw_transactions(spark, sf_dir))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_products(_staged(spark, sf_dir), synonym_rules())


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ledger(_staged(spark, sf_dir), synonym_rules())


def _staged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_prices(with_split_factor(A.raw_prices(spark, sf_dir)))


def _daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_daily_close(_staged_prices(spark, sf_dir), _dim_date(spark, sf_dir), A.AS_OF)


def q_dim_date(spark, sf_dir):
    return _dim_date(spark, sf_dir)


def q_holidays(spark, sf_dir):
    path = landing.land_holidays(A.raw_holidays(spark, sf_dir))
    return read_holidays(spark, f"{path}/*/part-*")


def q_tickers_of_interest(spark, sf_dir):
    return tickers_of_interest(A.raw_transactions(spark, sf_dir))


def q_price_window_scan(spark, sf_dir):
    tickers = tickers_of_interest(A.raw_transactions(spark, sf_dir))
    return read_prices(spark, A.raw_prices(spark, sf_dir), tickers, *PRICE_WINDOW)


def q_price_table(spark, sf_dir):
    """All quotes stored by ticker, then a window of those of interest read back from the buckets they are in."""
    path = landing.scratch(spark, "price_table")
    name = f"{PRICE_TABLE}_{path[-12:]}"
    save_prices(written(A.raw_prices(spark, sf_dir), "quotes"), name, "raw", path=path)  # once: the ranges are found by a first pass
    tickers = tickers_of_interest(A.raw_transactions(spark, sf_dir))
    out = read_price_table(spark, tickers, *PRICE_WINDOW, name=name).checkpoint(eager=True)
    drop_table(spark, name, "raw")
    return out


def q_split_factor(spark, sf_dir):
    return with_split_factor(A.raw_prices(spark, sf_dir))


def q_staged_prices(spark, sf_dir):
    return _staged_prices(spark, sf_dir)


def q_daily_close(spark, sf_dir):
    return _daily_close(spark, sf_dir)


def q_staged_transactions(spark, sf_dir):
    return _staged(spark, sf_dir)


def q_products(spark, sf_dir):
    return _products(spark, sf_dir)


def q_dim_product(spark, sf_dir):
    return build_dim_product(_products(spark, sf_dir))


def q_ordered_ledger(spark, sf_dir):
    return order_ledger(_staged(spark, sf_dir), synonym_rules()).select(*ORDERED_COLUMNS)


def q_avg_cost_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir).select(*LEDGER_COLUMNS)


def q_cdi_daily(spark, sf_dir):
    return cdi_daily(A.raw_daily_rates(spark, sf_dir), _dim_date(spark, sf_dir), A.AS_OF)


def q_ipca_monthly(spark, sf_dir):
    return ipca_monthly(A.raw_monthly_rates(spark, sf_dir))


def q_mul_by_group(spark, sf_dir):
    """A2: each month's compounded daily rate (partial + final aggregation)."""
    r = A.raw_daily_rates(spark, sf_dir).select(
        F.trunc(parse_dmy("data"), "month").alias("month"), percent_to_rate(F.col("valor")).alias("rate")
    )
    return r.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_points"),
        round_half_away(mul((F.lit(1) + F.col("rate")).cast("double")), 6).alias("month_factor"),
    )


def q_daily_holdings(spark, sf_dir):
    return daily_holdings(_ledger(spark, sf_dir), _dim_date(spark, sf_dir), A.AS_OF).select(*HOLDING_COLUMNS)


def q_fact_daily_ownership(spark, sf_dir):
    close_iv = close_intervals(_staged_prices(spark, sf_dir), A.AS_OF)
    return fact_daily_ownership(_ledger(spark, sf_dir), close_iv, _dim_date(spark, sf_dir), A.AS_OF)


def q_statement_scan(spark, sf_dir):
    path = landing.land_statements(A.raw_transactions(spark, sf_dir))
    return read_statements(spark, path)


def q_rate_scan(spark, sf_dir):
    parts = []
    for name, frame in (
        ("cdi", A.raw_daily_rates(spark, sf_dir)),
        ("selic_goal", A.raw_selic_rates(spark, sf_dir)),
        ("ipca", A.raw_monthly_rates(spark, sf_dir)),
    ):
        path = landing.land_rate_series(frame)
        parts.append(read_rate_series(spark, f"{path}/*/part-*", indicator=name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RATE_WINDOW = (dt.date(1995, 1, 1), dt.date(1996, 6, 30))


def q_rate_window(spark, sf_dir):
    """S2 + S7: the monthly series limited to a window while it is read, then compounded."""
    path = landing.land_rate_series(A.raw_monthly_rates(spark, sf_dir))
    return ipca_monthly(read_rate_series(spark, f"{path}/*/part-*", None, *RATE_WINDOW))


RELOAD = (dt.date(1997, 1, 1), dt.date(1999, 12, 31))


def q_rate_table(spark, sf_dir):
    """Three series in one table by indicator; then the daily one is loaded again for a window, alone."""
    path = landing.scratch(spark, "rate_table")
    name = f"{RATE_TABLE}_{path[-12:]}"
    cdi = landing.land_rate_series(A.raw_daily_rates(spark, sf_dir))
    for indicator, folder in (("cdi", cdi), ("selic_goal", landing.land_rate_series(A.raw_selic_rates(spark, sf_dir))), ("ipca", landing.land_rate_series(A.raw_monthly_rates(spark, sf_dir)))):
        replace_partitions(read_rate_series(spark, f"{folder}/*/part-*", indicator), name, ["indicator"], "raw", path)
    replace_partitions(read_rate_series(spark, f"{cdi}/*/part-*", "cdi", *RELOAD), name, ["indicator"], "raw", path)
    out = read_rate_table(spark, name=name).checkpoint(eager=True)
    drop_table(spark, name, "raw")
    return out


def q_mul_sql(spark, sf_dir):
    """``mul`` in SQL text, as an aggregate and over a window."""
    register_functions(spark)
    rates = A.raw_daily_rates(spark, sf_dir).select(parse_dmy("data").alias("day"), percent_to_rate(F.col("valor")).alias("rate"))
    rates.createOrReplaceTempView("holdwise_daily_rates")
    return run_sql(
        spark,
        """SELECT day, r.rate, r.so_far, t.month_factor FROM (
             SELECT day, rate, trunc(day, 'month') AS month, round(mul(CAST(1 + rate AS DOUBLE)) OVER (PARTITION BY trunc(day, 'month') ORDER BY day), 9) AS so_far
             FROM holdwise_daily_rates) r
           JOIN (SELECT trunc(day, 'month') AS month, round(mul(CAST(1 + rate AS DOUBLE)), 9) AS month_factor FROM holdwise_daily_rates GROUP BY 1) t
           ON r.month = t.month""",
    )


def q_product_names(spark, sf_dir):
    return product_names(_products(spark, sf_dir))


def q_raw_layer(spark, sf_dir):
    """Statements stored in their model's layer, read by name, and queried as SQL.

    The table has a name of its own and goes when the counts are taken, so a warehouse's tables stay as they are.
    """
    model = "b3_financial_transactions"
    path = landing.scratch(spark, "raw_layer")
    own, layer = f"{model}_{path[-12:]}", S.layer_of(model)
    name = save_table(A.raw_transactions(spark, sf_dir), own, layer=layer, path=path)
    rows = table(spark, own, layer).groupBy(F.col(S.COL_MOVEMENT).alias("movement")).agg(F.count(F.lit(1)).alias("n_rows"))
    names = run_sql(spark, f"SELECT `{S.COL_MOVEMENT}` AS movement, count(DISTINCT `{S.COL_PRODUCT}`) AS n_products FROM {name} GROUP BY 1")
    out = rows.join(names, "movement").withColumn("layer", F.lit(name.split(".")[0])).checkpoint(eager=True)
    drop_table(spark, own, layer)
    return out


def q_save_modes(spark, sf_dir):
    """K1, K2: the table's rows and distinct products after it is created, appended to and replaced."""
    products = written(_products(spark, sf_dir), "products")  # once, so the three writes do not recompute it
    path = landing.scratch(spark, "products_table")
    name = f"products_{path[-12:]}"
    out = None
    for step, mode in enumerate(("fail", "append", "replace")):
        save_table(products, name, layer="staging", if_exists=mode, path=path)
        counts = spark.table(f"staging.{name}").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("product").alias("n_products"))
        counts = counts.select(F.lit(step).alias("step"), F.lit(mode).alias("mode"), "n_rows", "n_products").checkpoint(eager=True)
        out = counts if out is None else out.union(counts)
    drop_table(spark, name, "staging")
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_date": q_dim_date,
    "holidays": q_holidays,
    "tickers_of_interest": q_tickers_of_interest,
    "price_window_scan": q_price_window_scan,
    "price_table": q_price_table,
    "split_factor": q_split_factor,
    "staged_prices": q_staged_prices,
    "daily_close": q_daily_close,
    "staged_transactions": q_staged_transactions,
    "products": q_products,
    "dim_product": q_dim_product,
    "ordered_ledger": q_ordered_ledger,
    "avg_cost_ledger": q_avg_cost_ledger,
    "cdi_daily": q_cdi_daily,
    "ipca_monthly": q_ipca_monthly,
    "mul_by_group": q_mul_by_group,
    "daily_holdings": q_daily_holdings,
    "fact_daily_ownership": q_fact_daily_ownership,
    "statement_scan": q_statement_scan,
    "rate_scan": q_rate_scan,
    "rate_window": q_rate_window,
    "rate_table": q_rate_table,
    "mul_sql": q_mul_sql,
    "product_names": q_product_names,
    "raw_layer": q_raw_layer,
    "save_modes": q_save_modes,
}
