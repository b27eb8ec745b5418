"""Reshape the generic test tables into the warehouse's raw inputs.

The test tables carry no market data, so each raw input is derived from them by
fixed rules (FIXTURES.md section 2); the DuckDB oracle derives the same rows with
the same rules written in SQL (``holdwise.plans.oracle``). Everything is a
DataFrame derived from the given tables, so its size grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.functions import bounded_broadcast
from holdwise.operators.prices import TICKER_AT_START

# Fixed parameters of the test build.
AS_OF = dt.date(2001, 12, 31)
CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_END = dt.date(2004, 12, 31)

TABLES = ("lineitem", "part", "supplier", "orders")

#: Up to so many suppliers' names are sent to every executor (some 50 MB); else all lines are dealt by supplier and then by part again.
MAX_SUPPLIERS = 500_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")



def _letter(k: Column, divisor: int) -> Column:
    return F.char(F.lit(65) + (F.floor(k / divisor) % 26))


def stock_code(k: Column) -> Column:
    """Four letters from the part key in base 26, then one digit 3..11; every 97th part is CARD."""
    digit = (F.lit(3) + k % 9).cast("string")
    letters = F.concat(_letter(k, 17576), _letter(k, 676), _letter(k, 26), _letter(k, 1))
    return F.when(k % 97 == 0, F.concat(F.lit("CARD"), digit)).otherwise(F.concat(letters, digit))


def product_name(k: Column) -> Column:
    """The statement's product name of a part: CDB, bond, a bare name, or ticker - name."""
    ptype = F.col("p_type")
    return (
        F.when(ptype == "PROMO", F.concat(F.lit("CDB - CDB"), k.cast("string"), F.lit(" BANK")))
        .when(ptype == "LARGE", F.concat(F.lit("Tesouro "), F.col("p_name")))
        .when(k % 89 == 0, F.col("p_name"))
        .otherwise(F.concat(stock_code(k), F.lit(" - "), F.col("p_name")))
    )


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement lines: one per lineitem, in the raw statement schema."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate",
    )
    part = load(spark, sf_dir, "part").select("p_partkey", product_name(F.col("p_partkey")).alias("product"), "p_retailprice")
    supp = bounded_broadcast(load(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), MAX_SUPPLIERS)
    w = Window.partitionBy("l_partkey").orderBy(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    base = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .withColumn("rn", F.row_number().over(w))
    )
    first = F.col("rn") == 1
    line = F.col("l_linenumber")
    movement = (
        F.when(first | line.between(1, 3), F.lit(S.MOVE_SETTLEMENT))
        .when(line == 4, F.lit(S.MOVE_BONUS))
        .when(line == 5, F.lit(S.MOVE_FRACTION_AUCTION))
        .when(line == 6, F.lit(S.MOVE_GROUPING))
        .otherwise(F.lit("Rendimento"))
    )
    no_price = (~first) & line.isin(4, 6)
    return base.select(
        F.when(first | (F.col("l_returnflag") != "R"), F.lit(S.RAW_CREDIT)).otherwise(F.lit(S.RAW_DEBIT)).alias(
            S.COL_DIRECTION
        ),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias(S.COL_DATE),
        movement.alias(S.COL_MOVEMENT),
        F.col("product").alias(S.COL_PRODUCT),
        F.col("s_name").alias(S.COL_INSTITUTION),
        _money("l_quantity").alias(S.COL_QUANTITY),
        F.when(no_price, F.lit("-")).otherwise(_money("p_retailprice")).alias(S.COL_UNIT_PRICE),
        F.when(no_price, F.lit("-")).otherwise(_money("l_extendedprice")).alias(S.COL_OPERATION_VALUE),
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes of every ticker named in the statements (before the split factor).

    A part's lines are quotes of the ticker at the start of its product name;
    parts whose names carry no ticker (CDBs, bonds, bare names) have no quotes.
    """
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_shipdate")
    ticker = F.regexp_extract(product_name(F.col("p_partkey")), TICKER_AT_START, 1)
    part = load(spark, sf_dir, "part").select("p_partkey", ticker.alias("ticker")).where(F.col("ticker") != "")
    quotes = li.join(part, li.l_partkey == part.p_partkey)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    g = quotes.groupBy("ticker", F.col("l_shipdate").alias("Date")).agg(
        F.max(price).alias("hi"),
        F.min(price).alias("lo"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("Volume"),
        F.max(F.col("l_tax").cast("decimal(4,2)")).alias("tax"),
    )
    return g.select(
        "Date",
        F.col("lo").cast("double").alias("Open"),
        F.col("hi").cast("double").alias("High"),
        F.col("lo").cast("double").alias("Low"),
        F.col("hi").cast("double").alias("Close"),
        F.col("lo").cast("double").alias("Adj Close"),
        "Volume",
        F.lit(0.0).alias("Dividends"),
        F.when(F.col("tax") == F.lit(0.08).cast("decimal(4,2)"), F.lit(2.0)).otherwise(F.lit(0.0)).alias(
            "Stock Splits"
        ),
        "ticker",
    )


def raw_daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily percent series on weekdays, one point per order date."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    g = o.where(F.weekday(d) < 5).groupBy(d.alias("d")).agg(F.max("o_orderkey").alias("mk"))
    return g.select(
        F.date_format("d", "dd/MM/yyyy").alias("data"),
        F.concat(F.lit("0.0"), F.lpad((F.col("mk") % 1000).cast("string"), 3, "0")).alias("valor"),
    )


def raw_monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly percent series, one point per month with orders, dated the 1st."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    g = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("m")).agg(F.max("o_orderkey").alias("mk"))
    return g.select(
        F.date_format("m", "dd/MM/yyyy").alias("data"),
        F.concat(F.lit("0."), F.lpad((F.col("mk") % 100).cast("string"), 2, "0")).alias("valor"),
    )


def raw_selic_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second daily series (loaded, never modeled: decision D8)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    g = o.where(F.weekday(d) < 5).groupBy(d.alias("d")).agg(F.min("o_orderkey").alias("mk"))
    return g.select(
        F.date_format("d", "dd/MM/yyyy").alias("data"),
        F.concat(F.lit("0.0"), F.lpad((F.col("mk") % 1000).cast("string"), 3, "0")).alias("valor"),
    )


def raw_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays: per month, the date of the largest order (ties: lowest order key).

    ``max_by`` is an aggregate, so each task pre-aggregates before the shuffle.
    """
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    d = F.to_date("o_orderdate")
    top = o.groupBy(F.trunc(d, "month").alias("m")).agg(
        F.max_by(d, F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("d")
    )
    return top.select(
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        F.lit("holiday").alias("name"),
        F.lit("national").alias("type"),
    )
