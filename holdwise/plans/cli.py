"""Build every model from landed files and save each into its layer.

    python -m holdwise.plans.cli LANDING_DIR [start [end]] [--as-of yyyy-mm-dd] [--without-prices]

LANDING_DIR is a path on any file system that Spark reads. Layout (rates and holidays are optional, prices with
--without-prices):
    statements/*.csv        statement exports (header row)
    prices/                 raw quotes, Parquet, columns as in schemas.PRICE_SCHEMA
    rates/cdi/*.json        JSON arrays of {data, valor}; also rates/ipca, rates/selic_goal
    holidays/*.json         one JSON array of {date, ...} per year
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.operators.prices import tickers_of_interest
from holdwise.plans.pipeline import RawInputs, build_all
from holdwise.session import pin_time_zone, scratch_path
from holdwise.sinks import save_table
from holdwise.sources import path_exists, read_holidays, read_prices, read_rate_series, read_statements, table

# The default window of the original loaders.
DEFAULT_START = dt.date(2018, 1, 1)
CALENDAR_YEARS_AHEAD_DAYS = 3 * 365


def parse_window(args: list[str], today: dt.date | None = None, calendar: bool = False) -> tuple[dt.date, dt.date]:
    """Optional positional start and end (yyyy-mm-dd).

    Start defaults to 2018-01-01; end defaults to today, or to today + 3 x 365
    days for the calendar.
    """
    today = today or dt.date.today()
    start = dt.date.fromisoformat(args[0]) if len(args) >= 1 else DEFAULT_START
    if len(args) >= 2:
        end = dt.date.fromisoformat(args[1])
    else:
        end = today + dt.timedelta(days=CALENDAR_YEARS_AHEAD_DAYS) if calendar else today
    return start, end


def load_landed(spark: SparkSession, landing: str, start: dt.date, end: dt.date, without_prices: bool = False) -> RawInputs:
    """S1-S4 over a landing folder; rates and prices are limited to the window, prices also to the
    tickers found in the statements. An absent price folder is an error unless ``without_prices``."""
    statements = read_statements(spark, f"{landing}/statements/*.csv")
    if without_prices:
        prices = spark.createDataFrame([], S.PRICE_SCHEMA)
    else:
        prices = read_prices(spark, f"{landing}/prices", tickers_of_interest(statements), start, end)

    def rates(name: str) -> DataFrame:
        path = f"{landing}/rates/{name}"
        if not path_exists(spark, path):
            return spark.createDataFrame([], S.RATE_SCHEMA)
        return read_rate_series(spark, f"{path}/*.json", start=start, end=end)

    if path_exists(spark, f"{landing}/holidays"):
        holidays = read_holidays(spark, f"{landing}/holidays/*.json").select("date")
    else:
        holidays = spark.createDataFrame([], "date date")
    return RawInputs(statements=statements, prices=prices, cdi=rates("cdi"), ipca=rates("ipca"), selic=rates("selic_goal"), holidays=holidays)


def save_raw(spark: SparkSession, raw: RawInputs) -> RawInputs:
    """Replace the raw layer's tables by the landed inputs; models then read them by name."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        save_table(df, name, if_exists="replace")
        return table(spark, name)

    return RawInputs(
        statements=kept(raw.statements, "b3_financial_transactions"),
        prices=kept(raw.prices, "stock_price_history"),
        cdi=kept(raw.cdi, "central_bank_cdi_daily"),
        ipca=kept(raw.ipca, "central_bank_ipca_monthly"),
        selic=kept(raw.selic, "central_bank_selic_goal_daily") if raw.selic is not None else None,
        holidays=raw.holidays,
        rules=raw.rules,
    )


def build_and_save(
    spark: SparkSession,
    raw: RawInputs,
    as_of: dt.date,
    calendar_start: dt.date,
    calendar_end: dt.date,
) -> dict[str, str]:
    """K2: store the raw layer, then full-refresh every model into its layer; the fact is partitioned by year."""
    pin_time_zone(spark)
    raw = save_raw(spark, raw)
    models = build_all(spark, raw, as_of, calendar_start, calendar_end, persist_dir=scratch_path(spark, "build"))
    saved = {}
    for name, df in models.items():
        if name == "fact_daily_stock_ownership":
            df = df.withColumn("year", (F.col("sk_date") / 10000).cast("int"))
            saved[name] = save_table(df, name, if_exists="replace", partition_by=["year"])
        else:
            saved[name] = save_table(df, name, if_exists="replace")
    return saved


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    as_of = dt.date.today()
    if "--as-of" in argv:
        i = argv.index("--as-of")
        as_of = dt.date.fromisoformat(argv[i + 1])
        argv = argv[:i] + argv[i + 2 :]
    without_prices = "--without-prices" in argv
    argv = [a for a in argv if a != "--without-prices"]
    landing, window = argv[0], argv[1:]
    start, end = parse_window(window, today=as_of)
    cal_start, cal_end = parse_window(window, today=as_of, calendar=True)
    spark = SparkSession.builder.appName("holdwise-build").getOrCreate()
    raw = load_landed(spark, landing, start, end, without_prices)
    for name, table in build_and_save(spark, raw, as_of, cal_start, cal_end).items():
        print(f"{name} -> {table}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
