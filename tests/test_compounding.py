import datetime as dt

from pyspark.sql import functions as F

from holdwise.operators.calendar import build_dim_date
from holdwise.operators.compounding import (
    cdi_daily,
    compound_to_end,
    compound_to_end_plain,
    ipca_monthly,
    percent_to_rate,
)
from holdwise.plans import adapters as A


def test_cdi_daily_densifies_and_compounds(spark):
    cal = build_dim_date(spark, "2020-01-30", "2020-02-10")
    rates = spark.createDataFrame(
        [("30/01/2020", "1.0"), ("31/01/2020", None), ("03/02/2020", "-100"), ("04/02/2020", "2.0"),
         ("05/02/2020", "10.0")],
        "data string, valor string",
    )
    rows = {r["date"]: r for r in cdi_daily(rates, cal, dt.date(2020, 2, 4)).collect()}
    assert sorted(rows) == [dt.date(2020, 1, 30) + dt.timedelta(days=i) for i in range(6)]  # cut at as_of
    assert float(rows[dt.date(2020, 2, 1)]["cdi_overnight"]) == 0.0  # missing day
    assert float(rows[dt.date(2020, 1, 31)]["cdi_overnight"]) == 0.0  # null rate
    assert rows[dt.date(2020, 2, 4)]["correction_factor"] == 1.02
    # a -100 % day zeroes its own factor and every earlier one
    assert rows[dt.date(2020, 2, 3)]["correction_factor"] == 0.0
    assert rows[dt.date(2020, 1, 30)]["correction_factor"] == 0.0


def test_ipca_monthly(spark):
    rates = spark.createDataFrame([("01/01/2020", "1.0"), ("01/02/2020", "2.0"), ("01/03/2020", None)], "data string, valor string")
    rows = sorted(ipca_monthly(rates).collect(), key=lambda r: r["date"])
    assert [r["correction_factor"] for r in rows] == [1.0302, 1.02, 1.0]


def test_two_level_scan_equals_plain_window(spark):
    r = A.raw_daily_rates(spark, "/root/testdata/sf0.01").select(
        F.to_date("data", "d/M/yyyy").alias("date"), percent_to_rate(F.col("valor")).alias("rate")
    )
    fast = compound_to_end(r, F.lit(1) + F.col("rate"), "date")
    plain = compound_to_end_plain(r, F.lit(1) + F.col("rate"), "date")
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


def test_factor_recurrence(spark):
    r = A.raw_monthly_rates(spark, "/root/testdata/sf0.01").select(
        F.to_date("data", "d/M/yyyy").alias("date"), percent_to_rate(F.col("valor")).alias("rate")
    )
    rows = sorted(compound_to_end(r, F.lit(1) + F.col("rate"), "date").collect(), key=lambda x: x["date"])
    for a, b in zip(rows, rows[1:]):
        assert abs(a["correction_factor"] - (1 + float(a["rate"])) * b["correction_factor"]) < 5e-6 * a["correction_factor"] + 1e-6
    assert abs(rows[-1]["correction_factor"] - (1 + float(rows[-1]["rate"]))) < 1e-6


def test_keyed_series_are_independent(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), 2.0), ("a", dt.date(2020, 2, 1), 3.0), ("b", dt.date(2020, 1, 1), 5.0)],
        "k string, d date, f double",
    )
    got = {(r["k"], r["d"].month): r["correction_factor"] for r in compound_to_end(df, F.col("f"), "d", keys=("k",)).collect()}
    assert got == {("a", 1): 6.0, ("a", 2): 3.0, ("b", 1): 5.0}
