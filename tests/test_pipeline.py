import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.plans import adapters as A
from holdwise.plans.cli import build_and_save, load_landed, parse_window
from holdwise.plans.pipeline import build_all, inputs_from_test_tables
from holdwise.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_parse_window_defaults():
    today = dt.date(2024, 5, 1)
    assert parse_window([], today=today) == (dt.date(2018, 1, 1), today)
    assert parse_window([], today=today, calendar=True) == (dt.date(2018, 1, 1), today + dt.timedelta(days=1095))
    assert parse_window(["2020-01-01"], today=today) == (dt.date(2020, 1, 1), today)
    assert parse_window(["2020-01-01", "2021-01-01"], today=today) == (dt.date(2020, 1, 1), dt.date(2021, 1, 1))


def test_build_all_matches_registered_queries(spark, tmp_path):
    models = build_all(spark, inputs_from_test_tables(spark, SF), A.AS_OF, A.CALENDAR_START, A.CALENDAR_END,
                       persist_dir=str(tmp_path / "persist"))
    assert set(models) == set(S.MODEL_LAYER) - {
        "b3_financial_transactions", "central_bank_cdi_daily", "central_bank_selic_goal_daily",
        "central_bank_ipca_monthly", "stock_price_history",
    }
    fact = models["fact_daily_stock_ownership"]
    ref = QUERIES["fact_daily_ownership"](spark, SF)
    assert fact.exceptAll(ref).count() == 0 and ref.exceptAll(fact).count() == 0
    keys = fact.groupBy("sk_product", "sk_date").count().where("count > 1").count()
    assert keys == 0  # at most one row per product and day
    dim = models["dim_product"]
    assert dim.count() == dim.select("sk_product").distinct().count()


def test_cli_build_from_landed_files(spark):
    base = tempfile.mkdtemp(prefix="run-")
    A.raw_transactions(spark, SF).coalesce(2).write.option("header", True).csv(f"{base}/statements")
    A.raw_prices(spark, SF).write.parquet(f"{base}/prices")
    os.makedirs(f"{base}/rates/cdi")
    rows = [r.asDict() for r in A.raw_daily_rates(spark, SF).collect()]
    with open(f"{base}/rates/cdi/all.json", "w") as fh:
        json.dump(rows, fh)
    raw = load_landed(spark, base, dt.date(1995, 1, 1), dt.date(2002, 1, 1))
    saved = build_and_save(spark, raw, A.AS_OF, A.CALENDAR_START, A.CALENDAR_END)
    assert saved["fact_daily_stock_ownership"] == "dw.fact_daily_stock_ownership"
    fact = spark.table("dw.fact_daily_stock_ownership")
    assert "year" in fact.columns and fact.count() > 0
    assert spark.table("staging.central_bank__staging__cdi_daily").count() > 0
    assert spark.table("raw.b3_financial_transactions").count() == raw.statements.count()
    assert {t.name for t in spark.catalog.listTables("raw")} >= {n for n, layer in S.MODEL_LAYER.items() if layer == "raw"}
    assert spark.table("staging.central_bank__staging__ipca_monthly").count() == 0


def test_landed_inputs_are_the_same_by_path_and_uri(spark):
    base = tempfile.mkdtemp(prefix="run-")
    A.raw_transactions(spark, SF).coalesce(1).write.option("header", True).csv(f"{base}/statements")
    A.raw_prices(spark, SF).coalesce(1).write.parquet(f"{base}/prices")
    os.makedirs(f"{base}/rates/ipca")
    with open(f"{base}/rates/ipca/all.json", "w") as fh:
        json.dump([r.asDict() for r in A.raw_monthly_rates(spark, SF).collect()], fh)
    window = (dt.date(1995, 1, 1), dt.date(1997, 1, 1))
    plain, uri = (load_landed(spark, at, *window) for at in (base, f"file://{base}"))
    for a, b in ((plain.statements, uri.statements), (plain.prices, uri.prices), (plain.ipca, uri.ipca)):
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0
    assert plain.ipca.count() < A.raw_monthly_rates(spark, SF).count()  # the window holds for rates too
    assert plain.cdi.count() == uri.selic.count() == 0
    assert load_landed(spark, base, *window, without_prices=True).prices.count() == 0
