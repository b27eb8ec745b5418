import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.plans.registry import QUERIES
from holdwise.sinks import drop_table, materialize, replace_partitions, save_prices, save_table, tables
from holdwise.sources import read_holidays, read_price_table, read_prices, read_rate_series, read_statements, run_sql, table
from holdwise.sources import files
from holdwise.sources.files import rate_table_name


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_statement_files_with_different_columns(spark):
    d = tempfile.mkdtemp(prefix="run-")
    header = ",".join(S.STATEMENT_COLUMNS)
    _write(f"{d}/movimentacao-2020.csv", header + "\nCredito,01/02/2020,Transferência - Liquidação,ABCD3 - X,Broker,10,1.00,10.00\n")
    cols = [c for c in S.STATEMENT_COLUMNS if c != S.COL_INSTITUTION]
    _write(f"{d}/old-2019.csv", ",".join(cols) + "\nDebito,05/03/2019,Transferência - Liquidação,ABCD3 - X,2,-,-\n")
    df = read_statements(spark, [f"{d}/movimentacao-*.csv", f"{d}/old-*.csv"])
    rows = sorted(df.collect(), key=lambda r: r[S.COL_DATE])
    assert set(S.STATEMENT_COLUMNS) <= set(df.columns)
    assert len(rows) == 2
    by_date = {r[S.COL_DATE]: r for r in rows}
    assert by_date["05/03/2019"][S.COL_INSTITUTION] is None
    assert by_date["05/03/2019"][S.COL_UNIT_PRICE] == "-"
    assert by_date["01/02/2020"][S.COL_INSTITUTION] == "Broker"


def test_no_statement_file_is_an_error(spark):
    with pytest.raises(Exception):
        read_statements(spark, "/nonexistent/dir/*.csv").collect()


def test_rate_series_and_holidays(spark):
    d = tempfile.mkdtemp(prefix="run-")
    _write(f"{d}/cdi.json", json.dumps([{"data": "02/01/2020", "valor": "0.017"}, {"data": "03/01/2020", "valor": "0.018"}]))
    r = read_rate_series(spark, f"{d}/cdi.json", indicator="cdi")
    assert sorted(x["valor"] for x in r.collect()) == ["0.017", "0.018"]
    assert {x["indicator"] for x in r.collect()} == {"cdi"}
    assert rate_table_name("selic_goal", "daily") == "central_bank_selic_goal_daily"
    os.makedirs(f"{d}/h")
    _write(f"{d}/h/2020.json", json.dumps([{"date": "2020-01-01", "name": "a", "type": "national"},
                                           {"date": "2020-01-01", "name": "b", "type": "national"},
                                           {"date": "2020-12-25", "name": "c", "type": "national"}]))
    _write(f"{d}/h/2021.json", json.dumps([{"date": "2021-01-01", "name": "a", "type": "national"}]))
    h = read_holidays(spark, f"{d}/h/*.json")
    assert sorted(str(x["date"]) for x in h.collect()) == ["2020-01-01", "2020-12-25", "2021-01-01"]


def test_read_prices_window_and_tickers(spark):
    import datetime as dt

    rows = [(dt.datetime(2020, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, t) for d in (1, 2, 3) for t in ("A", "B")]
    prices = spark.createDataFrame(rows, S.PRICE_SCHEMA)
    tickers = spark.createDataFrame([("A",)], "ticker string")
    got = read_prices(spark, prices, tickers, dt.date(2020, 1, 2), dt.date(2020, 1, 3)).collect()
    assert [(r["ticker"], r["Date"].day) for r in got] == [("A", 2)]  # end is exclusive


def _scanned(df):
    """Rows that the file scans of a collected query put out."""
    df.collect()
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind == "FileSourceScanExec":
            total += plan.metrics().apply("numOutputRows").value()
        else:
            children = plan.children()
            plans += [children.apply(k) for k in range(children.size())]
    return total


def test_stored_quotes_are_pruned_by_the_tickers(spark):
    import datetime as dt

    names = [f"T{k:03d}" for k in range(200)]
    rows = [(dt.datetime(2020, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, t) for d in range(1, 11) for t in [*names, None, "hot"]]
    rows += [(dt.datetime(2021, 1, 1) + dt.timedelta(d), 2.0, 2.0, 2.0, 2.0, 2.0, 2, 0.0, 0.0, "hot") for d in range(1000)]
    prices = spark.createDataFrame(rows, S.PRICE_SCHEMA)
    save_prices(prices, "prices_test", "raw", path=tempfile.mkdtemp(prefix="run-"))
    span = dt.date(2020, 1, 3), dt.date(2020, 1, 6)
    scanned = []
    for few in (["T007"], names[:20], names):
        path = tempfile.mkdtemp(prefix="run-") + "/tickers"
        spark.createDataFrame([(t,) for t in [*few, None, "absent"]], "ticker string").write.parquet(path)
        tickers = spark.read.parquet(path)
        got = read_price_table(spark, tickers, *span, name="prices_test")
        want = read_prices(spark, prices, tickers, *span)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(tuple(r) for r in want.collect())
        assert len(got.collect()) == 3 * len(few)
        scanned.append(_scanned(got))
    assert scanned[0] < scanned[1] < scanned[2]
    assert scanned[0] < scanned[2] / 10
    assert read_price_table(spark, None, *span, name="prices_test").count() == 3 * 202
    drop_table(spark, "prices_test", "raw")


def test_save_modes(spark):
    d = tempfile.mkdtemp(prefix="run-")
    df = spark.range(3).withColumn("x", F.col("id") * 2)
    name = "save_modes_test"
    assert save_table(df, name, layer="raw", path=f"{d}/t") == "raw.save_modes_test"
    with pytest.raises(Exception):
        save_table(df, name, layer="raw", path=f"{d}/t")  # fail is the default
    save_table(df, name, layer="raw", if_exists="append", path=f"{d}/t")
    assert spark.table("raw.save_modes_test").count() == 6
    save_table(df.limit(1), name, layer="raw", if_exists="replace", path=f"{d}/t")
    assert spark.table("raw.save_modes_test").count() == 1
    with pytest.raises(ValueError):
        save_table(df, name, layer="raw", if_exists="upsert")
    m = materialize(spark, "dim_product", spark.range(2))
    assert m.count() == 2 and table(spark, "dim_product").count() == 2
    assert run_sql(spark, "SELECT count(*) AS n FROM dw.dim_product").first()["n"] == 2


def test_layer_routing():
    assert S.layer_of("fact_daily_stock_ownership") == "dw"
    assert S.layer_of("b3__staging__products") == "staging"
    assert S.layer_of("something_new") == "public"
    assert S.layer_of("fact_daily_stock_ownership", " custom ") == "custom"


def test_statement_json_files(spark):
    d = tempfile.mkdtemp(prefix="run-")
    row = {c: "x" for c in S.STATEMENT_COLUMNS}
    row[S.COL_QUANTITY] = 10
    _write(f"{d}/a.json", json.dumps([row]))
    partial = {c: "y" for c in S.STATEMENT_COLUMNS if c != S.COL_UNIT_PRICE}
    _write(f"{d}/b.json", json.dumps([partial]))
    df = read_statements(spark, f"{d}/*.json", fmt="json")
    got = {r[S.COL_DIRECTION]: r for r in df.collect()}
    assert got["x"][S.COL_QUANTITY] == "10"  # numbers stay text
    assert got["y"][S.COL_UNIT_PRICE] is None


def test_statement_files_of_one_glob_are_stacked_by_name(spark):
    import os
    import tempfile

    base = tempfile.mkdtemp(prefix="run-")
    a = dict(zip(S.STATEMENT_COLUMNS, ["Credito", "01/01/2020", "Rendimento", "ABCD3 - X", "Broker, Inc", "1", "2.00", "2.00"]))
    layouts = {
        "2019 a.csv": S.STATEMENT_COLUMNS,
        "2020.csv": [S.COL_INSTITUTION, *[c for c in S.STATEMENT_COLUMNS if c not in (S.COL_INSTITUTION, S.COL_UNIT_PRICE)], "Extra"],
    }
    for name, columns in layouts.items():
        with open(os.path.join(base, name), "w", encoding="utf-8") as fh:
            for row in (columns, [a.get(c, "more") for c in columns]):
                fh.write(",".join(f'"{v}"' for v in row) + "\n")
    out = sorted(read_statements(spark, f"{base}/*.csv").collect(), key=lambda r: r["Extra"] or "")
    assert [r[c] for c in S.STATEMENT_COLUMNS for r in out[:1]] == list(a.values())
    assert out[1][S.COL_INSTITUTION] == "Broker, Inc" and out[1][S.COL_DIRECTION] == "Credito"
    assert out[1][S.COL_UNIT_PRICE] is None and out[1]["Extra"] == "more"


def _csv(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


HEADER = ",".join(S.STATEMENT_COLUMNS)


def test_blank_lines_before_the_header_and_breaks_in_cells(spark):
    d = tempfile.mkdtemp(prefix="run-")
    _csv(f"{d}/a [1].csv", f'\n  \n{HEADER}\nCredito,01/01/2020,"two\nlines, ""quoted""",P,B,1,2,2\nDebito,02/01/2020,x,P,B,1,2,2\n')
    _csv(f"{d}/b.csv", f"{HEADER}\n")
    _csv(f"{d}/c.csv", "﻿" + f"{HEADER},Extra\nCredito,03/01/2020,y,P,B,1,2,2,more\n")
    got = {r["Data"]: r for r in read_statements(spark, f"{d}/*.csv").collect()}
    assert sorted(got) == ["01/01/2020", "02/01/2020", "03/01/2020"]
    assert got["01/01/2020"]["Movimentação"] == 'two\nlines, "quoted"'
    assert got["03/01/2020"]["Extra"] == "more" and got["03/01/2020"]["Entrada/Saída"] == "Credito"


def test_a_broken_record_is_an_error_where_files_are_split(spark):
    d = tempfile.mkdtemp(prefix="run-")
    _csv(f"{d}/a.csv", f'{HEADER}\nCredito,01/01/2020,"two\nlines",P,B,1,2,2\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_statements(spark, f"{d}/*.csv", multiline=False).collect()


def test_a_file_without_a_header_is_named(spark):
    d = tempfile.mkdtemp(prefix="run-")
    _csv(f"{d}/good.csv", f"{HEADER}\n")
    _csv(f"{d}/empty one.csv", "\n\n")
    with pytest.raises(ValueError, match="empty one.csv"):
        read_statements(spark, f"{d}/*.csv")


def test_only_the_beginning_of_a_file_is_read_for_its_header(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="run-")
    _csv(f"{d}/long.csv", HEADER + "\n" + "Credito,01/01/2020,x,P,B,1,2,2\n" * 200_000)
    assert files.csv_header(spark, f"{d}/long.csv") == S.STATEMENT_COLUMNS
    monkeypatch.setattr(files, "HEADER_BYTES", 1 << 13)
    _csv(f"{d}/wide.csv", ",".join(f"column {k}" for k in range(9000)))
    with pytest.raises(ValueError, match="wide.csv"):
        files.csv_header(spark, f"{d}/wide.csv")


@pytest.mark.parametrize("kind", ["plain", "external", "partitioned", "made elsewhere", "made elsewhere, partitioned"])
def test_a_replace_that_fails_keeps_the_old_rows(spark, kind):
    name = "kept_" + kind.replace(" ", "_").replace(",", "")
    old = spark.range(10).withColumn("part", F.col("id") % 3)
    args = {"path": tempfile.mkdtemp(prefix="run-")} if kind == "external" else {}
    if "partitioned" in kind:
        args["partition_by"] = ["part"]
    if "elsewhere" in kind:
        spark.sql("CREATE DATABASE IF NOT EXISTS staging")
        writer = old.write.partitionBy("part") if "partitioned" in kind else old.write
        writer.saveAsTable(f"staging.{name}")
    else:
        save_table(old, name, layer="staging", **args)
    # the error comes in the middle of the write, after other rows are out
    bad = spark.range(0, 1000, 1, 4).withColumn("part", F.col("id") % 2).withColumn("x", F.when(F.col("id") == 900, F.raise_error(F.lit("broken row"))).otherwise("a"))
    with pytest.raises(Exception, match="broken row"):
        save_table(bad, name, layer="staging", if_exists="replace", **args)
    assert spark.table(f"staging.{name}").select("id", "part").collect().__len__() == 10
    assert [t.name for t in spark.catalog.listTables("staging") if t.name.startswith(name + "__")] == []
    # a good one has other columns, and may read the table that it replaces
    new = spark.table(f"staging.{name}").where("id < 4").withColumn("y", F.lit(1))
    save_table(new, name, layer="staging", if_exists="replace", **args)
    assert sorted(tuple(r) for r in spark.table(f"staging.{name}").select("id", "y").collect()) == [(k, 1) for k in range(4)]
    more = spark.range(1).selectExpr("id", "id AS part", "1 AS y")
    save_table(more, name, layer="staging", if_exists="append", **args)
    assert spark.table(f"staging.{name}").count() == 5
    drop_table(spark, name, "staging")
    drop_table(spark, name, "staging")  # absent: no error
    if kind == "external":
        assert os.listdir(args["path"]) == []


def test_a_swap_that_fails_gives_the_old_table_its_name_back(spark):
    save_table(spark.range(3), "swap_back", layer="staging")
    with pytest.raises(Exception):
        tables._swap(spark, "staging", "swap_back", "no_such_table")
    assert spark.table("staging.swap_back").count() == 3


def test_raw_layer_leaves_the_warehouse_alone(spark):
    save_table(spark.range(7), "b3_financial_transactions", if_exists="replace")
    QUERIES["raw_layer"](spark, "/root/testdata/sf0.001").collect()
    assert spark.table("raw.b3_financial_transactions").count() == 7
    drop_table(spark, "b3_financial_transactions")


def test_a_series_is_reloaded_alone(spark):
    d = tempfile.mkdtemp(prefix="run-")
    series = {"cdi": [("01/01/2020", "0.1"), ("02/01/2020", "0.2")], "ipca": [("01/01/2020", "0.5")]}
    for indicator, points in series.items():
        rows = spark.createDataFrame(points, S.RATE_SCHEMA).withColumn("indicator", F.lit(indicator))
        replace_partitions(rows, "rates_test", ["indicator"], "raw", d)
    kept = files.read_rate_table(spark, "ipca", "rates_test")
    before = sorted(kept.inputFiles())
    again = spark.createDataFrame([("03/01/2020", "0.3")], S.RATE_SCHEMA).withColumn("indicator", F.lit("cdi"))
    replace_partitions(again.select("indicator", "valor", "data"), "rates_test", ["indicator"], "raw", d)
    cdi = files.read_rate_table(spark, "cdi", "rates_test")
    assert [(r["data"], r["valor"]) for r in cdi.collect()] == [("03/01/2020", "0.3")]
    kept = files.read_rate_table(spark, "ipca", "rates_test")
    assert sorted(kept.inputFiles()) == before and kept.count() == 1
    plan = cdi._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator" in plan
    bad = again.withColumn("valor", F.raise_error(F.lit("broken row")))
    with pytest.raises(Exception, match="broken row"):
        replace_partitions(bad, "rates_test", ["indicator"], "raw", d)
    assert files.read_rate_table(spark, "cdi", "rates_test").count() == 1
    drop_table(spark, "rates_test", "raw")
