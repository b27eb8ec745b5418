"""The ledger cut over many partitions against a plain fold of each product."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from holdwise import schemas as S
from holdwise.operators import ledger_fold, ordering
from holdwise.operators.ledger import build_ledger, folded_ledger, order_ledger
from holdwise.operators.products import stage_transactions, synonym_rules
from holdwise.plans import adapters as A
from holdwise.session import shared_dir
from tests.fixtures import AUCTION, BONUS, CR, DB, GROUP, LEDGER_ROWS, NULL_DATE_ROWS, SETTLE, statements


def plain(rows):
    """Units, cost and previous average of one product's rows in order, one after another."""
    out, u, c = [], None, None
    for k, r in enumerate(rows):
        n = None if r["number_of_units"] is None else float(r["number_of_units"])
        t = None if r["total_price_brl"] is None else float(r["total_price_brl"])
        credit, grouping = r["debit_or_credit"] == S.CREDIT, r["transaction_type"] == S.MOVE_GROUPING
        avg = c / u if k and c is not None and u else None
        if k == 0:
            u, c = (n if credit or n is None else -n), (t if credit else None)
        else:
            if c is not None:
                c += (t or 0.0) if grouping or credit else (-n * avg if n is not None and avg is not None else 0.0)
            u = n if grouping else None if n is None or u is None else u + n if credit else u - n
        out.append((u, c))
    return out


def check(ledger, staged):
    ordered = {(r["sk_product"], r["transaction_nr_for_product"]): r for r in order_ledger(staged, synonym_rules(), 5).collect()}
    got = {(r["sk_product"], r["transaction_nr_for_product"]): r for r in ledger.collect()}
    assert got.keys() == ordered.keys()
    for sk in {k for k, _ in got}:
        rows = [ordered[sk, i + 1] for i in range(sum(k == sk for k, _ in got))]
        for i, (u, c) in enumerate(plain(rows)):
            g = got[sk, i + 1]
            assert g["transaction_date"] == rows[i]["transaction_date"] and g["product"] == rows[i]["product"]
            assert g["next_transaction_date_for_same_product"] == (rows[i + 1]["transaction_date"] if i + 1 < len(rows) else None)
            for x, y in ((g["acc_units"], u), (g["acc_total_cost_brl"], c)):
                assert (x is None) == (y is None) and (x is None or abs(x - y) < 0.000501 + 1e-12 * abs(y))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_hand_cases(spark, parts):
    staged = stage_transactions(statements(spark, LEDGER_ROWS + NULL_DATE_ROWS))
    check(build_ledger(staged, synonym_rules(), parts), staged)


def test_one_product_holds_a_third_of_the_rows(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(3000):
        name = "HOTT3 - HOT" if k % 3 == 0 else f"AB{chr(65 + k % 26)}D4 - S{k % 26}"
        move = rnd.choices([SETTLE, BONUS, AUCTION, GROUP], [90, 4, 3, 1])[0]
        total = "-" if move in (BONUS, GROUP) else f"{rnd.randint(1, 9999)}.{rnd.randint(0, 99):02d}"
        quantity = f"{rnd.randint(1, 500)}.{rnd.randint(0, 9)}"
        rows.append((rnd.choice([CR, CR, DB]), f"{rnd.randint(1, 28)}/{rnd.randint(1, 12)}/{2000 + k % 20}", move, name, quantity, f"{rnd.randint(1, 90)}.50", total))
    staged = stage_transactions(statements(spark, rows)).cache()
    cut, whole = (build_ledger(staged, synonym_rules(), parts) for parts in (37, 1))
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    check(cut, staged)


def test_nulls_in_units_last_until_a_grouping(spark):
    rows = [
        (CR, "01/01/2020", SETTLE, "NULL3 - X", "10", "1.00", "10.00"),
        (CR, "02/01/2020", SETTLE, "NULL3 - X", None, "1.00", "5.00"),
        (DB, "03/01/2020", SETTLE, "NULL3 - X", "2", "1.00", "2.00"),
        (CR, "04/01/2020", GROUP, "NULL3 - X", "7", "-", "-"),
        (DB, "05/01/2020", SETTLE, "NULL3 - X", "1", "3.00", "3.00"),
    ]
    staged = stage_transactions(statements(spark, rows))
    for parts in (1, 5):
        out = sorted(build_ledger(staged, synonym_rules(), parts).collect(), key=lambda r: r["transaction_nr_for_product"])
        assert [r["acc_units"] for r in out] == [10.0, None, None, 7.0, 6.0]
        assert [r["delta_units"] for r in out] == [10.0, None, -2.0, None, -1.0]


def test_test_tables(spark):
    staged = stage_transactions(A.raw_transactions(spark, "/root/testdata/sf0.001"))
    check(build_ledger(staged, synonym_rules(), 23), staged)


def test_empty(spark):
    staged = stage_transactions(statements(spark, LEDGER_ROWS[:1])).limit(0)
    assert build_ledger(staged, synonym_rules()).collect() == []


def test_units_beyond_64_bits(spark):
    rows = [(CR, f"{k + 1:02d}/01/2020", SETTLE, "HUGE3 - X", "999999999999", "1.00", "1.00") for k in range(12)]
    staged = stage_transactions(statements(spark, rows))
    for parts in (1, 5):
        out = folded_ledger(staged, synonym_rules(), parts).collect()
        assert max(r["_units"] for r in out) == 11_999_999_999_988.0


def raw_doubles(staged, parts):
    out = folded_ledger(staged, synonym_rules(), parts).collect()
    return sorted((r["sk_product"], r["transaction_nr_for_product"], repr((r["_units"], r["_cost"], r["_prev_avg"], r["delta_units"]))) for r in out)


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_costs_do_not_depend_on_the_cut(spark, monkeypatch, block):
    """The doubles before rounding are the same bits for any number of range partitions, also over many blocks."""
    monkeypatch.setattr(ledger_fold, "BLOCK", block)
    rnd = random.Random(5)
    rows = []
    for k in range(1200):
        move = rnd.choices([SETTLE, BONUS, AUCTION, GROUP], [90, 4, 3, 1])[0]
        total = "-" if move in (BONUS, GROUP) else f"{rnd.randint(1, 9999)}.{rnd.randint(0, 99):02d}"
        name = "HOTT3 - HOT" if k % 2 else f"AB{chr(65 + k % 7)}D4 - S{k % 7}"
        day = f"{rnd.randint(1, 28)}/{rnd.randint(1, 12)}/{2000 + k % 20}"
        direction, day, move, total = (CR, "1/1/1999", SETTLE, "100.00") if k < 14 else (rnd.choice([CR, CR, DB]), day, move, total)
        rows.append((direction, day, move, name, f"{rnd.randint(1, 500)}.{rnd.randint(0, 9)}", f"{rnd.randint(1, 90)}.50", total))
    staged = stage_transactions(statements(spark, rows)).cache()
    whole = raw_doubles(staged, 1)
    assert len(whole) == 1200 and sum("None" not in r[2] for r in whole) > 500
    assert raw_doubles(staged, 7) == whole
    assert raw_doubles(staged, 97) == whole
    check(build_ledger(staged, synonym_rules(), 7), staged)


def test_the_input_of_ranges_is_written_by_compiled_methods(spark, monkeypatch):
    """the limit on fused methods holds while the input is written, and only then."""
    from holdwise.operators import ordering
    from holdwise.session import HUGE_METHOD

    seen = {}
    real = ordering.written

    def spy(df, name):
        seen[name] = df.sparkSession.conf.get(HUGE_METHOD)
        return real(df, name)

    monkeypatch.setattr(ordering, "written", spy)
    before = spark.conf.get(HUGE_METHOD)
    rows = ordering.ranged(spark.range(5), [F.col("id")], 2)
    assert [r["id"] for r in rows.orderBy("_at").collect()] == [0, 1, 2, 3, 4]
    assert int(seen["ranged-input"]) <= 8000
    assert seen["ranged"] == spark.conf.get(HUGE_METHOD) == before


def shuffled(df):
    """Rows that the jobs of ``df`` wrote to shuffles, without those that found the bounds of ranges before."""
    df.collect()
    seen = {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            seen[node.id()] = node.metrics().get("shuffleRecordsWritten").get().value()
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(seen.values())


def many_products(spark, products=60, lines=50):
    rows = [(CR if k % 4 else DB, f"{k % 28 + 1}/{k % 12 + 1}/2020", SETTLE, f"AB{chr(65 + p // 26)}{chr(65 + p % 26)}3 - S{p}", f"{k + 1}", "1.50", f"{k + 2}.25") for p in range(products) for k in range(lines)]
    return stage_transactions(statements(spark, rows))


def test_only_products_that_cross_a_border_are_dealt_anew(spark):
    """the ledger's windows and folds run where the ranged rows are stored."""
    staged = many_products(spark)
    ledger = build_ledger(staged, synonym_rules(), 4)
    assert "hashpartitioning(_pid" not in ledger._jdf.queryExecution().toString()
    assert shuffled(ledger) < 1000  # of 3,000 rows: at most three products of 50, and a few rows a product
    check(ledger, staged)


def test_a_large_product_in_one_partition_keeps_its_blocks(spark, monkeypatch):
    """Products of several blocks are chained, also those that lie in one partition."""
    monkeypatch.setattr(ledger_fold, "BLOCK", 16)
    staged = many_products(spark, 6)
    whole = raw_doubles(staged, 1)
    assert len(whole) == 300 and raw_doubles(staged, 5) == whole
    check(build_ledger(staged, synonym_rules(), 1), staged)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for k in range(blocks.size()) if (name := blocks.apply(k).name()).startswith("shuffle_")}


def test_written_tables_leave_no_shuffles_and_no_copies(spark):
    """the copy that ranges are made of goes, and so do the shuffles of each write."""
    folder = shared_dir(spark).removeprefix("file:")
    before, kept = shuffle_files(spark), set(os.listdir(folder))
    rows = ordering.ranged(spark.range(500).repartition(5, "id"), [F.col("id").desc()], 3, "kept", bucketed=True)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    new = set(os.listdir(folder)) - kept
    assert len(new) == 1 and new.pop().startswith("kept-")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("holdwise_kept")]
    assert [r["id"] for r in rows.orderBy("_at").collect()] == list(range(499, -1, -1))
    assert [r["_pid"] for r in rows.select("_pid").distinct().orderBy("_pid").collect()] == ordering.bucket_labels(3)


def test_each_label_has_a_bucket_of_its_own(spark):
    labels = ordering.bucket_labels(97)
    assert labels == sorted(labels)
    found = spark.createDataFrame([(x,) for x in labels], "x int").select(F.pmod(F.hash("x"), F.lit(97)).alias("b")).collect()
    assert sorted(r["b"] for r in found) == list(range(97))


@pytest.mark.parametrize("labels", [1, 2])
def test_more_partitions_than_labels(spark, labels):
    """A session may deal out more partitions than were asked for: their numbers still grow and differ."""
    rows = spark.range(40).repartitionByRange(5, "id").sortWithinPartitions("id").select(F.monotonically_increasing_id().alias("_at"), "id")
    rows = rows.withColumn("_pid", F.shiftright("_at", ordering.ROW_BITS).cast("int")).cache()
    out = ordering._bucketed(rows, "few", labels)
    assert out.count() == 40 and out.select("_pid").distinct().count() == rows.select("_pid").distinct().count()
    ids = [r["id"] for r in out.orderBy("_pid", "_at").collect()]
    assert ids == list(range(40))
