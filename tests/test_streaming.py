import os
import tempfile

from holdwise import schemas as S
from holdwise.streaming import land_statements_incrementally

HEADER = ",".join(S.STATEMENT_COLUMNS)


def _file(d, name, rows):
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(HEADER + "\n" + "\n".join(rows) + "\n")


def test_incremental_landing_appends_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="run-")
    land = os.path.join(base, "landing")
    os.makedirs(land)
    table = os.path.join(base, "raw_statements")
    ckpt = os.path.join(base, "ckpt")
    line = "Credito,02/01/2020,Transferência - Liquidação,ABCD3 - X,Broker,{q},1.00,{q}.00"
    _file(land, "movimentacao-2019.csv", [line.format(q=1), line.format(q=2)])
    land_statements_incrementally(spark, land, table, checkpoint=ckpt)
    assert spark.read.parquet(table).count() == 2
    land_statements_incrementally(spark, land, table, checkpoint=ckpt)  # nothing new
    assert spark.read.parquet(table).count() == 2
    _file(land, "movimentacao-2020.csv", [line.format(q=3)])
    land_statements_incrementally(spark, land, table, checkpoint=ckpt)
    df = spark.read.parquet(table)
    assert sorted(r[S.COL_QUANTITY] for r in df.collect()) == ["1", "2", "3"]
    assert df.columns == [*S.STATEMENT_COLUMNS, "batch"]
