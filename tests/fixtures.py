"""Hand-written raw inputs in the warehouse's real schemas (FIXTURES.md section 1)."""

from __future__ import annotations

from holdwise import schemas as S

CR, DB = S.RAW_CREDIT, S.RAW_DEBIT
SETTLE, BONUS, AUCTION, GROUP = S.MOVE_SETTLEMENT, S.MOVE_BONUS, S.MOVE_FRACTION_AUCTION, S.MOVE_GROUPING
STOCK = "ABCD3 - ABC SA"


def statements(spark, rows):
    """rows: (direction, date, movement, product, qty, unit price, total)."""
    full = [(d, dt, m, p, "Broker", q, pu, tot) for d, dt, m, p, q, pu, tot in rows]
    return spark.createDataFrame(full, S.STATEMENT_SCHEMA)


LEDGER_ROWS = [
    (CR, "01/01/2020", SETTLE, STOCK, "100", "10.00", "1000.00"),
    (DB, "02/01/2020", SETTLE, STOCK, "40", "12.00", "480.00"),
    (CR, "03/01/2020", BONUS, STOCK, "6", "-", "-"),
    (CR, "04/01/2020", GROUP, STOCK, "33", "-", "-"),
    (CR, "05/01/2020", AUCTION, STOCK, "3", "20.00", "50.00"),
    (DB, "06/01/2020", SETTLE, STOCK, "30.5", "20.00", "610.00"),
    (CR, "7/1/2020", SETTLE, STOCK, "10", "15.00", "150.00"),
    (DB, "07/01/2020", SETTLE, STOCK, "3", "20.00", "60.00"),
    (DB, "08/01/2020", SETTLE, STOCK, "20", "20.00", "400.00"),
    (CR, "08/01/2020", "Rendimento", STOCK, "1", "1.00", "1.00"),
    (DB, "02/01/2020", SETTLE, "EFGH4 - FIRST DEBIT", "5", "10.00", "50.00"),
    (CR, "03/01/2020", SETTLE, "EFGH4 - FIRST DEBIT", "10", "10.00", "100.00"),
    (CR, "02/01/2020", BONUS, "IJKL5 - FIRST BONUS", "5", "-", "-"),
    (CR, "03/01/2020", SETTLE, "IJKL5 - FIRST BONUS", "5", "10.00", "50.00"),
    ("Outro", "02/01/2020", SETTLE, "MNOP6 - ODD DIRECTION", "5", "10.00", "50.00"),
    (CR, "02/01/2020", SETTLE, None, "5", "10.00", "50.00"),
]

NULL_DATE_ROWS = [
    (CR, None, SETTLE, "QRST3 - NULL DATE", "5", "1.00", "5.00"),
    (CR, "02/01/2020", SETTLE, "QRST3 - NULL DATE", "10", "1.00", "10.00"),
    (DB, "03/01/2020", SETTLE, "QRST3 - NULL DATE", "4", "1.00", "4.00"),
]
