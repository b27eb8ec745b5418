"""Raw table schemas (declared, never inferred) and layer routing (K3)."""

from __future__ import annotations

from pyspark.sql import types as T

# The statement export's column names, as they appear in the files.
COL_DIRECTION = "Entrada/Saída"
COL_DATE = "Data"
COL_MOVEMENT = "Movimentação"
COL_PRODUCT = "Produto"
COL_INSTITUTION = "Instituição"
COL_QUANTITY = "Quantidade"
COL_UNIT_PRICE = "Preço unitário"
COL_OPERATION_VALUE = "Valor da Operação"

STATEMENT_COLUMNS = [
    COL_DIRECTION,
    COL_DATE,
    COL_MOVEMENT,
    COL_PRODUCT,
    COL_INSTITUTION,
    COL_QUANTITY,
    COL_UNIT_PRICE,
    COL_OPERATION_VALUE,
]

# Statement cells mix numbers and '-', so every column is text until staging.
STATEMENT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in STATEMENT_COLUMNS])

RATE_SCHEMA = T.StructType(
    [T.StructField("data", T.StringType(), True), T.StructField("valor", T.StringType(), True)]
)

HOLIDAY_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
    ]
)

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.TimestampType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
        T.StructField("Close", T.DoubleType(), True),
        T.StructField("Adj Close", T.DoubleType(), True),
        T.StructField("Volume", T.LongType(), True),
        T.StructField("Dividends", T.DoubleType(), True),
        T.StructField("Stock Splits", T.DoubleType(), True),
        T.StructField("ticker", T.StringType(), True),
    ]
)

SYNONYM_SCHEMA = T.StructType(
    [T.StructField("old", T.StringType(), False), T.StructField("new", T.StringType(), False)]
)

# The single rename rule of the warehouse (old code pattern -> new code).
# Spark's replacement syntax refers to a group as $2.
DEFAULT_SYNONYMS = [("(CARD)(\\d+)", "CSUD$2")]

# Ledger-relevant movement types and direction labels.
MOVE_SETTLEMENT = "Transferência - Liquidação"
MOVE_BONUS = "Bonificação em Ativos"
MOVE_FRACTION_AUCTION = "Leilão de Fração"
MOVE_GROUPING = "Grupamento"
LEDGER_MOVEMENTS = [MOVE_SETTLEMENT, MOVE_BONUS, MOVE_FRACTION_AUCTION, MOVE_GROUPING]
RAW_CREDIT, RAW_DEBIT = "Credito", "Debito"
CREDIT, DEBIT = "Credit", "Debit"

# K3: the layer (catalog database) of every model. A model's layer replaces the
# default database instead of being appended to it.
DEFAULT_LAYER = "public"
# The table names of the models.
MODEL_LAYER = {
    "b3_financial_transactions": "raw",
    "central_bank_cdi_daily": "raw",
    "central_bank_selic_goal_daily": "raw",
    "central_bank_ipca_monthly": "raw",
    "stock_price_history": "raw",
    "dim_date": "dw",
    "b3__staging__financial_transactions": "staging",
    "b3__staging__products": "staging",
    "b3__staging__stock_transactions_with_avg_cost": "staging",
    "central_bank__staging__cdi_daily": "staging",
    "central_bank__staging__ipca_monthly": "staging",
    "yfinance__staging__stock_price_history": "staging",
    "yfinance__staging__daily_stock_close_price": "staging",
    "dim_product": "dw",
    "dim_product_names": "dw",
    "fact_daily_stock_ownership": "dw",
}


def layer_of(model: str, custom: str | None = None) -> str:
    """K3: an explicit custom layer wins (trimmed); else the model's layer; else the default."""
    if custom is not None:
        return custom.strip()
    return MODEL_LAYER.get(model, DEFAULT_LAYER)


def qualified_name(model: str, custom: str | None = None) -> str:
    return f"{layer_of(model, custom)}.{model}"
