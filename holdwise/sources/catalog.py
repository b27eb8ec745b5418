"""Tables by logical name and ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdwise.schemas import qualified_name


def table(spark: SparkSession, model: str, layer: str | None = None) -> DataFrame:
    """A model's table in its layer (``source``/``ref`` in the warehouse)."""
    return spark.table(qualified_name(model, layer))


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """An ad-hoc query over registered tables; collecting is left to the caller."""
    return spark.sql(query)
