"""Functions for SQL text: ``register_functions`` names them in a session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_functions(spark: SparkSession) -> None:
    """A2 in SQL: ``mul(x)``, the product of a group's or a window's values; nulls are skipped, and none give 1.

    SQL text can name no product of Spark's own, so this is an aggregate over Arrow batches, which hands a group's
    values to one task. For groups of any size use :func:`holdwise.functions.mul`, which combines partial products.
    """

    def mul(x: pd.Series) -> float:
        return float(x.dropna().astype("float64").prod())

    spark.udf.register("mul", F.pandas_udf(mul, "double"))
