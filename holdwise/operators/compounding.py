"""Compounding factors of rate series.

W4 in the warehouse is a window over one global partition (``PARTITION BY 1``),
which puts a whole series into one task. Here it is a two-level scan: months
are compounded in parallel inside each month, each month's total comes from a
partial + final aggregation, and a running product over the month totals (one
row per series and month, bounded by the calendar, not by the data) supplies the
factor of everything later. ``exp(sum(log))`` is avoided: it fails for a factor
<= 0, which a rate of -100 % or less produces.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdwise.functions import mul, parse_dmy, round_half_away

RATE_TYPE = "decimal(20,10)"
FACTOR_DIGITS = 6
# one row per series and month: 10,000 years of monthly buckets per series at most
MAX_BUCKETS = 120_000


def percent_to_rate(valor: Column) -> Column:
    """Percent text to a fraction; a missing value is 0."""
    return F.coalesce((valor.cast("decimal(18,8)") / F.lit(100)).cast(RATE_TYPE), F.lit(0).cast(RATE_TYPE))


def compound_to_end(
    df: DataFrame,
    factor: Column,
    order: str,
    keys: tuple[str, ...] = (),
    out: str = "correction_factor",
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """Product of ``factor`` over this row and every later row of its series.

    Nulls count as 1. The result is rounded half away from zero to 6 places.
    """
    keys = list(keys)
    d = df.withColumn("_f", F.coalesce(factor.cast("double"), F.lit(1.0))).withColumn(
        "_bucket", F.trunc(F.col(order), "month")
    )
    per_bucket = d.groupBy(*keys, "_bucket").agg(mul("_f").alias("_bucket_factor"))
    # A null order value sorts after every date (as ascending order with nulls last would).
    later = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = per_bucket.select(
        *keys, "_bucket", F.coalesce(F.product("_bucket_factor").over(later), F.lit(1.0)).alias("_carry")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(
        F.col(order).desc_nulls_first(), *[F.col(c).desc_nulls_first() for c in tie_break]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    partial = d.withColumn("_inside", F.product("_f").over(inside))
    carry = carry.withColumnRenamed("_bucket", "_cb")  # a row per series and month: Spark broadcasts it by its size
    for k in keys:
        carry = carry.withColumnRenamed(k, f"_ck_{k}")
    cond = [partial["_bucket"].eqNullSafe(carry["_cb"])] + [partial[k].eqNullSafe(carry[f"_ck_{k}"]) for k in keys]
    joined = partial.join(carry, cond)
    return joined.withColumn(out, round_half_away(F.col("_inside") * F.col("_carry"), FACTOR_DIGITS)).drop(
        "_f", "_bucket", "_inside", "_carry", "_cb", *[f"_ck_{k}" for k in keys]
    )


def compound_to_end_plain(df: DataFrame, factor: Column, order: str, keys: tuple[str, ...] = (), out: str = "correction_factor") -> DataFrame:
    """Test twin of :func:`compound_to_end`: one window per series, newest first."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    f = F.coalesce(factor.cast("double"), F.lit(1.0))
    return df.withColumn(out, round_half_away(F.product(f).over(w), FACTOR_DIGITS))


def cdi_daily(rates: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """C1 (J4, P9, P18, W4): every calendar day up to ``as_of``; days without a rate get 0."""
    r = rates.select(parse_dmy("data").alias("date"), F.col("valor"))
    days = calendar.where(F.col("date") <= F.lit(as_of)).select("date")
    dense = days.join(r, "date", "left").select("date", percent_to_rate(F.col("valor")).alias("cdi_overnight"))
    return compound_to_end(dense, F.lit(1) + F.col("cdi_overnight"), "date", tie_break=("cdi_overnight",)).select(
        "date", "cdi_overnight", "correction_factor"
    )


def ipca_monthly(rates: DataFrame) -> DataFrame:
    """C5 (P5, P9, W4): the monthly series compounded to its end; no calendar, no cut-off."""
    r = rates.select(parse_dmy("data").alias("date"), percent_to_rate(F.col("valor")).alias("ipca_monthly"))
    return compound_to_end(r, F.lit(1) + F.col("ipca_monthly"), "date", tie_break=("ipca_monthly",)).select(
        "date", "ipca_monthly", "correction_factor"
    )
