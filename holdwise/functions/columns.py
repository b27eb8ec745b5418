"""Column expressions. All of them stay JVM-side (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the warehouse's for identical keys:
# the text that stands for a null field inside a surrogate key, and the
# separator placed between fields.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

STAGING_DECIMAL = "decimal(18,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mul(c: Column | str) -> Column:
    """A2: product aggregate; nulls are skipped and an empty (or all-null) group gives 1.

    ``F.product`` is a declarative aggregate, so Spark runs it as partial +
    final aggregation (map-side combine), like the combine function of the
    original aggregate.
    """
    return F.coalesce(F.product(_col(c)), F.lit(1.0))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the fields joined by '-', null fields replaced by a token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def sentinel_decimal(c: Column | str, sentinel: str = "-", dtype: str = STAGING_DECIMAL) -> Column:
    """The sentinel text becomes null, everything else is cast (bad text raises)."""
    return F.nullif(_col(c), F.lit(sentinel)).cast(dtype)


def parse_dmy(c: Column | str) -> Column:
    """P5: day/month/year text to a date; one- and two-digit day and month both parse."""
    return F.to_date(_col(c), "d/M/yyyy")


def _floor_double(y: Column) -> Column:
    """floor() of a double, as a double. Spark's floor returns a long, which would
    saturate; a double of magnitude 2^52 or more has no fraction left to drop."""
    return F.when(F.abs(y) < F.lit(float(2**52)), F.floor(y).cast("double")).otherwise(y)


def round_half_away(c: Column | str, digits: int) -> Column:
    """Round a double half away from zero at ``digits`` places.

    Written as sign * floor(|x| * 10^k + 0.5) / 10^k so that the same text gives
    bit-identical results in every engine (built-in double rounding differs
    between engines on values such as 0.285). Ties are judged on the binary
    value: 0.125 rounds to 0.13, while 0.285 (stored as 0.28499...) gives 0.28.
    """
    x = _col(c)
    scale = float(10**digits)
    # "+ 0.0" turns a negative zero into zero, in every engine alike.
    return F.signum(x) * _floor_double(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale) + F.lit(0.0)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it provably holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the frame is
    returned unhinted, so the join falls back to a shuffle join (or to AQE's own
    size-checked broadcast).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


#: Partitions of the stored quotes.
TICKER_BUCKETS = 64


def ticker_bucket(ticker: str = "ticker") -> Column:
    """The partition that holds a ticker's stored quotes (null for a null ticker)."""
    return F.pmod(F.crc32(F.col(ticker).cast("binary")), F.lit(TICKER_BUCKETS)).cast("int")
