"""Write derived raw inputs as landed files, in the layouts the scans expect.

Files go below the session's shared folder (``spark.checkpoint.dir``), one new
folder per call. Holiday and rate files are JSON arrays, one per year (as the
public APIs serve them); each array is built by an aggregation per year, which
holds at most one year of points. Statements are CSV files with a header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise.session import scratch_path


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def _json_arrays_by_year(df: DataFrame, year: F.Column, path: str) -> str:
    arrays = df.groupBy(year.alias("year")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.write.partitionBy("year").text(path)
    return path


def land_holidays(holidays: DataFrame) -> str:
    """One JSON array of {date, name, type} per year."""
    path = scratch(holidays.sparkSession, "holidays")
    _json_arrays_by_year(holidays, F.substring("date", 1, 4), path)
    return path


def land_rate_series(rates: DataFrame) -> str:
    """One JSON array of {data, valor} per year."""
    path = scratch(rates.sparkSession, "rates")
    _json_arrays_by_year(rates, F.substring("data", 7, 4), path)
    return path


def land_statements(statements: DataFrame) -> str:
    """Statement lines as CSV files with a header row, in two layouts: the second has its columns in reverse.

    Returns the glob of all files. Rows go to a layout by their hash; every task writes its own files.
    """
    path = scratch(statements.sparkSession, "statements")
    second = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in statements.columns]), F.lit(2)) == 1
    for name, rows in (("a", statements.where(~second)), ("b", statements.where(second).select(*[f"`{c}`" for c in reversed(statements.columns)]))):
        rows.write.option("header", True).csv(f"{path}/{name}")
    return f"{path}/*/*.csv"
