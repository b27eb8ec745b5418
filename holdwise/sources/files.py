"""Landed statement, rate, holiday and price files.

The warehouse fetched these over HTTP and parsed workbooks one file at a time on
one machine. Here they are landed files (CSV, JSON or Parquet) read by one scan
over a glob, split across executors; nothing passes through the driver.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise import schemas as S
from holdwise.functions import parse_dmy, ticker_bucket
from holdwise.sources.catalog import table


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (not a glob) exists on the file system that its scheme names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


#: Bytes of a CSV file that must hold its header.
HEADER_BYTES = 1 << 20


def _beginning(spark: SparkSession, file: str, size: int) -> bytes:
    """At most ``size`` bytes of a file on any file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        bounded = spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(bounded))
    finally:
        stream.close()


def _first_record(text: str) -> tuple[list[str], bool]:
    """The first record of CSV text, and whether its end is in the text."""
    taken = [""]

    def lines():
        for line in io.StringIO(text, newline=""):
            taken[0] = line
            yield line

    try:
        return next(csv.reader(lines(), strict=True), []), taken[0].endswith(("\n", "\r"))
    except csv.Error:  # the text ends within quotes
        return [], False


def csv_header(spark: SparkSession, file: str) -> list[str]:
    """Column names of a CSV file: its first record that is not blank, from a read of the file's beginning only."""
    size = 1 << 12
    while True:
        data = _beginning(spark, file, size)
        record, ended = _first_record(data.decode("utf-8-sig", errors="ignore").lstrip())
        if record and (ended or len(data) < size):
            return record
        if len(data) < size:
            raise ValueError(f"no header in statement file {file}")
        if size >= HEADER_BYTES:
            raise ValueError(f"the header of statement file {file} exceeds {HEADER_BYTES} bytes")
        size *= 16


def csv_layouts(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of every distinct header among CSV files.

    The driver lists the files, as for any scan, and opens each for a bounded read of its beginning; no other byte is
    read. A file without a header is an error that names it.
    """
    files = [unquote(f) for f in spark.read.text(_paths(paths)).inputFiles()]
    layouts: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, names in zip(files, pool.map(lambda f: csv_header(spark, f), files), strict=True):
            layouts.setdefault(tuple(names), []).append(file)
    return sorted((list(names), sorted(group)) for names, group in layouts.items())


def literal(file: str) -> str:
    """A path that the readers take as it is, not as a glob."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", file)


def _is_header(names: list[str]) -> Column:
    first, *rest = [F.col(f"`{c}`") for c in names]
    same = F.regexp_replace(F.coalesce(first, F.lit("")), "^\ufeff", "") == names[0]
    for c, name in zip(rest, names[1:], strict=True):
        same &= c.eqNullSafe(F.lit(name or None))
    return same


def _is_blank(names: list[str]) -> Column:
    first, *rest = [F.col(f"`{c}`") for c in names]
    blank = F.trim(F.regexp_replace(F.coalesce(first, F.lit("")), "^\ufeff", "")) == ""
    for c in rest:
        blank &= c.isNull()
    return blank


def read_statements(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    multiline: bool = True,
) -> DataFrame:
    """Stack statement files by column name; a missing column is null.

    ``paths`` is one glob or a list of globs. CSV files may differ in the columns they have and in their order, also
    within one glob: files are grouped by their header, each group is read with its own columns, and the groups
    are stacked by name. Blank lines before the header are skipped. JSON and Parquet scans merge columns by name on
    their own. Every cell stays text. No matching file, and a CSV file without a header, are errors, as in the
    original loader. The file index is not kept.

    CSV cells may hold line breaks, as workbook cells do; a file is then read by one task. With ``multiline=False``
    large files are split over tasks, and a record that does not have the header's columns (such as a cell that goes
    on in the next line) is an error, never two rows.
    """
    if fmt == "csv":
        frames = []
        for names, files in csv_layouts(spark, paths):
            schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
            reader = spark.read.schema(schema).option("escape", '"').option("enforceSchema", True)
            if multiline:  # whose reader would take a line of blanks for the header
                rows = reader.option("multiLine", True).csv([literal(f) for f in files])
                frames.append(rows.where(~_is_header(names) & ~_is_blank(names)))
            else:
                frames.append(reader.option("header", True).option("mode", "FAILFAST").csv([literal(f) for f in files]))
    else:
        option = {"primitivesAsString": True, "multiLine": True} if fmt == "json" else {"mergeSchema": True}
        frames = [spark.read.options(**option).format(fmt).load(p) for p in _paths(paths)]
    if not frames:
        raise ValueError("no statement files")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for c in S.STATEMENT_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    extra = [c for c in out.columns if c not in S.STATEMENT_COLUMNS]
    return out.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in S.STATEMENT_COLUMNS + extra])


def read_rate_series(
    spark: SparkSession,
    path: str,
    indicator: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """S2 + S7: a JSON array of {data, valor} text points (one file or a glob), those from ``start`` to ``end`` (inclusive).

    With ``indicator`` the rows are stamped with it, so several series can share
    one table partitioned by indicator.
    """
    df = spark.read.schema(S.RATE_SCHEMA).option("multiLine", True).json(path)
    day = parse_dmy("data")
    if start is not None:
        df = df.where(day >= F.lit(start))
    if end is not None:
        df = df.where(day <= F.lit(end))
    return df if indicator is None else df.withColumn("indicator", F.lit(indicator))


def rate_table_name(indicator: str, granularity: str) -> str:
    """S2 naming: central_bank_{indicator}_{granularity}."""
    return f"central_bank_{indicator}_{granularity}"


#: One table of all rate series, partitioned by indicator.
RATE_TABLE = "central_bank_rates"


def read_rate_table(spark: SparkSession, indicator: str | None = None, name: str = RATE_TABLE, layer: str = "raw") -> DataFrame:
    """The stored rate series; with ``indicator`` only that series' files are read."""
    rows = table(spark, name, layer)
    return rows if indicator is None else rows.where(F.col("indicator") == indicator)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """S3: yearly JSON lists of holidays -> distinct dates flagged as holidays.

    Other fields are ignored; a date listed twice counts once.
    """
    raw = spark.read.schema(S.HOLIDAY_SCHEMA).option("multiLine", True).json(path)
    return (
        raw.select(F.to_date("date", "yyyy-MM-dd").alias("date"))
        .where(F.col("date").isNotNull())
        .dropDuplicates(["date"])
        .withColumn("is_holiday", F.lit(True))
    )


def read_prices(
    spark: SparkSession | None,
    prices: DataFrame | str,
    tickers: DataFrame | None,
    start: dt.date,
    end: dt.date,
    fmt: str = "parquet",
) -> DataFrame:
    """S4 + S7: price rows of the tickers of interest in [start, end).

    The date bounds reach the file scan as pushed filters; the ticker set is a
    left-semi join (Spark broadcasts it when its measured size allows).
    """
    df = prices if isinstance(prices, DataFrame) else spark.read.format(fmt).schema(S.PRICE_SCHEMA).load(prices)
    window = df.where(_in_window(start, end))
    if tickers is None:
        return window
    return window.join(tickers.select("ticker"), "ticker", "left_semi")


def _in_window(start: dt.date, end: dt.date) -> Column:
    start_ts, end_ts = dt.datetime.combine(start, dt.time()), dt.datetime.combine(end, dt.time())
    return (F.col("Date") >= F.lit(start_ts)) & (F.col("Date") < F.lit(end_ts))


#: One table of all quotes, partitioned by ``ticker_bucket``.
PRICE_TABLE = "stock_prices"


def read_price_table(spark: SparkSession, tickers: DataFrame | None, start: dt.date, end: dt.date, name: str = PRICE_TABLE, layer: str = "raw") -> DataFrame:
    """S4 + S7: stored quotes (:func:`holdwise.sinks.save_prices`) of the tickers in [start, end).

    The semi-join is on the bucket and the ticker, so that where Spark broadcasts the ticker set it prunes the
    files while the query runs; a larger set is joined as any other. Null tickers match nothing.
    """
    window = table(spark, name, layer).where(_in_window(start, end))
    if tickers is not None:
        # the comparison is always true; Spark prunes at run time only by a side that has a filter of its own
        wanted = tickers.select("ticker", ticker_bucket().alias("ticker_bucket")).where(F.col("ticker_bucket") >= 0)
        window = window.join(wanted, ["ticker_bucket", "ticker"], "left_semi")
    return window.drop("ticker_bucket")
