"""K1, K2: save a DataFrame as a catalog table in a layer (database)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from holdwise.functions import ticker_bucket
from holdwise.schemas import layer_of

MODES = ("append", "fail", "replace")
#: Table property: the folder that :func:`save_table` wrote for this version of the table and may delete with it.
FOLDER = "holdwise.folder"


def _property(spark: SparkSession, qualified: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {qualified}").where(f"key = '{key}'").collect()
    return rows[0]["value"] if rows else None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(spark: SparkSession, name: str, layer: str | None = None) -> None:
    """Drop a table that :func:`save_table` wrote, then its files. A missing table is no error."""
    qualified = f"`{layer_of(name, layer)}`.`{name}`"
    if not spark.catalog.tableExists(qualified):
        return
    folder = _property(spark, qualified, FOLDER)
    spark.sql(f"DROP TABLE {qualified}")
    if folder:
        _delete(spark, folder)


def _swap(spark: SparkSession, db: str, name: str, staged: str) -> None:
    """Give ``staged`` the table's name. The old table keeps its files until the new one has the name."""
    old = f"{name}__old_{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE `{db}`.`{name}` RENAME TO `{db}`.`{old}`")
    try:
        spark.sql(f"ALTER TABLE `{db}`.`{staged}` RENAME TO `{db}`.`{name}`")
    except Exception:
        spark.sql(f"ALTER TABLE `{db}`.`{old}` RENAME TO `{db}`.`{name}`")
        raise
    drop_table(spark, old, db)


def save_table(
    df: DataFrame,
    name: str,
    layer: str | None = None,
    if_exists: str = "fail",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
) -> str:
    """K1: create the layer if absent, then write the table.

    ``if_exists``: ``fail`` (default) raises when the table exists, ``replace`` puts new rows (and columns) in its
    place, ``append`` adds rows. The files go to a new folder below ``path``, or else beside the layer's other
    tables. Returns the qualified table name.

    A write that fails changes nothing: a new version is written as a table of its own, under another name and in its
    own folder, and takes the table's name only when it is complete; the old version's files go last. So a
    replacement may also read the table it replaces. Files of tables made elsewhere with a location of their own stay.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {list(MODES)}")
    spark = df.sparkSession
    db = layer_of(name, layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    qualified = f"`{db}`.`{name}`"
    exists = spark.catalog.tableExists(qualified)
    if exists and if_exists != "replace":
        writer.mode("append" if if_exists == "append" else "errorifexists").saveAsTable(qualified)
        return f"{db}.{name}"
    base = path.rstrip("/") if path is not None else spark.catalog.getDatabase(db).locationUri.rstrip("/")
    version = uuid.uuid4().hex[:12]
    folder, staged = f"{base}/{name}-{version}", f"{name}__new_{version}"
    try:
        writer.mode("errorifexists").option("path", folder).saveAsTable(f"`{db}`.`{staged}`")
        spark.table(f"`{db}`.`{staged}`").isEmpty()  # it can be read
        spark.sql(f"ALTER TABLE `{db}`.`{staged}` SET TBLPROPERTIES ('{FOLDER}' = '{folder}')")
        if exists:
            _swap(spark, db, name, staged)
        else:
            spark.sql(f"ALTER TABLE `{db}`.`{staged}` RENAME TO {qualified}")
        spark.catalog.refreshTable(qualified)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{staged}`")
        _delete(spark, folder)
        raise
    return f"{db}.{name}"


def materialize(spark: SparkSession, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """K2: full-refresh a model's table and return a scan of what was written.

    Reading the written table back cuts the lineage, so later models start from
    stored files instead of recomputing this one.
    """
    qualified = save_table(df, name, if_exists="replace", partition_by=partition_by)
    return spark.table(qualified)


def replace_partitions(df: DataFrame, name: str, partition_by: list[str], layer: str | None = None, path: str | None = None) -> str:
    """Save ``df`` into a partitioned table, replacing only the partitions that it has rows of.

    The table is created if absent; other partitions' files are not touched. A write that fails changes nothing: new
    files are moved into their partitions when all are written.
    """
    spark = df.sparkSession
    db = layer_of(name, layer)
    qualified = f"`{db}`.`{name}`"
    if not spark.catalog.tableExists(qualified):
        return save_table(df, name, layer=layer, partition_by=partition_by, path=path)
    rows = df.select(*[f"`{c}`" for c in spark.table(qualified).columns])  # inserted by place
    mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session alone
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(qualified)
    finally:
        spark.conf.set(mode, before)
    return f"{db}.{name}"


def save_prices(prices: DataFrame, name: str, layer: str | None = None, if_exists: str = "fail", path: str | None = None) -> str:
    """Quotes stored by ``ticker_bucket``, each bucket sorted by ticker and day.

    Rows are dealt by ranges of (bucket, ticker, day), so one ticker with a large share of them fills several tasks and
    files, and a task writes into few partitions. Readers skip buckets of other tickers, and row groups of
    other days by their statistics.
    """
    rows = prices.withColumn("ticker_bucket", ticker_bucket())
    order = ["ticker_bucket", "ticker", "Date"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return save_table(rows, name, layer, if_exists, partition_by=["ticker_bucket"], path=path)
