"""S1 + K1 as an incremental file stream (see package docstring)."""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from holdwise.schemas import STATEMENT_COLUMNS
from holdwise.session import shared_dir
from holdwise.sources.files import literal, read_statements


def land_statements_incrementally(
    spark: SparkSession,
    landing_glob: str,
    table_path: str,
    checkpoint: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append every not-yet-seen statement CSV under ``landing_glob`` to a Parquet table.

    Files are stacked by column name, whatever their layouts. Each micro-batch replaces its own folder
    (``batch=N``) below ``table_path``, so a batch that is run again adds nothing twice. ``checkpoint`` defaults to a
    folder below ``spark.checkpoint.dir`` that the whole table path names.
    """
    if checkpoint is None:
        checkpoint = f"{shared_dir(spark)}/streams/{hashlib.sha256(table_path.rstrip('/').encode()).hexdigest()[:24]}"

    def land(files: DataFrame, batch: int) -> None:
        paths = [literal(unquote(r["path"])) for r in files.select("path").collect()]  # file names only
        if paths:
            rows = read_statements(spark, paths).select(*[f"`{c}`" for c in STATEMENT_COLUMNS])
            rows.write.mode("overwrite").parquet(f"{table_path}/batch={batch}")

    # of binary files only the path is asked for, so their content is not read here
    found = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(found).load(landing_glob).select("path")
    query = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query
