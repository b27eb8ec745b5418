"""Connected components by hooking and contraction; every step is a join or an aggregation on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdwise.llm.common import stored


#: Tasks over which the rows that look up one key are spread.
PARTS = 64


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row a key, where one key may have a large share of ``rows``.

    Rows of a key are divided by their hash; each part in use gets its own copy of the key's row first.
    """
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(PARTS))
    rows = rows.withColumn("_part", part)
    copies = rows.select(key, "_part").distinct().join(table, key)
    return rows.join(copies, [key, "_part"], "left").drop("_part")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node of its component.

    Each round every node is hooked to the smallest of itself and its neighbours, hooks are followed once, and the
    edges are drawn again between the hooks. Edges shrink to none; star-shaped ones in two or three rounds.
    """
    edges = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = ends.select("node", F.col("node").alias("label"))
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        hook = both.groupBy("node").agg(F.least("node", F.min("near")).alias("up"))
        hook = stored(hook, f"{name}-nearest")
        above = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hook = stored(looked_up(hook, above, "up").select("node", F.coalesce("top", "up").alias("up")), f"{name}-hooks")
        labels = stored(looked_up(labels, hook.withColumnRenamed("node", "label"), "label").select("node", F.coalesce("up", "label").alias("label")), f"{name}-labels")
        a, b = hook.select(F.col("node").alias("a"), F.col("up").alias("x")), hook.select(F.col("node").alias("b"), F.col("up").alias("y"))
        drawn = looked_up(looked_up(edges, a, "a"), b, "b").where("x != y")
        edges = stored(drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-edges")
    return labels
