"""Operator 12: mix sources to target weights by balanced sampling (the cube method).

A source's target over its size is how often each of its documents is taken: a whole number of times, and once more
with the fractional part as its inclusion probability. The cube method turns the probabilities into decisions. In
the flight, three undecided documents at a time move their probabilities along the one direction that leaves the
expected number of documents and of words as it is, until one of them is 0 or 1. Chunks of bounded size fly at the same
time and leave two documents each, which fly again together, until one chunk per source is left. Its last documents
land: of all ways to decide them the one nearest to both totals is taken. Some documents of many sizes are kept out of
the last flight for that, so words can be met closely.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdwise.llm.common import stored
from holdwise.operators.ordering import numbered, ranged

WORDS = r"[^\x20\x09-\x0D]+"
#: Documents that fly together.
CHUNK = 2_000
#: Documents that the landing decides together, at most (all 2**LANDING ways are tried).
LANDING = 12
EPS = 1e-9


def targets(sizes: DataFrame, weights: int, most: int) -> DataFrame:
    """``sizes`` (source, source_size, n_docs) with ``target``: shares by weight, stopped at ``most`` times the size.

    Sources in order, null last, weigh 1 to ``weights``, repeating. The excess of sources above their stop is shared by
    weight among the others until none is above; a round is one aggregation, of which a few numbers reach the driver.
    """
    rows = numbered(ranged(sizes, [F.col("source").asc_nulls_last()], name="mix-sources"), "place")
    rows = rows.select("source", "source_size", "n_docs", (F.col("place") % weights + 1).alias("weight"), F.lit(False).alias("stopped"))
    rows = stored(rows, "mix-weights")
    whole = rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    while True:
        stop = F.col("source_size") * most
        fixed = F.sum(F.when(F.col("stopped"), stop).otherwise(0)).alias("fixed")
        s = rows.agg(fixed, F.sum(F.when(~F.col("stopped"), F.col("weight"))).alias("weights")).first()
        rest, total = whole - (s["fixed"] or 0), s["weights"]
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(total)) if total else F.lit(0.0)
        now = rows.withColumn("stopped", F.col("stopped") | (share >= stop))
        if now.where("stopped").count() == rows.where("stopped").count():
            target = F.when(F.col("stopped"), stop.cast("double")).otherwise(share)
            return rows.select("source", "source_size", "n_docs", target.alias("target"))
        rows = stored(now, "mix-stopped")


def flight(size: np.ndarray, p: np.ndarray, rnd: np.random.Generator, keep: int = 0) -> np.ndarray:
    """Probabilities after moving all but two of them (and the last ``keep``) to 0 or 1.

    The sums of ``p`` and of ``p * size`` stay as they are, up to rounding.
    """
    p = p.copy()
    undecided = [int(k) for k in np.flatnonzero((p > EPS) & (p < 1 - EPS)) if k < len(p) - keep]
    undecided.reverse()
    x, q = size.tolist(), p.tolist()
    coin = rnd.random(len(undecided) + 1)
    trio: list[int] = []
    n = 0
    while True:
        while len(trio) < 3 and undecided:
            trio.append(undecided.pop())
        if len(trio) < 3:
            break
        a, b, c = trio
        step = [x[b] - x[c], x[c] - x[a], x[a] - x[b]]
        if not any(step):
            step = [1.0, -1.0, 0.0]  # equal sizes: a trade between two keeps both sums
        up = min((1 - q[k]) / u if u > 0 else q[k] / -u for k, u in zip(trio, step, strict=True) if u)
        down = min(q[k] / u if u > 0 else (1 - q[k]) / -u for k, u in zip(trio, step, strict=True) if u)
        move = up if coin[n] * (up + down) < down else -down
        n += 1
        for k, u in zip(trio, step, strict=True):
            q[k] += move * u
            if q[k] < EPS or q[k] > 1 - EPS:
                q[k] = round(q[k])
        trio = [k for k in trio if 0 < q[k] < 1]
    return np.array(q)


def ladder(size: np.ndarray, count: int) -> np.ndarray:
    """Indices of up to ``count`` entries whose sizes are near to the largest one, its half, its quarter, and so on."""
    order = np.argsort(size, kind="stable")
    picked: list[int] = []
    for step in range(count):
        at = int(np.searchsorted(size[order], size.max() / 2**step))
        free = [k for k in (at, at - 1, at + 1, at - 2, at + 2) if 0 <= k < len(order) and order[k] not in picked]
        if free:
            picked.append(order[free[0]])
    return np.array(picked, dtype=np.int64)


def landing(size: np.ndarray, p: np.ndarray, mean: float) -> np.ndarray:
    """The decisions (0 or 1) for at most ``LANDING`` + 2 documents that miss words and documents least.

    Words count in units of ``mean`` (the source's words per document), documents a tenth each; the first best counts.
    """
    n = len(p)
    ways = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    miss = np.abs(ways @ size - p @ size) / max(mean, 1.0) + 0.1 * np.abs(ways.sum(axis=1) - p.sum())
    return ways[int(np.argmin(np.round(miss, 9)))].astype(float)


def _fly(last: bool):
    """The decisions of one chunk; ``last``: of a source's only chunk, so that it lands too."""

    def chunk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "nth"], ascending=[False, True, True], kind="stable", ignore_index=True)
        p, size = rows["p"].to_numpy(float), rows["size"].to_numpy(float)
        first = rows.iloc[0]
        rnd = np.random.default_rng([len(rows), int(size.sum()), int(first["chunk"]), int(first["size"])])
        order = np.arange(len(rows))
        keep = 0
        if last:
            open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
            kept = open_[ladder(size[open_], LANDING)] if len(open_) else open_
            order, keep = np.append(np.setdiff1d(order, kept), kept), len(kept)
        q = np.empty(len(rows))
        q[order] = flight(size[order], p[order], rnd, keep)
        if last:
            open_ = np.flatnonzero((q > EPS) & (q < 1 - EPS))
            if len(open_):
                q[open_] = landing(size[open_], q[open_], float(first["mean"]))
        return rows.assign(p=q)

    return chunk


def decided(units: DataFrame) -> DataFrame:
    """``units`` with every ``p`` 0 or 1: rounds of flights over chunks of each source, then the landing."""
    columns, done, width = units.columns, [], CHUNK
    schema = units.schema
    units = stored(units, "mix-units")
    while True:
        counts = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / width).alias("chunks"))
        counts = stored(counts.withColumnRenamed("source", "_s"), "mix-chunks")
        at = units.drop("chunk").join(counts, units["source"].eqNullSafe(counts["_s"]))
        at = at.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size", "nth"), F.col("chunks")))
        ready, rest = at.where("chunks = 1").select(*columns), at.where("chunks > 1").select(*columns)
        done.append(stored(ready.groupBy("source").applyInPandas(_fly(True), schema), "mix-landed"))
        flown = stored(rest.groupBy("source", "chunk").applyInPandas(_fly(False), schema), "mix-flown")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~open_))
        units = flown.where(open_)
        if units.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: int = 3, most: int = 3) -> DataFrame:
    """How many words of each document the mix takes.

    A document's size is its number of words (a null text has none). Sources in code point order, null last, weigh 1
    to ``weights``, repeating, and share all words; a target stops at ``most`` times its source's size. Returns a row
    per input row: ``id_col``, ``source``, ``size``, ``source_size``, ``target`` (of its source) and ``taken``, a multiple of
    ``size`` up to ``most`` times. Results depend on the rows alone.

    Rows that repeat an id, a source and a size are one unit that is flown once: a whole number of them is taken, and
    one more by chance, so they cost no work and share no task. Null ids are ids like others. An empty table gives no
    rows. Other columns are not read and may have any name.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long")
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    docs = stored(docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-docs")
    sizes = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n_docs"))
    per_source = stored(targets(sizes, weights, most), "mix-targets").withColumnRenamed("source", "_s")
    docs = docs.join(per_source, docs["source"].eqNullSafe(per_source["_s"])).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ratio = F.least(ratio, F.lit(float(most)))
    docs = docs.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio))
    docs = docs.withColumn("sure", F.floor(F.col("part") * F.col("copies"))).withColumn("p", F.col("part") * F.col("copies") - F.col("sure"))
    mean = F.col("source_size") / F.col("n_docs")
    units = docs.select("doc_id", "source", "size", F.lit(0).cast("long").alias("nth"), F.lit(0).cast("long").alias("chunk"), mean.alias("mean"), "p")
    picks = decided(units).select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"), (F.col("p") > 0.5).cast("long").alias("more"))
    same = docs["doc_id"].eqNullSafe(picks["_d"]) & docs["source"].eqNullSafe(picks["_s"]) & (docs["size"] == picks["_n"])
    out = docs.join(picks, same).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    times = F.col("whole") + (F.col("copy") <= F.col("sure") + F.col("more")).cast("long")
    return out.select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))
