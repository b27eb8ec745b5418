"""Operator 8: approximate nearest neighbours by cosine (method: multiprobe p-stable hashing).

Vectors are scaled to length 1 and hashed by rounded Gaussian projections, several to a key and several tables. A query
visits its own bucket and then perturbed ones in the order of their estimated success; what all tables bring is
ranked by the exact cosine of the original vectors.

Equal vectors are one class that carries its smallest ids. Buckets are dealt to cells of bounded size, and queries
meet them there as matrices, so that no pair becomes a row; a cell returns each query's best only.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdwise.llm.common import bounded_batches, stored

#: Vectors, and queries, that meet in one cell.
CELL = 4096


@dataclass(frozen=True)
class Probing:
    """How much the search visits.

    ``tables`` tables of keys of ``hashes`` projections, rounded to multiples of ``width`` (vectors have length 1), and
    ``probes`` perturbed buckets a query and table. More hashes, or a smaller width, make smaller buckets, so a query visits
    a smaller share of the rows; more tables and probes find more of the nearest. The defaults suit vectors without
    clusters, of which a query must visit most; where vectors are clustered, longer keys find the same with a small share
    (measured by :func:`visited`).
    """

    tables: int = 5
    hashes: int = 8
    width: float = 2.0
    probes: int = 500


DEFAULT = Probing()


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part: a vector of finite numbers that are not all zero."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(v.isNotNull() & (F.size(v) > 0)).where(~bad).where(F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(id_col).alias("id"), F.transform(v, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    return rows.where("id is not null").distinct()


def classes_of(vectors: DataFrame, most: int) -> DataFrame:
    """(node, vector, ids): a row per distinct vector with its ``most`` smallest ids; node is the smallest."""
    order = Window.partitionBy("vector").orderBy("id")
    first = vectors.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)  # cut within each task first
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("node"), "vector", "ids")


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest number first, so that no square leaves the range."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class PStable:
    """Keys of the buckets of unit vectors of one dimension, and the buckets a query visits."""

    def __init__(self, dim: int, table: int, probing: Probing = DEFAULT):
        rng = np.random.default_rng([8, dim, table])
        self.hashes, self.width, self.most = probing.hashes, probing.width, probing.probes
        self.direction = rng.normal(size=(dim, self.hashes))
        self.shift = rng.random(self.hashes) * self.width
        self.mult = rng.integers(1, 2**62, self.hashes, dtype=np.int64) | 1
        self.salt = int(rng.integers(0, 2**62))

    def places(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.direction + self.shift) / self.width

    def keys(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mult).sum(axis=-1) + self.salt

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Keys of one query's buckets, the likeliest first: sets of steps to neighbours, by summed squared distance."""
        home = np.floor(place).astype(np.int64)
        down = place - home
        cost = np.concatenate([down**2, (1 - down) ** 2])
        order = np.argsort(cost, kind="stable")
        step = [(int(k) % self.hashes, -1 if k < self.hashes else 1) for k in order]
        cost = cost[order].tolist()
        out = [home]
        heap = [(cost[0], (0,))]
        while heap and len(out) <= self.most:
            total, chosen = heapq.heappop(heap)
            last = chosen[-1]
            if last + 1 < len(cost):
                heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
            if len({step[k][0] for k in chosen}) == len(chosen):  # not down and up in one direction
                cell = home.copy()
                for k in chosen:
                    cell[step[k][0]] += step[k][1]
                out.append(cell)
        return self.keys(np.array(out))


def hashed(rows: DataFrame, visits: bool, probing: Probing) -> DataFrame:
    """(node, key) per table: the key of each vector's bucket or, with ``visits``, of all buckets it visits."""

    def task(batches):
        hashing: dict[tuple[int, int], PStable] = {}
        for batch in batches:
            vectors = batch.column(1)
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            start = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                x = unit(np.stack([flat[start[k] : start[k] + dim] for k in mine]))
                node = batch.column(0).take(pa.array(mine))
                for t in range(probing.tables):
                    h = hashing.setdefault((dim, t), PStable(dim, t, probing))
                    place = h.places(x)
                    if not visits:
                        yield pa.RecordBatch.from_arrays([node, pa.array(h.keys(np.floor(place)))], ["node", "key"])
                        continue
                    keys = [h.probes(p) for p in place]
                    row = pa.array(np.repeat(np.arange(len(mine)), [len(k) for k in keys]))
                    yield pa.RecordBatch.from_arrays([node.take(row), pa.array(np.concatenate(keys))], ["node", "key"])

    kind = dict(rows.dtypes)["node"]
    return bounded_batches(rows).select("node", "vector").mapInArrow(task, f"node {kind}, key long")


def best_in_cell(queries: pd.DataFrame, rows: pd.DataFrame, most: int, by_key: bool) -> pd.DataFrame:
    """Each query's best rows (cosine, then smaller node) among those in the buckets that it visits."""
    out = {"query": [], "node": [], "score": []}
    dim = queries["vector"].map(len).to_numpy(), rows["vector"].map(len).to_numpy()
    for d in np.intersect1d(*dim).tolist():
        q, r = queries[dim[0] == d], rows[dim[1] == d].sort_values("node", kind="stable")
        # a row lies in a bucket of every table, and several of them may be in this cell: it counts once
        node, first = np.unique(r["node"].to_numpy(), return_index=True)
        x, y = np.stack(q["vector"].to_numpy()), np.stack(r["vector"].to_numpy()[first])
        close = unit(x) @ unit(y).T
        if by_key:
            code, keys = pd.factorize(r["key"])
            visits = np.zeros((len(q), len(keys)), bool)
            for i, k in enumerate(q["keys"]):
                visits[i, np.flatnonzero(np.isin(keys, np.asarray(k)))] = True
            close[~np.logical_or.reduceat(visits[:, code], first, axis=1)] = -2
        for i, (name, line) in enumerate(zip(q["node"].to_numpy(), close, strict=True)):
            few = min(most, len(line))
            floor = max(-1.5, np.partition(line, len(line) - few)[len(line) - few] - 1e-9)
            near = np.flatnonzero(line >= floor)  # with near ties; the exact measure decides
            score = cosine(x[i], y[near])
            pick = np.lexsort((node[near], -score))[:most]
            out["query"] += [name] * len(pick)
            out["node"] += node[near][pick].tolist()
            out["score"] += score[pick].tolist()
    return pd.DataFrame(out)


def cosine(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (rows * x).sum(axis=1) / (np.sqrt((x * x).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def search(queries: DataFrame, classes: DataFrame, most: int, n_rows: int, probing: Probing) -> DataFrame:
    """(query, node, score): the best classes that the probed buckets hold."""
    index = hashed(classes, False, probing)
    size = index.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    size = stored(size.select("key", F.ceil(F.col("size") / CELL).alias("parts")), "ann-buckets")
    cells = max(1, -(-n_rows * probing.tables // CELL))

    def cell(part):  # a bucket of more than CELL vectors has several parts
        return F.pmod(F.xxhash64("key", part), F.lit(cells))

    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    visits = hashed(queries, True, probing).join(size, "key").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    visits = stored(visits.groupBy(cell(F.col("part")).alias("cell"), "node").agg(F.collect_set("key").alias("keys")), "ann-visits")
    # a cell meets the queries that visit it, in blocks of about CELL
    blocks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("blocks"))
    dealt = index.join(size, "key").withColumn("cell", cell(part)).join(blocks, "cell").join(classes.select("node", "vector"), "node")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "block", "node", "vector", "key")
    visits = visits.join(blocks, "cell").join(queries.select("node", "vector"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    kind = dict(classes.dtypes)["node"]
    pair = visits.groupBy("cell", "block").cogroup(dealt.groupBy("cell", "block"))
    found = pair.applyInPandas(lambda q, r: best_in_cell(q, r, most, True), f"query {kind}, node {kind}, score double")
    return found.groupBy("query", "node").agg(F.max("score").alias("score"))


def scan(queries: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """The same by comparing the queries with all classes of their length, block by block."""
    n_queries = queries.groupBy(F.size("vector").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("blocks"))
    n_rows = classes.groupBy(F.size("vector").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"))
    plan = stored(n_queries.join(n_rows, "dim"), "ann-scan")  # a row per length

    def dealt(df: DataFrame, own: str, other: str, c: str, d: str) -> DataFrame:
        """Each row's own place by its hash, once for every place of the other side."""
        rows = df.select("node", "vector", F.size("vector").alias("dim")).join(plan, "dim")
        rows = rows.withColumn(c, F.pmod(F.xxhash64("node"), F.col(own))).withColumn(d, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        return rows.select("dim", "cell", "block", "node", "vector")

    asked, rows = dealt(queries, "blocks", "cells", "block", "cell"), dealt(classes, "cells", "blocks", "cell", "block")
    kind = dict(classes.dtypes)["node"]
    pair = asked.groupBy("dim", "cell", "block").cogroup(rows.groupBy("dim", "cell", "block"))
    return pair.applyInPandas(lambda q, r: best_in_cell(q, r, most, False), f"query {kind}, node {kind}, score double")


def ranked(found: DataFrame, classes: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """(query_id, rank, id, score): classes written out as their ids, the query's own left out."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    found = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1)
    rows = found.join(classes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    rows = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1)  # one may be the query itself
    lists = rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    mine = asked.join(lists, asked["node"] == lists["query"]).select("query_id", F.expr(f"slice(filter(near, x -> x.id <> query_id), 1, {top})").alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.score").alias("score"))


def nearest(df: DataFrame, query_filter, top: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", probing: Probing = DEFAULT) -> DataFrame:
    """The ``top`` nearest rows by cosine of every row that ``query_filter`` (a condition on ``id``) selects.

    Returns ``query_id``, ``rank`` (from 1), ``id_col`` and ``score``, nearest first, ties to the smaller id; the row
    itself is no candidate. Null, empty and zero vectors and those with null or non-finite components take no part,
    nor do null ids; vectors of different lengths are not compared. Rows that repeat an id and a vector count once.
    A query whose buckets hold fewer than ``top`` others is compared with all rows of its length. An empty table gives
    no rows. ``probing`` sets how much is visited.
    Other columns are not read and may have any name.
    """
    vectors = stored(valid_vectors(df, id_col, vector_col), "ann-vectors")
    classes = stored(classes_of(vectors, top + 1), "ann-classes")
    n_rows = classes.count()
    asked = vectors.where(query_filter).select(F.col("id").alias("query_id"), "vector")
    asked = stored(asked.join(classes.select("node", "vector"), "vector").select("query_id", "node"), "ann-asked")
    queries = classes.join(asked.select("node").distinct(), "node", "left_semi").select("node", "vector")
    found = stored(search(queries, classes, top + 1, n_rows, probing), "ann-found")
    members = classes.select("node", F.size("ids").alias("n"))
    enough = found.join(members, "node").groupBy("query").agg(F.sum("n").alias("n")).where(F.col("n") > top)
    short = stored(queries.join(enough, queries["node"] == enough["query"], "left_anti"), "ann-short")
    if not short.isEmpty():
        rest = scan(short, classes, top + 1)
        found = found.join(short, found["query"] == short["node"], "left_anti").union(rest)
    return ranked(found, classes, asked, top).withColumnRenamed("id", id_col)


def visited(df: DataFrame, query_filter, id_col: str = "vec_id", vector_col: str = "embedding", probing: Probing = DEFAULT) -> DataFrame:
    """One row for choosing ``probing``: ``queries``, ``classes``, and ``visits``, the rows of all tables that the queries'
    buckets hold (a class counts once a table). ``visits / (queries * classes)`` bounds the share of comparisons from
    above; nothing is compared. Rows as in :func:`nearest`; an empty table gives zeros and null visits.
    """
    vectors = stored(valid_vectors(df, id_col, vector_col), "ann-vectors")
    classes = stored(classes_of(vectors, 1), "ann-classes")
    asked = vectors.where(query_filter).select("vector").distinct()
    queries = classes.join(asked, "vector", "left_semi")
    size = hashed(classes, False, probing).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    asks = hashed(queries, True, probing).groupBy("key").agg(F.count(F.lit(1)).alias("asks"))
    visits = size.join(asks, "key").agg(F.sum(F.col("rows") * F.col("asks")).alias("visits"))
    n = F.count(F.lit(1))
    counts = [queries.agg(n.alias("queries")), classes.agg(n.alias("classes")), visits]
    rows = [c.select(*[F.col(x) if x in c.columns else F.lit(None).cast("long").alias(x) for x in ("queries", "classes", "visits")]) for c in counts]
    return rows[0].union(rows[1]).union(rows[2]).agg(*[F.max(x).alias(x) for x in ("queries", "classes", "visits")])
