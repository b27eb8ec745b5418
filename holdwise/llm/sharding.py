"""Operator 6: shards of equal bytes (method: best-fit-decreasing bin packing of indivisible groups in a balanced tree)."""

from __future__ import annotations

from random import Random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm.common import stored

#: Groups smaller than a ``BIG``-th of a shard are packed in ``BUNDLES`` bundles chosen by their hash.
BIG, BUNDLES = 512, 8192
#: Cells in which rows get their slots, besides one per item.
CELLS = 16384


class Tree:
    """A balanced search tree (treap) of (remaining capacity, bin) keys."""

    def __init__(self):
        self.root, self.random = None, Random(7)

    def _split(self, node, key):
        """Subtrees of the keys below ``key`` and of the others; a node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, key) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.random.random(), None, None]), right)

    def take_first_from(self, key):
        """Remove and return the smallest key that is at least ``key``; None if there is none."""
        left, right = self._split(self.root, key)
        if right is None:
            self.root = left
            return None
        parent, node = None, right
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            right = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(left, right)
        return node[0]


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; items enter, largest first, the bin with the least room that still fits them."""
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    tree, used, out = Tree(), 0, [0] * len(sizes)
    for k in order:
        found = tree.take_first_from((sizes[k], -1))
        room, chosen = found if found else (capacity, used)
        used += found is None
        out[k] = chosen
        tree.add((room - sizes[k], chosen))
    return out


def balanced_bins(sizes: list[int], bins: int) -> list[int]:
    """Bin of each item so that at most ``bins`` bins of the least capacity that best-fit-decreasing manages are used.

    An item larger than an equal share of what is left gets a bin of its own.
    """
    out = [-1] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    left, n = sum(sizes), bins
    while order and n > 1 and sizes[order[0]] * n >= left:
        out[order[0]] = bins - n
        left -= sizes[order.pop(0)]
        n -= 1
    rest = [sizes[k] for k in order]
    if not rest:
        return out
    share = max(-(-left // n), max(rest))
    low, high, best = share, None, None
    step = max(1, share // 10_000)
    capacity = share
    while best is None or high - low > max(1, share // 20_000):
        found = best_fit_decreasing(rest, capacity)
        if max(found) < n:
            best, high = found, capacity
        else:
            low = capacity + 1
            step *= 2
        capacity = low + step if best is None else (low + high) // 2
        if best is not None and low >= high:
            break
    for k, b in zip(order, best, strict=True):
        out[k] = bins - n + b
    return out


def shards(df: DataFrame, count: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of ``count`` shards whose sizes in bytes are as equal as whole groups allow.

    A row's size is its UTF-8 length plus 1 (null text: 1). Rows of equal texts form a group and share a shard.
    Groups of at least a ``BIG``-th of a shard are items; all others are combined into ``BUNDLES`` items by the hash
    of their text, so the driver packs at most ``count * BIG + BUNDLES`` sizes whatever the input.

    Returns ``id_col``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (0, 1, ... within the shard). Null and
    empty texts are one group, null ids are kept, repeated rows get slots of their own, an empty table gives no
    rows. Other columns are not read and may have any name.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.xxhash64(text).alias("h"))
    rows = stored(rows, "shard-rows")
    groups = stored(rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total, n_rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    big = F.col("bytes") * (count * BIG) >= max(1, total)
    large = groups.where(big).select("h", "bytes", "n").collect()  # at most count * BIG rows
    small = groups.where(~big).groupBy(F.pmod("h", F.lit(BUNDLES)).alias("h")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    items = [(True, r) for r in large] + [(False, r) for r in small]
    shard = balanced_bins([r["bytes"] for _, r in items], count)
    per_cell = max(1000, -(-n_rows // CELLS))
    chosen = [(own, r["h"], k, s, -(-r["n"] // per_cell)) for k, ((own, r), s) in enumerate(zip(items, shard, strict=True))]
    schema = T.StructType([T.StructField("own", T.BooleanType()), T.StructField("key", T.LongType()), T.StructField("item", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("cells", T.LongType())])
    placed = spark.createDataFrame(chosen, schema)
    own = F.broadcast(placed.where("own").select(F.col("key").alias("h"), F.struct("item", "shard", "cells").alias("a")))
    bundle = F.broadcast(placed.where("not own").select(F.col("key").alias("b"), F.struct("item", "shard", "cells").alias("c")))
    at = rows.join(own, "h", "left").withColumn("b", F.pmod("h", F.lit(BUNDLES))).join(bundle, "b", "left")
    at = at.withColumn("place", F.coalesce("a", "c"))
    at = at.select("id", "size", "crc", "h", "place.shard", "place.item", F.pmod(F.xxhash64("id"), F.col("place.cells")).alias("cell"))
    # a slot is the number of rows in the shard's earlier cells plus the row's number in its own cell
    cells = at.groupBy("shard", "item", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("item", "cell")) - F.col("n")
    cells = stored(cells.select("item", "cell", before.alias("before")), "shard-cells")
    inside = F.row_number().over(Window.partitionBy("item", "cell").orderBy("id", "h"))
    out = at.withColumn("inside", inside).join(F.broadcast(cells), ["item", "cell"])  # at most CELLS more rows than items
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("before") + F.col("inside") - 1).alias("slot"))
