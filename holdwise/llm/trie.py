"""Operator 11: prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of the first d turns; it is named by its smallest member and d. Nodes come from the
cumulative digests of every conversation, which are sums over its turns, so a conversation of any length is scanned
over as many partitions as its turns need (:mod:`holdwise.operators.ordering`).

Subtree totals go up from the leaves. Nodes are sorted by reverse level order (an external sort), and each adds what
its children left for it in a priority queue to its own value and leaves the sum for its parent; the queue spills
sorted runs. First this is done within shards: a shard is a subtree of bounded weight (turns below its top), so many
run at once, several to a task. What is above the shards' roots is done next. There, stretches of nodes with one child
and no end are folded away by a window over pieces of bounded length, and the joints that stay take one pass over the
totals of the shards' roots: per level at most (all turns / SHARD_TURNS) nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdwise.llm.common import bounded_batches, stored
from holdwise.operators.ordering import along, carried, ranged, sum_before

#: Turns below the top of a shard, at most.
SHARD_TURNS = 200_000
#: Levels of a piece of a stretch without branches.
PIECE = 1 << 16
#: Messages that a priority queue holds in memory.
IN_MEMORY = 500_000
#: Conversation ids of one part of a node's list of ends.
ENDS = 4096
WORDS = r"[^\x20\x09-\x0D]+"


def _limbs(at: Column, digest: Column) -> dict[str, Column]:
    """Five 32-bit numbers of the SHA-1 of a place and a turn's digest: sums of them name a sequence of turns."""
    mixed = F.sha1(F.concat_ws(":", at.cast("string"), digest))
    return {f"l{k}": F.conv(F.substring(mixed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(5)}


def placed_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, i, digest, words, _pid, _at): every turn with its place in its conversation, from 1."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.substring(by, 1, 64).alias("role"),
        F.substring(said, 1, 64).alias("text"),  # orders ties; the digest tells the rest apart
        F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256).alias("digest"),
        F.regexp_count(said, F.lit(WORDS)).cast("long").alias("words"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("digest")]
    rows = ranged(rows, order, name="trie-turns").drop("turn", "role", "text")
    groups = rows.groupBy("_pid", "conv").agg(F.count(F.lit(1)).alias("n"))
    rows = carried(rows, groups, "conv", {"_before": sum_before("n")})
    inside = Window.partitionBy("_pid", "conv").orderBy("_at")
    return rows.withColumn("i", F.coalesce("_before", F.lit(0)) + F.row_number().over(inside)).drop("_before")


def rebuilt(turns: DataFrame, period: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv, len), also those without turns, and (conv, depth, key, above, words).

    ``key`` names the first ``depth`` turns, ``above`` those without the last one.
    """
    convs = turns.groupBy("conv").agg(F.max("i").alias("own"))
    head = F.crc32(F.col("conv").cast("string")) % heads
    convs = convs.select("conv", "own", head.alias("h"), (F.col("conv") - F.col("conv") % period).alias("base"))
    lead = turns.where((F.col("i") < heads) & (F.col("conv") % period == 0)).select(F.col("conv").alias("base"), "i", "digest", "words")
    # at most 2 * period - 1 conversations have the same base
    taken = convs.select("conv", "h", "base").join(lead, "base").where("i <= h")
    taken = taken.select("conv", F.col("i").alias("depth"), "words", *[c.alias(n) for n, c in _limbs(F.col("i"), F.col("digest")).items()])
    sums = {f"l{k}": F.sum(f"l{k}") for k in range(5)}
    first = taken.groupBy("conv").agg(F.count(F.lit(1)).alias("got"), *[c.alias(f"s{n}") for n, c in sums.items()])
    convs = convs.join(first, "conv", "left").na.fill(0)
    convs = stored(convs.withColumn("len", F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.col("got")), "trie-convs")

    own = turns.join(convs.select("conv", "h", "got", *[f"sl{k}" for k in range(5)]), "conv").where("i > h")
    own = own.withColumn("depth", F.col("i") - F.col("h") + F.col("got"))
    own = stored(own.withColumns(_limbs(F.col("depth"), F.col("digest"))).drop("digest", "i", "h", "got"), "trie-own")
    groups = own.groupBy("_pid", "conv").agg(*[c.alias(n) for n, c in sums.items()])
    own = carried(own, groups, "conv", {f"_b{k}": sum_before(f"l{k}") for k in range(5)})
    start = [F.col(f"sl{k}") + F.coalesce(f"_b{k}", F.lit(0)) for k in range(5)]
    upto = {f"u{k}": F.sum(f"l{k}").over(along("conv")) + start[k] for k in range(5)}
    own = own.withColumns(upto).select("conv", "depth", "words", *[f"u{k}" for k in range(5)], *[(F.col(f"u{k}") - F.col(f"l{k}")).alias(f"v{k}") for k in range(5)])
    few = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # below `heads` rows
    taken = taken.withColumns({f"u{k}": F.sum(f"l{k}").over(few) for k in range(5)})
    taken = taken.select("conv", "depth", "words", *[f"u{k}" for k in range(5)], *[(F.col(f"u{k}") - F.col(f"l{k}")).alias(f"v{k}") for k in range(5)])

    def name(kind: str, depth: Column) -> Column:
        return F.concat_ws(":", depth.cast("string"), *[F.col(f"{kind}{k}").cast("string") for k in range(5)])

    rows = own.union(taken).select("conv", "depth", name("u", F.col("depth")).alias("key"), name("v", F.col("depth") - 1).alias("above"), "words")
    return convs.select("conv", "len"), rows


def hashed_ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256, n_ends): SHA-256 of the ascending ids, comma-joined, of the conversations that end at a node.

    Ids go to parts by their range, at most ``ENDS`` each; a node of one part is hashed in the JVM, one of more by
    streaming its parts in order through one hash, whatever their number.
    """
    parts = rows.groupBy("key", F.floor(F.col("conv") / ENDS).alias("part")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    parts = stored(parts.select("key", "part", F.size("ids").cast("long").alias("n"), F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("ids")), "trie-ends")
    counts = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n_ends"), F.first("ids").alias("ids"))
    one = counts.where("parts = 1").select("key", F.sha2("ids", 256).alias("ends_sha256"), "n_ends")
    more = counts.where("parts > 1").select("key", "n_ends")

    def stream(batches):
        at = digest = None
        n = 0
        for batch in batches:
            out: dict[str, list] = {"key": [], "ends_sha256": [], "n_ends": []}
            for key, ids, total in zip(*[batch.column(c).to_pylist() for c in ("key", "ids", "n_ends")], strict=True):
                if key != at:
                    if at is not None:
                        out["key"].append(at), out["ends_sha256"].append(digest.hexdigest()), out["n_ends"].append(n)
                    at, digest, n = key, hashlib.sha256(ids.encode()), total
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict(out, schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_pydict({"key": [at], "ends_sha256": [digest.hexdigest()], "n_ends": [n]}, schema=schema)

    schema = pa.schema([("key", pa.string()), ("ends_sha256", pa.string()), ("n_ends", pa.int64())])
    long = bounded_batches(parts.join(more, "key").repartition("key").sortWithinPartitions("key", "part").select("key", "ids", "n_ends"))
    return one.union(long.mapInArrow(stream, "key string, ends_sha256 string, n_ends long"))


def trie_nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per node: its names, members, children, ends, own ``saved`` tokens and weight (turns of members below)."""
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("len").alias("below")).where("n_convs > 0")
    root = root.select(F.lit("root").alias("key"), F.lit(None).cast("string").alias("above"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), "below")
    at = rows.join(convs, "conv")
    nodes = at.groupBy("key").agg(
        F.first("above").alias("above"),
        F.first("depth").alias("depth"),
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("words").alias("words"),
        F.sum(F.col("len") - F.col("depth")).alias("below"),
    )
    above = F.when(F.col("depth") == 1, F.lit("root")).otherwise(F.col("above"))
    nodes = stored(nodes.withColumn("above", above).unionByName(root), "trie-nodes")
    children = nodes.groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("n_children")).where("key is not null")
    ends = at.where("depth = len").select("key", "conv").union(convs.where("len = 0").select(F.lit("root"), "conv"))
    parents = nodes.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.col("below").alias("above_below"))
    out = nodes.join(children, "key", "left").join(hashed_ends(ends), "key", "left")
    out = stored(out, "trie-counted").join(parents, "above", "left")
    none = hashlib.sha256(b"").hexdigest()
    saved = (F.col("n_convs") - 1) * F.col("words")
    return out.na.fill({"n_children": 0, "n_ends": 0, "ends_sha256": none}).select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_ends", "ends_sha256", "below", "above_below", saved.alias("saved")
    )


class SpillingQueue:
    """A priority queue of messages (place, leaves, saved) that keeps ``IN_MEMORY`` of them and spills sorted runs.

    A run is an unnamed file of the task, gone with it, read back as a stream: like Spark's own spills it is never
    needed by another task, and a task that is run again writes its own.
    """

    def __init__(self, in_memory: int):
        self.in_memory, self.heap, self.runs = in_memory, [], []

    def push(self, place: tuple, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (place, leaves, saved))
        if len(self.heap) > self.in_memory:
            run = tempfile.TemporaryFile()
            for message in sorted(self.heap):
                pickle.dump(message, run)
            run.seek(0)
            self.heap = []
            self._next(run)

    def _next(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def taken(self, place: tuple) -> tuple[int, int]:
        """The sums of all messages for ``place``, which no later node sends to."""
        leaves = saved = 0
        while self.heap and self.heap[0][0] == place:
            _, a, b = heapq.heappop(self.heap)
            leaves, saved = leaves + a, saved + b
        while self.runs and self.runs[0][0][0] == place:
            (_, a, b), _, run = heapq.heappop(self.runs)
            leaves, saved = leaves + a, saved + b
            self._next(run)
        return leaves, saved


def time_forward(rows: DataFrame, in_memory: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of nodes that lie in reverse level order within each partition.

    ``rows``: conv_id, depth, up_conv, up_depth (where the total goes; null: nowhere here), up_saved (added on the
    way), leaves and saved (the node's own).
    """

    def task(batches):
        queue = SpillingQueue(in_memory)
        for batch in batches:
            conv, depth, up_conv, up_depth, up_saved, leaves, saved = [batch.column(c).to_pylist() for c in NODE]
            for k in range(batch.num_rows):
                a, b = queue.taken((-depth[k], conv[k]))
                leaves[k] += a
                saved[k] += b
                if up_conv[k] is not None:
                    queue.push((-up_depth[k], up_conv[k]), leaves[k], saved[k] + up_saved[k])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], ["conv_id", "depth", "n_leaves", "saved_tokens"])

    return bounded_batches(rows).select(*NODE).mapInArrow(task, "conv_id long, depth long, n_leaves long, saved_tokens long")


NODE = ["conv_id", "depth", "up_conv", "up_depth", "up_saved", "leaves", "saved"]


def subtree_totals(nodes: DataFrame, convs: DataFrame, rows: DataFrame, shard_turns: int, piece: int, in_memory: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of every node."""
    zero, level = F.lit(0).cast("long"), [F.col("depth").desc(), F.col("conv_id")]
    own = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("heavy", F.col("below") > shard_turns)
    top = F.coalesce(F.col("above_below") > shard_turns, F.lit(True))  # of a shard, where the node is light
    # a conversation's path enters one shard, at its first light node; a node lies on its smallest member's path
    light = own.where("not heavy")
    tops = light.where(top).select("key", F.col("conv_id").alias("top_conv"), F.col("depth").alias("top_depth"))
    whole = F.broadcast(tops.where("key = 'root'"))  # one row, or none
    entered = [x.select(F.col("conv").alias("conv_id"), "top_conv", "top_depth") for x in (rows.join(tops, "key"), convs.withColumn("key", F.lit("root")).join(whole, "key"))]
    shard = entered[0].union(entered[1])
    up = {"up_conv": F.when(~top, F.col("parent_conv_id")), "up_depth": F.when(~top, F.col("depth") - 1), "up_saved": zero}
    light = light.withColumns(up)
    low = time_forward(light.join(shard, "conv_id").repartition("top_conv", "top_depth").sortWithinPartitions(*level), in_memory)
    low = stored(low, "trie-low")

    heavy = own.where("heavy")
    roots = low.join(light.where(top).select("conv_id", "depth", "parent_conv_id"), ["conv_id", "depth"]).where("parent_conv_id is not null")
    roots = roots.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.sum("n_leaves").alias("got_leaves"), F.sum("saved_tokens").alias("got_saved"))
    heavy = heavy.join(roots, ["conv_id", "depth"], "left")
    last = F.col("depth") % piece == piece - 1
    joint = (F.col("n_children") != 1) | (F.col("n_ends") > 0) | F.col("got_leaves").isNotNull() | (F.col("depth") == 0) | last
    heavy = stored(heavy.withColumn("joint", joint).na.fill({"got_leaves": 0, "got_saved": 0}), "trie-heavy")
    # a stretch: a joint and the single children's line above it; a piece holds at most `piece` levels of one path
    path = Window.partitionBy("conv_id", F.floor(F.col("depth") / piece)).orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = heavy.withColumns({"foot": F.last(F.when(F.col("joint"), F.col("depth")), ignorenulls=True).over(path), "sum": F.sum("saved").over(path)})
    lines = lines.withColumn("foot_sum", F.last(F.when(F.col("joint"), F.col("sum")), ignorenulls=True).over(path))
    lines = stored(lines.withColumn("passed", F.col("sum") - F.col("foot_sum")), "trie-lines")
    heads = lines.groupBy("conv_id", "foot").agg(F.min_by(F.struct("parent_conv_id", "depth", "passed"), "depth").alias("head"))
    heads = heads.select("conv_id", F.col("foot").alias("depth"), F.col("head.parent_conv_id").alias("up_conv"), (F.col("head.depth") - 1).alias("up_depth"), F.col("head.passed").alias("up_saved"))
    joints = lines.where("joint").select("conv_id", "depth", (F.col("leaves") + F.col("got_leaves")).alias("leaves"), (F.col("saved") + F.col("got_saved")).alias("saved"))
    joints = joints.join(heads, ["conv_id", "depth"])
    above = stored(time_forward(joints.repartition(1).sortWithinPartitions(*level), in_memory), "trie-high")
    feet = above.withColumnRenamed("depth", "foot")
    high = lines.join(feet, ["conv_id", "foot"]).select("conv_id", "depth", "n_leaves", (F.col("saved_tokens") + F.col("passed")).alias("saved_tokens"))
    return low.union(high)


def prefix_trie(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    period: int = 20,
    heads: int = 4,
    shard_turns: int = SHARD_TURNS,
    piece: int = PIECE,
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node.

    Every conversation c is rebuilt from the first h turns of conversation c - c % ``period`` (h: crc32 of c's decimal
    text, modulo ``heads``) and its own turns after its first h. Returns ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by ``turn``, null first; equal ones by role and text (their first 64 characters, then a digest).
    A null role or text is empty. Rows that repeat are turns of their own. Rows with a null conversation take no part;
    an empty table has no nodes. Ids may be negative (% has the sign of c). Other columns are not read and may have
    any name.
    """
    turns = placed_turns(df, conv, turn, role, text)
    convs, rows = rebuilt(turns, period, heads)
    rows = stored(rows, "trie-rows")
    nodes = stored(trie_nodes(convs, rows), "trie-named")
    totals = subtree_totals(nodes, convs, rows, shard_turns, piece, in_memory)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.join(totals, ["conv_id", "depth"]).select(*columns)
