"""Operator 5: near-duplicates by MinHash (one-permutation hashing, optimal densification, star-shaped edges).

One permutation of the hash space is cut into ``BANDS * ROWS`` bins; a text's signature is the smallest hash of each
bin, and an empty bin borrows from the first filled one in a random order that depends on the bin alone. Bands of
the signature are bucket keys. In each bucket edges run from the most central member to the others, so
candidates grow with the bucket's size, and every edge is confirmed on the full sets.

Members of a bucket that the confirmed edges leave in different components are then compared with each other in
blocks of bounded size, on the full sets too; only edges that join components leave a block. With 51 bands of 5
rows a pair at similarity 0.75 shares no bucket with a probability of about one in a million.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm.common import ByteKeys, blocks, bounded_batches, may_contain, membership_bits, mix, stored, text_buffer, words
from holdwise.llm.components import components, looked_up
from holdwise.session import unfused_stages

BANDS, ROWS = 51, 5
SHINGLE = 5
#: Links: PERCENT * union <= 100 * intersection.
PERCENT = 75
#: Sets of fewer shingles link with equal sets only: with n of n + 1 in common, 100 * n >= PERCENT * (n + 1).
LEAST = -(-PERCENT // (100 - PERCENT))
BLOCK_BYTES = 1_500_000
#: Shingles, and documents, of one side of a block.
BLOCK_SHINGLES, BLOCK_DOCS = 400_000, 512
#: Edges of a star's centre, and cells of a row, that one copy of its set serves.
EDGES_A_COPY, CELLS_A_COPY = 256, 32
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Shingles:
    """Sets of hashed word shingles of the rows of a text buffer."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.bytes = ByteKeys(lower=True)
        rng = np.random.default_rng(5)
        self.place = rng.integers(1, 2**63, size, dtype=np.uint64) | np.uint64(1)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each row; a row of fewer words has one shingle, one without words none."""
        starts, ends, counts = words(data, offsets)
        first = np.cumsum(counts) - counts
        with np.errstate(over="ignore"):
            word = mix(self.bytes.keys(data, starts, ends) + (ends - starts).astype(np.uint64))
            part = [mix(word * p + np.uint64(k)) for k, p in enumerate(self.place)]
            n = max(0, len(word) - self.size + 1)
            full = np.zeros(n, np.uint64)
            for k in range(self.size):
                full += part[k][k : k + n]
            full = mix(full + np.uint64(self.size))
            out = []
            for s, c in zip(first.tolist(), counts.tolist(), strict=True):
                if c >= self.size:
                    out.append(np.unique(full[s : s + c - self.size + 1]))
                elif c:
                    out.append(mix(np.array([sum(int(part[k][s + k]) for k in range(c)) + c & (2**64 - 1)], np.uint64)))
                else:
                    out.append(np.zeros(0, np.uint64))
        return out


class OnePermutation:
    """Signatures of shingle sets and their band keys."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(11)
        # attempt[e, j]: when bin e, empty, first tries bin j; the order is random for each bin
        tries = np.argsort(rng.random((self.bins, self.bins)), axis=1)
        self.attempt = np.empty((self.bins, self.bins), np.int16)
        np.put_along_axis(self.attempt, tries, np.broadcast_to(np.arange(self.bins, dtype=np.int16), tries.shape), axis=1)
        self.mult = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest hash of each bin (``hashes``: sorted, not empty), empty bins densified."""
        bins = ((hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
        filled = bins[first]
        out = np.empty(self.bins, np.uint64)
        out[filled] = hashes[first]
        empty = np.ones(self.bins, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        if len(empty):
            out[empty] = hashes[first[np.argmin(self.attempt[empty][:, filled], axis=1)]]
        return out

    def band_keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """One key per set and band; equal keys mean equal signature rows in the same band."""
        sig = np.array([self.signature(s) for s in sets]).reshape(len(sets), self.bands, self.rows)
        out = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), sig.shape[:2])
        with np.errstate(over="ignore"):
            for k in range(self.rows):
                out = mix(out + sig[:, :, k] * self.mult[k])
        return out.astype(np.int64)


def set_key(hashes: np.ndarray, text: bytes, size: int = SHINGLE) -> bytes | None:
    """128 bits that name a set (null: the empty one); a set of one shingle is named by its words, not by their hash."""
    if len(hashes) == 0:
        return None
    content = hashes.tobytes() if len(hashes) > 1 else b" ".join(m.group() for m in islice(WORD.finditer(text.lower()), size))
    return hashlib.blake2b(content, digest_size=16).digest()


def set_keys(sets: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    return [set_key(s, data[i:j].tobytes() if len(s) == 1 else b"") for s, i, j in zip(sets, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def list_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, node, bands) per row: set size, key of the set (null: empty) and band keys (sets of ``LEAST`` or more)."""
    schema = T.StructType([
        T.StructField("id", df.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def task(batches):
        shingles, hashing = Shingles(), OnePermutation()
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in blocks(offsets, BLOCK_BYTES):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                sets = shingles.sets(part, at)
                full = [s for s in sets if len(s) >= LEAST]
                keys = hashing.band_keys(full) if full else np.zeros((0, BANDS), np.int64)
                counts = np.array([BANDS if len(s) >= LEAST else 0 for s in sets])
                nodes = pa.array(set_keys(sets, part, at), pa.binary())
                n = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(2)[i:j], n, nodes, list_rows(keys.ravel(), counts)], schema.fieldNames())

    return bounded_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(task, schema)


def shingle_sets(df: DataFrame, id_col: str, text_col: str, bits: bytes) -> DataFrame:
    """(node, hashes) of the rows whose id may be in the filter ``bits``."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.LongType()))])

    def task(batches):
        shingles, known = Shingles(), np.frombuffer(bits, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(may_contain(known, batch.column(0).to_numpy())))
            data, offsets = text_buffer(batch.column(1))
            for i, j in blocks(offsets, BLOCK_BYTES):
                sets = [s for s in shingles.sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) if len(s) >= max(2, LEAST)]
                if sets:
                    nodes = pa.array([set_key(s, b"") for s in sets], pa.binary())
                    yield pa.RecordBatch.from_arrays([nodes, list_rows(np.concatenate(sets), np.array([len(s) for s in sets]))], schema.fieldNames())

    return bounded_batches(df).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text")).mapInArrow(task, schema)


def exploded(classes: DataFrame, bits: bytes) -> DataFrame:
    """(key, node, n) for the band keys that may be in the filter ``bits``."""

    def task(batches):
        known = np.frombuffer(bits, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), BANDS)
            keep = may_contain(known, keys)
            row = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), batch.column(0).take(row), batch.column(1).take(row)], ["key", "node", "n"])

    return classes.where(F.col("n") >= LEAST).select("node", "n", "bands").mapInArrow(task, "key long, node binary, n long")


def linked(common: Column, n: Column, m: Column) -> Column:
    return 100 * common >= PERCENT * (n + m - common)


def sizes_allow(n: Column, m: Column) -> Column:
    """The larger set bounds the union from below, the smaller one the intersection from above."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def confirmed(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``edges`` (a, b, part) whose full sets are similar enough.

    ``part`` divides the edges of an ``a`` with many of them; its set is copied once for each part.
    """
    a = edges.select("a", "part").distinct().join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a")), "a")
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = edges.join(a, ["a", "part"]).join(b, "b").select("a", "b", common.alias("common"), F.size("set_a").alias("n"), F.size("set_b").alias("m"))
    return both.where(linked(F.col("common"), F.col("n"), F.col("m"))).select("a", "b")


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs (left x right) that are linked, only as many as needed to join the labels they connect."""
    size = np.array([len(s) for s in sets])
    value, column = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(column) > 1
    number = np.cumsum(shared) - 1
    doc, column = doc[shared[column]], number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    row_of = np.full((2, len(sets)), -1)
    row_of[0, left], row_of[1, right] = np.arange(len(left)), np.arange(len(right))
    width = 2048
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, [c, c + width])
        side = []
        for k, n in ((0, len(left)), (1, len(right))):
            x = np.zeros((n, width), np.float32)
            rows = row_of[k, doc[s:e]]
            x[rows[rows >= 0], column[s:e][rows >= 0] - c] = 1
            side.append(x)
        common += side[0] @ side[1].T
    common = common.astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - common
    hit = (100 * common >= PERCENT * union) & (label[left][:, None] != label[right][None, :])
    up = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        x, y = top(int(label[left[i]])), top(int(label[right[j]]))
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((int(left[i]), int(right[j])))
    return out


def rest_links(members: DataFrame, centers: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket, from comparing the sets themselves.

    A bucket is filed under the component of its center (``home``). Its members outside that component are
    compared with all members filed there, block by block.
    """
    label = labels.withColumnRenamed("label", "comp")
    home = centers.join(label.withColumnRenamed("node", "center"), "center", "left").select("key", F.coalesce("comp", "center").alias("home"))
    at = members.join(label, "node", "left").select("key", "node", "n", F.coalesce("comp", "node").alias("comp"))
    at = stored(looked_up(at, home, "key"), "near-homes")
    open_keys = at.where("comp != home").select("key").distinct().withColumn("open", F.lit(True))
    rows = looked_up(at, open_keys, "key").where("open").select("home", "node", "n", "comp").distinct()
    rows = stored(rows.withColumn("outer", F.col("comp") != F.col("home")), "near-rest")
    weight = F.greatest("n", F.lit(BLOCK_SHINGLES // BLOCK_DOCS))

    def last(side: Column) -> Column:
        """Number of a side's last chunk (null: no rows); a hash deals its rows to the chunks, so no task orders them all."""
        return (F.ceil(F.sum(F.when(side, weight)) / BLOCK_SHINGLES) - 1).cast("long")

    count = rows.groupBy("home").agg(last(F.col("outer")).alias("o"), last(~F.col("outer")).alias("m"))
    chunk = F.pmod(F.xxhash64("node"), F.when(F.col("outer"), F.col("o")).otherwise(F.col("m")) + 1)

    def pairs(side: str, kind: str, i: str, j: str) -> Column:
        """Blocks (kind, i, j) that a row of this chunk enters, one for each chunk ``c`` of the other side."""
        return F.expr(f"transform(if({side} is null, array(), sequence(0, {side})), c -> struct('{kind}' as kind, {i} as i, {j} as j))")

    own = pairs("o", "outer", "least(c, chunk)", "greatest(c, chunk)")
    cells = F.when(F.col("outer"), F.array_union(own, pairs("m", "inner", "chunk", "c"))).otherwise(pairs("o", "inner", "c", "chunk"))
    placed = looked_up(rows, count, "home").withColumn("chunk", chunk).select("home", "node", "comp", "outer", "chunk", F.posexplode(cells).alias("at", "cell"))
    placed = placed.withColumn("part", F.floor(F.col("at") / CELLS_A_COPY)).select("home", "node", "comp", "outer", "chunk", "part", "cell.kind", "cell.i", "cell.j")
    placed = stored(placed, "near-cells")
    copies = placed.select("node", "part").distinct().join(sets, "node")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.asarray(x) for x in pdf["hashes"]]
        kind, i, j = pdf["kind"].iloc[0], pdf["i"].iloc[0], pdf["j"].iloc[0]
        outer, chunk = pdf["outer"].to_numpy(), pdf["chunk"].to_numpy()
        left = np.flatnonzero(outer & (chunk == i))
        right = np.flatnonzero(~outer if kind == "inner" else outer & (chunk == j))
        node = pdf["node"].to_numpy()
        found = block_links(hashes, left, right, pd.factorize(pdf["comp"])[0]) if len(left) and len(right) else []
        return pd.DataFrame({"a": [node[x] for x, _ in found], "b": [node[y] for _, y in found]}, dtype=object)

    return placed.join(copies, ["node", "part"]).groupBy("home", "kind", "i", "j").applyInPandas(compare, "a binary, b binary")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link texts whose sets of word 5-shingles have a Jaccard similarity of 0.75 or more.

    Returns a row per input row: ``id_col``, ``n_shingles``, ``component_id`` (the smallest id that links reach, the
    row's own included), ``kept`` (id = component_id), ``component_key`` (null: no words) and ``text_hash``. Words are runs without ASCII white space, A-Z in lower
    case. A text of 1 to 4 words has one shingle; null texts and texts without words have none, are linked with
    nothing and kept. Equal sets are one node (named by 128 bits), so copies cost no pairs. Repeated rows give repeated rows. Null ids
    never become a component_id; a row with a null id is kept only if its component has no other id. An empty
    table gives no rows. Other columns are not read and may have any name.
    """
    with unfused_stages(df.sparkSession):  # dozens of jobs, more where components take more rounds
        docs = stored(signatures(df, id_col, text_col), "near-signatures")
        classes = docs.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        classes = stored(classes, "near-classes")
        counted = classes.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        counted = stored(counted, "near-buckets")
        members = exploded(classes, membership_bits(counted, F.col("key"))).join(counted, "key")
        members = stored(members, "near-members")  # key, node, n, size
        central = members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("weight"))
        members = members.join(central, "node").drop("size")
        best = members.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("c"), F.count(F.lit(1)).alias("size"))
        centers = stored(best.select("key", F.col("c.node").alias("center"), F.col("c.n").alias("center_n"), F.ceil(F.col("size") / EDGES_A_COPY).alias("parts")), "near-centers")
        members = stored(members.drop("weight"), "near-weighed")
        star = looked_up(members, centers, "key").where(F.col("node") != F.col("center")).where(sizes_allow(F.col("n"), F.col("center_n")))
        star = star.groupBy(F.col("center").alias("a"), F.col("node").alias("b")).agg(F.max("parts").alias("parts"))
        star = stored(star.select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")), "near-star")

        wanted = members.select("node").distinct()
        ids = classes.join(wanted, "node", "left_semi").select(F.xxhash64("id").alias("h"))
        sets = shingle_sets(df, id_col, text_col, membership_bits(ids, F.col("h")))
        sets = stored(sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes")), "near-sets")

        links = stored(confirmed(star, sets), "near-links")
        labels = components(links)
        more = stored(rest_links(members, centers.select("key", "center"), labels, sets), "near-more-links")
        if not more.isEmpty():
            labels = components(links.union(more), "components-again")

    low = classes.select("node", "id").join(labels, "node")
    low = low.join(low.groupBy("label").agg(F.min("id").alias("low")), "label").select("node", "low", "label")
    named = classes.select("node", "id").join(low, "node", "left").select("node", F.coalesce("low", "id").alias("component"), F.coalesce("label", "node").alias("component_key"))
    out = looked_up(docs.select("id", "text_hash", "n", "node"), named, "node")  # copies of one text, and texts without words, are many rows of one node
    component = F.coalesce("component", "id")
    kept = F.coalesce(F.col("id") == component, component.isNull())
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), "component_key", "text_hash")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, all columns, of each component of ``near_duplicates``; rows without words all stay.

    Id and text tell rows apart. Where an id is given to several texts of a component, or no text of it has one, one
    of them stays, and of rows that repeat both one.
    """
    marked = stored(near_duplicates(df, id_col, text_col), "near-marked").withColumnRenamed(id_col, "_id")
    lost = marked.where("not kept").select("_id", "text_hash")
    stays = marked.where("kept and component_key is not null")
    firsts = stays.groupBy("component_key").agg(F.count(F.lit(1)).alias("rows"), F.min("text_hash").alias("first"))
    firsts = stored(firsts.where("rows > 1").select("component_key", "first"), "near-repeats")
    repeats = not firsts.isEmpty()
    if repeats:
        lost = lost.union(stays.join(firsts, "component_key").where("text_hash <> first").select("_id", "text_hash"))
    out = df.join(lost, df[id_col].eqNullSafe(lost["_id"]) & (F.xxhash64(df[text_col]) == lost["text_hash"]), "left_anti")
    if not repeats:
        return out
    wordy = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return out.where(wordy).dropDuplicates([id_col, text_col]).union(out.where(~wordy))
