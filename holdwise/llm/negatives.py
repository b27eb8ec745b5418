"""Operator 13: hard negatives from Hilbert-ordered blocks with zone maps.

Candidates are sorted by label and along a Hilbert curve of their components and cut into blocks, written as Parquet in
that order. A block's zone map holds the smallest and largest number of every dimension. For an anchor, interval
arithmetic over a zone map bounds the inner products that the block can hold, and the block is read for the anchor
only where these bounds meet one of the anchor's windows: above the best score known for positives, and between the
two shares of a positive's score for negatives.

Anchors are taken in groups; a group meets each block that one of its anchors needs as one matrix product, several
blocks to a task, and a task keeps the best of each window only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdwise.llm.common import bounded_batches, stored
from holdwise.operators.ordering import numbered, ranged

#: Candidates of a block, blocks that meet a group in one task, and anchors of a group.
BLOCK, SPAN, GROUP = 1024, 16, 1024
#: Bits per dimension of the Hilbert curve.
BITS = 3


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of ``cells`` (whole numbers below 2**bits) along the Hilbert curve, as sortable bytes.

    Bits are taken from the highest plane to the lowest: in each, a dimension whose bit is set flips the lower bits of
    the first dimension and any other swaps its differing lower bits with it; the curve's place is the Gray decoding.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for plane in range(bits - 1, 0, -1):
        low = (1 << plane) - 1
        for d in range(dims):
            flips = (x[d] >> plane) & 1 == 1
            differing = np.where(flips, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(flips, low, differing)
            x[d] ^= differing
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turned = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> plane) & 1 == 1, (1 << plane) - 1, 0)
    x ^= turned
    planes = ((x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1).astype(np.uint8)  # plane, dimension, row
    packed = np.packbits(planes.reshape(bits * dims, -1), axis=0).T
    return [row.tobytes() for row in packed]


def matrix(lists: pd.Series) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix of doubles, in which sums of products are exact."""
    rows = np.array(lists.tolist(), dtype=np.int64)
    if rows.size and float(np.abs(rows).max()) ** 2 * rows.shape[1] >= 2**53:
        return rows.astype(object)  # beyond doubles: exact, and slower
    return rows.astype(float)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices, exact."""
    if a.dtype == object or b.dtype == object:
        return a.astype(object) @ b.T.astype(object)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return a @ b.T if largest < 2**53 else a.astype(np.int64).astype(object) @ b.T.astype(np.int64).astype(object)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest inner product (anchor x zone map) that numbers between ``low`` and ``high`` allow."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def valid_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, shift: Column, classes: int) -> DataFrame:
    """(id, label, v, dims): rows that take part, labels shifted where ``shift`` holds, components as floor(256 x)."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(label_col).isNotNull() & v.isNotNull() & F.col(id_col).isNotNull()).where(~bad)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    label = F.when(shift, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return rows.select("id", label.alias("label"), "v", F.size("v").alias("dims")).distinct()


def curve(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``, the bytes of their place along the curve through the box of all rows of their length."""
    parts = rows.select("dims", F.posexplode("v").alias("d", "x")).groupBy("dims", "d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    box = parts.groupBy("dims").agg(F.sort_array(F.collect_list(F.struct("d", "low", "high"))).alias("box"))  # as long as a row
    box = box.select(F.col("dims").alias("_dims"), F.col("box.low").alias("low"), F.col("box.high").alias("high"))
    boxed = rows.join(box, rows["dims"] == box["_dims"], "left").select("id", "label", "dims", "v", "low", "high")

    def task(batches):
        for batch in batches:
            t = batch.to_pandas()
            place: list = [b""] * len(t)
            for dims, part in t.groupby("dims"):
                if dims == 0:
                    continue
                x, low, high = (np.array(part[c].tolist(), dtype=float) for c in ("v", "low", "high"))
                cells = np.clip((x - low) / np.maximum(high - low, 1) * 2**BITS, 0, 2**BITS - 1).astype(np.int64)
                for k, key in zip(part.index, hilbert_keys(cells, BITS), strict=True):
                    place[k] = key
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "label", "dims", "v")], pa.array(place, pa.binary())], ["id", "label", "dims", "v", "place"])

    return bounded_batches(boxed).mapInArrow(task, "id long, label long, dims int, v array<long>, place binary")


def blocks_of(rows: DataFrame, block: int, span: int) -> tuple[DataFrame, DataFrame]:
    """The rows in curve order with their block and span, written; and a zone map per block.

    Spans are numbers of blocks of one label and length; a block never mixes labels.
    """
    order = [F.col("dims"), F.col("label"), F.col("place"), F.col("id")]
    rows = numbered(ranged(rows, order, name="negatives-curve"), "nth")
    at = F.floor(F.col("nth") / block)
    rows = rows.select("id", "label", "dims", "v", F.concat_ws(":", "dims", "label", at.cast("string")).alias("block"), F.concat_ws(":", "dims", "label", F.floor(at / span).cast("string")).alias("span"))
    rows = stored(rows, "negatives-blocks")
    zones = rows.select("dims", "label", "span", "block", F.posexplode_outer("v").alias("d", "x")).groupBy("dims", "label", "span", "block", "d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    bound = F.when(F.col("d").isNotNull(), F.struct("d", "low", "high"))  # none of an empty vector
    zones = zones.groupBy("dims", "label", "span", "block").agg(F.sort_array(F.collect_list(bound)).alias("z"))
    return rows, stored(zones.select("dims", "label", "span", "block", F.col("z.low").alias("low"), F.col("z.high").alias("high")), "negatives-zones")


def met(anchors: DataFrame, rows: DataFrame, zones: DataFrame, same: bool, top: int) -> DataFrame:
    """(anchor, w, id, score, rank): the ``top`` best rows of each window ``w`` of each anchor.

    ``anchors``: anchor, self (its id), label, dims, v, low and high (lists of scores: the windows), grp. ``same``: among
    rows of the anchor's label, else of others. Groups and blocks are planned from zone maps alone; rows of a block
    go on only to the groups that need it.
    """

    def plan(a: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"grp": [], "span": [], "anchor": [], "blocks": []}
        if len(a) and len(z):
            least, most = bounds(matrix(a["v"]), matrix(z["low"]), matrix(z["high"]))
            mine = (a["label"].to_numpy()[:, None] == z["label"].to_numpy()[None, :]) == same
            span, block = z["span"].to_numpy(), z["block"].to_numpy()
            for i, (lows, highs) in enumerate(zip(a["low"], a["high"], strict=True)):
                need = np.zeros(len(z), bool)
                for low, high in zip(lows, highs, strict=True):
                    need |= (most[i] >= low) & (least[i] <= high)
                for name, blocks in pd.Series(block[need & mine[i]]).groupby(span[need & mine[i]]):
                    out["grp"].append(int(a["grp"].iloc[0]))
                    out["span"].append(name)
                    out["anchor"].append(int(a["anchor"].iloc[i]))
                    out["blocks"].append(",".join(blocks))
        return pd.DataFrame(out).astype({"span": object, "blocks": object})

    # a group looks at all zone maps of its length, some thousand of them in a task
    pieces = zones.withColumn("piece", F.pmod(F.xxhash64("span"), F.lit(zones.count() // 4096 + 1)))
    looks = pieces.join(stored(anchors.select("dims", "grp").distinct(), "negatives-groups"), "dims")
    asked = anchors.join(stored(pieces.select("dims", "piece").distinct(), "negatives-pieces"), "dims")
    planned = asked.groupBy("dims", "grp", "piece").cogroup(looks.groupBy("dims", "grp", "piece"))
    planned = stored(planned.applyInPandas(plan, "grp long, span string, anchor long, blocks string"), "negatives-plan")
    wanted = stored(planned.select("grp", "span", F.explode(F.split("blocks", ",")).alias("block")).distinct(), "negatives-wanted")
    needed = wanted.join(rows.select("id", "v", "block"), "block")
    asking = planned.join(anchors.select("anchor", "self", "v", "low", "high"), "anchor")
    found = asking.groupBy("grp", "span").cogroup(needed.groupBy("grp", "span"))
    found = found.applyInPandas(lambda a, r: best_in_windows(a, r, top), "anchor long, w int, id long, score long")
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")  # `top` rows of a span
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def best_in_windows(a: pd.DataFrame, r: pd.DataFrame, top: int) -> pd.DataFrame:
    """The ``top`` best rows of the blocks that an anchor reads, for each of its windows."""
    out: dict[str, list] = {"anchor": [], "w": [], "id": [], "score": []}
    for block, part in r.groupby("block"):
        mine = a[[block in b.split(",") for b in a["blocks"]]]
        if not len(mine):
            continue
        part = part.sort_values("id", kind="stable")
        ids = part["id"].to_numpy()
        scores = product(matrix(mine["v"]), matrix(part["v"]))
        order = np.argsort(-scores, axis=1, kind="stable")
        for i, (anchor, own, lows, highs) in enumerate(zip(mine["anchor"], mine["self"], mine["low"], mine["high"], strict=True)):
            falling = -scores[i][order[i]]
            starts = np.searchsorted(falling, [-h for h in highs], "left").tolist()
            ends = np.searchsorted(falling, [-low for low in lows], "right").tolist()
            for w, (s, e) in enumerate(zip(starts, ends, strict=True)):
                picked: list[int] = []
                while s < e and len(picked) < top:
                    if ids[order[i][s]] != own:
                        picked.append(order[i][s])
                    s += 1
                out["anchor"] += [anchor] * len(picked)
                out["w"] += [w] * len(picked)
                out["id"] += ids[picked].tolist()
                out["score"] += [int(x) for x in scores[i][picked]]
    found = pd.DataFrame(out).sort_values(["anchor", "w", "score", "id"], ascending=[True, True, False, True], kind="stable")
    return found.groupby(["anchor", "w"], sort=False).head(top)  # of all blocks of the span


def hard_negatives(
    df: DataFrame,
    anchor_filter: Column,
    shift: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    classes: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    span: int = SPAN,
    group: int = GROUP,
) -> DataFrame:
    """Negatives of anchors that score between ``least`` and ``most`` percent of a positive.

    A score is the inner product of components floor(256 x); higher comes first, ties by the smaller id. An anchor
    (``anchor_filter``, a condition on ``id``) has its first ``positives`` other rows of the same label as positives,
    and for each the first ``negatives`` rows of other labels within the window. Labels move on by one, modulo
    ``classes``, where ``shift`` (a condition on ``id``) holds. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. Results are exact: a block is passed over only where its bounds exclude it.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; vectors of different
    lengths are not compared, and empty ones have score 0 with each other. Rows that repeat id, label and vector count
    once; an id with several vectors is several rows, none of them its own partner. Scores beyond 64 bits are an
    error. An empty table gives no rows. Other columns are not read and may have any name.
    """
    valid = stored(valid_rows(df, id_col, vector_col, label_col, shift, classes), "negatives-valid")
    rows, zones = blocks_of(stored(curve(valid), "negatives-places"), block, span)
    at = rows.where(anchor_filter).withColumn("anchor", F.monotonically_increasing_id())
    at = stored(at.select("anchor", F.col("id").alias("self"), "label", "dims", "v", "span"), "negatives-anchors")
    groups = max(1, -(-at.count() // group))
    at = at.withColumn("grp", F.pmod(F.xxhash64("anchor"), F.lit(groups)))

    def to_beat(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        """The score of an anchor's last positive within its own span, which its true ones reach or exceed."""
        out: dict[str, list] = {"anchor": [], "least": []}
        if len(a) and len(r):
            ids = r["id"].to_numpy()
            for anchor, own, line in zip(a["anchor"], a["self"], product(matrix(a["v"]), matrix(r["v"])), strict=True):
                line = np.sort(line[ids != own])
                if len(line) >= positives:
                    out["anchor"].append(anchor)
                    out["least"].append(int(line[-positives]))
        return pd.DataFrame(out)

    near = at.select("anchor", "self", "v", "span").groupBy("span").cogroup(rows.select("id", "v", "span").groupBy("span"))
    near = near.applyInPandas(to_beat, "anchor long, least long")
    low = F.coalesce("least", F.lit(-(2**62)))
    first = at.join(near, "anchor", "left").withColumns({"low": F.array(low), "high": F.array(F.lit(2**62))})
    good = met(stored(first.drop("least", "span"), "negatives-first"), rows, zones, True, positives)
    good = good.select("anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    good = stored(good, "negatives-positives")

    # windows in whole numbers: low >= least % of the positive's score, high <= most % of it
    rest = F.pmod("positive_score", F.lit(100))
    hundreds = F.expr("(positive_score - pmod(positive_score, 100)) div 100")  # so that no product leaves 64 bits
    window = good.select("anchor", "w", (hundreds * least + F.ceil(rest * least / 100)).alias("low"), (hundreds * most + F.floor(rest * most / 100)).alias("high"))
    windows = window.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "low", "high"))).alias("s"))  # `positives` of them
    asking = at.drop("span").join(windows.select("anchor", F.col("s.low").alias("low"), F.col("s.high").alias("high")), "anchor")
    bad = met(stored(asking, "negatives-asking"), rows, zones, False, negatives)
    bad = bad.select("anchor", (F.col("w") + 1).alias("w"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    out = bad.join(good, ["anchor", "w"]).join(at.select("anchor", F.col("self").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
