"""Helpers that the operators share: table access, text buffers inside tasks, written intermediate tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdwise.session import scratch_path

#: Rows and bytes per Arrow batch, whichever is reached first.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """Limit what a Python worker holds at once: ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` per Arrow batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later jobs start from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """True where crc32 of the decimal text of ``doc_id`` leaves ``rest`` modulo ``mod``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == rest, F.lit(False))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int):
    """Row ranges [i, j) whose bytes stay below ``limit`` (a longer row is a block of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length) pair, one after another."""
    total = int(lengths.sum())
    kind = np.int32 if total < 2**31 and (len(starts) == 0 or int(starts.max()) < 2**31 - total) else np.int64
    begin = (starts - (np.cumsum(lengths) - lengths)).astype(kind)
    return np.repeat(begin, lengths) + np.arange(total, dtype=kind)


class ByteKeys:
    """64-bit keys of byte slices: a polynomial of the bytes that does not depend on the place of the slice."""

    STEP = 0x9E3779B97F4A7C15

    def __init__(self, lower: bool = False):
        """``lower``: A-Z count as a-z."""
        rng = np.random.default_rng(17)
        self.mult = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        if lower:
            self.mult[ord("A") : ord("Z") + 1] = self.mult[ord("a") : ord("z") + 1]
        self.power = self.inverse = np.ones(1, np.uint64)

    def keys(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        step, back = np.uint64(self.STEP), np.uint64(pow(self.STEP, -1, 2**64))
        n = len(data) + 1
        with np.errstate(over="ignore"):
            if len(self.power) < n:
                self.power = np.cumprod(np.full(n, step, np.uint64)) * back
                self.inverse = np.cumprod(np.full(n, back, np.uint64)) * step
            total = np.zeros(n, np.uint64)
            np.multiply(self.mult[data], self.power[: n - 1], out=total[1:])
            np.cumsum(total, out=total)
            return (total[ends] - total[starts]) * self.inverse[starts]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x7FB5D329728EA185)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, and the number of them per row."""
    n = len(data)
    solid = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    first = np.append(True, ~solid[:-1]) if n else np.zeros(0, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(solid & first)
    last = np.append(~solid[1:], True) if n else np.zeros(0, bool)
    cuts = offsets[1:-1]
    last[cuts[(cuts > 0) & (cuts <= n)] - 1] = True
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


#: Size of a membership filter: 2**24 bits, 2 MB, whatever the data.
FILTER_BITS = 1 << 24


def membership_bits(df: DataFrame, hashed: Column) -> bytes:
    """A filter of fixed size that has the bit of every ``hashed`` value set (values not in ``df`` may pass too)."""
    place = F.pmod(hashed, F.lit(FILTER_BITS)) + 1  # bitmaps count from 1
    rows = (
        df.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
        .groupBy("b")
        .agg(F.bitmap_construct_agg("p").alias("bits"))
        .collect()  # at most FILTER_BITS / 32768 rows of 4 KB
    )
    out = bytearray(FILTER_BITS // 8)
    for r in rows:
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = r["bits"]
    return bytes(out)


def may_contain(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Test int64 hashes against ``np.frombuffer(membership_bits, np.uint8)``."""
    place = hashed & (FILTER_BITS - 1)
    return (bits[place >> 3] >> (place & 7)) & 1 == 1
