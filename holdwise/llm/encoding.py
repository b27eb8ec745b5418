"""Operator 10: BPE encoding and decoding of whole texts (method: pair occurrence index, see ``bpe``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdwise.llm.bpe import Bpe, encode_rows
from holdwise.llm.common import bounded_batches, text_buffer


def binary_rows(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of ids as one binary column: each id as four bytes, little-endian."""
    ends = np.append(0, np.cumsum(counts) * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4").tobytes())])


def id_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``binary_rows``; a null row is an empty list."""
    parts = [x or b"" for x in column.to_pylist()]
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), np.array([len(x) // 4 for x in parts], np.int64)


def encode(df: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Token ids of every text, as the tokenizer file ``vocab`` gives them without added tokens.

    Returns ``id_col``, ``n_tokens`` and ``token_ids`` (binary: ids as little-endian unsigned 32-bit integers),
    with ``decoded`` also the text that decoding these ids gives.

    Null and empty texts have no tokens (decoded: the empty text). Repeated rows are encoded each on its own, a
    null id stays null, an empty table gives an empty result. Only the two named columns are read, so other
    columns may have any name. A text far beyond a block is split where a word surely ends.
    """
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] * decoded

    def task(batches):
        def read():
            for batch in batches:
                if batch.num_rows:
                    yield (batch.column(0), *text_buffer(batch.column(1)))

        source = read()
        first = next(source, None)
        if first is None:
            return
        bpe = Bpe(vocab) if decoded else None

        def chain():
            yield first
            yield from source

        for keys, ids, counts in encode_rows(chain(), vocab):
            columns = [keys, pa.array(counts, pa.int64()), binary_rows(ids, counts)]
            if bpe:
                columns.append(pa.array([x.decode("utf-8", "replace") for x in bpe.decode(ids, counts)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return bounded_batches(df).select(id_col, text_col).mapInArrow(task, T.StructType(fields))


def decode(df: DataFrame, vocab: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Texts of binary id lists (see ``encode``), special tokens kept; returns ``id_col`` and ``decoded``.

    A null or empty list gives the empty text; bytes that are not UTF-8 become U+FFFD.
    """

    def task(batches):
        bpe = None
        for batch in batches:
            bpe = bpe or Bpe(vocab)
            texts = [x.decode("utf-8", "replace") for x in bpe.decode(*id_rows(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "decoded"])

    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("decoded", T.StringType())])
    return bounded_batches(df).select(id_col, ids_col).mapInArrow(task, schema)
