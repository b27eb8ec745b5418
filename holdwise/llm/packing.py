"""Operator 1: packing of token sequences (method: sum-of-squares online packing over a level array)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdwise.llm.bpe import encode_rows
from holdwise.llm.common import bounded_batches, text_buffer
from holdwise.llm.encoding import binary_rows

#: Partially filled windows that a task keeps before it cuts them into full ones.
OPEN_WINDOWS = 2048
#: Pieces per output batch.
OUT_ROWS = 2000


class SumOfSquares:
    """Online packing of items into windows of ``size`` tokens.

    ``level[h]`` counts the open windows that hold h tokens. An item of s tokens goes to the fill level h (0: a
    new window) for which the sum of the squared counts grows least; ties go to the fullest window. When
    ``most_open`` windows are open, and at the end, the emptiest ones are cut up to fill the gaps of the others.
    """

    def __init__(self, size: int, first_sequence: int, most_open: int = OPEN_WINDOWS):
        self.size, self.most_open = size, most_open
        self.level = np.zeros(size + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(size + 1)]  # per level: lists of pieces
        self.n_open = 0
        self.sequence = first_sequence
        self.done: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        """Place a document: whole windows at once, the rest by level."""
        total, at = len(ids), 0
        while total - at >= self.size:
            self.close([(doc, at, ids[at : at + self.size], total)])
            at += self.size
        if at < total:
            self.place((doc, at, ids[at:], total))

    def place(self, piece: tuple) -> None:
        s, n = len(piece[2]), self.level
        # growth of the sum of squares if the item enters a window of level h: from h to h + s
        cost = 2 * n[s : self.size + 1] - 2 * n[: self.size + 1 - s] + 2
        cost[-1] = 1 - 2 * n[self.size - s]  # the window becomes full and leaves the count
        cost[n[: self.size + 1 - s] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * n[s] + 1
        h = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self.windows[h].pop() if h else []
        if h:
            n[h] -= 1
            self.n_open -= 1
        window.append(piece)
        if h + s == self.size:
            self.close(window)
        else:
            n[h + s] += 1
            self.windows[h + s].append(window)
            self.n_open += 1
            if self.n_open >= self.most_open:
                self.consolidate()

    def close(self, window: list) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.done.append((doc, start, ids, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def consolidate(self) -> None:
        """Fill the fullest open windows with pieces cut from the emptiest; one window at most stays open."""
        rest = [w for group in reversed(self.windows) for w in group]
        self.level[:] = 0
        self.windows = [[] for _ in self.windows]
        self.n_open = 0
        full, empty = 0, len(rest) - 1
        held = [sum(len(p[2]) for p in w) for w in rest]
        while full < empty:
            gap = self.size - held[full]
            doc, start, ids, total = rest[empty].pop()
            take = min(gap, len(ids))
            if take < len(ids):
                rest[empty].append((doc, start, ids[: len(ids) - take], total))
            rest[full].append((doc, start + len(ids) - take, ids[len(ids) - take :], total))
            held[full] += take
            held[empty] -= take
            if held[full] == self.size:
                self.close(rest[full])
                full += 1
            if held[empty] == 0:
                empty -= 1
        if full == empty and held[full] == self.size:
            self.close(rest[full])
        elif full == empty and held[full]:
            self.level[held[full]] = 1
            self.windows[held[full]].append(rest[full])
            self.n_open = 1

    def finish(self) -> None:
        """Close everything: the last window is cut into sequences whose lengths are powers of two."""
        self.consolidate()
        for group in self.windows:
            for window in group:
                left = sum(len(p[2]) for p in window)
                while left:
                    want = 1 << (left.bit_length() - 1)
                    left -= want
                    part = []
                    while want:
                        doc, start, ids, total = window.pop(0)
                        take = min(want, len(ids))
                        part.append((doc, start, ids[:take], total))
                        if take < len(ids):
                            window.insert(0, (doc, start + take, ids[take:], total))
                        want -= take
                    self.close(part)


def pack(df: DataFrame, vocab: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", most_open: int = OPEN_WINDOWS) -> DataFrame:
    """Encode every text, append ``end_id`` and pack the documents into sequences of at most ``size`` tokens.

    Returns one row per piece: ``id_col``, ``start`` (tokens of the document before the piece), ``length``,
    ``token_ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens`` (with the end id), ``sequence_id`` (unique
    over all tasks) and ``offset`` (of the piece in its sequence, without gaps). All sequences are full but a few
    per task whose lengths are powers of two, so nothing is padded.

    Each task packs its own partition; nothing is shuffled, and a task that is run again gives the same rows. Null and
    empty texts are documents of the end id alone. Repeated rows are documents of their own, a null id stays
    null, an empty table gives no rows. Other columns are not read and may have any name.
    """
    doc_type = df.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, doc_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("token_ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def task(batches):
        packer = SumOfSquares(size, TaskContext.get().partitionId() << 33, most_open)

        def out(rows, kind):
            lengths = np.array([len(r[2]) for r in rows], np.int64)
            long = [pa.array(x, pa.int64()) for x in ([r[1] for r in rows], lengths, [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows])]
            ids = np.concatenate([r[2] for r in rows])
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), long[0], long[1], binary_rows(ids, lengths), *long[2:]], schema.fieldNames())

        def read():
            for batch in batches:
                if batch.num_rows:
                    yield (batch.column(0), *text_buffer(batch.column(1)))

        source = read()
        first = next(source, None)
        if first is None:
            return
        kind = first[0].type

        def chain():
            yield first
            yield from source

        for keys, ids, counts in encode_rows(chain(), vocab):
            ids = ids.astype(np.uint32)
            end = np.array([end_id], np.uint32)
            at = 0
            for doc, n in zip(keys.to_pylist(), counts.tolist(), strict=True):
                packer.add(doc, np.append(ids[at : at + n], end))
                at += n
                if len(packer.done) >= OUT_ROWS:
                    yield out(packer.done, kind)
                    packer.done = []
        packer.finish()
        for k in range(0, len(packer.done), OUT_ROWS):
            yield out(packer.done[k : k + OUT_ROWS], kind)

    return bounded_batches(df).select(id_col, text_col).mapInArrow(task, schema)
