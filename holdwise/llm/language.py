"""Operator 4: language ID (method: cross-parsing entropy with suffix automata).

Of each language a bounded sample of labelled text becomes a suffix automaton. A text is parsed from left to right
into the longest phrases that occur in the sample; each costs the bits of a place in the sample. The language
with the fewest bits per character wins. All segments of a block walk all automata at once, a character a step.
"""

from __future__ import annotations

import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm.bpe import LETTER, char_class, class_table
from holdwise.llm.common import blocks, bounded_batches, held_out, text_buffer

#: The training sample per language: so many characters, of each distinct text so many (more where texts are too few).
SAMPLE_DOC_CHARS, SAMPLE_CHARS = 500, 32_000
#: Places of texts are counted in so many bins per power of two.
PLACE_BINS = 8
#: Languages that are learned: those with the most text, by the characters that their distinct texts may give the sample.
LANGUAGES = 256
#: Long texts are parsed in segments of so many symbols; their phrases add up.
SEGMENT = 512
BLOCK_BYTES = 1_500_000
UNKNOWN = "und"


def suffix_edges(symbols: list[int]) -> list[dict[int, int]]:
    """Edges (symbol to state) of each state of the suffix automaton of ``symbols``; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Transitions:
    """Targets of (state, symbol) in one table whose size follows the number of edges, whatever the alphabet.

    A state's edges lie at a place of its own plus their symbol, and this place is the state's name from here on. Places
    are drawn until the edges meet free cells only, states with the most edges first; a cell holds the name of its state, so
    other states see that it is not theirs. The first state is named 0; states without edges share the name ``none``.
    Symbols are below ``width``.
    """

    def __init__(self, edges: list[dict[int, int]], width: int):
        bits = (3 * sum(map(len, edges))).bit_length()
        self.none = (1 << bits) + width
        self.name = np.full(len(edges), self.none, np.int32)
        used, names, rnd = bytearray(self.none), set(), random.Random(5)
        for state in sorted(range(len(edges)), key=lambda k: (k > 0, -len(edges[k]))):
            row = edges[state]
            if state and not row:
                break
            place = rnd.getrandbits(bits) if state else 0
            while place in names or any(used[place + c] for c in row):
                place = rnd.getrandbits(bits)
            names.add(place)
            self.name[state] = place
            for c in row:
                used[place + c] = 1
        owner = np.repeat(self.name, [len(row) for row in edges])
        cells = owner + np.array([c for row in edges for c in row], np.int32)
        self.cells = np.full((self.none + width, 2), -1, np.int32)  # a state and its target
        self.cells[cells, 0] = owner
        self.cells[cells, 1] = self.name[np.array([to for row in edges for to in row.values()], np.int32)]
        self.both = self.cells.view(np.int64).ravel()

    def __getitem__(self, key):
        """The target of a state and a symbol, -1 where there is no edge."""
        owner, target = self.cells[sum(key)]
        return target if owner == key[0] else -1

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each row of states goes with the symbols, and where it has no such edge."""
        cell = self.both.take(state + symbol).view(np.int32)  # one access a state, as most miss the processor's cache
        return cell[:, 1::2], cell[:, ::2] != state


def automaton(symbols: list[int]) -> Transitions:
    """Transitions of the suffix automaton of ``symbols``; state 0 is the root."""
    return Transitions(suffix_edges(symbols), 1 + max(symbols, default=0))


class CrossParser:
    """Automata of all languages in one table, and the alphabet they share.

    Each letter of the samples, in lower case, is a symbol. Symbol 0 is any run of other characters; letters that no sample
    has share the last one.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = Counter(low[0] for k in self.languages for low in map(str.lower, samples[k]) if low[0].isalpha())
        self.own = {ord(c): 1 + k for k, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0])))}
        self.n_symbols = 2 + len(self.own)
        self.table = np.zeros(0x10000, np.uint16 if self.n_symbols <= 0x10000 else np.int32)
        for c in np.flatnonzero(class_table() == LETTER).tolist():
            self.table[c] = self.letter(c)
        edges, roots, self.bits = [], [], []
        for k in self.languages:
            raw = samples[k].encode()
            symbols = self.symbols(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
            base = len(edges)
            roots.append(base)
            edges += [{c: base + to for c, to in state.items()} for state in suffix_edges(symbols.tolist())]
            self.bits.append(np.log2(max(2, len(symbols))))
        self.step = Transitions(edges, self.n_symbols)
        # a phrase that starts with a symbol; no phrase is open (state ``none``) after one that the sample lacks
        self.first = np.full((len(roots), self.n_symbols), self.step.none, np.int32)
        for row, root in enumerate(roots):
            self.first[row, list(edges[root])] = self.step.name[list(edges[root].values())]

    def letter(self, code: int) -> int:
        return self.own.get(ord(chr(code).lower()[0]), self.n_symbols - 1)

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all rows, the number of symbols per row, and whether a row has a letter."""
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        rows = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
        out = self.table[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        if len(high):
            distinct, which = np.unique(codes[high], return_inverse=True)
            out[high] = np.array([self.letter(c) if char_class(c) == LETTER else 0 for c in distinct.tolist()], out.dtype)[which]
        letters = np.append(0, np.cumsum(out > 0))
        keep = np.append(True, (out[1:] > 0) | (out[:-1] > 0)) if len(out) else np.zeros(0, bool)
        keep[rows[:-1][rows[:-1] < len(out)]] = True
        before = np.append(0, np.cumsum(keep))[rows]
        return out[keep], np.diff(before), np.diff(letters[rows]) > 0

    def parse(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Bits that each row costs in each language (languages x rows)."""
        starts = np.cumsum(counts) - counts
        n_seg = -(-counts // SEGMENT)
        row = np.repeat(np.arange(len(counts)), n_seg)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
        begin = starts[row] + nth * SEGMENT
        size = np.minimum(counts[row] - nth * SEGMENT, SEGMENT)
        order = np.argsort(-size, kind="stable")
        begin, size, row = begin[order], size[order], row[order]
        state = np.full((len(self.languages), len(row)), self.step.none, np.int32)
        phrases = np.zeros(state.shape, np.int32)
        active = np.searchsorted(-size, -np.arange(SEGMENT), "left")  # segments longer than t
        for t in range(int(size[0]) if len(size) else 0):
            n = int(active[t])
            symbol = symbols[begin[:n] + t]
            to, miss = self.step.follow(state[:, :n], symbol)
            state[:, :n] = np.where(miss, self.first.take(symbol, axis=1), to)  # a new phrase begins with this symbol
            phrases[:, :n] += miss
        total = np.stack([np.bincount(row, p, len(counts)) for p in phrases])
        return total * np.array(self.bits)[:, None]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        symbols, counts, letters = self.symbols(data, offsets)
        bits = self.parse(symbols, counts)
        per = bits / np.sqrt(np.maximum(counts, 1))  # longer texts are surer, but not without limit
        best = bits.argmin(axis=0)
        share = np.exp(-(per - per.min(axis=0)))
        score = np.where(letters, 1 / share.sum(axis=0), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)], score


@lru_cache(maxsize=1)
def parser_of(learned: tuple[tuple[str, str], ...]) -> CrossParser:
    """The parser of (language, sample) pairs, built once in a worker that runs several tasks."""
    return CrossParser(dict(learned))


def samples(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, str]:
    """``SAMPLE_CHARS`` characters of text per language, or all it has, from rows that are not held out.

    Only the ``LANGUAGES`` languages with the most text are learned, so that what the driver holds is bounded.
    Equal texts count once. They are taken by a hash of the text until their characters suffice, each as a slice at
    a hashed offset; where a language has too few texts for that, the slices grow.
    """
    known = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where("id is not null and lang is not null and text is not null").where(~held_out(F.col("id"), 5, 0)).where(F.col("text").rlike(r"\p{L}"))
    place = (F.pmod(F.xxhash64("text"), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))
    known = known.select("lang", F.xxhash64("text").alias("hash"), F.floor(-F.log2(place) * PLACE_BINS).alias("bin"), F.length("text").alias("size"), "text")
    texts = known.groupBy("lang", "hash", "bin").agg(F.max("size").alias("size"))
    counted = texts.groupBy("lang", "bin").agg(F.sum(F.least("size", F.lit(SAMPLE_DOC_CHARS))).alias("chars"))
    most = counted.groupBy("lang").agg(F.sum("chars").alias("all")).orderBy(F.desc("all"), "lang").limit(LANGUAGES).select("lang")
    counted = counted.join(F.broadcast(most), "lang").collect()  # at most 40 * PLACE_BINS rows a language
    limits, chars = {}, Counter()
    for r in sorted(counted, key=lambda r: (r["lang"], -r["bin"])):
        if chars[r["lang"]] < SAMPLE_CHARS:
            chars[r["lang"]] += r["chars"]
            limits[r["lang"]] = r["bin"]
    if not limits:
        return {}
    # where short slices do not suffice there are few texts, so longer slices of all of them stay bounded
    limit = [(k, int(limits[k]), SAMPLE_DOC_CHARS if chars[k] >= SAMPLE_CHARS else SAMPLE_CHARS) for k in limits]
    limit = df.sparkSession.createDataFrame(limit, "lang string, least long, slice int")  # a row per language
    chosen = known.join(F.broadcast(limit), "lang").where("bin >= least")
    offset = F.pmod(F.xxhash64("hash"), F.greatest(F.col("size") - F.col("slice"), F.lit(0)) + 1).cast("int") + 1
    chosen = chosen.select("lang", "hash", "bin", F.col("text").substr(offset, F.col("slice")).alias("text"))
    groups: dict[str, list[str]] = {}
    for r in sorted(chosen.dropDuplicates(["lang", "hash"]).collect(), key=lambda r: (r["lang"], -r["bin"], r["hash"])):
        groups.setdefault(r["lang"], []).append(r["text"])
    out = {}
    for lang, slices in groups.items():
        size = SAMPLE_DOC_CHARS
        while size < SAMPLE_CHARS and sum(min(len(t), size) for t in slices) < SAMPLE_CHARS:
            size *= 2
        out[lang] = " ".join(t[:size] for t in slices)[:SAMPLE_CHARS]
    return {k: v for k, v in out.items() if any(c.isalpha() for c in v)}


def languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict the language of every whole text: ``id_col``, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    Learned from a bounded sample of rows with a language that are not held out (crc32 of the id modulo 5 is not 0).
    Null texts and texts without a letter are ``und`` with score 0, and so is everything if nothing can be
    learned. Null ids are kept, repeated rows predicted each, an empty table gives no rows. Other columns are not
    read and may have any name.
    """
    learned = tuple(sorted(samples(df, id_col, text_col, lang_col).items()))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def task(batches):
        parser = parser_of(learned) if learned else None
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for i, j in blocks(offsets, BLOCK_BYTES) if parser else ():
                names[i:j], score[i:j] = parser.predict(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], schema.fieldNames())

    found = bounded_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(task, schema)
    return found.select(F.col("id").alias(id_col), held_out(F.col("id"), 5, 0).alias("held_out"), "lang_pred", "score")
