"""Hashed words of text buffers, shared by the classifiers."""

from __future__ import annotations

import numpy as np

from holdwise.llm.common import ByteKeys, blocks, mix


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ASCII letters, digits and non-ASCII bytes, and the number of them per row."""
    n = len(data)
    low = data | 0x20
    solid = ((low >= 0x61) & (low <= 0x7A)) | ((data >= 0x30) & (data <= 0x39)) | (data >= 0x80)
    first = np.append(True, ~solid[:-1]) if n else np.zeros(0, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(solid & first)
    last = np.append(~solid[1:], True) if n else np.zeros(0, bool)
    cuts = offsets[1:-1]
    last[cuts[(cuts > 0) & (cuts <= n)] - 1] = True
    return starts, np.flatnonzero(solid & last) + 1, np.diff(np.searchsorted(starts, offsets))


class WordHash:
    """Rows of a hash table for each word: the word itself and its first bytes (so that inflected forms share rows)."""

    def __init__(self, bits: int, prefixes: tuple[int, ...] = (4, 5, 6)):
        self.bits, self.prefixes = bits, prefixes
        self.bytes = ByteKeys(lower=True)

    def all_ids(self, data: np.ndarray, offsets: np.ndarray, limit: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of many texts, worked out in blocks of about ``limit`` bytes."""
        parts = [self.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in blocks(offsets, limit)]
        if not parts:
            return self.ids(data, offsets)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words x kinds) table rows and the number of words per text row."""
        starts, ends, counts = letter_words(data, offsets)
        out = np.empty((len(starts), 1 + len(self.prefixes)), np.int32)
        shift = np.uint64(64 - self.bits)
        with np.errstate(over="ignore"):
            for k, length in enumerate((None, *self.prefixes)):
                stop = ends if length is None else np.minimum(ends, starts + length)
                out[:, k] = mix(self.bytes.keys(data, starts, stop) + np.uint64(k + 1)) >> shift
        return out, counts


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with words, and where the words of each begin (for ``reduceat``)."""
    full = np.flatnonzero(counts)
    return full, (np.cumsum(counts) - counts)[full]
