"""Byte-level BPE over whole blocks of text: vectorised word splitting, a pair occurrence index, decoding.

The words of a partition are collected once each. For their symbols an index maps every pair to all of its
positions; active ranks are applied in ascending order, and only the lists that a merge touches are updated.
A merge can only create pairs of higher rank (its product did not exist before), so one ascending sweep
gives what merging each word on its own, lowest rank first, gives.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pandas as pd

from holdwise.llm.common import ByteKeys, blocks, ragged

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3

# Unicode's White_Space code points.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Text bytes that are split at once, and words that are held before they are encoded.
BLOCK_BYTES = 1_000_000
HELD_WORDS = 2_000_000


def char_class(code: int) -> int:
    kind = unicodedata.category(chr(code))[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


def class_table() -> np.ndarray:
    """Class of each code point of the basic plane; higher ones are looked up when they occur."""
    out = np.fromiter(map(char_class, range(0x10000)), np.uint8, 0x10000)
    out[WHITE_SPACE] = SPACE
    return out


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


class Bpe:
    """Vocabulary and merge ranks of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(max(vocab.values()), *self.specials.values())
        letters = byte_alphabet()
        back = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self.key_rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.key_rank]
        tokens = [b""] * self.size
        for t, i in vocab.items():
            tokens[i] = bytes(back[c] for c in t)
        for t, i in self.specials.items():
            tokens[i] = t.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_len = np.fromiter(map(len, tokens), np.int64, self.size)
        self.token_start = np.cumsum(self.token_len) - self.token_len

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where no merge is known."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], -1)

    def encode_words(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (``raw`` holds their bytes) one after another, and the number of tokens of each."""
        n = len(raw)
        if n == 0:
            return np.zeros(0, np.int64), lengths
        sym = np.append(self.byte_id[raw], -1).astype(np.int32)  # -1: no symbol here (merged away, or the end)
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        # neighbours; n stands for "none": a word's first symbol has no left one, its last no right one
        nxt = np.arange(1, n + 2, dtype=np.int32)
        prv = np.arange(-1, n, dtype=np.int32)
        ends = np.cumsum(lengths)[lengths > 0]
        nxt[ends - 1] = n
        prv[np.append(0, ends[:-1])] = n
        nxt[n] = prv[n] = n

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(rank: np.ndarray, at: np.ndarray) -> None:
            if len(self.product) < 2**16:
                rank = rank.astype(np.uint16)  # sorted by radix
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, where in zip(rank[np.append(0, cut)].tolist(), np.split(at, cut) if len(cut) else [at], strict=True):
                if r in index:
                    index[r].append(where)
                else:
                    index[r] = [where]
                    heapq.heappush(heap, r)

        at = np.flatnonzero(nxt[:n] < n).astype(np.int32)
        # at the start symbols are bytes: look each of their pairs up once
        table = self.ranks(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)).astype(np.int32)
        rank = table[raw[at].astype(np.int32) * 256 + raw[at + 1]]
        if len(at := at[rank >= 0]):
            add(rank[rank >= 0], at)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            p = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            a, b, new = self.left[r], self.right[r], self.product[r]
            q = nxt[p]
            ok = (sym[p] == a) & (sym[q] == b)
            p, q = p[ok], q[ok]
            if a == b and len(p) > 1:  # in a run of equal symbols every other pair counts, from the left
                chained = np.append(False, p[1:] == q[:-1])
                first = np.maximum.accumulate(np.where(chained, 0, np.arange(len(p))))
                keep = (np.arange(len(p)) - first) % 2 == 0
                p, q = p[keep], q[keep]
            if not len(p):
                continue
            after = nxt[q]
            sym[p], sym[q] = new, -1
            nxt[p], prv[after] = after, p
            nxt[n] = prv[n] = n
            # prv[p] may itself be a merged neighbour: pairs are read after all merges of this rank
            before = prv[p]
            lefts = np.concatenate([before[before < n], p[after < n]])
            if len(lefts):
                rank = self.ranks(sym[lefts], sym[nxt[lefts]])
                good = rank >= 0
                if good.any():
                    add(rank[good], lefts[good])
        alive = sym[:n] >= 0
        return sym[:n][alive], np.bincount(word[alive], minlength=len(lengths))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of consecutive id lists (``counts`` ids each)."""
        lengths = self.token_len[ids]
        flat = self.token_bytes[ragged(self.token_start[ids], lengths)].tobytes()
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts))].tolist()
        return [flat[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]


class Words:
    """Words as slices of a byte buffer, each with a 64-bit key of its bytes."""

    def __init__(self, key: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.key, self.data, self.starts, self.lengths = key, data, starts, lengths

    @classmethod
    def none(cls) -> Words:
        return cls(np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))

    @classmethod
    def joined(cls, parts: list[Words]) -> Words:
        shift = np.cumsum([0] + [len(w.data) for w in parts])
        starts = [w.starts + s for w, s in zip(parts, shift.tolist(), strict=False)]
        return cls(*(np.concatenate(x) for x in ([w.key for w in parts], [w.data for w in parts], starts, [w.lengths for w in parts])))

    def bytes(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.starts[k] + self.lengths[k]].tobytes()

    def distinct(self) -> tuple[np.ndarray, Words]:
        """A number for each word (equal numbers: equal bytes, which are compared) and the distinct words, packed."""
        n = len(self.key)
        if n == 0:
            return np.zeros(0, np.int64), Words.none()
        codes, _ = pd.factorize(self.key)
        rep = first_places(codes)
        same = np.array_equal(self.lengths, self.lengths[rep[codes]])
        if same:
            other = np.flatnonzero(rep[codes] != np.arange(n))
            left = ragged(self.starts[other], self.lengths[other])
            left += np.repeat(self.starts[rep[codes[other]]] - self.starts[other], self.lengths[other])
            same = np.array_equal(self.data[left], self.data[ragged(self.starts[other], self.lengths[other])])
        if not same:  # two words share a key: compare the words themselves
            codes, _ = pd.factorize(np.array([self.bytes(k) for k in range(n)], object))
            rep = first_places(codes)
        lengths = self.lengths[rep]
        data = self.data[ragged(self.starts[rep], lengths)]
        return codes, Words(self.key[rep], data, np.cumsum(lengths) - lengths, lengths)


def first_places(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(codes.max() + 1, np.int64)
    out[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return out


class Splitter:
    """Splits texts into the words of the byte-level scheme and numbers distinct words.

    A word is a run of letters, of numbers or of other characters, each with one space before it if there is
    one; an apostrophe with s, t, re, ve, m, ll or d is a word; the rest of white space stays together.
    """

    def __init__(self, specials: dict[str, int]):
        self.table = class_table()
        self.specials = specials
        self.keys = ByteKeys()

    def classes(self, codes: np.ndarray) -> np.ndarray:
        out = self.table[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        if len(high):
            which, inverse = np.unique(codes[high], return_inverse=True)
            out[high] = np.array([char_class(int(c)) for c in which], np.uint8)[inverse]
        return out

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
        """The rows' words (UTF-8 ``data`` cut at ``offsets``) as numbers, the count of words per row, the distinct words."""
        n_rows = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.int64), np.zeros(n_rows, np.int64), Words.none()
        raw = data.tobytes()
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # byte offset of each character
        cls = self.classes(codes)
        n = len(codes)
        brk = np.zeros(n + 1, bool)
        rows = np.searchsorted(at, offsets)
        brk[rows] = True
        special = []
        for text in self.specials:
            found, mark = raw.find(mark := text.encode()), mark
            while found >= 0:
                row = int(np.searchsorted(offsets, found, "right"))
                if found + len(mark) <= offsets[row]:  # not across two rows
                    s = int(np.searchsorted(at, found))
                    special.append((s, s + len(text)))
                    found = raw.find(mark, found + len(mark))
                else:
                    found = raw.find(mark, found + 1)
        for s, e in special:
            brk[s] = brk[e] = True
        brk[n] = True
        start = brk[:n].copy()
        start[1:] |= cls[1:] != cls[:-1]
        run = start.copy()
        # the last white space before a word stands alone, and a plain space goes with the word
        j = np.flatnonzero(run & (cls != SPACE) & ~brk[:n])
        j = j[cls[j - 1] == SPACE]
        start[j - 1] = True
        start[j[codes[j - 1] == 0x20]] = False
        # apostrophe words
        i = np.flatnonzero((codes == 0x27) & start)
        if len(i):
            code = np.append(codes, [0, 0, 0])
            broken = np.append(brk, [True, True])
            i = i[~broken[i + 1]]
            one = np.isin(code[i + 1], [ord(c) for c in "stmd"])
            two = np.zeros(len(i), bool)
            for a, b in ("re", "ve", "ll"):
                two |= (code[i + 1] == ord(a)) & (code[i + 2] == ord(b)) & ~broken[np.minimum(i + 2, n)]
            start[i[one | two] + 1] = False
            for k in (i[one] + 2, i[two] + 3):
                start[k[k < n]] = True
        for s, e in special:
            start[s:e] = False
            start[s] = True
        first = np.flatnonzero(start)
        starts, ends = at[first], np.append(at[first][1:], len(data))
        ids, distinct = Words(self.keys.keys(data, starts, ends), data, starts, ends - starts).distinct()
        return ids, np.diff(np.searchsorted(first, rows)), distinct


def cut_long(data: np.ndarray, offsets: np.ndarray, limit: int):
    """Yield (first row, last row + 1, bytes, offsets, whole) blocks; a row beyond ``limit`` is cut where a word surely ends.

    A cut lies before a space between two ASCII letters. A row without such a place stays whole.
    """
    for i, j in blocks(offsets, limit):
        s, e = offsets[i], offsets[j]
        part = data[s:e]
        if e - s <= limit:
            yield i, j, part, offsets[i : j + 1] - s, True
            continue
        low = part | 0x20
        letter = (low >= 0x61) & (low <= 0x7A)
        places = np.flatnonzero((part[1:-1] == 0x20) & letter[:-2] & letter[2:]) + 1
        begin = 0
        while begin < len(part):
            k = int(np.searchsorted(places, begin + limit, "right")) - 1
            end = int(places[k]) if len(part) - begin > limit and k >= 0 and places[k] > begin else len(part)
            yield i, j, part[begin:end], np.array([0, end - begin]), end == len(part)
            begin = end


def encode_rows(batches, path: str, block_bytes: int = BLOCK_BYTES, held_words: int = HELD_WORDS):
    """Encode (keys, UTF-8 data, offsets) batches; yield (keys, ids, counts) with counts ids for each key.

    Words are held until ``held_words`` of them wait (or the input ends); then the distinct ones are encoded
    together, so that the pair index covers the partition and memory stays bounded.
    """
    bpe = Bpe(path)
    splitter = Splitter(bpe.specials)
    waiting, parts, held, local = [], [], 0, 0

    def flush():
        numbering, words = Words.joined(parts).distinct() if parts else Words.none().distinct()
        ids, counts = bpe.encode_words(words.data, words.lengths)
        starts = np.cumsum(counts) - counts
        for text, own in bpe.specials.items():  # one id, whatever its bytes would give
            mark = text.encode()
            for k in np.flatnonzero(words.lengths == len(mark)):
                if words.bytes(k) == mark:
                    starts[k], counts[k] = len(ids), 1
                    ids = np.append(ids, own)
        for keys, numbers, per_row in waiting:
            numbers = numbering[numbers]
            n_ids = counts[numbers]
            flat = ids[ragged(starts[numbers], n_ids)]
            ends = np.append(0, np.cumsum(n_ids))[np.append(0, np.cumsum(per_row))]
            yield keys, flat, np.diff(ends)
        waiting.clear()
        parts.clear()

    for keys, data, offsets in batches:
        open_row: list[np.ndarray] = []
        for i, j, part, cut, whole in cut_long(data, offsets, block_bytes):
            numbers, per_row, words = splitter.split(part, cut)
            numbers = numbers + local  # number among all the blocks' distinct words
            parts.append(words)
            local += len(words.key)
            held += len(numbers)
            if not whole or open_row:  # pieces of one long row
                open_row.append(numbers)
                if not whole:
                    continue
                numbers = np.concatenate(open_row)
                per_row, open_row = np.array([len(numbers)]), []
            waiting.append((keys[i:j], numbers.astype(np.int32), per_row))
            if held >= held_words:
                yield from flush()
                held = local = 0
    yield from flush()
