import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdwise.llm.bpe import encode_rows
from holdwise.llm.common import text_buffer
from holdwise.llm.encoding import decode, encode
from holdwise.llm.packing import SumOfSquares, pack
from tests.llm.conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def own_ids(texts, **limits):
    import pyarrow as pa

    out = {}
    for keys, ids, counts in encode_rows([(list(range(len(texts))), *text_buffer(pa.array(texts, pa.string())))], PATH, **limits):
        ends = np.append(0, np.cumsum(counts))
        out.update({k: ids[s:e].tolist() for k, s, e in zip(keys, ends[:-1], ends[1:], strict=True)})
    return [out[k] for k in range(len(texts))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aab'stredvlm  \n\té日😀²٣.,-_<|>endoftext\u0085  "), max_size=40), min_size=1, max_size=12))
def test_ids_equal_the_librarys(texts):
    library = Tokenizer.from_file(PATH)
    assert own_ids(texts, block_bytes=60, held_words=20) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_rows_are_cut_at_sure_places(library):
    text = prose(5000, 3)
    assert own_ids([text, "x", text[:50]], block_bytes=1000) == [library.encode(t, add_special_tokens=False).ids for t in (text, "x", text[:50])]


def test_encode_and_decode_odd_rows(spark, docs_of, odd_rows, library):
    coded = encode(docs_of(odd_rows), PATH, decoded=True)
    rows = coded.collect()
    assert len(rows) == len(odd_rows)
    want = sorted((i is None, i or 0, t or "") for i, t in odd_rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in rows) == want
    for r in rows:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == library.encode(r.decoded, add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids) // 4
    again = decode(coded.select("doc_id", "token_ids"), PATH)
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in rows)
    assert encode(docs_of([]), PATH).count() == 0


def test_pieces_cover_documents_and_fill_sequences(docs_of, odd_rows, library):
    source = [(i, t) for i, t in odd_rows if i not in (7, None)] + [(100 + k, prose(30 + 17 * k, k)) for k in range(60)]
    pieces = pack(docs_of(source).coalesce(3), PATH, most_open=8).withColumn("crc", F.crc32("token_ids")).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, t in source:
        ids, at = [*library.encode(t or "", add_special_tokens=False).ids, 0], 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.crc == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for part in by_sequence.values():
        at = 0
        for p in sorted(part, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0  # full or a smaller power of two
    assert pack(docs_of([]), PATH).count() == 0


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(0)
    packer = SumOfSquares(16, 0, most_open=10**9)
    levels = np.zeros(17, int)
    for k in range(300):
        s = int(rng.integers(1, 16))
        costs = []
        for h in [0, *np.flatnonzero(levels[:16]).tolist()]:
            if h + s <= 16:
                after = levels.copy()
                after[h] -= h > 0
                after[h + s] += h + s < 16
                costs.append(int((after**2).sum()))
        packer.add(k, np.zeros(s, np.uint32))
        levels = packer.level
        assert int((levels**2).sum()) == min(costs)
