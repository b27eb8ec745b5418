import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdwise.llm.language import CrossParser, automaton, languages
from holdwise.llm.neighbours import DEFAULT, Probing, PStable, nearest, unit, visited
from holdwise.llm import pii
from holdwise.llm import quality as quality_module
from holdwise.llm.pii import base_spans, personal_data, redact_personal_data, redacted
from holdwise.llm.quality import quality
from holdwise.llm.toxicity import drop_toxic, toxicity
from tests.llm.conftest import prose

WORDS = {"en": "the an re on ti ing er at nd es", "de": "sch ei ung ver keit lich ge zu"}


def labelled(n):
    rows, labels = [], []
    for k in range(n):
        lang = "en" if k % 2 else "de"
        text, bad = prose(40 + k % 50, k, WORDS[lang]), k % 5 == 0
        if bad:
            text = text[:60] + f" {'stupid' if lang == 'en' else 'lowei' + 'abcdefgh'[k % 8]} " + text[60:] + " worthless"
        rows.append((k, text, lang))
        labels.append((k, 1 - int(k % 3 == 0), int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def toxic_tables(spark, docs_of, odd_rows):
    rows, labels = labelled(900)
    odd = [(None if i is None else 10_000 + i, t) for i, t in odd_rows]
    return docs_of(rows + odd), spark.createDataFrame(labels + [(10_001, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_rows(toxic_tables, docs_of):
    docs, labels, truth = toxic_tables
    out = toxicity(docs, labels).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    bad = {i: t for i, _, t in truth}
    held = [r for r in out if r.held_out and r.doc_id in bad]
    assert len(held) > 200 and np.mean([r.predicted == bad[r.doc_id] for r in held]) > 0.97
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in out)
    none = toxicity(docs_of([(1, "a"), (2, None)]), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in none] == [(0.0, 0)] * 2
    assert toxicity(docs_of([]), labels).count() == 0


def test_toxicity_cuts_see_the_real_share_of_labels(spark, docs_of, monkeypatch):
    from holdwise.llm import toxicity as module

    # one word stands in toxic and in clean texts alike: rejecting it pays only while toxic texts are common
    rows = [(k, prose(30, k) + (" vexing" if k % 10 == 0 else ""), "en") for k in range(3000)]
    bad = lambda k: int(k % 100 == 0)
    labels = spark.createDataFrame([(k, 1, bad(k)) for k, _, _ in rows], "doc_id long, quality int, toxic int")
    docs = docs_of(rows)
    monkeypatch.setattr(module, "SAMPLE_TOXIC", 30)
    monkeypatch.setattr(module, "SAMPLE_CLEAN", 30)
    known = module.known_labels(labels, "doc_id", "toxic")
    sample = module.labelled_sample(docs, labels, "doc_id", "text", "lang", "toxic")
    model = module.train(sample)
    counts = module.labelled_logits(docs, known, model, set(sample["id"]), "doc_id", "text")
    assert counts["n"].sum() == known.count() > 1900 and counts["n"][counts["toxic"] == 1].sum() == known.where("toxic = 1").count()
    assert counts["n"][counts["fitted"] == 1].sum() == len(sample) <= 60


def test_toxicity_cut_follows_the_share(spark):
    from holdwise.llm.toxicity import ToxicModel, set_cuts
    import pandas as pd

    def cut(clean):
        model = ToxicModel(None, None, None, 0.0, np.zeros((1, 1)), np.zeros(1), 1.0)
        rows = [(0, 64, 1, 0, 50), (0, 128, 1, 0, 50), (0, 64, 0, 0, clean), (0, -64, 0, 0, 10 * clean), (0, 64, 0, 1, clean)]
        set_cuts(model, pd.DataFrame(rows, columns=["language", "bin", "toxic", "fitted", "n"]))
        return model.cut[0]

    assert cut(5) < 1 < cut(5000)


def brute_logit(model, text):
    """Largest value of each filter over all of a text's places, weighed; and the language whose words it has most."""
    from holdwise.llm.features import WordHash
    from holdwise.llm.toxicity import BITS, FILTERS, WIDTHS

    hashing = WordHash(BITS)
    found = [hashing.ids(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0] for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]
    total, column = model.offset, 0
    for f in range(len(WIDTHS) * FILTERS):
        width = WIDTHS[f // FILTERS]
        column = FILTERS * sum(WIDTHS[: f // FILTERS]) + f % FILTERS
        best = 0.0
        for at in range(len(found)):
            value = float(model.bias[f])
            for j in range(width):
                if at + j < len(found):
                    value += sum(float(model.table[row, column + j * FILTERS]) for row in found[at + j])
            best = max(best, value)
        total += best * float(model.weight[f])
    spoken = sum((model.language[row[0]].astype(float) for row in found), np.zeros(model.language.shape[1]))
    return total, int(spoken.argmax())


def test_toxicity_scores_equal_brute_force(toxic_tables, odd_rows, monkeypatch):
    from holdwise.llm import toxicity as module
    from holdwise.llm.common import text_buffer
    from holdwise.llm.features import WordHash
    import pyarrow as pa

    docs, labels, _ = toxic_tables
    model = module.learned(docs, labels, "doc_id", "text", "lang", "toxic")
    texts = {r.doc_id: r.text for r in docs.where("doc_id < 60 or doc_id > 10000").collect() if len(r.text or "") < 5000}
    want = {k: brute_logit(model, t) for k, t in texts.items()}
    for chunk in (7, 50_000):  # filters reach over the ends of chunks
        monkeypatch.setattr(module, "CHUNK_WORDS", chunk)
        logit, language = model.logits(*WordHash(module.BITS).ids(*text_buffer(pa.array(list(texts.values()), pa.string()))))
        assert np.allclose(logit, [v for v, _ in want.values()], atol=1e-3)
        assert language.tolist() == [k for _, k in want.values()]
    monkeypatch.undo()
    got = {r.doc_id: r for r in toxicity(docs, labels).where("doc_id < 60 or doc_id > 10000").collect() if r.doc_id in texts}
    for k, (logit, language) in want.items():
        z = model.slope * (logit - model.cut[language]) + np.log(0.7 / 0.3)
        assert abs(got[k].score - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 2e-3


def test_rare_languages_share_a_cut():
    import pandas as pd
    from holdwise.llm import toxicity as module

    rows = [(k, prose(8, k) + (" vexing" if k % 2 else ""), f"l{k % 50}" if k < 200 else "en", k % 2) for k in range(400)]
    model = module.train(pd.DataFrame(rows, columns=["id", "text", "lang", "toxic"]))
    assert len(model.cut) == model.language.shape[1] == module.LANGUAGES


def test_quality_on_held_out_rows(spark, docs_of, odd_rows):
    rows = [(k, (prose(40, k) if k % 4 else " | ".join(prose(30, k).split())), "en") for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(400)], "doc_id long, quality int")
    docs = docs_of(rows + [(None if i is None else 10_000 + i, t) for i, t in odd_rows])
    out = quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 600 and (r.held_out or r.doc_id >= 400)]
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95
    assert quality(docs_of([]), labels).count() == 0
    assert {r.score for r in quality(docs, labels.limit(0)).collect()} == {0.5}


def brute_phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def test_phrases_equal_brute_force():
    sample = prose(120, 1)
    parser = CrossParser({"en": sample, "de": prose(120, 2, WORDS["de"])})
    import pyarrow as pa

    from holdwise.llm.common import text_buffer

    texts = [prose(20, 9), prose(20, 8, WORDS["de"]), "zz q the the"]
    symbols, counts, _ = parser.symbols(*text_buffer(pa.array(texts)))
    bits = parser.parse(symbols, counts)
    row = parser.languages.index("en")
    got = (bits[row] / parser.bits[row]).round().astype(int).tolist()
    letters = lambda s: "".join(c if c.isalpha() else " " for c in s)
    assert got == [brute_phrases(letters(t), letters(sample)) for t in texts]


def test_automaton_knows_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2]
    step = automaton(text)
    known = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    for a in range(1, 4):
        for b in range(1, 4):
            for c in range(1, 4):
                state = 0
                for x in (a, b, c):
                    state = step[state, x] if state >= 0 else -1
                assert (state >= 0) == ((a, b, c) in known)


def test_languages_on_held_out_rows(docs_of, odd_rows):
    rows, _ = labelled(400)
    out = languages(docs_of(rows + [(None if i is None else 10_000 + i, t) for i, t in odd_rows])).collect()
    lang = {i: g for i, _, g in rows}
    held = [r for r in out if r.held_out and r.doc_id in lang]
    assert len(held) > 50 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    odd = {r.doc_id: r for r in out if r.doc_id and r.doc_id > 10_000}
    assert [odd[10_000 + k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in out) and len(out) == 400 + len(odd_rows)
    assert {r.lang_pred for r in languages(docs_of([(1, "abc"), (2, None)])).collect()} == {"und"}
    assert languages(docs_of([])).count() == 0


def test_language_samples_are_filled_in_spite_of_copies(docs_of):
    from holdwise.llm.language import SAMPLE_CHARS, samples

    rows = [(k, prose(60, 1, WORDS["de"]), "de") for k in range(3000)]  # one group of copies
    rows += [(4000 + k, "the same opening " * 40 + prose(300, k, WORDS["de"]), "de") for k in range(200)]
    rows += [(5000 + k, f"{prose(1, k)}{k}", "en") for k in range(6000)]  # one-word texts
    rows += [(20_000 + k, prose(9000, k), "fr") for k in range(6)]  # few long ones
    got = samples(docs_of(rows + [(30_000, "", "en"), (30_001, "12", "en")]), "doc_id", "text", "lang")
    assert {k: len(v) for k, v in got.items()} == {"de": SAMPLE_CHARS, "en": SAMPLE_CHARS, "fr": SAMPLE_CHARS}
    assert got["de"].count(rows[0][1][:200]) <= 1 and got["de"].count("the same opening") < 900


def test_letters_of_several_scripts_are_told_apart(docs_of):
    """Languages of one script with thousands of letters, and of one beyond the basic plane."""

    def writing(seed, first, last):
        rnd = random.Random(seed)
        stems = ["".join(chr(rnd.randint(first, last)) for _ in range(rnd.randint(1, 3))) for _ in range(2000)]
        return lambda n: "".join(rnd.choice(stems) + rnd.choice(["", "", ". "]) for _ in range(n))

    write = {"a": writing(1, 0x4E00, 0x5A00), "b": writing(2, 0x4E00, 0x5A00), "c": writing(3, 0x3B1, 0x3C9), "d": writing(4, 0x10330, 0x1034A)}
    rows = [(k, write["abcd"[k % 4]](60 if k < 2400 else 12), "abcd"[k % 4]) for k in range(2800)]
    out = languages(docs_of(rows + [(9000, "\u05d0\u05d1", None)])).collect()
    assert np.mean([r.lang_pred == "abcd"[r.doc_id % 4] for r in out if r.held_out and r.doc_id < 2800]) > 0.98
    assert {r.lang_pred for r in out} == set("abcd")  # letters that no sample has are predicted too


def test_phrases_equal_brute_force_with_many_letters():
    import pyarrow as pa

    from holdwise.llm.common import text_buffer

    rnd = random.Random(6)
    write = lambda n: "".join(chr(rnd.choice([0x4E00 + rnd.randrange(400), 0x10330 + rnd.randrange(16), 0x20])) for _ in range(n))
    clean = lambda t: " ".join(t.split(" ")) if "  " not in t else re.sub(" +", " ", t)
    sample = clean(write(3000))
    parser = CrossParser({"a": sample, "b": clean(write(3000))})
    texts = [clean(write(300)) for _ in range(20)] + ["\u05d0" + sample[100:160] + "\u05d0\u05d1"]
    symbols, counts, _ = parser.symbols(*text_buffer(pa.array(texts)))
    got = (parser.parse(symbols, counts)[0] / parser.bits[0]).round().astype(int).tolist()
    assert got == [brute_phrases(t, sample) for t in texts]


def test_only_the_languages_with_most_text_are_learned(docs_of, monkeypatch):
    from holdwise.llm import language as module

    monkeypatch.setattr(module, "LANGUAGES", 2)
    rows = [(k, prose(20, k), f"l{k % 7}" if k % 7 < 2 else "rare") for k in range(140)] + [(500 + k, "one word", f"x{k}") for k in range(40)]
    assert set(module.samples(docs_of(rows), "doc_id", "text", "lang")) <= {"l0", "l1", "rare"}
    assert len(module.samples(docs_of(rows), "doc_id", "text", "lang")) == 2


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            luhn = sum(d // 10 + d % 10 for d in double) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((k, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(5)
    parts = ["a@b.c", "x.y@host-1.example.com", "@", "a@@b.co", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.003.004", "4539 1488 0343 6467", "4539148803436467", "+1 (456) 555-2186", "+49 30 1234567", "+1", " ", "é", "-", ".", "7", "12"]
    for _ in range(3000):
        text = "".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 8)))
        assert base_spans(text) == brute_spans(text), text
    assert base_spans("9" * 200_000) == []


def test_personal_data_and_redaction(docs_of, odd_rows):
    rows = [(100 + k, f"é {prose(9, k)} mail joe.{k}@host.example.com or +1 (456) 555-21{k:02d}, 10.0.0.{k} {prose(9, k)} version 4.0") for k in range(80)]
    docs = docs_of(rows + odd_rows)
    text = dict(rows)
    out = personal_data(docs).collect()
    assert len(out) == len(rows) + len(odd_rows)
    for r in out:
        if r.doc_id in text:
            base = [(s.kind, s.start, s.end) for s in r.base]
            assert base == [(PATTERNS[k][0], s, e) for k, s, e in brute_spans(text[r.doc_id])]
            assert set(r.base) <= set(r.spans)
    clean = redact_personal_data(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        if r.doc_id in text:
            assert "@" not in r.text and "555" not in r.text and "[EMAIL]" in r.text and "[PHONE]" in r.text and "version 4.0" in r.text
    assert Counter(r.text for r in clean.collect() if r.doc_id not in text) == Counter(t for _, t in odd_rows)
    assert redacted("a 1.2.3.4 b", [(1, 2, 9)]) == "a [IP] b"
    assert personal_data(docs_of([])).count() == 0


def test_personal_data_without_its_marks_is_added(docs_of):
    rows = [(k, f"{prose(9, k)} mail joe.{k}@host{k % 7}.example.com or +1 (456) 555-{2100 + k}, 10.0.0.{k} {prose(3, k)} 4539148803436467 {prose(9, k)}") for k in range(120)]
    rows += [(200 + k, f"{prose(9, k)} version 2024.10.{1000 + k} of 2024-10-{10 + k % 20} 12, token = \"ab{186661156 + k}f\" {prose(5, k)} {4539148803436460} ") for k in range(60)]
    rows += [(300 + k, f"{prose(9, k)} {what} {prose(9, k)}") for k, what in enumerate(["(456) 555-7188", "jane.doe (at) host3.example (dot) com", "version 2024.10.5551", "4539.1488.0343.6467", "10[.]0[.]0[.]77", "4539.1488.0343.6460", "2024-10-05 12"])]
    text = dict(rows)
    out = {r.doc_id: [(s.kind, text[r.doc_id][s.start : s.end]) for s in r.spans] for r in personal_data(docs_of(rows)).collect()}
    assert out[300] == [("phone", "(456) 555-7188")]
    assert out[301] == [("email", "jane.doe (at) host3.example (dot) com")]
    assert out[303] == [("card", "4539.1488.0343.6467")] and out[304] == [("ip", "10[.]0[.]0[.]77")]
    assert out[302] == out[305] == out[306] == []
    assert all(out[200 + k] == [] for k in range(60))


def brute_nearest(rows, queries, top):
    out = {}
    for q, x in queries:
        near = []
        for i, y in rows:
            if i != q and len(x) == len(y):
                a, b = np.array(x), np.array(y)
                near.append((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i))
        out[q] = sorted(near)[:top]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(600)]
    rows += [(600 + k, [1.0] * 16) for k in range(30)] + [(700, [2.0] * 16)]  # copies, and a scaled one
    bad = [(800, None), (801, []), (802, [0.0] * 16), (803, [float("nan")] * 16), (804, [None] * 16), (805, [float("inf")] * 16), (None, [1.0] * 16), (810, [1.0, 2.0, 3.0]), (5, rows[5][1])]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + bad], "vec_id long, embedding array<float>, node string, score string")
    out = nearest(table, F.col("id") % 10 == 0, top=5).collect()
    exact = spark.createDataFrame(rows, "vec_id long, embedding array<float>").collect()
    exact = [(r.vec_id, [float(v) for v in r.embedding]) for r in exact]
    want = brute_nearest(exact, [r for r in exact if r[0] % 10 == 0], 5)
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for _, i in want[q]}) / 5 for q in want]) > 0.9
    for q in (600, 610, 700):  # ties go to the smaller id
        assert [i for i, _ in got[q]] == [i for _, i in want[q]]
    pair = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(pair, F.col("id") % 2 == 0).collect()] == [(0, 1, 1, 0.0)]
    assert nearest(pair.limit(0), F.col("id") % 2 == 0).count() == 0


def test_neighbours_are_the_best_of_all_probed_buckets(spark):
    x = np.random.default_rng(2).normal(size=(900, 32))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(table, F.col("id") % 20 == 0, top=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    u = unit(x)
    for q in range(0, 900, 20):
        seen = np.zeros(900, bool)
        for t in range(DEFAULT.tables):
            h = PStable(32, t)
            seen |= np.isin(h.keys(np.floor(h.places(u))), h.probes(h.places(u[q : q + 1])[0]))
        seen[q] = False
        close = np.where(seen, u @ u[q], -2)
        assert seen.sum() < 5 or got[q] == np.argsort(-close, kind="stable")[:5].tolist()


def test_longer_keys_find_clustered_neighbours_with_a_small_share(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 32))[rng.integers(0, 50, 2000)] + 0.3 * rng.normal(size=(2000, 32))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    few, chosen = F.col("id") % 20 == 0, Probing(tables=6, hashes=12, width=1.0, probes=150)
    got = {}
    for r in nearest(table, few, probing=chosen).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(list(enumerate(x)), [(k, x[k]) for k in range(0, 2000, 20)], 5)
    assert np.mean([len(got[q] & {i for _, i in want[q]}) / 5 for q in want]) >= 0.9
    u, total = unit(x), 0
    for t in range(chosen.tables):
        h = PStable(32, t, chosen)
        keys = h.keys(np.floor(h.places(u)))
        total += sum(np.isin(keys, h.probes(p)).sum() for p in h.places(u[::20]))
    row = visited(table, few, probing=chosen).first()
    assert (row.queries, row.classes, row.visits) == (100, 2000, total)
    assert row.visits / (row.queries * row.classes) < 0.1
    empty = visited(table.limit(0), few).first()
    assert (empty.queries, empty.classes, empty.visits) == (0, 0, None)


def test_short_queries_meet_rows_of_their_length(spark, monkeypatch):
    monkeypatch.setattr("holdwise.llm.neighbours.CELL", 4)
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=2 + k % 3).tolist()) for k in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(table, F.col("id") % 2 == 0, top=30, probing=Probing(1, 2, 4.0, 0)).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for _, i in near] for q, near in brute_nearest(rows, [r for r in rows if r[0] % 2 == 0], 30).items()}


def unmarked_corpus():
    rows = [(k, f"{prose(9, k)} mail joe.{k}@host{k % 7}.example.com or +1 (456) 555-{2100 + k}, 10.0.0.{k} {prose(3, k)} 4539148803436467 {prose(9, k)}") for k in range(120)]
    rows += [(200 + k, f"{prose(9, k)} version 2024.10.{1000 + k} of 2024-10-{10 + k % 20} 12, token = \"ab{186661156 + k}f\" {prose(5, k)} {4539148803436460} ") for k in range(60)]
    planted = ["(456) 555-7188", "jane.doe (at) host3.example (dot) com", "4539.1488.0343.6467", "10[.]0[.]0[.]77"]
    alike = ["he scored 456 555 7188 points", "they serialised 20 30 40 50 60 units", "we meet at noon dot org", "see section 1 . 4 . 2 . 7 there"]
    rows += [(300 + k, f"{prose(9, k)} {what} {prose(9, k)}") for k, what in enumerate(planted)]
    return rows + [(400 + k, f"{prose(9, k)} {what} {prose(9, k)}") for k, what in enumerate(alike)], planted


def test_trees_tell_personal_data_from_look_alikes(docs_of):
    rows, planted = unmarked_corpus()
    text = dict(rows)
    out = {r.doc_id: [text[r.doc_id][s.start : s.end] for s in r.spans] for r in personal_data(docs_of(rows)).collect()}
    assert [out[300 + k] for k in range(4)] == [[p] for p in planted]
    assert [out[400 + k] for k in range(4)] == [[], [], [], []]


def test_the_trees_decide(spark, docs_of, monkeypatch):
    """With trees that find everything likely, look-alikes and failed checks would be taken."""
    rows, _ = unmarked_corpus()
    model = pii.learned(docs_of(rows), "doc_id", "text")
    real = [pii.chosen_spans(t, pii.base_spans(t), model) for _, t in rows]
    monkeypatch.setattr(model.trees, "probability", lambda x: np.ones(len(x)))
    blind = [pii.chosen_spans(t, pii.base_spans(t), model) for _, t in rows]
    more = [doc for (doc, _), a, b in zip(rows, real, blind, strict=True) if a != b]
    assert {400, 401, 402}.issubset(more) and sum(200 <= d < 260 for d in more) == 60


def few_labels():
    rnd = random.Random(9)
    vocabulary = [prose(200, 90 + y).split() for y in (0, 1)]
    common = prose(60, 3).split()
    rows, truth = [], {}
    for k in range(1500):
        y = truth[k] = rnd.randint(0, 1)
        own = [rnd.choice(vocabulary[y]) + "xy"[y] for _ in range(3)]
        said = [*own, *[rnd.choice(common) for _ in range(25)]]
        rnd.shuffle(said)
        bars = (y == 0) != (rnd.random() < 0.05)  # the layout is right in 19 of 20
        rows.append((k, (" | " if bars else " ").join(said), "en"))
    return rows, truth


def auc(rows, truth):
    order = sorted(rows, key=lambda r: r.score)
    place = [i for i, r in enumerate(order, 1) if truth[r.doc_id]]
    n, m = len(place), len(rows) - len(place)
    return (sum(place) - n * (n + 1) / 2) / (n * m)


def test_the_exchange_helps_where_labels_are_few(spark, docs_of, monkeypatch):
    rows, truth = few_labels()
    labels = spark.createDataFrame([(k, truth[k]) for k in range(90)], "doc_id long, quality int")
    docs = docs_of(rows)
    found = {}
    for rounds in (0, 3):
        monkeypatch.setattr(quality_module, "ROUNDS", rounds)
        out = quality(docs, labels, field_cols=()).collect()
        found[rounds] = auc([r for r in out if r.doc_id >= 90], truth)
    assert found[3] > found[0] + 0.01 and found[3] > 0.97, found


def test_cuts_are_quantiles_of_all_rows(spark):
    rnd = np.random.default_rng(6)
    p = rnd.beta(0.8, 0.8, size=(5000, 2))
    scored = spark.createDataFrame([(float(a), float(b)) for a, b in p], "by_text double, by_page double")
    cut = quality_module.cuts(scored, 0.1)
    for k, view in enumerate(("text", "page")):
        for label in (0, 1):
            sure = p[:, k] if label else 1 - p[:, k]
            mine = np.sort(sure[sure >= 0.5])[::-1]
            assert cut[view, label] == pytest.approx(max(0.9, mine[int(0.1 * len(mine))]), abs=0.006)
            assert (mine >= cut[view, label]).sum() <= 0.12 * len(mine)
