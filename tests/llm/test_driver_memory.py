"""What the driver holds while it runs many jobs or fits a sample."""

import tracemalloc

import numpy as np
import pandas as pd
from holdwise.llm import components, neardup, toxicity
from holdwise.session import WHOLE_STAGE

from tests.llm.conftest import prose


def test_near_duplicate_jobs_compile_no_fused_code_on_the_driver(spark, docs_of, monkeypatch):
    written, seen = neardup.stored, []

    def stored(df, name):
        seen.append((name, spark.conf.get(WHOLE_STAGE)))
        return written(df, name)

    monkeypatch.setattr(neardup, "stored", stored)
    monkeypatch.setattr(components, "stored", stored)
    text = prose(60, 1)
    before = spark.conf.get(WHOLE_STAGE)
    found = neardup.near_duplicates(docs_of([(1, text), (2, text + " more"), (3, prose(60, 2)), (4, None)]))
    assert {"near-links", "components-edges", "near-more-links"} <= {name for name, _ in seen}
    assert {value for _, value in seen} == {"false"}
    assert spark.conf.get(WHOLE_STAGE) == before
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def sample_of(docs: int) -> pd.DataFrame:
    rnd = np.random.default_rng(1)
    vocabulary = np.array(sorted({f"{a}{b}{c}" for a in "lamo reti sun".split() for b in "ka pe du".split() for c in map(str, range(99))}))
    texts = [" ".join(rnd.choice(vocabulary, 250)) + (" vile" if k % 3 == 0 else "") for k in range(docs)]
    return pd.DataFrame({"text": texts, "lang": "en", "toxic": [int(k % 3 == 0) for k in range(docs)]})


def test_fit_holds_little_beyond_the_hashed_words_of_its_sample(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    sample = sample_of(6000)
    toxicity.train(sample[:50])
    tracemalloc.start()
    toxicity.train(sample)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    text = int(sample["text"].str.len().sum())
    ids = 251 * len(sample) * 4 * 4  # words x kinds, 4 bytes each
    print(f"peak {peak / 1e6:.1f} MB, ids {ids / 1e6:.1f}, text {text / 1e6:.1f}")
    assert peak < 4 * ids


def test_first_dimension_is_that_of_all_words_at_once(monkeypatch):
    rnd = np.random.default_rng(2)
    counts = rnd.integers(0, 40, 300)
    ids, y = rnd.integers(0, 500, (counts.sum(), 4)).astype(np.int32), (np.arange(300) % 3 == 0).astype(float)
    whole, parts = toxicity.Trainer(), toxicity.Trainer()
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 1 << 40)
    whole.start(ids, counts, y)
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 100)
    parts.start(ids, counts, y)
    assert np.array_equal(whole.p["E"], parts.p["E"])
