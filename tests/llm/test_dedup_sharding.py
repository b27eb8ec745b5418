import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdwise.llm.components import components, looked_up
from holdwise.llm.exactdup import drop_exact_duplicates, exact_duplicates
from holdwise.llm.neardup import LEAST, PERCENT, OnePermutation, Shingles, block_links, drop_near_duplicates, near_duplicates, set_key
from holdwise.llm.sharding import Tree, balanced_bins, best_fit_decreasing, shards
from tests.llm.conftest import prose


def check_exact(rows, out):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in out) == Counter((i, t or "") for i, t in rows)
    for r in out:
        ids = [i for i in groups[sha[r.text_sha256]] if i is not None]
        assert r.keep_id == (max(ids) if ids else None)
        assert r.group_size == len(groups[sha[r.text_sha256]])
    kept = Counter(sha[r.text_sha256] for r in out if r.kept)
    assert kept == Counter(groups.keys())  # exactly one row per text


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_compare_content(docs_of, odd_rows, weak):
    rows = odd_rows + [(k, f"copy {k % 3}") for k in range(20, 60)]
    more = {"digest": lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 2))} if weak else {}
    check_exact(rows, exact_duplicates(docs_of(rows), salts=4, **more).collect())


def test_exact_dedup_keeps_one_row_of_each_text(docs_of, odd_rows):
    out = drop_exact_duplicates(docs_of(odd_rows)).collect()
    assert Counter(r.text or "" for r in out) == Counter({t or "" for _, t in odd_rows})
    assert "keep_id" in out[0].asDict()
    assert exact_duplicates(docs_of([])).count() == drop_exact_duplicates(docs_of([])).count() == 0


def brute_components(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = [x for x in (t or "").translate(low).replace("\n", " ").replace("\t", " ").split(" ") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    low_id = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low_id[label[k]] = min(i, low_id.get(label[k], i))
    return [(i, len(sets[k]), low_id.get(label[k])) for k, (i, _) in enumerate(rows)]


def near_rows():
    rnd = random.Random(4)
    rows = []
    for base in range(6):
        words = prose(rnd.choice([6, 25, 80, 200]), base).split()
        for k in range(14):
            own = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 12))):
                own[rnd.randrange(len(own))] = f"w{base}{k}{rnd.randint(0, 99)}"
            rows.append((1000 * base + k, " ".join(own)))
    return rows


def test_near_duplicates_equal_brute_force(docs_of, odd_rows):
    rows = near_rows() + [(i if i is None else i + 90_000, t) for i, t in odd_rows] + [(77_000, "A b C"), (77_001, "a  B c")]
    out = near_duplicates(docs_of(rows)).collect()
    want = Counter((i, n, c if i is None or n else i) for i, n, c in brute_components(rows))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == want
    assert all(r.kept == (r.doc_id == r.component_id or r.component_id is None) for r in out)
    kept = drop_near_duplicates(docs_of(near_rows()))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(near_rows())})
    assert near_duplicates(docs_of([])).count() == 0


def test_one_row_of_each_component_stays_though_ids_repeat(docs_of):
    a, b = prose(40, 1), prose(40, 2)
    rows = [(5, a), (5, a + " end"), (5, b), (5, b), (7, b + " end"), (None, prose(40, 3)), (None, prose(40, 3) + " x"), (9, ""), (9, ""), (None, None), (None, a + " x")]
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(docs_of(rows)).collect()]
    assert len(kept) == 6 and sorted(kept, key=str).count((9, "")) == 2 and (None, None) in kept
    assert [sum((t or "").startswith(p) for _, t in kept) for p in (a, b, prose(40, 3))] == [1, 1, 1]
    assert {i for i, t in kept if t and t.startswith((a, b))} == {5}
    plain = [(k, prose(40, k)) for k in range(4)] + [(9, ""), (9, "")]
    assert drop_near_duplicates(docs_of(plain)).count() == 6


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    hashing = OnePermutation()
    for size in (10, 100, 2000):
        got = []
        for _ in range(30):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            a, b = (np.unique(np.append(both, rng.integers(0, 2**63, size // 5, dtype=np.uint64))) for _ in range(2))
            got.append((hashing.signature(a) == hashing.signature(b)).mean())
        assert abs(np.mean(got) - 1 / 1.4) < 0.06


def test_block_links_find_what_pairs_would():
    sets = Shingles().sets(*_buffer([t for _, t in near_rows()]))
    label = np.arange(len(sets))
    found = block_links(sets, label[:40], label[30:], label)
    up = list(range(len(sets)))
    for a, b in found:
        old, new = max(up[a], up[b]), min(up[a], up[b])
        up = [new if x == old else x for x in up]
    for a in range(40):
        for b in range(30, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if a != b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                assert up[a] == up[b]


def _buffer(texts):
    import pyarrow as pa

    from holdwise.llm.common import text_buffer

    return text_buffer(pa.array(texts))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(500, 500), (7, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert best_fit_decreasing([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    tree = Tree()
    for key in [(5, 0), (2, 1), (9, 2), (5, 3)]:
        tree.add(key)
    assert [tree.take_first_from((4, -1)), tree.take_first_from((5, -1)), tree.take_first_from((6, -1)), tree.take_first_from((6, -1))] == [(5, 0), (5, 3), (9, 2), None]


def test_balanced_bins_gives_giants_their_own():
    sizes = [1000, 900] + [1] * 300
    bins = balanced_bins(sizes, 5)
    load = Counter()
    for s, b in zip(sizes, bins, strict=True):
        load[b] += s
    assert sorted(load.values()) == [100, 100, 100, 900, 1000]
    assert balanced_bins([], 4) == [] and set(balanced_bins([3], 4)) <= set(range(4))


def test_shards_hold_whole_groups_and_gapless_slots(docs_of, odd_rows):
    rows = odd_rows + [(100 + k, prose(5 + k % 40, k % 150)) for k in range(400)]
    out = shards(docs_of(rows[:4] + rows[5:]), 4).collect()  # without the one very long text
    slots, load, home = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        home[(r["size"], r.text_crc32)].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())
    assert len(load) == 4 and max(load.values()) < 1.05 * min(load.values())
    assert len(out) == len(rows) - 1
    assert len(shards(docs_of(rows), 4).collect()) == len(rows)
    assert shards(docs_of([]), 4).count() == 0


def test_keys_of_sets_do_not_rest_on_one_hash():
    one, two = np.array([7], np.uint64), np.array([7, 9], np.uint64)
    assert set_key(one, b"A b\tc") == set_key(one, b" a  B c ") != set_key(one, b"a b d")
    assert set_key(one, b"x x x x x") == set_key(one, b"x x x x x x x") != set_key(one, b"x x x x")
    assert len(set_key(two, b"")) == 16 and set_key(two, b"") != set_key(two[:1], b"a") and set_key(two[:0], b"") is None
    assert 100 * LEAST >= PERCENT * (LEAST + 1) and 100 * (LEAST - 1) < PERCENT * LEAST


def test_a_hot_key_is_looked_up_by_many_tasks(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("key"))
    table = spark.createDataFrame([(-1, "hot"), *[(3 * k, f"v{k}") for k in range(5000)]], "key long, value string")
    keep = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(keep, ("-1", "false", "64"), strict=True):
            spark.conf.set(c, v)
        out = looked_up(rows, table, "key").withColumn("task", F.spark_partition_id()).collect()
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert sorted((r.id, r.key, r.value) for r in out if r.value is not None) == sorted((k, -1, "hot") if k % 3 else (k, k, f"v{k // 3}") for k in range(20_000) if k % 3 or k < 15_000)
    assert len(out) == 20_000
    assert max(Counter(r.task for r in out if r.key == -1).values()) < 13_333 / 8
