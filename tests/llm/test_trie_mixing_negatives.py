"""Operators 11 to 13 against brute force, on odd inputs and with small parameters."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdwise.llm import mixing
from holdwise.llm.mixing import flight, landing, mixed
from holdwise.llm.negatives import BITS, bounds, hard_negatives, hilbert_keys
from holdwise.llm.trie import SpillingQueue, prefix_trie

EXTRA = ["key", "above", "depth", "conv", "i", "words", "_pid", "_at", "source_size", "p", "nth", "chunk", "block", "span", "grp", "place", "id", "v", "dims"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def with_extras(df):
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


# -- 11 ----------------------------------------------------------------------------------------------------------------
TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def brute_trie(rows):
    turns = defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            turns[c].append(((n is not None, n or 0), r or "", t or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = {}
    for node, convs in members.items():
        sub = [x for x in members if x[: len(node)] == node]
        kids = [x for x in sub if len(x) == len(node) + 1]
        leaves = [x for x in sub if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in sub)]
        saved = sum((len(members[x]) - 1) * (len(WORDS.findall(x[-1][1])) if x else 0) for x in sub)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node)] = (parent, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def trie_of(spark, rows, **small):
    got = prefix_trie(with_extras(spark.createDataFrame(rows, TURNS).repartition(5)), **small)
    assert got.dtypes[:2] == [("conv_id", "bigint"), ("depth", "bigint")]
    got = got.collect()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


def odd_turns():
    rnd = random.Random(11)
    rows = [(None, 1, "user", "nobody's"), (41, None, None, None), (41, None, None, None), (41, 2, "user", ""), (42, 1, "user", "a  b"), (45, 7, "user", "x"), (-3, 1, "user", "a"), (-3, 2, "bot", "c d"), (-20, 1, "user", "a")]
    for c in range(0, 40):
        for n in range(rnd.randint(1, 6)):
            rows.append((c, n, "user" if n % 2 == 0 else "bot", rnd.choice(["hi", "hello there you", "same"]) if n < 2 else f"t{rnd.randint(0, 2)} x"))
    for c in range(60, 75):  # copies of one conversation, and a long common opening
        for n in range(30):
            rows.append((c, n, "user", f"word {n}" if n < 27 or c % 2 else f"own {c} {n}"))
    rows += [(100, n, "user", f"line {n}") for n in range(150)]  # one long conversation
    return rows


@pytest.mark.parametrize("small", [{}, {"shard_turns": 40, "piece": 8, "in_memory": 3}, {"shard_turns": 1, "piece": 1 << 16, "in_memory": 2}])
def test_trie_equals_brute_force(spark, small):
    rows = odd_turns()
    assert trie_of(spark, rows, **small) == brute_trie(rows)


def test_ends_of_many_parts(spark, monkeypatch):
    from holdwise.llm import trie

    monkeypatch.setattr(trie, "ENDS", 7)
    rows = [(c, 1, "user", "one") for c in range(0, 500)] + [(c, 2, "user", "two") for c in range(0, 500, 3)]
    assert trie_of(spark, rows, shard_turns=100) == brute_trie(rows)


def test_empty_trie(spark):
    assert trie_of(spark, []) == {}
    assert trie_of(spark, [(None, 1, "user", "x")]) == {}


def test_the_queue_spills_and_sums():
    rnd = random.Random(1)
    for in_memory in (1, 4, 1000):
        q, want = SpillingQueue(in_memory), defaultdict(lambda: [0, 0])
        for _ in range(300):
            place = (-rnd.randint(0, 5), rnd.randint(0, 9))
            q.push(place, 1, place[1])
            want[place][0] += 1
            want[place][1] += place[1]
        assert [q.taken(p) for p in sorted(want)] == [tuple(want[p]) for p in sorted(want)]


# -- 12 ----------------------------------------------------------------------------------------------------------------
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())])


def docs_of(spark, rows, parts=3):
    return with_extras(spark.createDataFrame(rows, DOCS).repartition(parts)).drop("source_size", "p", "nth", "chunk").select("*", *[F.lit("y").alias(c) for c in ("size", "target", "taken", "copies", "whole")])


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        total = sum(weight[s] for s in sizes if s not in stopped)
        share = {s: 3 * sizes[s] if s in stopped else rest * weight[s] / total for s in sizes}
        more = {s for s in sizes if s not in stopped and share[s] > 3 * sizes[s]}
        if not more:
            return share
        stopped |= more


def mixture():
    rnd = random.Random(12)
    rows = [(None, None, None), (None, None, "a b"), (1, "é", None), (2, "B", "x " * 3000), (2, "B", "x " * 3000), (3, "empty", ""), (4, "tiny", "one")]
    rows += [(5, "hot", "same three words")] * 400
    rows += [(k, rnd.choice(["hot", "hot", "B", "a", "é", None]), "w " * int(rnd.lognormvariate(3, 1))) for k in range(10, 900)]
    return rows


def test_mixture_follows_the_contract(spark):
    rows = mixture()
    got = mixed(docs_of(spark, rows)).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d, s, len(WORDS.findall(t or ""))) for d, s, t in rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    want = brute_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        ratio = min(want[r["source"]] / sizes[r["source"]], 3) if sizes[r["source"]] else 0
        assert r["taken"] in {r["size"] * math.floor(ratio), r["size"] * math.ceil(ratio)}
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in ("hot", "a", "é", None):
        assert abs(taken[s] - want[s]) <= 20
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_mixture_does_not_depend_on_partitions_or_order(spark):
    rows = mixture()
    first = Counter(tuple(r) for r in mixed(docs_of(spark, rows, 2)).collect())
    random.Random(3).shuffle(rows)
    assert Counter(tuple(r) for r in mixed(docs_of(spark, rows, 9)).collect()) == first


def test_many_chunks_fly_again(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rows = [(k, "ab"[k % 2], "w " * (k % 37 + 1)) for k in range(800)]
    got = mixed(docs_of(spark, rows)).collect()
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 40


def test_a_source_of_few_documents_lands_at_the_best_of_all_ways():
    rnd = np.random.default_rng(2)
    for _ in range(20):
        size, p = rnd.integers(0, 90, 8).astype(float), np.full(8, rnd.random())
        got = landing(size, p, size.mean())

        def miss(x):
            return round(abs(size @ x - size @ p) / max(size.mean(), 1) + 0.1 * abs(sum(x) - p.sum()), 9)

        assert miss(got) == min(miss(np.array(x)) for x in itertools.product((0, 1), repeat=8))


def test_the_flight_keeps_both_totals_and_the_probabilities():
    size = np.array([5.0, 5, 9, 14, 200, 3, 3, 0, 61, 7] * 30)
    p = np.full(300, 0.37)
    runs = []
    for seed in range(200):
        q = flight(size, p, np.random.default_rng(seed))
        assert ((q > 0) & (q < 1)).sum() <= 2
        assert q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)
        runs.append(q)
    assert abs(np.mean(runs, axis=0) - 0.37).max() < 0.15  # inclusion probabilities are kept


def test_empty_mixture(spark):
    assert mixed(docs_of(spark, [])).collect() == []
    assert [tuple(r) for r in mixed(docs_of(spark, [(1, "a", None)])).collect()] == [(1, "a", 0, 0, 0.0, 0)]


# -- 13 ----------------------------------------------------------------------------------------------------------------
VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute_negatives(rows):
    valid = set()
    for i, v, y in rows:
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v):
            y = (y + 1) % 10 if i % 7 == 0 else y
            valid.add((i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = Counter()
    for a, y, v in valid:
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in valid if i != a and len(w) == len(v))
        for s, p, z in [x for x in scored if x[2] == y][:5]:
            fits = [(n, i) for n, i, z2 in scored if z2 != y and 50 * -s <= 100 * -n <= 95 * -s]
            for rank, (n, i) in enumerate(fits[:3], 1):
                out[a, p, rank, i, -s, -n] += 1
    return out


def odd_vectors():
    rnd = np.random.default_rng(13)
    rows = [(i, [float(x) for x in rnd.normal(size=4) + 0.6], int(rnd.integers(0, 3))) for i in range(300)]
    rows += [(400, None, 1), (401, [1.0, None, 0.0, 0.0], 1), (402, [1.0, float("nan"), 0.0, 0.0], 1), (403, [1.0, 0.5, 0.25, 0.125], None), (None, [1.0] * 4, 1)]
    rows += [(450, [1.0, 1.0], 2), (451, [0.7, 1.0], 2), (452, [0.7, 0.6], 3), (500, [], 1), (501, [], 1), (502, [], 2), (550, [0.0] * 4, 1)]
    rows += [rows[50], rows[51], (51, [1.0, 1.0, 1.0, 1.0], 1)] + [(600 + k, [0.5, 0.5, 0.5, 0.5], k % 2) for k in range(60)]  # repeated rows, ties
    return rows


@pytest.mark.parametrize("small", [{}, {"block": 16, "span": 2, "group": 3}])
def test_negatives_equal_brute_force(spark, small):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECS).select("*", *[F.lit("x").alias(c) for c in EXTRA])
    got = hard_negatives(df, F.col("id") % 50 == 0, F.col("id") % 7 == 0, **small)
    want = brute_negatives(rows)
    assert len(want) > 50
    assert Counter(tuple(r) for r in got.collect()) == want


def test_large_components_are_exact(spark):
    rows = [(k, [1e6 + k, 2e6 - k, 1.0, -3e5], k % 3) for k in range(120)]
    df = spark.createDataFrame(rows, VECS)
    assert Counter(tuple(r) for r in hard_negatives(df, F.col("id") % 50 == 0, F.col("id") % 7 == 0).collect()) == brute_negatives(rows)


def test_no_negatives_of_nothing(spark):
    df = spark.createDataFrame([], VECS)
    assert hard_negatives(df, F.col("id") % 50 == 0, F.col("id") % 7 == 0).collect() == []


def test_the_curve_visits_neighbours():
    for dims in (2, 3):
        cells = np.array(list(itertools.product(range(2**BITS), repeat=dims)))
        order = np.argsort(np.array(hilbert_keys(cells, BITS), dtype=object), kind="stable")
        steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold_all_products():
    rnd = np.random.default_rng(4)
    a, rows = rnd.integers(-99, 99, (20, 6)).astype(float), rnd.integers(-99, 99, (50, 6)).astype(float)
    least, most = bounds(a, rows.min(axis=0)[None], rows.max(axis=0)[None])
    products = a @ rows.T
    assert (least <= products).all() and (products <= most).all()
