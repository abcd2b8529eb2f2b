"""Greedy deduplication against loops in plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from sievework.functions.similarity import simhash_values
from sievework.operators import dedup, retrieval
from sievework.plans.scratch import Scratch


def plain_simhash(text, bits=64):
    if not text:
        return 0
    low = text.lower()
    grams = low.split() + [low[i : i + 3] for i in range(len(low) - 2)]
    votes = [0] * bits
    for g in grams:
        h = int(hashlib.md5(g.encode()).hexdigest(), 16)
        for i in range(bits):
            votes[i] += 1 if h >> i & 1 else -1
    return sum(1 << i for i in range(bits) if votes[i] > 0)


@pytest.mark.parametrize("text", ["", "a", "ab c", "naïve été 如何 配置", "The same words, again and again " * 20, " 　x\ty"])
def test_simhash(text):
    for bits in (64, 12):
        assert [int(x) % (1 << 64) for x in simhash_values(["", text, None, "x y", text], bits)] == [plain_simhash(t, bits) for t in ("", text, "", "x y", text)]


def greedy_rows(fps, k):
    kept, out = [], {}
    for row, fp in sorted(fps):
        hit = next(((r, bin((f ^ fp) & (1 << 64) - 1).count("1")) for r, f in kept if bin((f ^ fp) & (1 << 64) - 1).count("1") <= k), None)
        if hit:
            out[row] = (False, *hit)
        else:
            kept.append((row, fp))
            out[row] = (True, row, 0)
    return out


@pytest.mark.parametrize("seed,bits,k", [(1, 12, 2), (2, 10, 1), (3, 64, 3), (4, 9, 0)])
def test_simhash_dedup(spark, seed, bits, k):
    rng = random.Random(seed)
    base = [rng.getrandbits(bits) for _ in range(25)]
    fps = [(i, b ^ (1 << rng.randrange(bits)) * rng.randrange(2) ^ (1 << rng.randrange(bits)) * rng.randrange(2)) for i, b in enumerate(rng.choices(base, k=70))]
    fps = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in fps]
    got = dedup.simhash_dedup(spark.createDataFrame(fps, "row bigint, fp bigint"), k).collect()
    assert {r.row: (r.kept, r.kept_row, r.distance) for r in got} == greedy_rows(fps, k)


def test_near_pairs_lose_none(spark):
    rng = random.Random(9)
    fps = {}
    for i in range(120):
        f = rng.getrandbits(64) if i % 3 == 0 or not fps else rng.choice(list(fps.values())) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
        if f not in fps.values():
            fps[i] = f
    rows = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in fps.items()]
    got = {(r.a, r.b, r.distance) for r in dedup.near_pairs(spark.createDataFrame(rows, "row bigint, fp bigint"), 3).collect()}
    want = {(i, j, bin(fps[i] ^ fps[j]).count("1")) for i in fps for j in fps if i < j and bin(fps[i] ^ fps[j]).count("1") <= 3}
    assert got == want and want


@pytest.fixture
def small_driver(spark):
    """Tables that seem to have at most 600 kB are broadcast, which fails if they turn out to have more than 2 MB in the driver."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "600k", "spark.sql.maxBroadcastTableSize": "2m"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield spark
    for key in limits:
        spark.conf.unset(key)


def near_rows(n, seed):
    """(row, fp) of 2 n rows: each fingerprint and one a bit from it."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    rows = list(range(2 * n))
    rng.shuffle(rows)
    return list(zip(rows, base + [f ^ 1 << rng.randrange(60) for f in base]))


def test_near_pairs_leave_the_driver_alone(small_driver):
    fps = near_rows(1500, 6)
    df = Scratch(small_driver, "t").write(small_driver.createDataFrame(fps, "row bigint, fp bigint"))  # small as a file, not as posts
    want = {tuple(sorted((fps[i][0], fps[i + 1500][0]))) for i in range(1500)}
    assert {(r.a, r.b) for r in dedup.near_pairs(df, 3).collect()} == want


def test_simhash_dedup_leaves_the_driver_alone(small_driver):
    fps = near_rows(15000, 7)
    got = dedup.simhash_dedup(small_driver.createDataFrame(fps, "row bigint, fp bigint"), 3).collect()
    first = {x: min(fps[i][0], fps[i + 15000][0]) for i in range(15000) for x in (fps[i][0], fps[i + 15000][0])}
    assert {r.row: (r.kept, r.kept_row) for r in got} == {x: (x == y, y) for x, y in first.items()}


def test_greedy_leaves_the_driver_alone(small_driver):
    pairs = small_driver.range(100_000).selectExpr("2 * id as a", "2 * id + 1 as b")
    assert dedup.greedy(pairs, Scratch(small_driver, "t")).count() == 100_000


def semantic_rows(vecs, t, window):
    kept, out = [], {}
    for row, v in vecs:
        if v is None:
            kept.append((row, None))
            out[row] = (True, row)
            continue
        hit = None
        for r, k in kept[-window:] if window else kept:
            if k is not None and np.dot(k, v) / np.linalg.norm(k) / np.linalg.norm(v) >= t:
                hit = r
                break
        if hit is None:
            kept.append((row, v))
        out[row] = (hit is None, row if hit is None else hit)
    return out


@pytest.mark.parametrize("seed,window", [(1, 5), (2, 3), (3, None)])
def test_semantic_dedup(spark, seed, window):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 4))
    vecs = [(i, None if i % 17 == 5 else (centres[rng.integers(6)] + rng.normal(scale=0.25, size=4)).tolist()) for i in range(60)]
    got = dedup.semantic_dedup(spark.createDataFrame(vecs, "row bigint, vec array<double>"), 0.9, window).collect()
    assert {r.row: (r.kept, r.kept_row) for r in got} == semantic_rows(vecs, 0.9, window)


def test_greedy_walks_long_chains(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(2000)]
    edges = {tuple(sorted(rng.sample(range(5000, 5400), 2))) for _ in range(900)} | set(chain) | {(i, 9000) for i in range(5000, 5400)}
    state = {}
    for x in sorted({x for e in edges for x in e}):
        state[x] = not any(state[a] for a, b in edges if b == x)
    for walk in (dedup.WALK, 300):
        got = dedup.greedy(spark.createDataFrame(sorted(edges), "a bigint, b bigint"), Scratch(spark, "t"), walk)
        assert sorted(r.b for r in got.collect()) == sorted(x for x, kept in state.items() if not kept)


@pytest.mark.parametrize("threshold", [0.4, 0.92])
def test_cosine_pairs_lose_none(spark, monkeypatch, threshold):
    monkeypatch.setattr(dedup, "PACK", 16)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(9, 12))
    vecs = [(i, (centres[rng.integers(9) if i % 3 else 0] + rng.normal(scale=0.3, size=12)).tolist()) for i in range(220)]
    odd = [(900, None), (901, [0.0] * 12), (902, [1.0]), (903, [None] * 12), (904, vecs[0][1]), (905, vecs[0][1])]
    got = dedup.cosine_pairs(spark.createDataFrame(vecs + odd, "row bigint, vec array<double>"), threshold).collect()
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in vecs + odd[4:]}
    want = {(i, j) for i in good for j in good if i < j and good[i] @ good[j] >= threshold}
    assert sorted((r.a, r.b) for r in got) == sorted(want)


def test_nearest_all(spark):
    rng = np.random.default_rng(5)
    vecs = {i: np.round(rng.normal(size=3), 1) for i in range(150)}
    rows = [(i, v.tolist()) for i, v in vecs.items()] + [(500, None), (501, [1.0]), (502, [0.0] * 3), (503, [None] * 3)]
    queries = [(i, vecs[i].tolist()) for i in range(0, 150, 10)] + [(700, [2.0]), (701, None), (702, [0.0] * 3)]
    df, q = spark.createDataFrame(rows, "row bigint, vec array<double>").repartition(3), spark.createDataFrame(queries, "query bigint, vec array<double>")
    cos = lambda a, b: round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6) + 0.0
    want = {(i, k + 1, j) for i in range(0, 150, 10) for k, (_, j) in enumerate(sorted((-cos(vecs[i], v), j) for j, v in vecs.items() if v.any())[:4]) if vecs[i].any()} | {(700, 1, 501)}
    for most in (1 << 20, 100):
        assert {(r.query, r["rank"], r.row) for r in retrieval.nearest_all(df, q, 4, most).collect()} == want
    assert retrieval.nearest_all(df, q.limit(0), 4).count() == 0


def test_empty_tables(spark):
    assert dedup.simhash_dedup(spark.createDataFrame([], "row bigint, fp bigint")).count() == 0
    assert dedup.cosine_pairs(spark.createDataFrame([], "row bigint, vec array<double>"), 0.9).count() == 0


def test_question_dedup_keeps_the_first(spark):
    df = spark.createDataFrame([(3, "How?"), (1, "how?"), (2, "Why?"), (4, None), (5, "")], "id int, q string")
    assert sorted(r.id for r in dedup.question_dedup(df, "q", "id").collect()) == [1, 2, 4]
    assert [r.id for r in dedup.question_dedup(df, "q", "id", 2).collect()] == [1, 2]
