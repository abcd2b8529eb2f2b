"""Quota samples, group splits, tokens and mixtures."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import group_split, mixture, quota_sample, tokens

# --- quotas


def plain_seats(cells, n):
    """Rows in the order of the rule, cut at n."""
    order = []
    for i, (share, have, least) in enumerate(cells):
        for r in range(1, have + 1):
            if share > 0 or r <= least:
                order.append((r > least, (r - 0.5) / share if share > 0 else float("inf"), i))
    return [sum(c == i for _, _, c in sorted(order)[:n]) for i in range(len(cells))]


@pytest.mark.parametrize("seed", range(25))
def test_seats_follow_the_priorities(seed):
    rng = random.Random(seed)
    cells = [(rng.choice([0.0, 0.013, 0.11, 0.2, 0.37]), rng.choice([0, 1, 5, 40, 300]), rng.choice([0, 3])) for _ in range(7)]
    n = rng.choice([0, 2, 10, 77, 400])
    got, want = quota_sample.seats(cells, n), plain_seats(cells, n)
    assert sum(got) == sum(want) and got == want


SAMPLE = "rec_no bigint, scenario string, quality struct<passed:boolean,coverage:struct<bucket:string,polarity:string>>, rank int"


def test_spelling_and_report(spark):
    cell = lambda s, b, p, ok=True: (s, {"passed": ok, "coverage": {"bucket": b, "polarity": p}})
    rows = [cell("QA-Rule ", " HIGH\n", "positive")] * 12 + [cell("qa rule", "mid", "Positive")] * 4 + [cell(None, "high", "positive")] * 3 + [cell("qa_rule", "high", "positive", False)] * 9 + [cell("qa_rule", "high", "positive", None), ("qa_rule", None), ("qa_rule", {"passed": True, "coverage": None})]
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], SAMPLE)
    targets = spark.createDataFrame([("qa_rule", "high", "positive", 0.5, 3), ("qa_rule", "mid", "positive", 0.4, 3), ("qa_rule", "hard", "positive", 0.1, 2)], "scenario string, bucket string, polarity string, target_share double, min_rows bigint")
    plan = {r.bucket: r for r in quota_sample.quota_plan(df, targets, 0.5).collect()}  # pool 20, n 10
    assert (plan["high"].pool_records, plan["high"].wanted, plan["high"].short) == (12, 5.0, False)
    assert (plan["mid"].pool_records, plan["mid"].short) == (4, False) and (plan["hard"].pool_records, plan["hard"].wanted, plan["hard"].short) == (0, 2.0, True)
    got = quota_sample.quota_sample(df, targets, 0.5).collect()
    assert Counter(r.bucket for r in got) == {"high": 6, "mid": 4} and len({r.rec_no for r in got}) == 10
    assert all(r.floor == (r["rank"] <= 3) for r in got)
    assert quota_sample.quota_sample(df.limit(0), targets).count() == 0 and quota_sample.quota_plan(df.limit(0), targets).where("taken > 0").count() == 0


# --- groups


def test_cited_file(spark):
    rows = [("a\\b//c.py", None, "a/b/c.py"), ("./x.py", None, "x.py"), (None, ".\\p\\q.py:z:1", "p/q.py"), ("", "y.py", "y.py"), (None, None, None), ("", "", None), ("./", "k", None)]
    got = [r[0] for r in spark.createDataFrame([r[:2] for r in rows], "f string, s string").select(group_split.cited_file(F.col("f"), F.col("s"))).collect()]
    assert got == [r[2] for r in rows]


def test_groups_equal_union_find(spark):
    rng = random.Random(5)
    refs = [(rng.randrange(60), f"f{rng.randrange(70)}", None) for _ in range(90)] + [(i, "hot", "x") for i in range(100, 130)] + [(None, "f1", None), (7, None, None), (200, None, "f3:a:1")]
    df = spark.createDataFrame([(*r, "clash") for r in refs], "sample_no bigint, file_path string, symbol_id string, file string")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for s, f, i in refs:
        f = f or (i.split(":")[0] if i else None)
        if s is not None and f:
            a, b = find(("s", s)), find(("f", f))
            parent[b] = a
    groups = defaultdict(list)
    for x in list(parent):
        if x[0] == "s":
            groups[find(x)].append(x[1])
    want = {s: min(g) for g in groups.values() for s in g}
    assert {r.rec_no: r.group_no for r in group_split.sample_groups(df).collect()} == want
    assert group_split.sample_groups(df.limit(0)).count() == 0


def test_splits_keep_groups_and_meet_targets(spark):
    rng = random.Random(1)
    samples = spark.createDataFrame([(i, rng.choice(["qa_rule", "QA-rule", "arch_design", None])) for i in range(1500)], "rec_no bigint, scenario string")
    refs = spark.createDataFrame([(i, "giant" if i < 500 else f"f{rng.randrange(300)}", None) for i in range(1200)], "sample_no bigint, file_path string, symbol_id string")
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], "split string, target_share double")
    got = group_split.group_splits(samples, refs, targets, steps=4000).collect()
    assert sorted(r.rec_no for r in got) == list(range(1500))
    places = defaultdict(set)
    for r in got:
        places[r.group_no].add(r.split)
    assert all(len(p) == 1 for p in places.values())
    share = Counter(r.split for r in got)
    assert abs(share["train"] / 1500 - 0.8) < 0.02 and abs(share["val"] / 1500 - 0.1) < 0.02
    assert group_split.group_splits(samples.limit(0), refs, targets).count() == 0


def test_annealing_keeps_its_best():
    rng = np.random.default_rng(3)
    x = rng.integers(1, 9, (300, 1)).astype(float)
    goal = np.array([[0.6], [0.4]]) * x.sum()
    start = np.zeros(300, dtype=int)
    place, cost = group_split.anneal(x, start, goal, 1, 3000)
    gap = np.array([x[place == s].sum() for s in (0, 1)]) - goal[:, 0]
    assert abs((np.square(gap / x.sum())).sum() - cost) < 1e-9 and cost < 1e-4
    assert group_split.anneal(np.zeros((0, 1)), np.zeros(0, dtype=int), goal * 0, 1, 10)[1] == 0


# --- tokens

TEXTS = ["", None, " ", "Hello, world! It's 42.", "a\r\n\r\n  b\t\tc   ", "列表在截断之前按 `x` 排序。", "👩‍💻 é naïve\u200b\u2028\u00a0x\ufeff", "<|endoftext|> ok", "\x00\x1c\x1f\x85 control", "x" * 5000, "don't  we'll I'm 'tis", "١٢٣ ४५६ Ⅷ ½"]


def test_encoding_equals_the_library_and_decodes(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS * 2)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tokens.encode(df).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(TEXTS * 2)}
    back = {r.doc_id: r.text for r in tokens.decode(tokens.encode(df)).collect()}
    assert back == dict(enumerate(TEXTS * 2))
    odd = spark.createDataFrame([(1, [0, None, 99_999_999, -1, 1]), (2, None), (3, [222])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.text for r in tokens.decode(odd).collect()} == {1: '!"', 2: None, 3: "\ufffd"}
    assert tokens.encode(df.limit(0)).count() == 0


def test_chunks_and_common_words(spark, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 100)
    monkeypatch.setattr(tokens, "COMMON", 8)
    texts = ["the end of the line", "", None, "the " * 200, "x" * 90 + " the", "rare words only here"] * 7
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    coded = tokens.encode(df)
    plain = tokens._encoder(tokens.ranks())
    words = lambda t: __import__("regex").findall(tokens.WORDS.replace("IsWhite_Space", "White_Space"), t or "")
    assert {r.doc_id: r.ids for r in coded.collect()} == {i: [x for w in words(t) for x in plain.encode_ordinary(w)] for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in tokens.decode(coded).collect()} == dict(enumerate(texts))


# --- mixtures


@pytest.mark.parametrize("seed", range(12))
def test_knapsack_is_optimal(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
    target = rng.randrange(0, 120)
    best = max(s for picks in itertools.product(*[range(c + 1) for c in counts.values()]) if (s := sum(k * n for k, n in zip(picks, counts))) <= target)
    got = mixture.knapsack(target, counts)
    assert sum(n * k for n, k in got.items()) == best and all(k <= counts[n] for n, k in got.items())


def test_fit_comes_near_for_large_targets():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 60) for n in range(50, 4000, 7)}
    size = sum(n * c for n, c in counts.items())
    for target in (0, 1, 12_345, size // 3, size - 1, size, size + 5):
        got = mixture.fit(target, counts)
        total = sum(n * k for n, k in got.items())
        assert all(0 <= k <= counts[n] for n, k in got.items()) and total <= target
        assert min(target, size) - total < 60 and (total == target or target < 60 or target > size - 60)


def test_budgets_redistribute():
    got = mixture.budgets(1000, [("a", 0.5, 100, 2), ("b", 0.3, 1000, 2), ("c", 0.2, 1000, 1), ("d", 0.0, 50, 3)])
    assert got == {"a": 200, "b": 480, "c": 320, "d": 0}
    assert mixture.budgets(10, []) == {} and sum(mixture.budgets(1000, [("a", 1.0, 10, 3)]).values()) == 30


def test_mixture_meets_shares_and_caps(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice(["cat", "dog", "tree", "river"]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60)), "big") for i in range(400)] + [(1000 + i, text(30), "Small ") for i in range(10)] + [(2000, None, "big"), (2001, "", "big"), (2002, text(20), None), (2003, text(10), "other"), (None, text(5), "big")]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id bigint, text string, source string, copies int")
    targets = spark.createDataFrame([("big", 0.6, 2), ("small", 0.4, 3), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    mix, shares = mixture.mixture(df, targets)
    rows = mix.collect()
    assert all(1 <= r.copies <= (2 if r.source == "big" else 3) for r in rows) and {2000, 2001, 2002, 2003}.isdisjoint({r.doc_id for r in rows})
    s = {r.source: r for r in shares.collect()}
    assert s["small"].capped and s["small"].tokens == 3 * s["small"].available_tokens and s["none"].tokens == 0
    total = sum(r.tokens for r in s.values())
    corpus = sum(r.n_tokens for r in mixture.sized(df).collect())
    assert corpus - 3 <= total <= corpus
    again = {(r.doc_id, r.copies) for r in mixture.mixture(df, targets)[0].collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    assert mixture.mixture(df.limit(0), targets)[0].count() == 0


def test_long_documents_keep_to_the_budget(spark):
    docs = [(i, "cat " * 20_000, "a") for i in range(6)] + [(100 + i, "dog " * (i + 1), "a") for i in range(200)] + [(500 + i, "tree " * 900, "b") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.7, 2)], "source string, target_share double, max_repeats int")
    mix, shares = mixture.mixture(df, targets)
    got = {r.source: r for r in shares.collect()}
    assert got["a"].actual_share <= 0.3 + 1e-4 and got["a"].repeats == 1 and mix.where("source = 'a'").count() > 0


def test_long_documents_fill_the_budget(spark):
    lengths = [20_000 + 680 * i for i in range(60)]
    total = 2 * sum(lengths)
    rows = [(i, "a", n) for i, n in enumerate(lengths)] + [(100, "b", sum(lengths))]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint").withColumn("length", mixture.length_class(F.col("n_tokens")))
    for share in (0.1, 0.25):  # of a corpus of twice the size: parts of 0.2 and 0.5
        targets = spark.createDataFrame([("a", share, 1), ("b", 1 - share, 2)], "source string, target_share double, max_repeats int")
        got = [r.n_tokens for r in mixture._ranked(sizes, mixture.plan_mixture(sizes, targets, 9), 9).where("source = 'a' and rank <= k").collect()]
        assert share * total - max(lengths) / 2 < sum(got) <= share * total
        assert min(got) < 30_000 and max(got) > 50_000


def test_long_classes_are_rounded_together():
    classes = {-c: (1, 20_000 + 600 * c) for c in range(60)}
    size = sum(most for _, most in classes.values())
    for share in (0.2, 0.3, 0.5):
        got = mixture.fit_long(int(share * size), share, classes)
        assert abs(sum(got.values()) - 60 * share) <= 1 and sum(k * classes[c][1] for c, k in got.items()) <= share * size
