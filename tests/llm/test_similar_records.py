"""Near-duplicates and split overlaps against all pairs in plain Python."""

from __future__ import annotations

import glob
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import near_duplicates, pairs, split_overlap
from sievework.llm.shingles import Normal, jaccard, shingle_set
from sievework.plans.scratch import Scratch

WORDS = "ledger voucher cursor outbox tenant carrier parcel retry window digest grant roster 凭证 租户 发件箱 重试 naïve 12 7f".split()
SCHEMA = "rec_no bigint, instruction string, answer string, context string, split string, rep string, k1 int, quality struct<coverage:struct<source:string>>"


def text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def edited(rng, t, k):
    w = t.split()
    for _ in range(k):
        i = rng.randrange(len(w))
        w[i] = rng.choice(WORDS)
    if rng.random() < 0.3:
        i = rng.randrange(len(w))
        w = w[i:] + w[:i]
    return " ".join(w)


def records(seed, n=90):
    rng, rows = random.Random(seed), []
    for i in range(n):
        if i % 3 and rows:
            src = rng.choice(rows)
            ins, ans, con = (edited(rng, src[c] or "x", rng.randrange(6)) for c in (1, 2, 3))
            if rng.random() < 0.3:
                ins, ans, con = src[1] or "x", src[2] or "y", src[3] or "z"
        else:
            ins, ans, con = text(rng, 12), text(rng, 30), text(rng, 40)
        rows.append((i, ins, ans, con, rng.choice(["train", "train", "val", "test", None, "dev"]), "clash", 5, {"coverage": {"source": rng.choice(["user", None])}}))
    rows += [(n, None, text(rng, 20), None, "val", None, None, None), (n + 1, text(rng, 12), "", "", "train", None, None, None), (n + 2, "short", "too short", "x", "val", None, None, None)]
    return rows


def similar(rows, column):
    norm = lambda s: "".join(filter(str.isalnum, (s or "").lower()))
    ok = [r for r in rows if len(norm(r[1])) >= 20 and len(norm(r[column])) >= 60]
    sets = {r[0]: (shingle_set(r[1]), shingle_set(r[column])) for r in ok}
    return {(a[0], b[0]) for a in ok for b in ok if a[0] < b[0] and all(jaccard(sets[a[0]][k], sets[b[0]][k]) >= 0.6 for k in (0, 1))}


def test_normalised_shingles():
    texts = ["Ab-cD é１２ 汉字x", "", None, "abcd", "ABCDE!"]
    n = Normal(texts)
    assert n.lengths.tolist() == [len("".join(filter(str.isalnum, (t or "").lower()))) for t in texts]
    h, counts = n.shingles()
    assert counts.tolist() == [max(0, x - 4) for x in n.lengths] and len(h) == counts.sum()
    assert Normal(["xabcdey"]).shingles()[0][1] == Normal(["ABCDE"]).shingles()[0][0]
    assert Normal(["abcde"]).shingles(1)[0][0] != Normal(["abcde"]).shingles(2)[0][0]


def test_bit_estimate_follows_the_similarity():
    plan = near_duplicates.MinHashPlan()
    minima, sign = near_duplicates._signer(plan)
    rng = random.Random(3)
    base = text(rng, 60)
    other = [edited(rng, base, k) for k in (0, 3, 8, 20)]
    a = Normal([base] * 4)
    _, s1 = sign(minima(a, Normal([""] * 4)))
    _, s2 = sign(minima(Normal(other), Normal([""] * 4)))
    for i, o in enumerate(other):
        equal = plan.hashes - sum(bin(int(x) & (1 << 64) - 1).count("1") for x in np.bitwise_xor(s1[i], s2[i]))
        estimate = 2 * equal / plan.hashes - 1
        assert abs(estimate - jaccard(shingle_set(base), shingle_set(o))) < 0.25


@pytest.mark.parametrize("seed,bits", [(1, 1), (2, 2)])
def test_near_duplicates_equal_brute_force(spark, seed, bits):
    rows = records(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = near_duplicates.MinHashPlan(bits=bits)
    got = {tuple(r) for r in near_duplicates.all_pairs(*near_duplicates.near_duplicate_links(df, plan)).collect()}
    want = similar(rows, 2)
    assert got <= want and len(got) >= 0.97 * len(want) and want


def test_groups_hold_every_row_once(spark):
    rows = records(5)
    got = near_duplicates.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.rec_no for r in got) == [r[0] for r in rows]
    group = {r.rec_no: r.group_no for r in got}
    assert all(group[a] == group[b] for a, b in similar(rows, 2)) and all(g <= r for r, g in group.items())


def test_a_hot_text_is_one_representative(spark):
    rng = random.Random(7)
    ins, ans = text(rng, 12), text(rng, 30)
    rows = [(i, ins.upper() if i % 2 else ins, ans, None, "train", None, None, None) for i in range(60)] + [(100 + i, text(rng, 12), text(rng, 30), None, None, None, None, None) for i in range(20)]
    links, members = near_duplicates.near_duplicate_links(spark.createDataFrame(rows, SCHEMA))
    assert links.count() == 0 and members.where("rep = 0").count() == 60
    assert near_duplicates.all_pairs(links, members).count() == 60 * 59 // 2


def test_hot_texts_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(pairs, "LEAST_HOT", 5)
    rows = records(4)
    rows += [(500 + i, rows[0][1], rows[0][2], rows[0][3], "train" if i % 2 else "val", None, None, None) for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in near_duplicates.all_pairs(*near_duplicates.near_duplicate_links(df)).collect()}
    assert got <= similar(rows, 2) and len(got) >= 0.97 * len(similar(rows, 2))
    side = {r[0]: r[4] for r in rows}
    want = {(a, b) for a, b in similar(rows, 3) if {side[a], side[b]} <= {"train", "val", "test"} and (side[a] == "train") != (side[b] == "train")}
    assert {tuple(r) for r in split_overlap.overlap_pairs(*split_overlap.overlap_links(df)).collect()} == want


def test_counters_grow_with_the_records():
    assert [split_overlap.count_bits(n) for n in (0, 1_000_000, 4_000_000, 5_000_000, 1 << 40)] == [17, 17, 18, 19, 21]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_is_exact(spark, seed):
    rows = records(seed, 120)
    got = {tuple(r) for r in split_overlap.overlap_pairs(*split_overlap.overlap_links(spark.createDataFrame(rows, SCHEMA))).collect()}
    side = {r[0]: r[4] for r in rows}
    want = {(a, b) for a, b in similar(rows, 3) if {side[a], side[b]} <= {"train", "val", "test"} and (side[a] == "train") != (side[b] == "train")}
    assert got == want and want


def test_overlap_of_repeated_letters_is_exact(spark):
    con = text(random.Random(9), 40)
    rows = [(i, ins, "x", con, split, "clash", 5, None) for i, (ins, split) in enumerate((ins, split) for ins in ("abc" * 8, "ABC" * 9, "z" * 24, "ab" * 12, "abcd" * 6, "abcabd" + "abc" * 7, "abcde" * 5) for split in ("train", "val", "test"))]
    got = {tuple(r) for r in split_overlap.overlap_pairs(*split_overlap.overlap_links(spark.createDataFrame(rows, SCHEMA))).collect()}
    want = {(a, b) for a, b in similar(rows, 3) if (rows[a][4] == "train") != (rows[b][4] == "train")}
    assert got == want and {(0, 1), (6, 7), (9, 11)} <= want


def test_overlap_is_exact_where_shingles_share_bits_and_positions_end(spark, monkeypatch):
    rows = records(4, 120)
    prefixes = split_overlap._prefixes
    monkeypatch.setattr(split_overlap, "_prefixes", lambda *args: prefixes(*args).withColumn("prefix", F.transform("prefix", lambda t: t % 97)))
    monkeypatch.setattr(split_overlap, "POSITION_BITS", 3)
    monkeypatch.setattr(split_overlap, "SLICES", 3)
    got = {tuple(r) for r in split_overlap.overlap_pairs(*split_overlap.overlap_links(spark.createDataFrame(rows, SCHEMA))).collect()}
    side = {r[0]: r[4] for r in rows}
    want = {(a, b) for a, b in similar(rows, 3) if {side[a], side[b]} <= {"train", "val", "test"} and (side[a] == "train") != (side[b] == "train")}
    assert got == want and want


def test_overlap_frees_the_disk_step_by_step(spark, monkeypatch):
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    write, left = Scratch.write, {}

    def watched(self, df, name="t", **options):
        before, until = shuffled(), time.monotonic() + 10
        out = write(self, df, name, **options)
        while shuffled() - before and time.monotonic() < until:
            time.sleep(0.1)
        left[name] = shuffled() - before
        return out

    monkeypatch.setattr(Scratch, "write", watched)
    scratch = Scratch(spark, "split-overlap")
    links, members = split_overlap.overlap_links(spark.createDataFrame(records(6, 120), SCHEMA), scratch=scratch)
    assert links.count() and members.count() and not any(left.values()), left
    assert sorted(t.split("-")[1] for t in os.listdir(scratch.root.removeprefix("file://"))) == ["links", "members"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_overlap_report_counts_all_rows(spark):
    rows = records(2, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    report = split_overlap.overlap_report(df).collect()
    assert sum(r.records for r in report) == sum(r[4] in ("train", "val", "test") for r in rows)
    assert sum(r.overlapping for r in report) == split_overlap.overlapping_records(df).count() > 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_duplicates.near_duplicate_groups(df).count() == 0
    assert near_duplicates.all_pairs(*near_duplicates.near_duplicate_links(df)).count() == 0
    assert split_overlap.overlap_report(df).count() == 0
