"""Splits that keep related records together, by component swap search.

Samples that cite the same file are one group, also through other samples; groups are the connected components of the samples' files.
Every group starts in the split its hash falls in. Groups are then moved or exchanged between splits while that lowers, or by annealing at
times raises, the deviation of the splits' sizes and label counts from their targets. The search runs in parallel: groups are spread over
buckets that each aim at the overall shares, several chains search each bucket, and the best chain is kept. The few groups too large for a
bucket (there are at most 1 / LARGE of them) are placed first, on the driver, and the buckets make up for what these leave.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.quota_sample import spelled
from sievework.operators.components import connected_components, star_edges
from sievework.plans.scratch import Scratch

LARGE = 0.001
BUCKET = 5_000
LABELS = ("qa_rule", "arch_design")


def cited_file(file_path: Column, symbol_id: Column) -> Column:
    """The file of a reference: file_path, or if that is null or empty the symbol_id up to its first colon; null if there is none.
    ``\\`` becomes ``/``, repeated slashes one, a leading ``./`` goes."""
    raw = F.coalesce(F.nullif(file_path, F.lit("")), F.substring_index(symbol_id, ":", 1))
    return F.nullif(F.regexp_replace(F.regexp_replace(raw, r"[\\/]+", "/"), r"^(\./)+", ""), F.lit(""))


def sample_groups(evidence: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(rec_no, group_no): every sample with a known file and the smallest rec_no of its group.

    Rows without sample_no or file are left out, repeated rows and references count once. A file cited by a third of all rows costs a
    minimum, not pairs.
    """
    scratch = scratch or Scratch(evidence.sparkSession, "groups")
    links = evidence.select(F.col("sample_no").cast("bigint").alias("rec_no"), cited_file(F.col("file_path"), F.col("symbol_id")).alias("file")).where("rec_no is not null and file is not null").distinct()
    links = scratch.write(links, "links")
    components = connected_components(star_edges(links, "rec_no", "file"), scratch)
    return links.select("rec_no").distinct().join(components.withColumnRenamed("node", "rec_no"), "rec_no", "left").select("rec_no", F.coalesce("component", "rec_no").alias("group_no"))


def anneal(sizes: np.ndarray, start: np.ndarray, goal: np.ndarray, seed: int, steps: int) -> tuple[np.ndarray, float]:
    """Places of groups after the search, and their deviation. sizes: groups x (1 + labels) counts, goal: splits x (1 + labels)."""
    rng = np.random.default_rng(seed)
    m, k = len(sizes), len(goal)
    place = start.copy()
    gap = -goal.astype(float)
    np.add.at(gap, place, sizes)
    scale = 1.0 / np.maximum(goal.sum(axis=0), 1.0)
    now = least = float(np.square(gap * scale).sum())
    if m == 0 or k < 2:
        return place, least
    heat = max(now, 1e-9) * 0.05
    who, other, to, luck, swap = rng.integers(0, m, steps), rng.integers(0, m, steps), rng.integers(0, k, steps), rng.random(steps), rng.random(steps) < 0.5
    undo: list[tuple[int, int]] = []  # since the best places
    for i in range(steps):
        heat *= 0.999
        a, b = who[i], other[i]
        p, q = place[a], place[b] if swap[i] else to[i]
        if p == q:
            continue
        d = sizes[a] - sizes[b] if swap[i] else sizes[a]
        gp, gq = gap[p] - d, gap[q] + d
        new = now + float((np.square(gp * scale) + np.square(gq * scale) - np.square(gap[p] * scale) - np.square(gap[q] * scale)).sum())
        if new >= now and luck[i] >= math.exp(max(-700.0, (now - new) / heat)):
            continue
        gap[p], gap[q], now = gp, gq, new
        undo.append((a, p))
        place[a] = q
        if swap[i]:
            undo.append((b, q))
            place[b] = p
        if now < least:
            least = now
            undo.clear()
    for a, p in reversed(undo):
        place[a] = p
    return place, least


def group_splits(samples: DataFrame, evidence: DataFrame, targets: DataFrame, seed: int = 7, chains: int = 4, steps: int = 20_000) -> DataFrame:
    """(rec_no, group_no, split): one row for each row of ``samples`` with a rec_no.

    Samples without a known file, and null evidence, form groups of their own. Sizes are rows; labels are the scenarios of LABELS in their
    plain spelling and the rest. ``targets`` is a table of fixed size with the columns split and target_share.
    """
    spark, scratch = samples.sparkSession, Scratch(samples.sparkSession, "splits")
    goal_rows = sorted(targets.select("split", "target_share").collect(), key=lambda r: (-r[1], r[0]))
    names, shares = [r[0] for r in goal_rows], np.array([r[1] for r in goal_rows], dtype=float)
    shares = shares / shares.sum()
    groups = sample_groups(evidence, scratch)
    label = spelled(F.col("scenario"))
    each = samples.where("rec_no is not null").select("rec_no", *[F.coalesce((label == x), F.lit(False)).cast("bigint").alias(f"l{i}") for i, x in enumerate(LABELS)])
    each = each.join(groups, "rec_no", "left").withColumn("group_no", F.coalesce("group_no", "rec_no"))
    each = scratch.write(each, "samples")
    labels = [f"l{i}" for i in range(len(LABELS))]
    sized = scratch.write(each.groupBy("group_no").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in labels]), "sized")
    total = sized.agg(F.count(F.lit(1)).alias("groups"), *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n", *labels)]).first()
    whole = np.array([total[x] for x in ("n", *labels)], dtype=float)
    bound = max(2, math.ceil(LARGE * whole[0]))
    large = sorted(sized.where(F.col("n") >= bound).collect(), key=lambda r: (-r.n, r.group_no))
    gap, scale = np.outer(shares, whole), np.maximum(whole, 1)
    placed = []
    for r in large:
        x = np.array([r[c] for c in ("n", *labels)], dtype=float)
        s = int(np.argmin([(np.square((gap[i] - x) / scale) - np.square(gap[i] / scale)).sum() for i in range(len(names))]))
        gap[s] -= x
        placed.append((r.group_no, names[s]))
    rest = np.maximum(gap, 0)
    rest_share = rest / np.maximum(rest.sum(axis=0), 1)
    buckets = max(1, math.ceil((total.groups - len(large)) / BUCKET))

    def search(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("group_no")
        x = pdf[["n", *labels]].to_numpy(dtype=float)
        goal = rest_share * x.sum(axis=0)
        u = pdf["u"].to_numpy()
        start = np.minimum(np.searchsorted(np.cumsum(rest_share[:, 0]), u, side="right"), len(names) - 1)
        place, cost = anneal(x, start, goal, seed * 1000 + int(key[0]) * 31 + int(key[1]), steps)
        return pd.DataFrame({"bucket": key[0], "chain": key[1], "cost": cost, "group_no": pdf["group_no"], "split": [names[i] for i in place]})

    small = sized.where(F.col("n") < bound)
    h = F.xxhash64(F.lit(seed), "group_no")
    spread = small.select("group_no", "n", *labels, F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"), (F.pmod(F.shiftright(h, 20), F.lit(1 << 30)) / float(1 << 30)).alias("u"), F.explode(F.array(*[F.lit(i) for i in range(chains)])).alias("chain"))
    found = scratch.write(spread.groupBy("bucket", "chain").applyInPandas(search, "bucket int, chain int, cost double, group_no bigint, split string"), "found")
    best = found.groupBy("bucket").agg(F.min_by("chain", F.struct("cost", "chain")).alias("chain"))
    chosen = found.join(best, ["bucket", "chain"]).select("group_no", "split")
    chosen = chosen.unionByName(spark.createDataFrame(placed, "group_no bigint, split string"))
    return each.select("rec_no", "group_no").join(chosen, "group_no").select("rec_no", "group_no", "split")
