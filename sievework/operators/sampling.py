"""Samples in a seeded random order, and quotas over levels.

How many rows a stratum gives follows from counts alone, so only counts by a few categories reach the driver; which rows these are is
decided by their rank in a seeded hash order (``ranking.hashed_rank``), which no single task sorts.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.coverage import BUCKETS, DEFAULT_TARGETS
from sievework.operators.lookup import numbered
from sievework.operators.ranking import hashed_rank

#: From which easier levels a level borrows.
BORROWS = {"hard": ("mid", "high"), "mid": ("high",)}


def hashed_sample(df: DataFrame, k: int, keys: Sequence[str], ties: Sequence[str], seed: int = 42) -> DataFrame:
    """k rows of each group in a seeded random order, with their rank; all of a group that has no more."""
    return hashed_rank(df, keys, ties, seed).where(F.col("rank") <= k)


def reservoir(df: DataFrame, k: int, order: str, seed: int = 42) -> DataFrame:
    """k rows, every set of k equally likely, with their rank; all of them if there are no more. ``order`` identifies a row."""
    return hashed_sample(df, k, [], [order], seed)


def replayed_reservoir(df: DataFrame, k: int, order: str, seed: int = 42) -> DataFrame:
    """The k rows that a single process would keep by reservoir sampling over the order with Python's generator, with their slot.

    A compatibility mode: the driver draws one number for each row and holds k of them.
    """
    n, rng = df.count(), random.Random(seed)
    slots = list(range(min(n, k)))
    for i in range(k, n):
        if (j := rng.randint(0, i)) < k:
            slots[j] = i
    picks = df.sparkSession.createDataFrame([(i, s) for s, i in enumerate(slots)], "_row bigint, slot bigint")
    return df.join(numbered(df.select(order), order, "_row").join(picks, "_row").drop("_row"), order)


def stratified(df: DataFrame, stratum: Column, targets: Mapping[str, int] | int, order: str, seed: int = 42) -> DataFrame:
    """Random rows of each stratum, as many as its target (strata without one give none), with stratum and rank. Null is the stratum unknown."""
    ranked = hashed_rank(df.withColumn("stratum", F.coalesce(stratum, F.lit("unknown"))), ["stratum"], [order], seed)
    if isinstance(targets, int):
        return ranked.where(F.col("rank") <= targets)
    wanted = df.sparkSession.createDataFrame([(s, int(k)) for s, k in targets.items()], "stratum string, _wanted bigint")
    return ranked.join(F.broadcast(wanted), "stratum").where("rank <= _wanted").drop("_wanted")


def by_coverage(samples: DataFrame, targets: Mapping[str, float], total: int, order: str, seed: int = 42) -> DataFrame:
    """int(total * ratio) rows of each level of quality.coverage.bucket."""
    return stratified(samples, F.col("quality.coverage.bucket"), {b: int(total * r) for b, r in targets.items()}, order, seed)


# --- quotas: counts decide how many, ranks decide which


def shares_of(targets: Mapping[str, float] | None) -> dict[str, float] | None:
    """The targets as shares of their sum, none where there is nothing to share."""
    whole = float(sum(targets.values())) if isinstance(targets, Mapping) else 0.0
    return {b: targets.get(b, 0.0) / whole for b in BUCKETS} if whole > 0 else None


def wanted_rows(total: int, shares: Mapping[str, float]) -> dict[str, int]:
    """Rows of each level: shares rounded half to even; what is then missing or too many is dealt out singly, the largest share first."""
    rows = {b: round(total * shares[b]) for b in BUCKETS}
    over = total - sum(rows.values())
    each, odd = divmod(abs(over), len(BUCKETS))
    for place, b in enumerate(sorted(BUCKETS, key=lambda b: -shares[b])):
        step = each + (place < odd)
        rows[b] = max(0, rows[b] + (step if over > 0 else -step))
    return rows


Cell = tuple[str, bool]


@dataclass
class QuotaPlan:
    """Which ranks of each cell (level, negative) are taken, and for which level: ``cuts`` holds (cell, ranks before, last rank, level)."""

    counts: Mapping[Cell, int]
    shares: dict[str, float]
    default: bool
    wanted: dict[str, int]
    cuts: list[tuple[Cell, int, int, str]] = field(default_factory=list)
    borrowed: dict[tuple[str, str], int] = field(default_factory=dict)
    negative_deficits: dict[str, int] = field(default_factory=dict)

    def used(self, cell: Cell) -> int:
        return sum(b - a for c, a, b, _ in self.cuts if c == cell)

    def filled(self, level: str) -> int:
        return sum(b - a for _, a, b, to in self.cuts if to == level)

    def deficit(self, level: str) -> int:
        return max(0, self.wanted[level] - self.filled(level))

    def cut(self, cell: Cell, rows: int, level: str) -> int:
        """Takes the next rows of a cell, as many as it has left."""
        at = self.used(cell)
        rows = max(0, min(rows, self.counts.get(cell, 0) - at))
        if rows:
            self.cuts.append((cell, at, at + rows, level))
        return rows


def quota_plan(counts: Mapping[Cell, int], targets: Mapping[str, float] | None, negative_ratio: float | None = None) -> QuotaPlan:
    """Seats from the counts of the cells. With a ratio that share of a level's seats goes to negatives, as far as both signs have rows;
    without one there is a single sign, False. A level that lacks rows then borrows from easier ones, their negatives first."""
    shares = shares_of(targets)
    plan = QuotaPlan(counts, shares or dict(DEFAULT_TARGETS), shares is None, {})
    plan.wanted = wanted_rows(sum(counts.values()), plan.shares)
    for b, seats in plan.wanted.items():
        negative = 0
        if negative_ratio is not None:
            due, there = round(seats * negative_ratio), counts.get((b, True), 0)
            plan.negative_deficits[b] = max(0, due - there)
            negative = plan.cut((b, True), max(due, seats - counts.get((b, False), 0)), b)  # where positives lack, negatives sit in
        plan.cut((b, False), seats - negative, b)
    for b, lenders in BORROWS.items():
        for lender in lenders:
            for sign in (True, False):
                if got := plan.cut((lender, sign), plan.deficit(b), b):
                    plan.borrowed[b, lender] = plan.borrowed.get((b, lender), 0) + got
    return plan


def level(samples: DataFrame) -> Column:
    b = F.col("quality.coverage.bucket")
    return F.when(b.isin(*BUCKETS), b).otherwise(F.lit("high"))


def quota_sample(samples: DataFrame, targets: Mapping[str, float] | None, order: str, seed: int = 42, negative_ratio: float | None = None) -> tuple[DataFrame, QuotaPlan]:
    """Samples whose levels follow the targets, a share of each negative; levels that lack rows borrow from easier ones.

    The rows come with ``filled``, the level whose place they take. Unknown and null levels count as high, a null polarity as not negative.
    """
    sign = F.coalesce(F.col("quality.coverage.polarity") == "negative", F.lit(False)) if negative_ratio is not None else F.lit(False)
    celled = samples.select(order, level(samples).alias("_level"), sign.alias("_negative"))
    counts = {(r["_level"], r["_negative"]): r["n"] for r in celled.groupBy("_level", "_negative").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = quota_plan(counts, targets, negative_ratio)
    cuts = samples.sparkSession.createDataFrame([(*cell, a, b, to) for cell, a, b, to in plan.cuts], "_level string, _negative boolean, _after bigint, _upto bigint, filled string")
    ranked = hashed_rank(celled, ["_level", "_negative"], [order], seed, "_rank")
    drawn = ranked.join(F.broadcast(cuts), ["_level", "_negative"]).where("_rank > _after and _rank <= _upto")
    return samples.join(drawn.select(order, "filled"), order), plan


def sample_or_pass(samples: DataFrame, targets: Mapping[str, float] | None, order: str, mode: str = "hybrid", min_size: int = 1, **options) -> tuple[DataFrame, dict]:
    """A quota sample, or all rows where the mode is upstream or there are fewer than ``min_size``; with a report."""
    n = samples.count()
    if mode == "upstream" or n == 0 or n < min_size:
        return samples, {"skipped": True, "reason": "mode" if mode == "upstream" else "size", "total": n}
    out, plan = quota_sample(samples, targets, order, **options)
    return out, {"skipped": False, "total": n, "targets": plan.shares, "used_default_targets": plan.default, "desired_counts": plan.wanted, "final_counts": {b: plan.filled(b) for b in BUCKETS}, "deficits": {b: plan.deficit(b) for b in BUCKETS}, "borrowed": {f"{a}<-{b}": k for (a, b), k in plan.borrowed.items()}, "negative_deficits": plan.negative_deficits}


# --- drawing labels for new questions: one uniform number for each row, from the seed and the row's key


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1), the same for equal seeds and keys: the first 13 hexadecimal digits of the MD5 of both. A null key counts as empty."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def weighted_choice(weights: Mapping[str, float], default: str, u: Column) -> Column:
    """The label whose part of the cumulated weights holds u; the default where all weights are 0."""
    total = sum(float(w) for w in weights.values()) if weights else 0.0
    if total <= 0:
        return F.lit(default)
    out, below = F, 0.0
    for name, w in weights.items():
        below += float(w)
        out = out.when(u * total <= below, F.lit(name))
    return out.otherwise(F.lit(default))


def one_of(values: Sequence[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.least(F.floor(u * len(values)).cast("int") + 1, F.lit(len(values))))


def maybe(ratio: float, values: Sequence[str], u: Column, v: Column) -> Column:
    """One of the values with probability ``ratio``, else null."""
    return F.when(u < ratio, one_of(values, v)) if values and ratio > 0 else F.lit(None).cast("string")
