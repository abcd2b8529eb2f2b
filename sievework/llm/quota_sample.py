"""A sample whose cells match target shares, by divisor-method priorities.

The record of random rank r in a cell with target share s has the priority (r - 0.5) / s. Records up to each cell's floor come first, then
the globally smallest priorities until the sample is full; a cell that runs out simply has no more priorities, so its seats go to the rest.
How many seats a cell gets depends on counts alone, so only the counts of the cells reach the driver, and no task sorts a whole cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ranking import hashed_rank

CELL = ("scenario", "bucket", "polarity")


def spelled(value: Column) -> Column:
    """Lower case, no outer blanks, ``_`` for ``-`` and blanks inside; null for nothing."""
    trimmed = F.regexp_replace(F.lower(value), r"(?U)^\s+|\s+$", "")
    return F.nullif(F.regexp_replace(trimmed, r"(?U)[\s-]", "_"), F.lit(""))


def passed_pool(samples: DataFrame) -> DataFrame:
    """(rec_no, scenario, bucket, polarity) of every row with quality.passed true, repeated rows too; the cell in its plain spelling."""
    cov = "quality.coverage"
    return samples.where("quality.passed").select("rec_no", spelled(F.col("scenario")).alias("scenario"), spelled(F.col(f"{cov}.bucket")).alias("bucket"), spelled(F.col(f"{cov}.polarity")).alias("polarity"))


def seats(cells: list[tuple[float, int, int]], n: int) -> list[int]:
    """Seats for cells (target share, records there, floor): at most n in all."""
    floor = [min(have, least) for _, have, least in cells]

    def taken(limit: float, have: list[int]) -> list[int]:
        return [0 if s <= 0 else max(0, min(h, math.floor(limit * s + 0.5))) for (s, _, _), h in zip(cells, have)]

    def fill(have: list[int], base: list[int]) -> list[int]:
        lo, hi = 0.0, 1.0
        count = lambda x: sum(map(max, taken(x, have), base))
        most = sum(max(b, h) for b, h, (s, _, _) in zip(base, have, cells) if s > 0) + sum(b for b, (s, _, _) in zip(base, cells) if s <= 0)
        if most <= n:
            return [max(b, h if s > 0 else 0) for b, h, (s, _, _) in zip(base, have, cells)]
        while count(hi) <= n:
            hi *= 2
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if count(mid) <= n else (lo, mid)
        out = [max(a, b) for a, b in zip(taken(lo, have), base)]
        open_ = sorted(((out[i] + 0.5) / s, i) for i, (s, _, _) in enumerate(cells) if s > 0 and out[i] < have[i])
        for _, i in open_[: n - sum(out)]:  # equal priorities, in the order of the cells
            out[i] += 1
        return out

    if sum(floor) >= n:
        return fill(floor, [0] * len(cells))
    return fill([have for _, have, _ in cells], floor)


def quota_plan(samples: DataFrame, targets: DataFrame, share: float = 0.3) -> DataFrame:
    """(scenario, bucket, polarity, target_share, min_rows, pool_records, wanted, taken, short): one row for each row of ``targets``.

    wanted is the larger of target_share * n and min_rows, with n the ``share`` of the pool, rounded down; short says that the pool holds
    fewer. The pool counts all passed rows, those without a cell too. Targets are a table of fixed size. An empty pool gives taken = 0.
    """
    spark = samples.sparkSession
    counts = {tuple(r[:3]): r[3] for r in passed_pool(samples).groupBy(*CELL).count().join(F.broadcast(targets.select(*CELL)), list(CELL), "left_semi").collect()}
    pool = samples.where("quality.passed").count()
    n = math.floor(share * pool + 1e-9)
    rows = sorted(targets.select(*CELL, "target_share", "min_rows").collect())
    got = seats([(r[3], counts.get(tuple(r[:3]), 0), r[4]) for r in rows], n)
    out = []
    for r, k in zip(rows, got):
        have, want = counts.get(tuple(r[:3]), 0), max(r[3] * n, float(r[4]))
        out.append((*r, have, want, k, have < want))
    return spark.createDataFrame(out, "scenario string, bucket string, polarity string, target_share double, min_rows bigint, pool_records bigint, wanted double, taken bigint, short boolean")


def quota_sample(samples: DataFrame, targets: DataFrame, share: float = 0.3, seed: int = 11) -> DataFrame:
    """(rec_no, scenario, bucket, polarity, rank, priority, floor): the rows drawn, floor for those taken to keep a cell's minimum.

    Nulls in quality count as not passed; a null or unknown scenario, bucket or polarity belongs to no cell. Repeated rows are rows.
    """
    plan = quota_plan(samples, targets, share)
    ranked = hashed_rank(passed_pool(samples).join(F.broadcast(plan.select(*CELL)), list(CELL), "left_semi"), CELL, ["rec_no"], seed)
    drawn = ranked.join(F.broadcast(plan.select(*CELL, "target_share", "min_rows", "taken")), list(CELL)).where("rank <= taken")
    return drawn.select("rec_no", *CELL, "rank", ((F.col("rank") - 0.5) / F.col("target_share")).alias("priority"), (F.col("rank") <= F.col("min_rows")).alias("floor"))
