"""What the operators on pairs of records share: the exact check of candidates, and the way from representatives back to all copies."""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.shingles import jaccard, shingle_set


#: Texts with more than one of so many rows are joined with their representative by broadcast; there are fewer of them than that.
HOT, LEAST_HOT = 1024, 100_000


def with_representatives(signed: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """(rec_no, rep, kept): every row of ``signed`` under the smallest rec_no of the rows with the same keys.

    The smallest is found by an aggregate that combines before its shuffle; the way back is a broadcast for the few texts that have very
    many rows and a shuffle for the rest, so a text with a third of all rows is no single task's work.
    """
    reps = signed.groupBy(*keys).agg(F.min("rec_no").alias("rep"), F.count(F.lit(1)).alias("_n"))
    hot = F.col("_n") > max(LEAST_HOT, math.ceil(signed.count() / HOT))
    few = reps.where(hot).drop("_n").collect()  # fewer than HOT
    rows = signed.select("rec_no", *keys, *[k for k in kept if k not in keys])
    if not few:
        return rows.join(reps.drop("_n"), keys).select("rec_no", "rep", *kept)
    tried = rows.join(F.broadcast(signed.sparkSession.createDataFrame(few, reps.drop("_n").schema)), keys, "left")
    rest = tried.where("rep is null").drop("rep").join(reps.where(~hot).drop("_n"), keys)
    return tried.where("rep is not null").select("rec_no", "rep", *kept).unionByName(rest.select("rec_no", "rep", *kept))


def verify(candidates: DataFrame, rows: DataFrame, key: str, first: str, second: str, threshold: float) -> DataFrame:
    """Candidates (a, b) for which both texts have a similarity of at least ``threshold``: (a, b, sim_first, sim_second).

    ``rows`` has one row for each ``key``. Texts travel only for rows that are in some candidate.
    """
    wanted = candidates.select(F.col("a").alias("_k")).union(candidates.select("b")).distinct()
    texts = rows.select(F.col(key).alias("_k"), F.col(first).alias("x"), F.col(second).alias("y")).join(wanted, "_k", "left_semi")
    left = texts.select(F.col("_k").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = texts.select(F.col("_k").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))

    def check(batches):
        sets = lru_cache(maxsize=512)(shingle_set)
        for batch in batches:
            out = []
            for a, b, ax, ay, bx, by in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ax", "ay", "bx", "by"))):
                sx = jaccard(sets(ax), sets(bx))
                if sx >= threshold:
                    sy = jaccard(sets(ay), sets(by))
                    if sy >= threshold:
                        out.append((a, b, sx, sy))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())], ["a", "b", "sim_first", "sim_second"])

    joined = candidates.join(left, "a").join(right, "b").select("a", "b", "ax", "ay", "bx", "by")
    return joined.mapInArrow(check, "a bigint, b bigint, sim_first double, sim_second double")
