"""Exact ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_hash(seed: int, *columns: str) -> Column:
    """32 hexadecimal digits that order rows at random, the same on every run with the same seed: the MD5 of seed and values, joined by
    colons. Nulls count as empty."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def hashed_rank(df: DataFrame, keys: Sequence[str], ties: Sequence[str], seed: int, name: str = "rank", slices: int = 256) -> DataFrame:
    """``df`` with the rank of each row (1, 2, ...) in its group of ``keys`` (none: in all) under a seeded random order.

    The hash range is cut into ``slices`` (16 or 256), by its first digits; a row's rank is the number of rows in earlier slices of its
    group plus its position within its own slice. Only slices are ever sorted, so a group with a third of all rows is spread over
    ``slices`` tasks. ``ties`` are columns that identify a row; rows equal in them all get distinct ranks in no defined order. Null keys
    form a group.
    """
    tmp = ["_sw_hash", "_sw_slice", "_sw_before"]
    if clash := set(tmp + [name]) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} are used by hashed_rank")
    df = df.withColumn(tmp[0], seeded_hash(seed, *ties)).withColumn(tmp[1], F.substring(tmp[0], 1, 1 if slices <= 16 else 2))
    counts = df.groupBy(*keys, tmp[1]).agg(F.count(F.lit(1)).alias("_sw_n"))
    ahead = Window.partitionBy(*keys).orderBy(tmp[1]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(tmp[2], F.coalesce(F.sum("_sw_n").over(ahead), F.lit(0))).drop("_sw_n")
    right = counts.select(*[F.col(k).alias(f"_sw_{i}") for i, k in enumerate(keys)], F.col(tmp[1]).alias("_sw_s"), tmp[2])
    on = df[tmp[1]] == right["_sw_s"]
    for i, k in enumerate(keys):
        on &= df[k].eqNullSafe(right[f"_sw_{i}"])
    joined = df.join(right, on).drop("_sw_s", *[f"_sw_{i}" for i in range(len(keys))])
    inside = Window.partitionBy(*keys, tmp[1]).orderBy(tmp[0], *ties)
    return joined.withColumn(name, F.col(tmp[2]) + F.row_number().over(inside)).drop(*tmp)


def bounded_sample(df: DataFrame, rows: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """About ``rows`` rows in no order, all if there are no more and never more than twice as many: those whose keys' hash falls in a share
    of the range. Unlike the first rows of an order, nothing but the sample itself leaves the tasks."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(n // rows)) == 0).limit(2 * rows)
