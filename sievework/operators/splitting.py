"""Splits by group: the package or directory of the first symbol a sample cites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.paths import directory_of, package_of, slashes
from sievework.operators.lookup import symbol_map
from sievework.operators.ranking import hashed_rank

NO_EVIDENCE, UNKNOWN_SYMBOL, DEFAULT_PACKAGE, ROOT = "_NO_EVIDENCE_", "_UNKNOWN_SYMBOL_", "_DEFAULT_PACKAGE_", "_ROOT_PATH_"
SPLITS = ("train", "val", "test")


def group_keys(samples: DataFrame, symbols: DataFrame, by: str = "package") -> DataFrame:
    """``samples`` with the column group_key; samples without evidence, and whose symbol is unknown, have groups of their own names."""
    if by not in ("package", "path"):
        raise ValueError(f"unknown grouping: {by}")
    known = symbol_map(symbols).select("sid", (package_of(F.col("qualified_name")) if by == "package" else directory_of(slashes(F.col("file_path")))).alias("_g"))
    refs = F.col("thought.evidence_refs")
    first = slashes(F.get(refs, F.lit(0))["symbol_id"])
    # samples without an id would all meet in one task: they get one of many keys that no symbol has
    spread = F.concat(F.lit("\0"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
    joined = samples.withColumn("_sid", F.coalesce(first, spread)).join(known, F.col("_sid") == known["sid"], "left")
    key = F.when(F.coalesce(F.size(refs), F.lit(0)) <= 0, NO_EVIDENCE).when(F.col("sid").isNull(), UNKNOWN_SYMBOL).when(F.col("_g") == "", DEFAULT_PACKAGE if by == "package" else ROOT).otherwise(F.col("_g"))
    return joined.withColumn("group_key", key).drop("_sid", "sid", "_g")


def cuts(n: int, train: float, val: float, groups: bool) -> tuple[int, int]:
    """How many of n groups or rows go to train and val: their shares rounded down, at least one each where there are three or more."""
    if groups and n <= 2:
        return min(n, 1), 0
    a, b = int(n * train), int(n * val)
    if n >= 3:
        a, b = max(a, 1), max(b, 1)
        if a + b >= n:
            a, b = max(1, n - 2), 1
    return a, b


def _assigned(df: DataFrame, key: str, a: int, b: int, seed: int) -> DataFrame:
    """(key, split): the first a keys of a seeded random order in train, the next b in val, the others in test."""
    ranked = hashed_rank(df.select(key), [], [key], seed)
    return ranked.select(key, F.when(F.col("rank") <= a, SPLITS[0]).when(F.col("rank") <= a + b, SPLITS[1]).otherwise(SPLITS[2]).alias("split"))


def group_split(samples: DataFrame, symbols: DataFrame, order: str = "rec_no", ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, by: str = "package", least_groups: int = 5) -> DataFrame:
    """(order, group_key, split): groups in a seeded random order are cut by their number, so no group is divided.

    With fewer than ``least_groups`` groups the rows are cut in that way instead, which divides groups. Only the numbers of groups and rows
    reach the driver. ``order`` is unique.
    """
    if abs(sum(ratios) - 1) > 0.001:
        raise ValueError(f"ratios must sum to 1, not {sum(ratios)}")
    keyed = group_keys(samples, symbols, by).select(order, "group_key")
    groups = keyed.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"))
    n, rows = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n < least_groups:
        return keyed.join(_assigned(keyed, order, *cuts(rows, ratios[0], ratios[1], False), seed), order).select(order, "group_key", "split")
    placed = _assigned(groups, "group_key", *cuts(n, ratios[0], ratios[1], True), seed)
    return keyed.join(placed, "group_key").select(order, "group_key", "split")


def split_all(samples: DataFrame, symbols: DataFrame, order: str = "rec_no", **options) -> dict[str, DataFrame]:
    """The splits of all samples, and of each scenario on its own; fewer than three rows all go to train."""
    parts = {"all": samples, "qa": samples.where("scenario = 'qa_rule'"), "design": samples.where("scenario = 'arch_design'")}
    out = {}
    for name, part in parts.items():
        if part.limit(3).count() < 3:
            out[name] = group_keys(part, symbols, options.get("by", "package")).select(order, "group_key", F.lit("train").alias("split"))
        else:
            out[name] = group_split(part, symbols, order, **options)
    return out
