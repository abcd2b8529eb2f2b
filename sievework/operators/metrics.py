"""Scores of predictions against references."""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("bleu", "rouge1", "rouge2", "rougeL")])


def tokens(text: str | None) -> list[str]:
    """ASCII words and numbers, and every ideograph on its own."""
    return re.findall(r"[A-Za-z0-9]+|[一-鿿]", (text or "").lower())


def grams(words: list[str], n: int) -> Counter:
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def bleu(hyp: list[str], ref: list[str], most: int = 4, epsilon: float = 0.1) -> float:
    """Geometric mean of clipped n-gram precisions with a brevity penalty; a precision of 0 counts as epsilon over its total."""
    if not hyp or not ref:
        return 0.0
    total = 0.0
    for n in range(1, most + 1):
        h, r = grams(hyp, n), grams(ref, n)
        size = max(1, sum(h.values()))
        hits = sum(min(c, r[g]) for g, c in h.items())
        if n == 1 and hits == 0:
            return 0.0
        total += math.log((hits if hits else epsilon) / size) / most
    return math.exp(total) * (1.0 if len(hyp) > len(ref) else math.exp(1 - len(ref) / len(hyp)))


def f1(hits: int, a: int, b: int) -> float:
    return 2 * hits / (a + b) if hits else 0.0


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with a whole row of the table in the bits of one number."""
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    mask = row = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(b) - row.bit_count()


def scores_of(prediction: str | None, reference: str | None) -> dict[str, float]:
    p, r = tokens(prediction), tokens(reference)
    rouge = {f"rouge{n}": f1(sum((grams(p, n) & grams(r, n)).values()), max(0, len(p) - n + 1), max(0, len(r) - n + 1)) for n in (1, 2)}
    return {"bleu": bleu(p, r), **rouge, "rougeL": f1(common_length(p, r), len(p), len(r))}


@F.pandas_udf(SCORES)
def score(prediction: pd.Series, reference: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scores_of(p, r) for p, r in zip(prediction, reference)], columns=[f.name for f in SCORES])


def exact_match(prediction: Column, reference: Column) -> Column:
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    return (bare(prediction) == bare(reference)).cast("int")


def corpus_scores(pairs: DataFrame, prediction: str, reference: str) -> DataFrame:
    """One row: pairs, exact matches and the mean of every score, four digits."""
    each = pairs.select(exact_match(F.col(prediction), F.col(reference)).alias("exact"), score(prediction, reference).alias("s"))
    return each.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("exact"), 4).alias("exact_match"), *[F.round(F.avg(f"s.{f.name}"), 4).alias(f.name) for f in SCORES])
