"""Fingerprints and vector similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=400_000)
def _low64(gram: str) -> int:
    return int.from_bytes(hashlib.md5(gram.encode("utf-8", "surrogatepass")).digest()[8:], "big")


def simhash_values(texts: Iterable[str | None], bits: int = 64) -> np.ndarray:
    """The fingerprints as signed 64-bit numbers.

    Features are the words and the character trigrams of the lower-cased text, each hashed to the low bits of its MD5; a bit is set if more
    features have it than have not. Null and empty texts have the fingerprint 0. Trigrams are found for many texts at once, and each
    distinct feature is hashed once.
    """
    low = [(t or "").lower() for t in texts]
    out = np.zeros(len(low), dtype=np.uint64)
    lo = 0
    while lo < len(low):
        hi, size = lo + 1, len(low[lo])
        while hi < len(low) and size + len(low[hi]) <= 1 << 18:
            size += len(low[hi])
            hi += 1
        out[lo:hi] = _votes(low[lo:hi])
        lo = hi
    return (out & np.uint64((1 << bits) - 1) if bits < 64 else out).astype(np.int64)


def _votes(low: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    c = np.uint64(21)
    key = codes[:-2] << c << c | codes[1:-1] << c | codes[2:] if len(codes) > 2 else np.zeros(0, dtype=np.uint64)
    inside = owner[2:] == owner[:-2]
    distinct, gram = np.unique(key[inside], return_inverse=True)
    mask = (1 << 21) - 1
    words = [t.split() for t in low]
    index: dict[str, int] = {}
    word = np.array([index.setdefault(w, len(index)) for ws in words for w in ws], dtype=np.int64)
    names = ["".join(map(chr, (k >> 42, k >> 21 & mask, k & mask))) for k in distinct.tolist()]
    h = np.array([*map(_low64, names), *map(_low64, index)], dtype=np.uint64)
    if not len(h):
        return np.zeros(len(low), dtype=np.uint64)
    plus = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * 2 - 1
    at = np.concatenate([owner[:-2][inside], np.repeat(np.arange(len(low)), [len(ws) for ws in words])]).astype(np.int64)
    feature = np.concatenate([gram.ravel(), word + len(distinct)]).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, feature = at[order], feature[order]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    out = np.zeros(len(low), dtype=np.uint64)
    votes = np.add.reduceat(plus[feature], starts, axis=0, dtype=np.int32)
    out[at[starts]] = np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


@F.pandas_udf(T.LongType())
def simhash(texts: pd.Series) -> pd.Series:
    return pd.Series(simhash_values(texts))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 where the lengths differ or one is all zeros, null where one is null."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when((F.size(a) != F.size(b)) | (norm == 0), F.lit(0.0)).otherwise(dot(a, b) / norm)


def cosine_checked(a: Column, b: Column) -> Column:
    """Cosine of two arrays; an error where the lengths differ."""
    sure = F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different lengths")).cast("double"))
    return F.coalesce(sure, cosine(a, b))
