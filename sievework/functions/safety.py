"""Secrets, blocked phrases and licences in texts.

Where findings overlap, the one that begins first is kept (of equal beginnings the one of the earlier kind), so that a replacement never
cuts through another.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of secrets with their published patterns.
SECRET_PATTERNS = {
    "AWS_ACCESS_KEY": r"AKIA[0-9A-Z]{16}",
    "PRIVATE_KEY": r"-----BEGIN (?:RSA |DSA |EC )?PRIVATE KEY-----",
    "JWT_TOKEN": r"eyJ[a-zA-Z0-9_-]+\.eyJ[a-zA-Z0-9_-]+\.[a-zA-Z0-9_-]+",
    "API_KEY": r"(?i)api[_-]?key['\"]?\s*[:=]\s*['\"]?([a-zA-Z0-9_\-]{32,})",
    "TOKEN": r"(?i)token['\"]?\s*[:=]\s*['\"]?([a-zA-Z0-9_\-]{32,})",
    "SECRET": r"(?i)secret['\"]?\s*[:=]\s*['\"]?([a-zA-Z0-9_\-]{16,})",
    "PASSWORD": r"(?i)password['\"]?\s*[:=]\s*['\"]?([a-zA-Z0-9!@#$%^&*()_+\-=]{8,})",
    "GITHUB_TOKEN": r"ghp_[a-zA-Z0-9]{36}",
    "SLACK_TOKEN": r"xox[baprs]-[0-9]{10,13}-[0-9]{10,13}-[a-zA-Z0-9]{24,}",
    "BASE64_SECRET": r"(?i)(?:secret|key|token|password)['\"]?\s*[:=]\s*['\"]?([A-Za-z0-9+/]{40,}={0,2})",
}
#: Licences in order of precedence with the phrases that tell them.
LICENSE_PATTERNS = {
    "MIT": ["MIT License", "Permission is hereby granted, free of charge"],
    "Apache-2.0": [r"Apache License,?\s*Version 2\.0", "Licensed under the Apache License"],
    "GPL-3.0": [r"GNU GENERAL PUBLIC LICENSE\s*Version 3", "GNU GPL v3"],
    "GPL-2.0": [r"GNU GENERAL PUBLIC LICENSE\s*Version 2", "GNU GPL v2"],
    "BSD-3-Clause": ["BSD 3-Clause", "Redistribution and use in source and binary forms"],
    "BSD-2-Clause": ["BSD 2-Clause", "Simplified BSD License"],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute"],
    "MPL-2.0": [r"Mozilla Public License,?\s*Version 2\.0"],
    "LGPL-3.0": [r"GNU LESSER GENERAL PUBLIC LICENSE\s*Version 3"],
    "LGPL-2.1": [r"GNU LESSER GENERAL PUBLIC LICENSE\s*Version 2\.1"],
    "AGPL-3.0": [r"GNU AFFERO GENERAL PUBLIC LICENSE\s*Version 3"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
#: Names of licence files in order of precedence.
LICENSE_FILES = ["LICENSE", "LICENSE.txt", "LICENSE.md", "COPYING", "COPYING.txt", "COPYRIGHT", "COPYRIGHT.txt", "UNLICENSE"]
REDACTED = "[REDACTED]"

FINDINGS = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("matched", T.StringType()), T.StructField("length", T.IntegerType())]))
_compiled = [(kind, re.compile(pattern)) for kind, pattern in SECRET_PATTERNS.items()]


def secret_counts(text: Column) -> dict[str, Column]:
    """The number of findings of each kind."""
    t = F.coalesce(text, F.lit(""))
    return {kind: F.regexp_count(t, F.lit(pattern)) for kind, pattern in SECRET_PATTERNS.items()}


def secret_types(text: Column) -> Column:
    """The kinds of secrets in a text, in the order of SECRET_PATTERNS."""
    t = F.coalesce(text, F.lit(""))
    return F.array_compact(F.array(*[F.when(F.regexp_like(t, F.lit(pattern)), F.lit(kind)) for kind, pattern in SECRET_PATTERNS.items()]))


def _masked(s: str) -> str:
    return s[:20] + "..." + s[-10:] if len(s) > 50 else s[:10] + "..." if len(s) > 10 else s


def _find(text: str | None) -> list[dict]:
    out = []
    for kind, pattern in _compiled:
        for m in pattern.finditer(text or ""):
            out.append({"type": kind, "start": m.start(), "end": m.end(), "matched": _masked(m.group()), "length": m.end() - m.start()})
    return out


def has_secret(text: Column) -> Column:
    """Whether any pattern fits; null has none."""
    t = F.coalesce(text, F.lit(""))
    return reduce(lambda a, b: a | b, (F.regexp_like(t, F.lit(pattern)) for pattern in SECRET_PATTERNS.values()))


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


@F.pandas_udf(FINDINGS)
def _find_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_find, na_action="ignore")


def find_secrets(text: Column | str) -> Column:
    """Every finding with its 0-based span, the text of it masked; kinds in order, overlapping ones too. Only texts in which a pattern fits
    leave the JVM."""
    t = _column(text)
    return F.coalesce(_find_batch(F.when(has_secret(t), t)), F.array().cast(FINDINGS))


def _redact(text: str | None) -> str | None:
    out, at = [], 0
    for f in sorted(_find(text), key=lambda f: f["start"]):
        if f["start"] >= at:
            out += [text[at : f["start"]], f"[REDACTED_{f['type']}]"]
            at = f["end"]
    return text if not at else "".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def _redact_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_redact, na_action="ignore")


def redact_secrets(text: Column | str) -> Column:
    """Every finding replaced by its kind; of overlapping ones only the first. Only texts in which a pattern fits leave the JVM."""
    t = _column(text)
    return F.coalesce(_redact_batch(F.when(has_secret(t), t)), t)


def blocked_hits(text: Column, phrases: list[str]) -> Column:
    """The blocked phrases in a text, whatever their case, in their order; empty phrases are none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.when(F.contains(low, F.lit(p.lower())), F.lit(p)) for p in phrases if p]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def redact_blocked(text: Column, phrases: list[str], mark: str = REDACTED) -> Column:
    """Blocked phrases replaced by a mark, whatever their case."""
    for p in phrases:
        if p:
            text = F.regexp_replace(text, "(?iu)" + re.escape(p), mark.replace("\\", "\\\\").replace("$", "\\$"))
    return text


def license_of(text: Column) -> Column:
    """STRUCT<name, score, confidence>: the licence most of whose phrases are in the text, of equals the first; nulls if none is.

    Confidence is high from 0.8 on, medium from 0.5, else low.
    """
    t = F.coalesce(text, F.lit(""))
    scored = []
    for i, (name, patterns) in enumerate(LICENSE_PATTERNS.items()):
        hits = sum((F.regexp_like(t, F.lit("(?i)" + p)).cast("int") for p in patterns), F.lit(0))
        scored.append(F.struct((hits / len(patterns)).alias("score"), F.lit(-i).alias("rank"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*scored))
    level = F.when(best["score"] >= 0.8, "high").when(best["score"] >= 0.5, "medium").otherwise("low")
    some = best["score"] > 0
    return F.struct(F.when(some, best["name"]).alias("name"), F.when(some, best["score"]).alias("score"), F.when(some, level).alias("confidence"))
