"""Merging of sample sources, and the scan of samples for secrets and blocked phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.safety import blocked_hits, redact_blocked, redact_secrets, secret_types

#: Phrases of refusing answers.
BLOCKED = ["作为人工智能", "无法访问", "不具备", "抱歉"]
SCANNED = ("instruction", "context", "answer")


def union(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns by name; a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def choose_source(clean: DataFrame | None, raw: DataFrame | None, mode: str, write_clean: bool, allow_fallback: bool, required: bool) -> DataFrame | None:
    """Clean samples if there are, else raw ones where the mode allows it.

    gate: raw samples without clean ones are skipped, or raise where they are required. report: they are used, or raise where falling back
    is not allowed. Without write_clean, raw samples are used.
    """
    if write_clean and clean is not None:
        return clean
    if raw is None:
        return None
    if write_clean and mode == "gate":
        if required:
            raise FileNotFoundError("clean samples are missing in gate mode")
        return None
    if write_clean and mode == "report" and not allow_fallback:
        raise FileNotFoundError("clean samples are missing and raw ones are not allowed")
    return raw


def merge(qa_clean: DataFrame | None, qa_raw: DataFrame | None, design_clean: DataFrame | None, design_raw: DataFrame | None, mode: str = "gate", write_clean: bool = True, allow_fallback: bool = True) -> DataFrame | None:
    """Question samples and then design samples; null if there are none."""
    parts = [choose_source(qa_clean, qa_raw, mode, write_clean, allow_fallback, False), choose_source(design_clean, design_raw, mode, write_clean, allow_fallback, True)]
    parts = [p for p in parts if p is not None]
    return union(*parts) if parts else None


def scan(samples: DataFrame, blocked: list[str] = BLOCKED, columns: tuple[str, ...] = SCANNED) -> DataFrame:
    """``samples`` with secrets, the kinds found in any of the columns, and blocked, the phrases; nulls have none."""
    secrets = F.array_distinct(F.concat(*[secret_types(F.col(c)) for c in columns]))
    hits = F.array_distinct(F.concat(*[blocked_hits(F.col(c), blocked) for c in columns]))
    return samples.withColumns({"secrets": secrets, "blocked": hits})


def apply_safety(samples: DataFrame, mode: str = "keep", blocked: list[str] = BLOCKED, key: str = "rec_no", columns: tuple[str, ...] = SCANNED) -> tuple[DataFrame, DataFrame]:
    """(samples, report): drop leaves samples with findings out, sanitize redacts them, keep keeps them as they are.

    The report (key, action, secrets, blocked) has every sample with findings, under the mode as its action.
    """
    if mode not in ("drop", "sanitize", "keep"):
        raise ValueError(f"unknown mode: {mode}")
    scanned = scan(samples, blocked, columns)
    found = (F.size("secrets") > 0) | (F.size("blocked") > 0)
    report = scanned.where(found).select(key, F.lit(mode).alias("action"), "secrets", "blocked")
    if mode == "drop":
        return scanned.where(~found).drop("secrets", "blocked"), report
    if mode == "sanitize":
        clean = {c: F.when(found, redact_blocked(F.when(F.size("secrets") > 0, redact_secrets(F.col(c))).otherwise(F.col(c)), blocked)).otherwise(F.col(c)) for c in columns}
        return scanned.withColumns(clean).drop("secrets", "blocked"), report
    return samples, report
