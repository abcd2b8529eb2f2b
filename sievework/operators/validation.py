"""Validation of samples against the symbols they cite."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.paths import slashes
from sievework.functions.text import alignment_tokens, cut
from sievework.operators.lookup import complete, evidence, evidence_symbols

UNKNOWN_COMMIT = "UNKNOWN_COMMIT"
CHECKS = ("schema", "evidence", "commit", "length", "scenario_rules", "trace")
#: The check that each code belongs to; errors fail it, warnings warn it.
CHECK_OF = {
    "SCHEMA_INVALID": "schema",
    "EVIDENCE_MISSING": "evidence",
    "EVIDENCE_MISSING_NEGATIVE": "evidence",
    "EVIDENCE_SYMBOL_NOT_FOUND": "evidence",
    "EVIDENCE_SOURCE_HASH_MISMATCH": "evidence",
    "EVIDENCE_LINE_RANGE_INVALID": "evidence",
    "EVIDENCE_RANGE_LARGE": "evidence",
    "EVIDENCE_FILE_PATH_MISMATCH": "evidence",
    "EVIDENCE_AUTOFILL": "evidence",
    "COMMIT_MISMATCH": "commit",
    "INSTRUCTION_TOO_SHORT": "length",
    "ANSWER_TOO_SHORT": "length",
    "ANSWER_TOO_LONG": "length",
    "DESIGN_EVIDENCE_TOO_FEW": "scenario_rules",
    "DESIGN_LAYER_COVERAGE_LOW": "scenario_rules",
}


@dataclass(frozen=True)
class TraceRules:
    mode: str = "warning"
    scope: str = "all"
    require_evidence_refs: bool = False
    require_trace_structure: bool = True
    require_evidence_anchor: bool = True
    require_answer_alignment: bool = False
    require_non_empty: bool = True
    require_evidence_alignment: bool = True
    min_observations: int = 1
    min_inferences: int = 1
    max_observations: int | None = 8
    max_inferences: int | None = 8
    max_assumptions: int | None = 5


@dataclass(frozen=True)
class QualityRules:
    gate_mode: str = "gate"
    allow_negative_without_evidence: bool = False
    fail_on_warnings: bool = False
    min_instruction: int = 10
    min_answer: int = 20
    max_answer: int = 6000
    max_range: int = 500
    design_min_refs: int = 2
    require_layer_coverage: bool = False
    scenarios: tuple[str, ...] = ("qa_rule", "arch_design")
    gate_version: str = "v1"
    trace: TraceRules = TraceRules()


def _codes(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(code)) for when, code in rules])) if rules else F.array().cast("array<string>")


def ref_issues(samples: DataFrame, symbols: DataFrame, rules: QualityRules, key: str = "rec_no") -> DataFrame:
    """(key, ref_errors, ref_warnings): the codes of all references of a sample, in order."""
    refs = evidence(samples, key, "thought.evidence_refs", "repo_commit")
    j = evidence_symbols(refs, symbols)
    found = F.col("found")
    errors = F.when(~found, F.array(F.lit("EVIDENCE_SYMBOL_NOT_FOUND"))).otherwise(
        _codes(
            (~F.col("source_hash").eqNullSafe(F.col("s_source_hash")), "EVIDENCE_SOURCE_HASH_MISMATCH"),
            ((F.col("start_line") < 1) | (F.col("end_line") < F.col("start_line")), "EVIDENCE_LINE_RANGE_INVALID"),
            (~slashes(F.col("file_path")).eqNullSafe(slashes(F.col("s_file_path"))), "EVIDENCE_FILE_PATH_MISMATCH"),
        )
    )
    both = (F.col("repo_commit") != UNKNOWN_COMMIT) & (F.col("s_repo_commit") != UNKNOWN_COMMIT)
    warnings = _codes((found & (F.col("end_line") - F.col("start_line") > rules.max_range), "EVIDENCE_RANGE_LARGE"), (found & both & (F.col("repo_commit") != F.col("s_repo_commit")), "COMMIT_MISMATCH"))
    coded = j.select(key, "pos", errors.alias("e"), warnings.alias("w"))
    grouped = coded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "e", "w"))).alias("x"))
    return grouped.select(key, F.flatten(F.transform("x", lambda r: r["e"])).alias("ref_errors"), F.flatten(F.transform("x", lambda r: r["w"])).alias("ref_warnings"))


def schema_ok(rules: QualityRules) -> Column:
    """Whether a record has what a sample must have: a known scenario, its texts and commit, and references with all fields and lines from 1."""
    refs = F.coalesce("thought.evidence_refs", F.array().cast("array<struct<symbol_id:string,file_path:string,start_line:int,end_line:int,source_hash:string>>"))
    whole = F.forall(refs, lambda r: r["symbol_id"].isNotNull() & r["file_path"].isNotNull() & r["source_hash"].isNotNull() & (F.coalesce(r["start_line"], F.lit(0)) >= 1) & (F.coalesce(r["end_line"], F.lit(0)) >= 1))
    texts = F.col("instruction").isNotNull() & F.col("context").isNotNull() & F.col("answer").isNotNull() & F.col("repo_commit").isNotNull()
    return F.coalesce(F.col("scenario").isin(*rules.scenarios), F.lit(False)) & texts & F.coalesce(whole, F.lit(True))


def validate(samples: DataFrame, symbols: DataFrame, rules: QualityRules = QualityRules(), key: str = "rec_no") -> DataFrame:
    """``samples`` with the column ``verdict``: STRUCT<gate_version, passed, errors, warnings, checks, stats>.

    A record that does not parse has the one error SCHEMA_INVALID and no trace check. Null thought, quality and coverage are allowed. Rows
    with equal keys share their reference issues, so the key must be unique; other columns are kept as they are. All that a row tells by
    itself is worked out before the join, so a query that wants only verdicts shuffles codes and no texts.
    """
    t = rules.trace
    empty = F.array().cast("array<string>")
    listed = lambda path: F.coalesce(F.col(path), empty)
    refs = F.col("thought.evidence_refs")
    n_refs = F.greatest(F.coalesce(F.size(refs), F.lit(0)), F.lit(0))
    none = n_refs == 0
    negative = F.coalesce(F.col("quality.coverage.polarity") == "negative", F.lit(False))
    excused = negative & F.lit(rules.allow_negative_without_evidence)
    autofill = (F.try_element_at("quality.checks", F.lit("evidence_autofill")) == "true") if rules.gate_mode == "gate" else F.lit(False)
    own = {"_ok": schema_ok(rules), "_e0": _codes((none & ~excused, "EVIDENCE_MISSING")), "_e1": _codes((autofill, "EVIDENCE_AUTOFILL")), "_w0": _codes((none & excused, "EVIDENCE_MISSING_NEGATIVE"))}
    n_answer, n_instruction = F.length(F.coalesce("answer", F.lit(""))), F.length(F.coalesce("instruction", F.lit("")))
    design = F.coalesce(F.col("scenario") == "arch_design", F.lit(False))
    tops = F.size(F.array_distinct(F.filter(F.transform(F.coalesce(refs, F.array()), lambda r: F.split(slashes(r["file_path"]), "/")[0]), lambda x: F.length(x) > 0)))
    lengths = [(n_instruction < rules.min_instruction, "INSTRUCTION_TOO_SHORT"), (n_answer < rules.min_answer, "ANSWER_TOO_SHORT")]
    if rules.max_answer:
        lengths.append((n_answer > rules.max_answer, "ANSWER_TOO_LONG"))
    plan = [(design & ~none & (n_refs < rules.design_min_refs), "DESIGN_EVIDENCE_TOO_FEW")]
    if rules.require_layer_coverage:
        plan.append((design & ~none & (tops < 2), "DESIGN_LAYER_COVERAGE_LOW"))
    obs, inf, ass = listed("thought.observations"), listed("thought.inferences"), listed("thought.assumptions")
    blank = (F.size(obs) == 0) & (F.size(inf) == 0)
    # by precedence: structure, anchor, emptiness, alignment, least and largest numbers
    steps = []
    if t.require_evidence_anchor:
        steps.append((none, "TRACE_EVIDENCE_ANCHOR"))
    if t.require_non_empty:
        steps.append((blank, "TRACE_EMPTY"))
    if t.require_evidence_alignment:
        steps.append((~none & blank, "TRACE_EVIDENCE_ALIGNMENT"))
    if t.require_answer_alignment:
        said = F.lower(F.array_join(F.concat(obs, inf), " "))
        tokens = alignment_tokens(F.col("answer"))
        steps.append(((F.size(tokens) > 0) & ~F.exists(tokens, lambda w: F.contains(said, w)), "TRACE_ANSWER_ALIGNMENT"))
    for xs, low, high, what in ((obs, t.min_observations, t.max_observations, "OBSERVATIONS"), (inf, t.min_inferences, t.max_inferences, "INFERENCES"), (ass, 0, t.max_assumptions, "ASSUMPTIONS")):
        if low:
            steps.append((F.size(xs) < low, f"TRACE_MIN_{what}"))
        if high is not None:
            steps.append((F.size(xs) > high, f"TRACE_MAX_{what}"))
    applies = (design if t.scope == "arch_design" else F.lit(True)) & (~none | F.lit(not t.require_evidence_refs))
    missing = [(F.col("thought").isNull(), "TRACE_MISSING")] if t.require_trace_structure else []
    trace = F.when(applies, _codes(*missing, *steps)).otherwise(empty)
    own["_w1"] = F.concat(_codes(*lengths, *plan), trace)
    own["_stats"] = F.struct(F.length(F.coalesce("context", F.lit(""))).alias("context_chars"), n_answer.alias("answer_chars"), n_refs.alias("evidence_refs"))
    df = samples.withColumns(own).join(ref_issues(samples, symbols, rules, key), key, "left")
    errors, warnings = F.concat("_e0", F.coalesce("ref_errors", empty), "_e1"), F.concat("_w0", F.coalesce("ref_warnings", empty), "_w1")
    df = df.withColumn("_e", F.when(F.col("_ok"), errors).otherwise(F.array(F.lit("SCHEMA_INVALID")))).withColumn("_w", F.when(F.col("_ok"), warnings).otherwise(empty))

    def status(check: str) -> Column:
        mine = [c for c, k in CHECK_OF.items() if k == check]
        hit = lambda xs: F.exists(xs, lambda c: c.isin(*mine) if check != "trace" else F.startswith(c, F.lit("TRACE_")))
        return F.when(hit(F.col("_e")) if mine else F.lit(False), "fail").when(hit(F.col("_w")), "warn").otherwise("pass")

    of = {c: status(c) for c in CHECKS}
    of["evidence"] = F.when(~F.col("_ok"), "fail").otherwise(of["evidence"])
    checks = F.create_map(*[x for c in CHECKS[:-1] for x in (F.lit(c), of[c])])
    checks = F.when(F.col("_ok"), F.map_concat(checks, F.create_map(F.lit("trace"), of["trace"]))).otherwise(checks)
    passed = (F.size("_e") == 0) & (of["evidence"] != "fail")
    if rules.fail_on_warnings:
        passed &= F.size("_w") == 0
    if t.mode == "reject":
        passed &= of["trace"] != "warn"
    verdict = F.struct(F.lit(rules.gate_version).alias("gate_version"), passed.alias("passed"), F.col("_e").alias("errors"), F.col("_w").alias("warnings"), checks.alias("checks"), F.col("_stats").alias("stats"), F.col("quality.coverage").alias("coverage"))
    return df.withColumn("verdict", verdict).drop(*own, "_e", "_w", "ref_errors", "ref_warnings")


def clean(validated: DataFrame) -> DataFrame:
    """The samples that passed, the verdict as their quality."""
    return validated.where("verdict.passed").withColumn("quality", F.col("verdict")).drop("verdict")


def rejected(validated: DataFrame, key: str = "rec_no") -> DataFrame:
    """(line, scenario, error, instruction, quality, raw) of the samples that failed, the instruction cut to 100 characters."""
    raw = F.to_json(F.struct(*[c for c in validated.columns if c != "verdict"]))
    return validated.where("not verdict.passed").select(F.col(key).alias("line"), "scenario", F.get("verdict.errors", F.lit(0)).alias("error"), cut(F.col("instruction"), 100).alias("instruction"), F.col("verdict").alias("quality"), raw.alias("raw"))


def trace_empty(thought: Column) -> Column:
    """Whether a trace holds nothing at all; a null trace does."""
    return F.coalesce(F.size(thought["observations"]) + F.size(thought["inferences"]) + F.size(thought["assumptions"]) + F.size(thought["evidence_refs"]) <= 0, F.lit(True))


__all__ = ["QualityRules", "TraceRules", "clean", "complete", "ref_issues", "rejected", "trace_empty", "validate"]
