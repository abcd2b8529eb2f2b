"""Steps that read and write named tables, run in order; a step that fails is recorded and the run goes on."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """needs: tables without which the step is skipped. keep: whether its results are materialised, which cuts the plan for what follows."""

    name: str
    run: Callable[[Tables, Mapping[str, Any]], Tables]
    needs: tuple[str, ...] = ()
    keep: bool = False
    flag: str | None = None


@dataclass
class Run:
    tables: Tables
    summary: list[dict[str, Any]] = field(default_factory=list)

    def status(self, name: str) -> str | None:
        return next((s["status"] for s in self.summary if s["step"] == name), None)


def run(spark: SparkSession, steps: list[Step], tables: Tables, config: Mapping[str, Any], write: Callable[[DataFrame, str], DataFrame] | None = None) -> Run:
    """Runs the steps. ``write`` materialises a table (a new version, never over one that is read); a flag set to True skips its step."""
    out = Run(dict(tables))
    for s in steps:
        began = time.time()
        entry: dict[str, Any] = {"step": s.name}
        missing = [n for n in s.needs if n not in out.tables]
        if s.flag and config.get(s.flag):
            entry["status"] = "skipped"
            entry["reason"] = s.flag
        elif missing:
            entry["status"] = "skipped"
            entry["reason"] = "missing " + ", ".join(missing)
        else:
            try:
                new = s.run(out.tables, config)
                if s.keep and write:
                    new = {n: write(df, n) for n, df in new.items()}
                out.tables.update(new)
                entry["status"] = "success"
                entry["tables"] = sorted(new)
            except Exception as e:  # noqa: BLE001 - one failing step must not end the run
                entry["status"] = "failed"
                entry["error"] = f"{type(e).__name__}: {e}"[:1000]
        entry["seconds"] = round(time.time() - began, 3)
        out.summary.append(entry)
    return out


KINDS = {"qa": "scenario is null or scenario <> 'arch_design'", "design": "scenario = 'arch_design'"}


def curation(order: str = "rec_no") -> list[Step]:
    """Parse, describe methods, ask and answer, design, validate, tag, sample, report question types, merge, deduplicate, scan, split, export.

    A run may begin anywhere: with files, symbols, profiles, raw samples of questions (qa_raw) and designs (design_raw), or samples of both.
    Steps whose tables are not there are skipped. Model calls are skipped under skip_llm.
    """
    from pyspark.sql import functions as F

    from sievework.operators import assemble, dedup, distributions, export, generation, sampling, splitting, tagging, validation
    from sievework.sources.code import ParseRules
    from sievework.sources.code import parse as parse_files
    from sievework.sources.model import COVERAGE, QUALITY

    def quality(known: Mapping[str, Column]) -> Column:
        """The quality of a new sample: nothing but the tags that were drawn for it."""
        none = lambda f: F.lit(None).cast(f.dataType)
        coverage = F.struct(*[known.get(f.name, none(f)).alias(f.name) for f in COVERAGE])
        return F.struct(*[coverage.alias(f.name) if f.name == "coverage" else none(f).alias(f.name) for f in QUALITY])

    def parse(t: Tables, c: Mapping[str, Any]) -> Tables:
        found, skipped = parse_files(t["files"], c.get("repo_commit", "UNKNOWN_COMMIT"), c.get("parse") or ParseRules())
        return {"symbols": found.withColumn(order, F.xxhash64("symbol_id")), "skipped_files": skipped}

    def understand(t: Tables, c: Mapping[str, Any]) -> Tables:
        good, bad = generation.understand(t["symbols"], t.get("profiles_done"), c.get("max_methods", 1000))
        return {"profiles": good, "profiles_rejected": bad}

    def question_answer(t: Tables, c: Mapping[str, Any]) -> Tables:
        asked, bad = generation.questions(t["profiles"], c.get("question_types", ["how_to"]), c.get("buckets", ["high", "mid", "hard"]), c.get("negative_types", []), c.get("negative_ratio") or 0.0, c.get("seed", 42))
        rows = asked.select(F.col(order).alias("query"), "question", "repo_commit", "evidence_refs", "negative_type", "question_type", "bucket")
        good, rejected, statistics = generation.answer_all(rows, t["symbols"], t.get("answers_done"), order=order)
        known = {"bucket": F.col("bucket"), "polarity": F.when(F.col("negative_type").isNotNull(), "negative").otherwise("positive"), "question_type": F.col("question_type")}
        drawn = rows.select("query", quality(known).alias("quality"))
        samples = good.join(drawn, "query").withColumnRenamed("query", order)
        return {"qa_raw": samples, "questions_rejected": bad, "qa_rejected_replies": rejected, "retrieval_statistics": statistics}

    def design(t: Tables, c: Mapping[str, Any]) -> Tables:
        refs = F.col("evidence_refs") if "evidence_refs" in t["design_questions"].columns else F.array().cast("array<struct<symbol_id:string>>")
        goals = t["design_questions"].select(F.xxhash64("id").alias("query"), F.col("goal").alias("question"), refs.alias("evidence_refs"), F.lit(c.get("repo_commit", "UNKNOWN_COMMIT")).alias("repo_commit"))
        good, rejected, statistics = generation.answer_all(goals, t["symbols"], order=order, scenario="arch_design")
        return {"design_raw": good.withColumn("quality", quality({})).withColumnRenamed("query", order), "design_rejected_replies": rejected, "design_retrieval_statistics": statistics}

    def validate(t: Tables, c: Mapping[str, Any]) -> Tables:
        out: Tables = {}
        if "samples" in t:
            out = {f"{k}_raw": t["samples"].where(w) for k, w in KINDS.items() if f"{k}_raw" not in t}
        raw = {k: (out | t)[f"{k}_raw"] for k in KINDS if f"{k}_raw" in (out | t)}
        if not raw:
            raise FileNotFoundError("there are no samples to validate")
        for k, rows in raw.items():
            v = validation.validate(rows, t["symbols"], c.get("quality") or validation.QualityRules(), order)
            out |= {f"{k}_verdicts": v, f"{k}_rejected": validation.rejected(v, order)}
            if c.get("write_clean", True):
                out[f"{k}_clean"] = validation.clean(v)
        return out

    def each(t: Tables, change: Callable[[DataFrame], DataFrame]) -> Tables:
        return {f"{k}_clean": change(t[f"{k}_clean"]) for k in KINDS if f"{k}_clean" in t}

    def tag(t: Tables, c: Mapping[str, Any]) -> Tables:
        cov = F.struct("tags.bucket", "tags.intent", "tags.module_span", "tags.polarity", "tags.question_type", "tags.source")
        return each(t, lambda rows: tagging.tag(rows).withColumn("quality", F.col("quality").withField("coverage", cov)).drop("tags"))

    def sample(t: Tables, c: Mapping[str, Any]) -> Tables:
        return each(t, lambda rows: sampling.sample_or_pass(rows, c.get("targets"), order, c.get("coverage_mode", "hybrid"), c.get("min_sample_size", 1), seed=c.get("seed", 42), negative_ratio=c.get("negative_ratio"))[0])

    def question_types(t: Tables, c: Mapping[str, Any]) -> Tables:
        out: Tables = {}
        for k in KINDS:
            if f"{k}_clean" in t:
                out[f"{k}_question_types"] = distributions.distribution(t[f"{k}_clean"], F.col("quality.coverage.question_type"))
                if wanted := c.get(f"{k}_question_type_targets"):
                    out[f"{k}_question_type_warnings"] = distributions.compare_targets(out[f"{k}_question_types"], wanted, c.get("max_delta", 0.1))
        return out

    def merge(t: Tables, c: Mapping[str, Any]) -> Tables:
        merged = assemble.merge(*[t.get(f"{k}_{s}") for k in KINDS for s in ("clean", "raw")], c.get("quality_mode", "gate"), c.get("write_clean", True), c.get("allow_fallback", True))
        if merged is None:
            raise FileNotFoundError("there are no samples to merge")
        return {"merged": assemble.union(merged, *[t[n] for n in ("extra_samples",) if n in t])}

    def dedupe(t: Tables, c: Mapping[str, Any]) -> Tables:
        key = F.concat(F.coalesce("instruction", F.lit("")), F.lit("\n"), F.coalesce("answer", F.lit("")))
        result = dedup.simhash_dedup(dedup.fingerprints(t["merged"], key, order), c.get("max_hamming", 3))
        return {"dedup_mapping": result, "deduplicated": t["merged"].join(result.where("kept").select(F.col("row").alias(order)), order, "left_semi")}

    def safety(t: Tables, c: Mapping[str, Any]) -> Tables:
        safe, report = assemble.apply_safety(t["deduplicated"], c.get("safety_mode", "keep"), c.get("blocked", assemble.BLOCKED), order)
        return {"safe": safe, "safety_report": report}

    def split(t: Tables, c: Mapping[str, Any]) -> Tables:
        return {"splits": splitting.group_split(t["safe"], t["symbols"], order, c.get("ratios", (0.8, 0.1, 0.1)), c.get("seed", 42))}

    def exports(t: Tables, c: Mapping[str, Any]) -> Tables:
        rows = t["safe"].drop("split").join(t["splits"].select(order, "split"), order)
        return {"chat": export.chat(rows, order, "split"), "alpaca": export.alpaca(rows, order, "split")}

    return [
        Step("parse", parse, ("files",), keep=True, flag="skip_parse"),
        Step("method_understanding", understand, ("symbols",), keep=True, flag="skip_llm"),
        Step("question_answer", question_answer, ("profiles", "symbols"), keep=True, flag="skip_question_answer"),
        Step("design", design, ("design_questions", "symbols"), keep=True, flag="skip_design"),
        Step("validate", validate, ("symbols",), keep=True, flag="skip_validation"),
        Step("tag", tag, ()),
        Step("sample", sample, (), keep=True, flag="skip_sampling"),
        Step("question_type_report", question_types, ()),
        Step("merge", merge, ()),
        Step("dedup", dedupe, ("merged",), keep=True, flag="skip_dedup"),
        Step("safety", safety, ("deduplicated",), flag="skip_safety"),
        Step("split", split, ("safe", "symbols"), keep=True, flag="skip_split"),
        Step("export", exports, ("safe", "splits"), flag="skip_export"),
    ]
