"""Topic and difficulty of questions, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.paths import slashes

#: Topics in order of precedence, each with the substrings that tell it.
INTENT_KEYWORDS = {
    "config": ["config", "yaml", "properties", "flag", "env", "配置", "开关"],
    "error": ["error", "exception", "fail", "timeout", "retry", "code", "错误", "异常", "失败", "超时", "重试", "错误码"],
    "deploy": ["deploy", "rollout", "release", "migration", "部署", "发布", "上线", "迁移"],
    "impact": ["impact", "change", "break", "影响", "变更"],
    "perf": ["latency", "throughput", "performance", "perf", "性能", "吞吐", "延迟"],
    "consistency": ["consistency", "transaction", "一致性", "事务"],
    "auth": ["auth", "authorize", "permission", "权限", "鉴权", "认证"],
    "flow": ["flow", "workflow", "流程", "链路", "路径"],
    "how_to": ["how to", "如何", "怎样", "如何做", "如何使用"],
    "compatibility": ["compatibility", "legacy", "兼容", "历史"],
    "edge": ["edge", "corner", "边界", "极端"],
}
#: Substrings of hard questions.
HARD_KEYWORDS = ["legacy", "compatibility", "invariant", "gotcha", "pitfall", "反直觉", "隐含", "历史", "兼容", "坑", "陷阱"]
#: Difficulties from easy to hard, and their default shares.
BUCKETS = ("high", "mid", "hard")
DEFAULT_TARGETS = {"high": 0.8, "mid": 0.15, "hard": 0.05}


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def question_text(instruction: Column, answer: Column) -> Column:
    return F.concat(F.coalesce(instruction, F.lit("")), F.lit(" "), F.coalesce(answer, F.lit("")))


def intent(text: Column) -> Column:
    """The first topic one of whose substrings is in the lower-cased text, how_to if none is; null text counts as empty."""
    return topic_of(F.lower(F.coalesce(text, F.lit(""))))


def topic_of(low: Column) -> Column:
    """``intent`` of a text in lower case. Give it a column that is computed before, not an expression: each keyword reads it."""
    out = F
    for name, words in INTENT_KEYWORDS.items():
        out = out.when(contains_any(low, words), F.lit(name))
    return out.otherwise(F.lit("how_to"))


def module_span(refs: Column) -> Column:
    """multi if the file paths of the evidence begin with more than one directory, else single; null and empty paths do not count."""
    tops = F.transform(refs, lambda r: F.split(slashes(F.coalesce(r["file_path"], F.lit(""))), "/")[0])
    return F.when(F.size(F.array_distinct(F.filter(tops, lambda t: t != ""))) > 1, F.lit("multi")).otherwise(F.lit("single"))


def bucket(topic: Column, span: Column, text: Column) -> Column:
    """hard for delicate topics or words, mid for several modules or topics that need them, else high."""
    return level_of(topic, span, F.lower(F.coalesce(text, F.lit(""))))


def level_of(topic: Column, span: Column, low: Column) -> Column:
    """``bucket`` of a text in lower case, from columns that are computed before."""
    hard = topic.isin("compatibility", "edge") | contains_any(low, HARD_KEYWORDS)
    return F.when(hard, F.lit("hard")).when((span == "multi") | topic.isin("perf", "consistency"), F.lit("mid")).otherwise(F.lit("high"))


def bucket_rank(b: Column) -> Column:
    return F.when(b == "hard", 2).when(b == "mid", 1).otherwise(0)


def evidence_bucket(b: Column, evidence: Column, mode: str = "assist", mid_min: int = 2, hard_min: int = 3) -> Column:
    """The difficulty after the number of evidence references is taken into account.

    off leaves it, assist only raises it, strict sets it from the number alone. A minimum of 0 switches its level off.
    """
    if mode not in ("assist", "strict"):
        return b
    level = F
    if hard_min:
        level = level.when(evidence >= hard_min, F.lit("hard"))
    if mid_min:
        level = level.when(evidence >= mid_min, F.lit("mid"))
    if level is F:
        return F.lit("high") if mode == "strict" else b
    if mode == "strict":
        return level.otherwise(F.lit("high"))
    level = level.otherwise(b)
    return F.when(bucket_rank(level) > bucket_rank(b), level).otherwise(b)


def constraint_strength(configured: str, b: Column) -> Column:
    """hybrid is strong for mid and hard questions; anything unknown is weak."""
    if configured == "hybrid":
        return F.when(b.isin("mid", "hard"), F.lit("strong")).otherwise(F.lit("weak"))
    return F.lit(configured if configured in ("strong", "weak") else "weak")
