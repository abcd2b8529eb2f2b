"""Architectural layers and the worth of symbols, from rules that are configured by language."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LayerRule:
    annotations: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    paths: tuple[str, ...] = ()


@dataclass(frozen=True)
class LanguageProfile:
    """Rules of a language: its layers in order of precedence, the annotations that mark business code, the keywords that raise a rank."""

    name: str
    layers: dict[str, LayerRule] = field(default_factory=dict)
    business_annotations: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    name_weight: float = 10.0
    path_weight: float = 5.0
    source_weight: float = 1.0


#: The default rules of Java projects.
JAVA = LanguageProfile(
    "java",
    {
        "controller": LayerRule(("RestController", "Controller"), ("controller", "endpoint", "api", "rest"), ("controller", "api", "rest")),
        "service": LayerRule(("Service", "Component"), ("service", "manager", "handler", "facade"), ("service", "business", "logic")),
        "repository": LayerRule(("Repository",), ("repository", "dao", "mapper"), ("repository", "dao", "persistence", "data")),
    },
    ("Transactional", "GetMapping", "PostMapping", "PutMapping", "DeleteMapping", "RequestMapping", "PatchMapping", "Service", "Component", "Repository", "RestController", "Controller", "Scheduled", "Async"),
    ("process", "handle", "execute", "validate", "calculate", "transform", "service", "controller", "handler", "processor"),
    2.0,
)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def annotation_names(annotations: Column) -> Column:
    return F.coalesce(F.transform(annotations, lambda a: a["name"]), F.array().cast("array<string>"))


def layer(profile: LanguageProfile, annotations: Column, name: Column, qualified_name: Column, path: Column) -> Column:
    """The first layer one of whose annotations, name or path keywords fits; null if none does. Nulls fit nothing."""
    low = [F.lower(F.coalesce(c, F.lit(""))) for c in (name, qualified_name, path)]
    out = F
    for title, rule in profile.layers.items():
        marked = F.coalesce(F.arrays_overlap(annotation_names(annotations), F.array(*[F.lit(a) for a in rule.annotations])), F.lit(False)) if rule.annotations else F.lit(False)
        named = any_of([F.contains(c, F.lit(w)) for w in rule.names for c in low[:2]])
        placed = any_of([F.contains(low[2], F.lit(w)) for w in rule.paths])
        out = out.when(marked | named | placed, F.lit(title))
    return out.otherwise(F.lit(None).cast("string"))


def priority(profile: LanguageProfile, annotations: Column, doc: Column, start_line: Column, end_line: Column) -> Column:
    """10 for every business annotation, 5 for documentation, 5 for 10 to 100 lines."""
    marks = F.array(*[F.lit(a) for a in profile.business_annotations])
    hits = F.size(F.filter(annotation_names(annotations), lambda a: F.array_contains(marks, a)))
    lines = end_line - start_line + 1
    return (hits * 10 + F.when(F.length(doc) > 0, 5).otherwise(0) + F.when(lines.between(10, 100), 5).otherwise(0)).cast("int")


def keyword_score(tokens: Column, qualified_name: Column, path: Column, source: Column, profile: LanguageProfile | None = None) -> Column:
    """For every token the weight of the first of name, path and source that contains it, and with a profile 1 for every keyword in the name; 0 without tokens."""
    n, p, s = (F.lower(F.coalesce(c, F.lit(""))) for c in (qualified_name, path, source))
    weights = (profile.name_weight, profile.path_weight, profile.source_weight) if profile else (10.0, 5.0, 1.0)
    one = lambda t: F.when(F.contains(n, t), F.lit(weights[0])).when(F.contains(p, t), F.lit(weights[1])).when(F.contains(s, t), F.lit(weights[2])).otherwise(F.lit(0.0))
    score = F.aggregate(tokens, F.lit(0.0), lambda acc, t: acc + one(t))
    if profile:
        for word in profile.keywords:
            score = score + F.contains(n, F.lit(word)).cast("double")
    return F.when(F.size(tokens) > 0, score).otherwise(F.lit(0.0))
