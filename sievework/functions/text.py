"""Texts: tokens, cuts, templates and the JSON that language models write."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words before a bracket that are no calls.
CALL_STOPWORDS = ["if", "for", "while", "switch", "catch", "return", "new", "try", "throw", "case", "else", "do", "this", "super"]


def alignment_tokens(text: Column) -> Column:
    """Distinct lower-case tokens: four or more ASCII word characters, or two or more ideographs in a row."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z0-9_]{4,}|[\\u4e00-\\u9fff]{2,}"), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def call_names(source: Column) -> Column:
    """Distinct names called in a source, in order of first use; null and empty have none."""
    found = F.regexp_extract_all(F.coalesce(source, F.lit("")), F.lit(r"(?U)\b([A-Za-z_][A-Za-z0-9_]*)\s*\("), F.lit(1))
    return F.array_except(F.array_distinct(found), F.array(*[F.lit(w) for w in CALL_STOPWORDS]))


def query_tokens(text: Column) -> Column:
    """Distinct lower-case words, letters of every script."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0)))


def cut(text: Column, limit: int, mark: str = "...") -> Column:
    """The first ``limit`` characters and a mark where the text is longer."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))).otherwise(text)


def cut_middle(text: Column, limit: int, mark: str = "\n    // ... (truncated) ...\n") -> Column:
    """Head and tail of a longer text, each half of the limit, with a mark between."""
    half = limit // 2
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, half), F.lit(mark), F.right(text, F.lit(half)))).otherwise(text)


def cut_counted(text: Column, limit: int) -> Column:
    """The first ``limit`` characters of a longer text, and how many there were."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("\n... [truncated, total "), F.length(text).cast("string"), F.lit(" chars]"))).otherwise(text)


def cut_parsed(text: Column, limit: int, language: str) -> Column:
    """A source as the parser of the language stores it: of Java head and tail, of Python the head."""
    if language == "java":
        keep = max(limit // 2 - 50, 0)
        mark = F.concat(F.lit("\n\n... /* TRUNCATED: "), (F.length(text) - limit).cast("string"), F.lit(" chars omitted */ ...\n\n"))
        return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), mark, F.right(text, F.lit(keep)))).otherwise(text)
    return cut(text, limit, "\n... (truncated)")


def embedding_text(name: Column, summary: Column, rules: Column, labels: Column) -> Column:
    """What of a method's profile is embedded: its parts joined by bars, empty ones left out."""
    part = lambda title, xs, sep: F.when(F.size(xs) > 0, F.concat(F.lit(title), F.array_join(xs, sep)))
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws(" | ", blank(name), blank(summary), part("业务规则: ", rules, "; "), part("标签: ", labels, ", "))


def fill(template: str, **values: Column) -> Column:
    """A prompt: every {name} of the template replaced by a column, null by nothing. {{ and }} stand for braces, unknown names stay."""
    parts = []
    for piece in re.findall(r"\{\{|\}\}|\{\w+\}|[^{}]+|[{}]", template):
        name = piece[1:-1]
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif piece[0] == "{" and name in values:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
        else:
            parts.append(F.lit(piece))
    return F.concat(F.lit(""), *parts)


def bare_json(text: Column) -> Column:
    """The outermost JSON object in what a model wrote: code fences and words around it are dropped. Without braces, the bare text."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?s)^\s+|\s+$", "")
    t = F.regexp_replace(F.regexp_replace(t, "^```(?:json)?", ""), "```$", "")
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(inner != "", inner).otherwise(F.regexp_replace(t, r"(?s)^\s+|\s+$", ""))


def escape_controls(text: Column) -> Column:
    """Raw line ends and tabs inside JSON strings, escaped; those between strings stay.

    The strings and what stands between them are cut out in turn, so each is edited on its own.
    """
    part = F.regexp_extract_all(text, F.lit('(?s)"(?:[^"\\\\]++|\\\\.)*+(?:"|\\\\?$)|[^"]++'), F.lit(0))
    fixed = lambda p: F.replace(F.replace(F.replace(p, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t")), F.lit("\r"), F.lit("\\r"))
    return F.array_join(F.transform(part, lambda p: F.when(F.startswith(p, F.lit('"')), fixed(p)).otherwise(p)), "")


def model_json(text: Column) -> Column:
    """What a model wrote as a VARIANT; null where it is no JSON even after cleaning."""
    return F.try_parse_json(escape_controls(bare_json(text)))
