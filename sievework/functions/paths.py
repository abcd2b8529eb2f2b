"""Paths, packages and identifiers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slashes(path: Column) -> Column:
    """``\\`` becomes ``/``."""
    return F.replace(path, F.lit("\\"), F.lit("/"))


def package_of(qualified_name: Column) -> Column:
    """The package of package.Class.method: all but the last two parts; of two parts the first; of one part, empty and null nothing."""
    parts = F.split(F.coalesce(qualified_name, F.lit("")), r"\.")
    n = F.size(parts)
    return F.when(n >= 3, F.array_join(F.slice(parts, F.lit(1), n - 2), ".")).when(n == 2, parts[0]).otherwise(F.lit(""))


def directory_of(path: Column) -> Column:
    """What stands before the last slash; nothing for a file in the root, empty and null."""
    p = F.coalesce(path, F.lit(""))
    return F.when(F.contains(p, F.lit("/")), F.regexp_extract(p, "^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def without_line(symbol_id: Column) -> Column:
    """The symbol id before its last colon; all of it if there is none."""
    return F.regexp_replace(symbol_id, ":[^:]*$", "")


def sample_id(scenario: Column, instruction: Column, context: Column) -> Column:
    """The first 16 hex digits of SHA-256 over scenario:instruction:context, of the context its first 100 characters."""
    joined = F.concat_ws(":", F.coalesce(scenario, F.lit("")), F.coalesce(instruction, F.lit("")), F.substring(F.coalesce(context, F.lit("")), 1, 100))
    return F.substring(F.sha2(joined, 256), 1, 16)


def question_id(question: Column, question_type: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", F.coalesce(question, F.lit("")), F.coalesce(question_type, F.lit(""))), 256), 1, 16)


def symbol_id(path: Column, qualified_name: Column, start_line: Column) -> Column:
    return F.concat_ws(":", slashes(path), qualified_name, start_line.cast("string"))


def hash_fits(source: Column, source_hash: Column) -> Column:
    """Whether the stored hash is that of the source; false where either is null."""
    return F.coalesce(F.sha2(source, 256) == source_hash, F.lit(False))
