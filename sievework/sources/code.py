"""Symbols from the source files of a repository."""

from __future__ import annotations

import ast
import bisect
import hashlib
import os
import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sources.model import SYMBOL


@dataclass(frozen=True)
class ParseRules:
    extensions: tuple[str, ...] = (".java", ".py")
    ignore: tuple[str, ...] = (".git", "target", "build", ".gradle", "node_modules", ".idea", ".vscode", "__pycache__", ".venv")
    most_chars: int = 12_000
    private: bool = False
    tests: bool = False
    look_back: int = 20


def source_files(spark: SparkSession, root: str, rules: ParseRules = ParseRules()) -> DataFrame:
    """(path, content) of the files below a folder whose name has one of the extensions, relative to it; paths that contain an ignored
    part are left out."""
    glob = "*{" + ",".join(rules.extensions) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    base = "file:" + os.path.abspath(root).rstrip("/") + "/" if "://" not in root else root.rstrip("/") + "/"
    path = F.replace(F.replace(F.col("path"), F.lit("file://"), F.lit("file:")), F.lit(base.replace("file://", "file:")), F.lit(""))
    rows = files.select(path.alias("path"), F.col("modificationTime").alias("modified"), "length", F.col("content"))
    for part in rules.ignore:
        rows = rows.where(~F.contains("path", F.lit(part)))
    return rows


def shortened_python(source: str, most: int) -> str:
    return source if len(source) <= most else source[:most] + "\n... (truncated)"


def shortened_java(source: str, most: int) -> str:
    """Head and tail, each half of the limit less 50 characters."""
    if len(source) <= most:
        return source
    keep = max(most // 2 - 50, 0)
    return f"{source[:keep]}\n\n... /* TRUNCATED: {len(source) - most} chars omitted */ ...\n\n{source[len(source) - keep :]}"


def _symbol(kind: str, name: str, qualified: str, path: str, first: int, last: int, source: str, doc: str | None, annotations: list[dict], metadata: dict[str, str], commit: str) -> dict:
    """The hash is that of the source as it is stored, so a cut source fits its hash."""
    digest = hashlib.sha256(source.encode("utf-8", "surrogatepass")).hexdigest()
    return {"symbol_id": f"{path}:{qualified}:{first}", "symbol_type": kind, "name": name, "qualified_name": qualified, "file_path": path, "start_line": first, "end_line": last, "source": source, "doc": doc, "annotations": annotations, "metadata": metadata, "repo_commit": commit, "source_hash": digest}


def _decorator(node: ast.expr) -> str | None:
    """The last part of a decorator's name: ``route`` of ``@app.route("/x")``; others have none."""
    target = node.func if isinstance(node, ast.Call) else node
    return target.id if isinstance(target, ast.Name) else target.attr if isinstance(target, ast.Attribute) else None


def python_symbols(path: str, text: str, commit: str, rules: ParseRules) -> list[dict]:
    """Functions and classes, nested ones too, with decorators and docstring; async functions are left out.

    Unless configured, private functions (one underscore, not two), private classes (any) and functions of tests are left out; classes of
    tests stay.
    """
    out, lines, stem = [], text.split("\n"), os.path.splitext(os.path.basename(path))[0]
    for node in ast.walk(ast.parse(text)):
        if isinstance(node, ast.ClassDef):
            hidden = not rules.private and node.name.startswith("_")
        elif isinstance(node, ast.FunctionDef):
            hidden = not rules.private and re.match(r"_(?!_)", node.name) or not rules.tests and (node.name.startswith("test_") or "test" in path.lower())
        else:
            continue
        if hidden:
            continue
        marks = [{"name": n, "arguments": None, "raw_text": "@" + n} for n in map(_decorator, node.decorator_list) if n]
        last = node.end_lineno or node.lineno
        source = shortened_python("\n".join(lines[node.lineno - 1 : last]), rules.most_chars)
        out.append(_symbol("class" if isinstance(node, ast.ClassDef) else "method", node.name, f"{stem}.{node.name}", path, node.lineno, last, source, ast.get_docstring(node), marks, {"language": "python"}, commit))
    return out


# --- Java: one pass blanks texts and comments, one finds every bracket's partner; the rest jumps from bracket to bracket

_TEXTS = re.compile(r"//[^\n]*|/\*.*?(?:\*/|\Z)|\"\"\"(?:\\.|[^\\])*?\"\"\"|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'", re.S)
_CLASS = re.compile(r"(?<![\w$.])class\s+([A-Za-z_$][\w$]*)[^{};]*\{")
_STOP = re.compile(r"[(\[{;=]")
_ANNOTATION = re.compile(r"@\s*(?!interface\b)([A-Za-z_$][\w$]*(?:\s*\.\s*[A-Za-z_$][\w$]*)*)\s*")
_MODIFIER = re.compile(r"(?:public|protected|private|static|final|abstract|synchronized|native|strictfp|default|transient|volatile)\b")
_DECLARED = re.compile(r"(?P<type>[\w$.<>\[\],?&\s@]*[\s>\]])?(?P<name>[A-Za-z_$][\w$]*)\s*")
_NOT_TYPES = frozenset("record class interface enum new return throw else".split())
_BODY = re.compile(r"\s*(?:\[\s*\]\s*)*(?:throws\b[\w$.,\s<>@]*)?(?=[{;])")
_VALUE = re.compile(r"\"(?:\\.|[^\"\\\n])*\"|[A-Za-z_$][\w$]*|-?\d\w*")


def partners(code: str) -> dict[int, int]:
    """For every opening bracket the place of the one that closes it, the end of the code if none does."""
    out: dict[int, int] = {}
    open_: list[int] = []
    closes = {"(": ")", "[": "]", "{": "}"}
    for m in re.finditer(r"[()\[\]{}]", code):
        if m.group() in closes:
            open_.append(m.start())
        elif open_ and closes[code[open_[-1]]] == m.group():
            out[open_.pop()] = m.start()
        elif m.group() == "}":  # brackets left open inside a block end with it
            while open_ and code[open_[-1]] != "{":
                out[open_.pop()] = m.start()
            if open_:
                out[open_.pop()] = m.start()
    return out | {i: len(code) for i in open_}


def _members(code: str, ends: dict[int, int], at: int, stop: int) -> Iterable[tuple[int, int, int]]:
    """(start, parameter bracket, end) of every declaration with parameters that stands directly between at and stop."""
    start, bracket, assigned = at, -1, False
    while m := _STOP.search(code, at, stop):
        at, c = m.start(), m.group()
        if c == "=":
            assigned = True
            at += 1
        elif c == ";":
            if bracket >= 0 and not assigned:
                yield start, bracket, at + 1
            at += 1
            start, bracket, assigned = at, -1, False
        elif c == "{":
            end = min(ends[at] + 1, stop)
            if bracket >= 0 and not assigned:
                yield start, bracket, end
            at = end
            if not assigned:  # else the value of a field, which goes on to its semicolon
                start, bracket = at, -1
        else:
            if c == "(" and not assigned and not _ANNOTATION.fullmatch(code[code.rfind("@", start, at) : at] if "@" in code[start:at] else ""):
                bracket = at if bracket < 0 else bracket
            at = min(ends[at] + 1, stop)


def _annotation(text: str, arguments: str | None, name: str) -> dict:
    """Named values that are plain texts, names or numbers, as they are written; a single text or name is called value."""
    found: dict[str, str] = {}
    if arguments is not None:
        blank = _TEXTS.sub(lambda m: "x" * len(m.group()) if m.group()[0] == '"' else " " * len(m.group()), arguments)
        ends, lo, pieces = partners(blank), 0, []
        i = 0
        while i < len(blank):
            if blank[i] in "([{":
                i = ends[i]
            elif blank[i] == ",":
                pieces.append(arguments[lo:i])
                lo = i + 1
            i += 1
        for piece in [*pieces, arguments[lo:]]:
            key, equals, value = piece.partition("=") if re.match(r"\s*[A-Za-z_$][\w$]*\s*=", piece) else ("value", "", piece)
            if _VALUE.fullmatch(value.strip()) and (equals or not re.match(r"-?\d", value.strip())):
                found[key.strip()] = value.strip()
    return {"name": name, "arguments": found or None, "raw_text": text}


def _javadoc(lines: list[str], row: int, look_back: int) -> str | None:
    """The documentation comment that ends above a line (blank lines and // lines between), its lines without outer blanks."""
    for i in range(row - 1, max(-1, row - 1 - look_back), -1):
        line = lines[i].strip()
        if line.endswith("*/"):
            for j in range(i, -1, -1):
                if lines[j].strip().startswith("/**"):
                    return "\n".join(x.strip() for x in lines[j : i + 1])
                if j < i and "*/" in lines[j]:
                    return None
            return None
        if line and not line.startswith("//"):
            return None
    return None


def java_symbols(path: str, text: str, commit: str, rules: ParseRules) -> list[dict]:
    """Methods and constructors in the bodies of classes, nested and local classes too, with annotations and the documentation comment above
    them (up to look_back lines). Methods of interfaces, enums and records are left out; a method is named by its package and class."""
    code = _TEXTS.sub(lambda m: re.sub(r"[^\n]", " ", m.group()), text)
    ends, lines = partners(code), text.split("\n")
    breaks = [m.start() for m in re.finditer("\n", text)]
    package = re.search(r"(?m)^\s*package\s+([\w.]+)\s*;", code)
    out = []
    for owner in _CLASS.finditer(code):
        body = owner.end() - 1
        for start, bracket, end in _members(code, ends, body + 1, ends[body]):
            at, marks = start, []
            while True:
                at += len(code[at:bracket]) - len(code[at:bracket].lstrip())
                if a := _ANNOTATION.match(code, at, bracket):
                    at = a.end()
                    inner = None
                    if code[at : at + 1] == "(":
                        inner, at = text[at + 1 : ends[at]], ends[at] + 1
                    marks.append(_annotation(text[a.start() : at].strip(), inner, re.sub(r"\s", "", a[1])))
                elif w := _MODIFIER.match(code, at, bracket):
                    at = w.end()
                else:
                    break
            declared = _DECLARED.fullmatch(code, at, bracket)
            if not declared or not _BODY.match(code, ends[bracket] + 1) or _NOT_TYPES & set((declared["type"] or "").split()) or not (declared["type"] or "").strip() and declared["name"] != owner[1]:
                continue
            begin = start + len(code[start:bracket]) - len(code[start:bracket].lstrip())
            first, last = bisect.bisect_left(breaks, begin) + 1, bisect.bisect_left(breaks, end - 1) + 1
            whole = text[begin:end]
            doc, source = _javadoc(lines, first - 1, rules.look_back), shortened_java(whole, rules.most_chars)
            about = {"language": "java", "class_name": owner[1], "method_name": declared["name"], "has_annotations": str(bool(marks)).lower(), "has_javadoc": str(doc is not None).lower()}
            if source != whole:
                about |= {"truncated": "true", "original_chars": str(len(whole))}
            qualified = ".".join(x for x in (package and package[1], owner[1], declared["name"]) if x)
            out.append(_symbol("method", declared["name"], qualified, path, first, last, source, doc, marks, about, commit))
    return out


def _decoded(content: bytes, path: str) -> str:
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError:
        if path.endswith(".py"):
            raise
        return content.decode("latin-1")


def parse(files: DataFrame, commit: str, rules: ParseRules = ParseRules()) -> tuple[DataFrame, DataFrame]:
    """(symbols, skipped): symbols of (path, content), and (path, error) of the files that could not be read or parsed."""
    schema = T.StructType([*SYMBOL.fields, T.StructField("error", T.StringType())])
    s, pairs = pa.string(), pa.map_(pa.string(), pa.string())
    types = {"start_line": pa.int32(), "end_line": pa.int32(), "annotations": pa.list_(pa.struct([("name", s), ("arguments", pairs), ("raw_text", s)])), "metadata": pairs}
    arrow = pa.schema([(f.name, types.get(f.name, s)) for f in schema])

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows: list[dict] = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = (path or "").replace("\\", "/")
                try:
                    text = _decoded(content or b"", path)
                    rows += (python_symbols if path.endswith(".py") else java_symbols)(path, text, commit, rules)
                except (SyntaxError, ValueError, RecursionError) as e:
                    rows.append({"file_path": path, "error": f"{type(e).__name__}: {e}"[:300]})
            for r in rows:
                if "metadata" in r:
                    r["metadata"] = list(r["metadata"].items())
                    r["annotations"] = [a | {"arguments": list(a["arguments"].items()) if a["arguments"] else None} for a in r["annotations"]]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    parsed = files.select("path", "content").mapInArrow(run, schema)
    return parsed.where("error is null").drop("error"), parsed.where("error is not null").select(F.col("file_path").alias("path"), "error")
