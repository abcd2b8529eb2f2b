"""Functions paired with their documentation.

Sources are split into code, strings and comments, so that declarations inside texts or comments are none. Every comment, docstring and
symbol documentation that informs is a candidate for all functions within reach of it, scored by distance, parameter tags and names. A
maximum assignment gives each function at most one of them and each of them to at most one function; links that are then too weak are
rejected, as comments at a distance are. Code commented out and empty or trivial words are no candidates.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JAVA = re.compile(r"//[^\n]*|/\*.*?(?:\*/|\Z)|\"\"\"(?:\\.|[^\\])*?\"\"\"|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'", re.S)
PYTHON = re.compile(r"#[^\n]*|[rbfuRBFU]{0,2}(?:\"\"\"(?:\\.|[^\\])*?\"\"\"|'''(?:\\.|[^\\])*?'''|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*')", re.S)
CALLED = re.compile(r"([A-Za-z_$][\w$]*)\s*\(")
AFTER = re.compile(r"\s*(?:\[\s*\]\s*)*(?:throws\s+[\w.,\s<>?@]+?)?\s*(\{|;|default\b)")
DEF = re.compile(r"^([ \t]*)(?:async[ \t]+)?def[ \t]+(\w+)", re.M)
ANNOTATION = re.compile(r"\s*@(?!interface\b)[\w.]+\s*")
NOT_NAMES = frozenset("if for while switch catch synchronized try return new throw else do case assert super this yield when".split())
NOT_TYPES = frozenset("return new throw else do case assert yield in instanceof package import record class enum interface goto extends implements throws and or not is".split())


#: Lines below a comment in which the functions it may belong to begin, and how many of them there may be.
REACH, RIVALS = 20, 3
#: Scores of the places: first in the body, directly above, the symbol's documentation; a comment at a distance scores less than 1.
INSIDE, ABOVE, SYMBOL = 4.0, 3.0, 2.5
#: What parameter tags and a mention of the name add at most; links below LEAST are rejected. A direct link stays above it whatever its tags.
TAGS, MENTION, LEAST = 0.5, 0.25, 2.0


@dataclass
class Function:
    name: str
    at: int  # of the name
    start: int  # of the declaration with its annotations
    end: int
    params: frozenset[str]
    depth: int = 0
    above: list[tuple[int, int]] = field(default_factory=list)
    inside: tuple[int, int] | None = None


def parts(source: str, python: bool) -> tuple[str, list[tuple[int, int]], dict[int, int]]:
    """The code with comments and strings blanked, the comments, and the strings by their start."""
    comments, strings, out, at = [], {}, [], 0
    for m in (PYTHON if python else JAVA).finditer(source):
        s = m.group()
        if s.startswith("#" if python else ("//", "/*")):
            comments.append(m.span())
        else:
            strings[m.start()] = m.end()
        out += [source[at : m.start()], re.sub(r"[^\n]", " ", s)]
        at = m.end()
    return "".join([*out, source[at:]]), comments, strings


def brackets(code: str) -> dict[int, int]:
    """For every opening bracket the position of the one that closes it; the end of the code if none does."""
    out, open_ = {}, {"(": [], "{": []}
    pair = {")": "(", "}": "{"}
    for m in re.finditer(r"[(){}]", code):
        c = m.group()
        if c in open_:
            open_[c].append(m.start())
        elif open_[pair[c]]:
            out[open_[pair[c]].pop()] = m.start()
    return out | {at: len(code) for rest in open_.values() for at in rest}


def merged(source: str, code: str, comments: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Whole-line comments on consecutive lines as one; comments behind code are dropped."""
    out: list[tuple[int, int]] = []
    for a, b in comments:
        line = source.rfind("\n", 0, a) + 1
        if code[line:a].strip():
            continue
        if out and source[a] in "/#" and source[a : a + 2] != "/*" and source[out[-1][0] : out[-1][0] + 2] != "/*" and re.fullmatch(r"\r?\n[ \t]*", source[out[-1][1] : a].rstrip(" \t") if source[out[-1][1] : a].strip(" \t") else source[out[-1][1] : a]):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def near(source: str, code: str, a: int, b: int, stop: int) -> bool:
    """Whether the comment a..b stands directly above what follows, or above a comment at ``stop``: no blank line, or one below a
    documentation comment."""
    gap = re.compile(r"\s*").match(code, b, stop).group()
    return gap.count("\n") <= (2 if source.startswith("/**", a) else 1)


def java_functions(source: str) -> list[Function]:
    code, comments, _ = parts(source, False)
    blocks, shuts = merged(source, code, comments), brackets(code)
    starts = [a for a, _ in blocks]
    stops, depth = [-1], 0
    for m in re.finditer(r"[(){};]", code):
        c = m.group()
        depth += (c == "(") - (c == ")")
        if depth <= 0 and c in "{};":
            stops.append(m.start())
    out = []
    for m in CALLED.finditer(code):
        name = m.group(1)
        if name in NOT_NAMES:
            continue
        shut = shuts[m.end() - 1]
        after = AFTER.match(code, shut + 1)
        if not after:
            continue
        stop = stops[bisect.bisect_left(stops, m.start()) - 1]
        head = code[stop + 1 : m.start()]
        # annotations, then modifiers and a type
        at = 0
        while a := ANNOTATION.match(head, at):
            at = a.end()
            if at < len(head) and head[at] == "(":
                at = min(shuts[stop + 1 + at] - stop, len(head))
        kind = head[at:].strip()
        if not kind and not (name[0].isupper() and after.group(1) == "{" and re.search(rf"\b(?:class|enum|record)\s+{re.escape(name)}\b", code)):
            continue
        if kind and (kind[-1] in ".?&," or not re.fullmatch(r"[\w$.<>\[\],?&\s@]+", kind) or kind.split()[-1] in NOT_TYPES or set(kind.split()) & NOT_TYPES):
            continue
        begin = stop + 1 + len(head) - len(head.lstrip())
        end = shuts[after.end() - 1] + 1 if after.group(1) == "{" else after.end()
        names = frozenset(re.findall(r"([\w$]+)\s*(?:\[\s*\])?\s*(?:,|$)", code[m.end() : shut]))
        f = Function(name, m.start(1), begin, end, names)
        last = stop + 1 + at + (len(head[at:]) - len(head[at:].lstrip()))
        below, kept = last, True
        for a, b in reversed(blocks[bisect.bisect_right(starts, stop) : bisect.bisect_left(starts, last)]):
            if b <= last:
                kept = near(source, code, a, b, below) and (kept or bool(code[b:below].strip()))
                f.above += [(a, b)] if kept else []
                below = a
        out.append(f)
    return out


def python_functions(source: str) -> list[Function]:
    code, comments, strings = parts(source, True)
    blocks, shuts = merged(source, code, comments), brackets(code)
    heads = list(DEF.finditer(code))
    lines = [0, *(m.end() for m in re.finditer("\n", code))]
    ends = [b - 1 for _, b in blocks]
    filled = [(m.start(), len(m.group(1).expandtabs()), m.group(2)) for m in re.finditer(r"^([ \t]*)(\S)", code, re.M)]
    at_line = [x[0] for x in filled]
    out = []
    for m in heads:
        indent = len(m.group(1).expandtabs())
        end = len(code)
        for start, other, mark in itertools.islice(filled, bisect.bisect_right(at_line, m.start()), None):
            if other <= indent and mark != ")":
                end = start
                break
        row = bisect.bisect_right(lines, m.start()) - 1
        above, start, i, depth = [], lines[row], row - 1, 0
        while i >= 0:
            text = code[lines[i] : lines[i + 1]].strip()
            k = bisect.bisect_left(ends, lines[i])
            block = blocks[k] if k < len(blocks) and ends[k] < lines[i + 1] else None
            if block and not text:
                above.append(block)
                i = bisect.bisect_right(lines, block[0]) - 2
            elif text.startswith("@") or depth < 0 or text.startswith(")"):
                depth += text.count("(") - text.count(")")
                start = lines[i]
                i -= 1
            else:
                break
        names: frozenset[str] = frozenset()
        f = Function(m.group(2), m.start(2), start, end, names)
        f.above = above
        paren = code.find("(", m.end())
        if paren >= 0:
            shut = shuts[paren]
            f.params = frozenset(re.findall(r"(?:^|,)\s*\*{0,2}(\w+)", code[paren + 1 : shut])) - {"self", "cls"}
            colon = re.compile(r"[^\n:]*:").match(code, shut + 1)
            if colon:
                # the first statement: skip white space and comments in the source
                at = colon.end()
                while skip := re.compile(r"\s+|#[^\n]*|\\\n").match(source, at):
                    at = skip.end()
                if at in strings and not re.match(r"(?i)[bf]", source[at : at + 2].rstrip("\"'")):
                    f.inside = (at, strings[at])
        out.append(f)
    return out


def functions(source: str, python: bool) -> list[Function]:
    found = python_functions(source) if python else java_functions(source)
    around: list[int] = []  # ends of the functions that are open
    for f in sorted(found, key=lambda f: f.at):
        while around and around[-1] <= f.at:
            around.pop()
        f.depth = len(around)
        around.append(f.end)
    return found


# --- words

CODE_LINE = re.compile(
    r"""(?x)^\s*(?:
      .*[;{}]\s*$ | @\w+(?:\(.*\))?\s*$ | [\w.\[\]]+\s*(?:[-+*/|&]?=)\s*\S.* | [\w.]+\(.*\)\s*;?\s*$ | \}.*
    | (?:async\s+def|def|class)\s+\w+.*:.* | (?:if|elif|for|while|with|except|try|else|finally)\b.*:\s*$ | (?:raise|throw|return)\s+[\w.]+(?:\(.*\))?\s*;?\s*$ | (?:import|from)\s+[\w.]+.*$ | pass | continue | break
    )$"""
)
TAG_LINE = re.compile(r"(?i)^\s*(?:[@\\][A-Za-z]+.*|:(?:param|type|return|returns|rtype|raise|raises|ivar|var|keyword)\b.*|(?:returns?|raises?|args?|arguments|parameters|params|yields?|examples?|throws?|see(?: also)?|notes?|返回|参数|抛出|异常|示例)\s*[:：].*)$")
PLACEHOLDERS = re.compile(
    r"(?i)^\W*(?:(?:todo|fixme|xxx|tbd|tba|hack)\b.*|n/?a|none|null|nil|no (?:doc(?:umentation|s|string)?|description|comment)(?: available| yet)?|(?:auto[- ]?generated|generated)(?: (?:method|constructor|function|code|stub|by|from)\b.*)?|add (?:doc|description|comment).*|description|documentation|docstring|placeholder|undocumented|(?:non-)?javadoc|see (?:above|below|super.*)|inheritdoc|待补充.*|待完善.*|待添加.*|待定.*|暂无.*|无|空|略|同上|自动生成.*)\W*$"
)


def plain_lines(raw: str) -> list[str]:
    """The lines of a comment or docstring without their signs."""
    t = raw.strip()
    if m := re.match(r"(?i)[rbfu]{0,2}(\"\"\"|'''|\"|')", t):
        t = t[m.end() :]
        t = t[: -len(m.group(1))] if t.endswith(m.group(1)) else t
    t = re.sub(r"^/\*+|\*+/\s*$", "", t.strip())
    t = re.sub(r"(?is)<pre>.*?</pre>", " ", t)
    out = []
    for line in t.split("\n"):
        line = re.sub(r"^\s*(?://+|#+|\*+(?!/))\s?", "", line.rstrip("\r"))
        line = re.sub(r"\{@\w+\s*([^}]*)\}", r"\1", line)
        out.append(re.sub(r"</?[A-Za-z][^<>]*>", " ", line).replace("*/", " ").strip())
    return out


def name_words(name: str) -> set[str]:
    return {w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)} | {name.lower()}


def description(raw: str, name: str) -> str | None:
    """The informing lines of a piece of documentation, or None if it is empty or trivial.

    Lines of code, tags and placeholders do not count, nor do the words of the function's name; four words must be left, or six Chinese
    characters, or a mixture that adds up to as much.
    """
    lines = [x for x in plain_lines(raw) if x and not CODE_LINE.match(x) and not TAG_LINE.match(x) and not PLACEHOLDERS.match(x)]
    own = name_words(name)
    text = " ".join(lines)
    words = [w for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", re.sub(r"[一-鿿]+", " ", text)) if w.lower() not in own]
    han = len(re.findall(r"[一-鿿]", text))
    return "\n".join(lines) if len(words) / 4 + han / 6 >= 1 else None


def tags(raw: str) -> set[str]:
    """The parameters that a documentation names: the word behind ``@param``, the last one of ``:param type name:``."""
    return set(re.findall(r"[@\\]param\s+(?:\[\w+\]\s+)?(\w+)", raw)) | set(re.findall(r":param\s+(?:[^:\n]*\s)?\*{0,2}(\w+)\s*:", raw))


# --- matching


def candidates(source: str, found: list[Function], kind: str | None, doc: str | None, name: str | None, python: bool) -> list[tuple[str, dict[int, float]]]:
    """(text, places): every comment, docstring and documentation with the functions it may belong to and the scores of their places."""
    code, comments, _ = parts(source, python)
    out: list[tuple[str, dict[int, float]]] = []
    order = sorted(range(len(found)), key=lambda i: found[i].start)
    starts = [found[i].start for i in order]
    direct = {span: (i, k) for i, f in enumerate(found) for k, span in enumerate(f.above)}
    lines = [m.start() for m in re.finditer("\n", source)]
    row = lambda at: bisect.bisect_left(lines, at)
    for a, b in merged(source, code, comments):
        places: dict[int, float] = {}
        at = bisect.bisect_left(starts, a)
        for i in order[at : at + RIVALS]:
            gap = row(found[i].start) - row(b - 1)
            if gap > REACH:
                break
            places[i] = 1 / (1 + gap)
        if (a, b) in direct:
            i, k = direct[a, b]
            places[i] = ABOVE - 0.01 * min(k, 9)  # of several the nearest
        if places:
            out.append((source[a:b], places))
    for i, f in enumerate(found):
        if f.inside:
            out.append((source[f.inside[0] : f.inside[1]], {i: INSIDE}))
    top = [i for i, f in enumerate(found) if f.depth == 0]
    if kind == "method" and doc and doc.strip() and top:
        outer = next((i for i in top if found[i].name == name), top[0])
        out.append((doc, {i: SYMBOL if i == outer else 1 / (1 + abs(k - top.index(outer))) for k, i in enumerate(top) if abs(k - top.index(outer)) <= RIVALS}))
    return out


def pairs(source: str, path: str, kind: str | None, doc: str | None, name: str | None) -> list[tuple[int, str, str, str]]:
    """(line of the name, name, code, description) of every function with informing documentation."""
    python = path.endswith((".py", ".pyi"))
    found = functions(source, python)
    if not found:
        return []
    score: dict[tuple[int, int], float] = {}
    texts: dict[tuple[int, int], str] = {}
    for j, (raw, places) in enumerate(candidates(source, found, kind, doc, name, python)):
        said = tags(raw)
        for i, place in places.items():
            text = description(raw, found[i].name)
            if text:
                agree = len(said & found[i].params) / len(said) if said else 0.5
                score[i, j] = place + TAGS * (agree - 0.5) + (MENTION if found[i].name in raw else 0.0)
                texts[i, j] = text
    newlines = [m.start() for m in re.finditer("\n", source)]
    out = []
    for i, j in sorted(matched(score).items(), key=lambda x: found[x[0]].at):
        f = found[i]
        if score[i, j] >= LEAST:
            out.append((bisect.bisect_left(newlines, f.at) + 1, f.name, source[f.start : f.end].strip(), texts[i, j]))
    return out


def matched(score: dict[tuple[int, int], float]) -> dict[int, int]:
    """The assignment of rows to columns with the largest sum of scores, each row and column in one link at most; scores below or equal 0
    are no links. The Hungarian method over sparse links: a shortest augmenting path for one row after the other."""
    links: dict[int, dict[tuple[bool, int], float]] = {}
    for (i, j), w in score.items():
        if w > 0:
            links.setdefault(i, {(False, i): 0.0})[True, j] = -w  # (False, i): the row stays alone
    owner: dict[tuple[bool, int], int] = {}
    column: dict[int, tuple[bool, int]] = {}
    price: dict[tuple[bool, int], float] = {}
    worth: dict[int, float] = {}
    for root in links:
        worth[root] = min(c - price.get(j, 0.0) for j, c in links[root].items())
        far: dict[tuple[bool, int], float] = {}
        back: dict[tuple[bool, int], int] = {}
        settled: dict[tuple[bool, int], None] = {}
        heap: list[tuple[float, tuple[bool, int]]] = []
        row, base = root, 0.0
        while True:
            for j, c in links[row].items():
                d = base + c - worth[row] - price.get(j, 0.0)
                if d < far.get(j, math.inf) - 1e-12:
                    far[j], back[j] = d, row
                    heapq.heappush(heap, (d, j))
            while True:
                base, j = heapq.heappop(heap)
                if base <= far[j] and j not in settled:
                    break
            if j not in owner:
                break
            settled[j] = None
            row = owner[j]
        worth[root] += base
        for k in settled:
            price[k] = price.get(k, 0.0) + far[k] - base
            worth[owner[k]] += base - far[k]
        while True:
            row = back[j]
            owner[j], before, column[row] = row, column.get(row), j
            if row == root:
                break
            j = before
    return {i: j for i, (real, j) in column.items() if real}


def documented_functions(symbols: DataFrame) -> DataFrame:
    """(rec_no, line_no, name, code, description): one row for each function in a row of type method or file with informing documentation.

    Null and empty sources, rows of other types and files other than Java and Python give no rows. Repeated rows are rows. A null
    documentation is none; name may be null. Where file_path is null the language is not known, so there are no rows.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for rec, kind, name, path, source, doc in zip(*(batch.column(i).to_pylist() for i in range(6))):
                rows += [(rec, *r) for r in pairs(source, path or "", kind, doc, name)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.string()) for c in cols[2:])], ["rec_no", "line_no", "name", "code", "description"])

    code = symbols.where("symbol_type in ('method', 'file') and source is not null and lower(file_path) rlike '[.](java|py|pyi)$'")
    return code.select(F.col("rec_no").cast("bigint"), "symbol_type", "name", "file_path", "source", "doc").mapInArrow(run, "rec_no bigint, line_no bigint, name string, code string, description string")
