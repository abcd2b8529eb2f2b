"""Functions with their documentation."""

from __future__ import annotations

import itertools
import random

import pytest

from sievework.llm import documented

GOOD = "Keeps the voucher of every tenant in step with the archive."
ZH = "按顺序遍历所有分片，避免损坏的草稿遮挡后面的数据。"


def found(src, path="A.java", kind="file", doc=None, name=None):
    return [(line, n) for line, n, _, _ in documented.pairs(src, path, kind, doc, name)]


@pytest.mark.parametrize(
    "src,want",
    [
        (f"/** {GOOD} */\npublic int go() {{\n}}", [(2, "go")]),
        (f"// {GOOD}\n// More.\n@Get(path = {{\"a\"}})\nprivate Map<String, Long> go(\n   int a)\n   throws E {{\n}}", [(4, "go")]),
        (f"/*\n  {ZH}\n*/\nvoid go() {{ }}", [(4, "go")]),
        (f"/** {GOOD} */\nprivate int x = 5;\n\nvoid go() {{ }}", []),
        (f"int x = 5; // {GOOD}\nvoid go() {{ }}", []),
        (f"// {GOOD}\n\nvoid go() {{ }}", []),
        ("/** TODO: add documentation */ void a() { }\n/** the go fast thing */\nvoid goFast() { }\n/** {@inheritDoc} */\nvoid b() { }\n/** @param x the x of the thing here */\nvoid c(int x) { }", []),
        ("// for (A item : items) {\n//     call(item, 1);\n// }\nvoid go() { }", []),
        (f'void go() {{\n  String s = "/** {GOOD} */ public void no() {{ }}";\n  // {GOOD}\n  other(1);\n}}', []),
        (f"class A {{\n  /** {GOOD} */\n  A(int a) {{ }}\n  /** {GOOD} */\n  abstract void b();\n  void c() {{ if (x) {{ d(); }} }}\n}}", [(3, "A"), (5, "b")]),
        (f"/** {GOOD} <pre>public void no() {{ }}</pre> */\r\nvoid go() {{ }}\r\n", [(2, "go")]),
    ],
)
def test_java(src, want):
    assert found(src) == want


@pytest.mark.parametrize(
    "src,want",
    [
        (f'def go(a):\n    """{GOOD}"""\n    return 1', [(1, "go")]),
        (f"# {GOOD}\n# :param a: x\n@cached(\n    times=3,\n)\nasync def go(\n    a, b,\n) -> int:\n    return 1", [(6, "go")]),
        (f"class A:\n    def f(self):\n        r'''{ZH}'''\n        def g():\n            # {GOOD}\n            return 1\n        return 2", [(2, "f")]),
        (f"# {GOOD}\nLIMIT = 3\n\ndef go():\n    pass", []),
        (f'def go():\n    x = 1\n    """{GOOD}"""\n    """TODO"""', []),
        (f'x = """\ndef no():\n    "{GOOD}"\n"""\n# def no2(): pass', []),
        (f'def a(): pass\n\n# if x is None:\n#     raise E(1)\ndef b():\n    """Example:\n    def sample(self): pass\n    """', []),
        (f'def a():\n    f"""{GOOD}"""', []),
    ],
)
def test_python(src, want):
    assert found(src, "a.py") == want


def test_symbol_documentation_is_the_outermost_ones():
    src = "def outer():\n    def inner():\n        pass\n    return inner"
    assert found(src, "a.py", "method", GOOD, "outer") == [(1, "outer")]
    assert found(src, "a.py", "file", GOOD, "outer") == []
    assert found(src, "a.py", "method", "outer", "outer") == [] and found(src, "a.py", "method", None) == []
    assert found("int x = 4;\nvoid go() { }", "A.java", "method", f"/**\n * {ZH}\n */", "go") == [(2, "go")]


def test_assignment_is_optimal():
    rng = random.Random(2)
    for _ in range(120):
        n, m = rng.randrange(1, 6), rng.randrange(1, 5)
        s = [[rng.choice([0, 0, rng.random()]) for _ in range(m)] for _ in range(n)]
        got = documented.matched({(i, j): s[i][j] for i in range(n) for j in range(m)})
        assert all(s[i][j] > 0 for i, j in got.items()) and len(set(got.values())) == len(got)
        cols = list(range(m)) + [None] * n
        best = max(sum(s[i][j] for i, j in enumerate(p) if j is not None) for p in set(itertools.permutations(cols, n)))
        assert abs(sum(s[i][j] for i, j in got.items()) - best) < 1e-9


def test_comments_are_offered_to_several_functions():
    src = f"// {GOOD} of one\nvoid one() {{ }}\nvoid two() {{ }}\n// {GOOD} of three\nvoid three() {{ }}\n"
    functions = documented.functions(src, False)
    places = [p for _, p in documented.candidates(src, functions, None, None, None, False)]
    assert [sorted(p) for p in places] == [[0, 1, 2], [2]] and places[0][0] > 2 > 1 > places[0][1] > places[0][2]
    assert found(src) == [(2, "one"), (5, "three")]  # two gets none: what is left over for it is too far away


def test_tags_choose_among_several_comments():
    src = f"/** {GOOD} first\n * @param other x */\n/** {GOOD} second\n * @param a x */\nvoid go(int a) {{ }}"
    assert [t for *_, t in documented.pairs(src, "A.java", "file", None, None)] == [GOOD + " second"]
    src = src.replace("@param a", "@param b").replace("@param other", "@param a")
    assert [t for *_, t in documented.pairs(src, "A.java", "file", None, None)] == [GOOD + " first"]


def test_many_functions_in_one_file():
    src = "\n".join(f"// {GOOD} number {'abc'[i % 3]}\nvoid f{i}() {{ }}" for i in range(3000))
    assert len(found(src)) == 3000


def test_rival_functions_share_out_texts():
    src = f"class A {{\n  /** {GOOD}\n   * @param b x */\n  void one(int b) {{ }}\n\n  void two(int a) {{ }}\n}}"
    assert found(src) == [(4, "one")]


def test_operator_on_odd_rows(spark):
    rows = [(1, "method", "go", "A.java", f"/** {GOOD} */\nvoid go() {{ }}", None), (1, "method", "go", "A.java", f"/** {GOOD} */\nvoid go() {{ }}", None), (2, "class", "A", "A.java", f"/** {GOOD} */\nvoid go() {{ }}", GOOD), (3, "method", None, "a.py", None, GOOD), (4, "method", None, None, "def go(): pass", GOOD), (5, "file", "x", "x.yml", "a: b", GOOD), (6, "method", "go", "a.py", "", GOOD), (7, "file", "g", "a.py", "def g(:\n" * 3000, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "rec_no bigint, symbol_type string, name string, file_path string, source string, doc string, code string")
    got = documented.documented_functions(df).collect()
    assert sorted((r.rec_no, r.line_no, r.name) for r in got) == [(1, 2, "go"), (1, 2, "go")] and got[0].description == GOOD
    assert documented.documented_functions(df.limit(0)).count() == 0


def test_javadoc_above_a_line_comment():
    assert found(f"/** {GOOD} */\n// NOSONAR\nvoid go() {{ }}") == [(3, "go")]
    assert found(f"/** {GOOD} */\n// NOSONAR\n// TODO\n@A\n/* x */\nvoid go() {{ }}") == [(6, "go")]
    assert found(f"// {GOOD}\n\n// NOSONAR\nvoid go() {{ }}") == [] and found(f"// {GOOD}\n/* x */\n\nvoid go() {{ }}") == []
