"""Validation, tags, safety, merging, exports, retrieval, scores and generation on small fixtures."""

from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from sievework.functions import coverage, paths, safety, similarity, text
from sievework.functions.layers import JAVA
from sievework.operators import assemble, distributions, export, generation, lookup, metrics, retrieval, tagging, validation
from sievework.plans import pipeline
from sievework.sources import code, model, records
from sievework.streaming import incremental

SAMPLES = "rec_no bigint, scenario string, instruction string, context string, thought struct<observations:array<string>,inferences:array<string>,assumptions:array<string>,evidence_refs:array<struct<symbol_id:string,file_path:string,start_line:int,end_line:int,source_hash:string>>>, answer string, repo_commit string, quality struct<passed:boolean,gate_version:string,errors:array<string>,warnings:array<string>,checks:map<string,string>,coverage:struct<bucket:string,intent:string,module_span:string,polarity:string,question_type:string,source:string>>"
SYMBOLS = "rec_no bigint, symbol_id string, symbol_type string, name string, qualified_name string, file_path string, start_line int, end_line int, source string, doc string, annotations array<struct<name:string,arguments:map<string,string>,raw_text:string>>, repo_commit string, source_hash string"
REF = {"symbol_id": "src/Demo.java:Demo:1", "file_path": "src/Demo.java", "start_line": 1, "end_line": 2, "source_hash": "h"}


def sample(rec_no=1, scenario="qa_rule", refs=(REF,), obs=("seen",), inf=("so",), polarity=None, **other):
    row = {"rec_no": rec_no, "scenario": scenario, "instruction": "How does it work?", "context": "ctx", "answer": "It works like this, always.", "repo_commit": "c1", "thought": {"observations": list(obs), "inferences": list(inf), "assumptions": [], "evidence_refs": [dict(r) for r in refs]}, "quality": {"passed": None, "gate_version": None, "errors": None, "warnings": None, "checks": None, "coverage": {"bucket": None, "intent": None, "module_span": None, "polarity": polarity, "question_type": None, "source": None}}}
    return row | other


def symbols(spark, *extra):
    base = (1, "src\\Demo.java:Demo:1", "class", "Demo", "com.example.Demo", "src/Demo.java", 1, 2, "class Demo {}", None, [], "UNKNOWN_COMMIT", "h")
    return spark.createDataFrame([base, *extra], SYMBOLS)


def verdict(spark, row, rules=validation.QualityRules(gate_mode="report")):
    df = spark.createDataFrame([row], SAMPLES)
    return validation.validate(df, symbols(spark), rules).select("verdict.*").first()


def test_good_sample_passes(spark):
    v = verdict(spark, sample())
    assert v.passed and v.errors == [] and v.checks == {c: "pass" for c in validation.CHECKS}
    assert v.stats.context_chars == 3 and v.stats.evidence_refs == 1


@pytest.mark.parametrize(
    "change,errors",
    [
        ({"symbol_id": "gone"}, ["EVIDENCE_SYMBOL_NOT_FOUND"]),
        ({"source_hash": "x"}, ["EVIDENCE_SOURCE_HASH_MISMATCH"]),
        ({"start_line": 5}, ["EVIDENCE_LINE_RANGE_INVALID"]),
        ({"file_path": "other"}, ["EVIDENCE_FILE_PATH_MISMATCH"]),
        ({"file_path": "src\\Demo.java"}, []),
        ({"file_path": None}, ["SCHEMA_INVALID"]),
        ({"start_line": 0}, ["SCHEMA_INVALID"]),
    ],
)
def test_evidence_rules(spark, change, errors):
    v = verdict(spark, sample(refs=[REF | change]))
    assert v.errors == errors and v.passed == (not errors)
    assert v.checks["evidence"] == ("fail" if errors else "pass")


def test_warnings(spark):
    assert verdict(spark, sample(refs=[REF | {"end_line": 600}])).warnings == ["EVIDENCE_RANGE_LARGE"]
    design = validation.QualityRules(gate_mode="report", require_layer_coverage=True)
    v = verdict(spark, sample(scenario="arch_design"), design)
    assert v.passed and v.warnings == ["DESIGN_EVIDENCE_TOO_FEW", "DESIGN_LAYER_COVERAGE_LOW"]
    v = verdict(spark, sample(instruction="Hi", answer="No."))
    assert v.warnings == ["INSTRUCTION_TOO_SHORT", "ANSWER_TOO_SHORT"] and v.checks["length"] == "warn"


def test_trace_modes(spark):
    empty = sample(obs=(), inf=())
    reject = validation.QualityRules(gate_mode="report", trace=validation.TraceRules(mode="reject"))
    v = verdict(spark, empty, reject)
    assert not v.passed and v.checks["trace"] == "warn" and v.errors == []
    assert verdict(spark, empty).passed
    aligned = validation.QualityRules(gate_mode="report", trace=validation.TraceRules(require_answer_alignment=True))
    assert "TRACE_ANSWER_ALIGNMENT" in verdict(spark, sample(), aligned).warnings
    assert "TRACE_ANSWER_ALIGNMENT" not in verdict(spark, sample(obs=("it works",)), aligned).warnings


def test_negative_without_evidence(spark):
    row = sample(refs=(), polarity="negative")
    assert verdict(spark, row).errors == ["EVIDENCE_MISSING"]
    v = verdict(spark, row, validation.QualityRules(gate_mode="report", allow_negative_without_evidence=True))
    assert v.passed and "EVIDENCE_MISSING_NEGATIVE" in v.warnings and "TRACE_EVIDENCE_ANCHOR" in v.warnings


def test_null_records_are_rejected_not_lost(spark):
    rows = [sample(1), sample(2, scenario=None), sample(3, thought=None), sample(4, quality=None), sample(5, answer=None)]
    v = validation.validate(spark.createDataFrame(rows, SAMPLES), symbols(spark))
    good, bad = validation.clean(v), validation.rejected(v)
    assert good.count() + bad.count() == 5
    assert {r.line: r.error for r in bad.collect()} == {2: "SCHEMA_INVALID", 3: "EVIDENCE_MISSING", 5: "SCHEMA_INVALID"}
    assert json.loads(bad.where("line = 2").first().raw)["instruction"] == "How does it work?"


def test_last_duplicate_symbol_wins(spark):
    two = symbols(spark, (9, "src/Demo.java:Demo:1", "class", "Demo", "x", "src/Demo.java", 1, 2, "new", None, None, None, "h2"))
    assert [r.source for r in lookup.symbol_map(two).collect()] == ["new"]


@pytest.mark.parametrize(
    "question,refs,want",
    [
        ("如何配置开关", [("module_a/x", 1), ("module_b/y", 1)], ("config", "multi", "mid")),
        ("what", [("m/x", 1), ("m/y", 1)], ("how_to", "single", "mid")),
        ("兼容", [("m/x", 1)], ("compatibility", "single", "hard")),
        ("what", [], ("how_to", "single", "high")),
        (None, [(None, 1), ("m\\x", 1), ("n/y", 1)], ("how_to", "multi", "hard")),
    ],
)
def test_tags(spark, question, refs, want):
    row = sample(refs=[REF | {"file_path": p} for p, _ in refs], instruction=question, answer="")
    t = tagging.tag(spark.createDataFrame([row], SAMPLES)).select("tags.*").first()
    assert (t.intent, t.module_span, t.bucket) == want


def test_evidence_bucket_modes(spark):
    df = spark.createDataFrame([("hard", 0), ("high", 2), ("high", 3), ("mid", 0)], "b string, n int")
    got = lambda mode: [r[0] for r in df.select(coverage.evidence_bucket(F.col("b"), F.col("n"), mode)).collect()]
    assert got("off") == ["hard", "high", "high", "mid"]
    assert got("assist") == ["hard", "mid", "hard", "mid"]
    assert got("strict") == ["high", "mid", "hard", "high"]


SECRETS = {
    "AWS_ACCESS_KEY": "AKIA" + "A1" * 8,
    "PRIVATE_KEY": "-----BEGIN RSA PRIVATE KEY-----",
    "JWT_TOKEN": "eyJhbGci.eyJzdWIi.c2ln",
    "API_KEY": "api_key: " + "k" * 32,
    "TOKEN": "token = '" + "t" * 32,
    "SECRET": "secret=" + "s" * 16,
    "PASSWORD": "password: Abc12345!",
    "GITHUB_TOKEN": "ghp_" + "a" * 36,
    "SLACK_TOKEN": "xoxb-1234567890-1234567890-" + "z" * 24,
    "BASE64_SECRET": "key=" + "Q" * 44 + "==",
}


@pytest.mark.parametrize("kind", SECRETS)
def test_secret_kinds(spark, kind):
    df = spark.createDataFrame([(SECRETS[kind],), (None,), ("nothing here",)], "t string")
    assert kind in df.select(safety.secret_types(F.col("t")).alias("k")).first().k
    found = [r.f for r in df.select(safety.find_secrets("t").alias("f")).collect()]
    assert kind in [f.type for f in found[0]] and found[1] == [] and found[2] == []
    clean = [r.c for r in df.select(safety.redact_secrets("t").alias("c")).collect()]
    assert "[REDACTED_" in clean[0] and clean[1] is None and clean[2] == "nothing here"


def test_overlapping_secrets_are_cut_once(spark):
    line = "x token='" + "A" * 44 + "' y"
    assert spark.createDataFrame([(line,)], "t string").select(safety.redact_secrets("t")).first()[0] == "x [REDACTED_TOKEN]' y"


@pytest.mark.parametrize("mode,rows,context", [("drop", 1, None), ("keep", 2, "我很抱歉, no"), ("sanitize", 2, "我很[REDACTED], no")])
def test_safety_modes(spark, mode, rows, context):
    df = spark.createDataFrame([sample(1, context="我很抱歉, no"), sample(2)], SAMPLES)
    out, report = assemble.apply_safety(df, mode)
    assert out.count() == rows and [(r.rec_no, r.action, r.blocked) for r in report.collect()] == [(1, mode, ["抱歉"])]
    if context:
        assert out.where("rec_no = 1").first().context == context


def test_license(spark):
    texts = ["The MIT License\nPermission is hereby granted, free of charge", "mit license", "GNU General Public License\n Version 3", "BSD 3-Clause and ISC License", "none", None]
    got = [tuple(r.l) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(safety.license_of(F.col("t")).alias("l")).collect()]
    assert got == [("MIT", 1.0, "high"), ("MIT", 0.5, "medium"), ("GPL-3.0", 0.5, "medium"), ("BSD-3-Clause", 0.5, "medium"), (None, None, None), (None, None, None)]


def test_merge_matrix(spark):
    one = lambda x: spark.createDataFrame([(x,)], "v string")
    got = assemble.merge(one("qc"), one("qr"), one("dc"), one("dr"))
    assert [r.v for r in got.collect()] == ["qc", "dc"]
    assert [r.v for r in assemble.merge(None, one("qr"), one("dc"), None).collect()] == ["dc"]
    with pytest.raises(FileNotFoundError):
        assemble.merge(None, None, None, one("dr"))
    assert [r.v for r in assemble.merge(None, one("qr"), None, one("dr"), mode="report").collect()] == ["qr", "dr"]
    with pytest.raises(FileNotFoundError):
        assemble.merge(None, one("qr"), None, None, mode="report", allow_fallback=False)
    assert [r.v for r in assemble.merge(one("qc"), one("qr"), None, None, write_clean=False).collect()] == ["qr"]
    assert assemble.merge(None, None, None, None) is None


def test_exports(spark):
    df = spark.createDataFrame([sample(1), sample(2, context=None, thought=None, answer=None)], SAMPLES)
    chat = {r.rec_no: r for r in export.chat(df, "rec_no").collect()}
    assert [m.role for m in chat[1].messages] == ["system", "user", "assistant"]
    assert chat[1].messages[1].content == "How does it work?\n\n代码上下文：\nctx" and chat[2].messages[1].content == "How does it work?"
    assert chat[2].messages[2].content == ""
    trace = {r.rec_no: r.messages[2].content for r in export.chat_with_trace(df, "rec_no").collect()}
    assert trace[1] == "## 推理过程\n\n### 观察\n- seen\n\n### 推断\n- so\n\n## 最终答案\n\nIt works like this, always."
    assert trace[2] == "## 推理过程\n\n## 最终答案\n\n"
    shown = export.chat(df, "rec_no").select(export.rendered(F.col("messages"), True).alias("t")).first().t
    assert shown.startswith("<|im_start|>system\n") and shown.endswith("<|im_end|>\n<|im_start|>assistant\n")


def retrieval_symbols(spark):
    mark = lambda n: [{"name": n, "arguments": None, "raw_text": "@" + n}]
    return spark.createDataFrame(
        [
            (1, "a:1", "method", "login", "com.UserController.login", "web/UserController.java", 1, 20, "service.login()", "doc", mark("RestController"), "c", "h"),
            (2, "b:1", "method", "login", "com.UserService.login", "core/UserService.java", 1, 5, "return 1", None, mark("Service"), "c", "h"),
            (3, "c:1", "method", "pad", "com.StringUtils.pad", "util/StringUtils.java", 1, 5, "if (x) trim(y)", None, None, "c", "h"),
            (4, "d:1", "method", "trim", "com.StringUtils.trim", "util/StringUtils.java", 6, 9, None, None, None, "c", "h"),
        ],
        SYMBOLS,
    )


def test_keyword_ranking(spark):
    got = retrieval.keyword_top(retrieval_symbols(spark), "login service", 2).collect()
    assert [(r.rec_no, r.score) for r in got] == [(2, 20.0), (1, 11.0)]
    assert retrieval.keyword_top(retrieval_symbols(spark), "", 2).count() == 0


def test_layers_and_priority(spark):
    s = retrieval_symbols(spark)
    assert [r.layer for r in retrieval.with_layer(s).orderBy("rec_no").collect()] == ["controller", "service", None, None]
    assert [(r.rec_no, r.priority) for r in retrieval.top_methods(s, 2).collect()] == [(1, 20), (2, 10)]


def test_calls(spark):
    s = retrieval_symbols(spark)
    assert {tuple(r) for r in lookup.call_edges(s).collect()} == {(1, "login", 2, 1), (3, "trim", 1, 4)}
    got = lookup.expand_calls(s.where("rec_no in (1, 3)").select("rec_no"), s, 2, 10).collect()
    assert [(r.rec_no, r.depth) for r in got] == [(2, 1), (4, 1)]
    assert lookup.expand_calls(s.select("rec_no"), s, 0, 10).count() == 0


def test_common_length_is_that_of_the_table():
    import random

    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(6)
    for _ in range(200):
        a, b = (rng.choices("abcde", k=rng.randrange(90)) for _ in range(2))
        assert metrics.common_length(a, b) == plain(a, b)


def test_retrieval_for_many_questions(spark):
    s = retrieval_symbols(spark)
    asked = spark.createDataFrame([(7, "login service"), (8, "pad"), (9, "?"), (10, None)], "query bigint, text string")
    got = retrieval.retrieve_all(s, asked, 2)
    for q, text_ in ((7, "login service"), (8, "pad"), (9, "?")):
        one = [(r.rec_no, r.place, r.how) for r in retrieval.retrieve(s, text_, 2).orderBy("place").collect()]
        assert [(r.rec_no, r.place, r.how) for r in got.where(f"query = {q}").orderBy("place").collect()] == one
    assert got.where("query = 10 and how = 'first'").count() == 2
    assert retrieval.keyword_all(s, asked, 2, most_queries=1).count() == retrieval.keyword_all(s, asked, 2).count() > 0


def test_retrieve_balances_layers(spark):
    s = retrieval_symbols(spark)
    got = retrieval.retrieve(s, "pad", 1).orderBy("place").collect()
    assert [(r.rec_no, r.how) for r in got] == [(3, "keyword"), (4, "call"), (1, "layer"), (2, "layer")]
    assert [r.how for r in retrieval.retrieve(s, "?", 2).collect()].count("first") == 2
    vecs = spark.createDataFrame([("a:1", [1.0, 0.0], 0), ("c:1", [0.0, 1.0], 1), ("c:1", [1.0], 2)], "symbol_id string, vec array<double>, row bigint")
    assert retrieval.retrieve(s, "x", 1, vecs, [0.1, 1.0]).orderBy("place").first().rec_no == 3


def test_ref_correction(spark):
    s = retrieval_symbols(spark)
    refs = spark.createDataFrame([(1, "a:1", "f", 9, 9, "x"), (2, "b:77", "f", 9, 9, "x"), (3, "gone:1", "f", 9, 9, "x"), (4, "gone", None, 9, 9, "x"), (5, None, "f", 1, 1, "x")], "n int, symbol_id string, file_path string, start_line int, end_line int, source_hash string")
    got = {r.n: (r.how, r.symbol_id, r.end_line) for r in lookup.corrected_refs(refs, s).collect()}
    assert got == {1: ("exact", "a:1", 20), 2: ("prefix", "b:1", 5), 3: ("none", "gone:1", 9), 5: ("none", None, 1)}


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, None]
    with pytest.raises(Exception, match="different lengths"):
        df.where("size(a) = 1").select(similarity.cosine_checked(F.col("a"), F.col("b"))).collect()


def test_model_json(spark):
    texts = ['```json\n{"a": "x\ny\t\\"q\\""}\n```', 'Sure: {"a": 1} done', "no json", None, "", '{"a": [1, 2'] 
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_variant_get(text.model_json(F.col("t")), "$.a", "string")).collect()]
    assert got == ['x\ny\t"q"', "1", None, None, None, None]


def test_texts(spark):
    df = spark.createDataFrame([("abcdef", None), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(text.cut(F.col("a"), 3)).collect()] == ["abc...", None]
    assert [r[0] for r in df.select(text.fill("{{{a}}} {b}!", a=F.col("a"), b=F.col("b"))).collect()] == ["{abcdef} !", "{} x!"]
    assert df.select(text.embedding_text(F.lit("n"), F.lit(""), F.array(F.lit("r")), F.array(F.lit("t"), F.lit("u")))).first()[0] == "n | 业务规则: r | 标签: t, u"
    assert [r[0] for r in spark.createDataFrame([("com.foo.bar.S.m",), ("foo.C",), ("C",), ("",), (None,)], "q string").select(paths.package_of(F.col("q"))).collect()] == ["com.foo.bar", "foo", "", "", ""]


def test_scores():
    same = metrics.scores_of("the cat sat on the mat today", "the cat sat on the mat today")
    assert all(abs(v - 1) < 1e-9 for v in same.values())
    assert metrics.scores_of(None, "x") == {"bleu": 0.0, "rouge1": 0.0, "rouge2": 0.0, "rougeL": 0.0}
    s = metrics.scores_of("a b c d", "a c b d")
    assert s["rouge1"] == 1.0 and s["rougeL"] == 0.75 and s["rouge2"] == 0.0


def test_generation_retries_and_rejects(spark):
    class Flaky:
        def __init__(self):
            self.calls = 0

        def __call__(self, prompts):
            self.calls += 1
            if self.calls < 3:
                raise RuntimeError("busy")
            return ["not json" if "bad" in p else '{"question": "ok"}' for p in prompts]

    rows = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, t string").coalesce(1)
    w = generation.Writer("{t}", {"question": "string"}, Flaky)
    good, bad = w.write(rows, t=F.col("t"))
    assert [(r.id, r.question) for r in good.collect()] == [(1, "ok")]
    assert [(r.id, r.reply) for r in bad.collect()] == [(2, "not json")]
    assert [tuple(r) for r in generation.warnings_report(bad).collect()] == [("not a JSON object", 1)]


def test_design_refs(spark):
    rows = spark.createDataFrame([("g", "c", [], ["p"]), ("g", "c", ["own"], ["p"])], "goal string, context string, evidence_refs array<string>, pool array<string>")
    assert [r.evidence_refs for r in generation.designs(rows, F.col("pool"), gate=False)[0].collect()] == [["p"], ["own"]]
    assert [r.evidence_refs for r in generation.designs(rows, F.col("pool"))[0].collect()] == [[], ["own"]]


def test_distribution_of_nothing(spark):
    empty = spark.createDataFrame([], SAMPLES)
    assert distributions.distribution(empty, F.col("scenario")).count() == 0
    assert distributions.statistics(empty).first().samples == 0
    assert distributions.coverage_distributions(empty).count() == 0


# --- sources


def test_jsonl_lanes(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"symbol_id": "x", "name": "n"}\n\nnot json\n{"symbol_id": "y", "start_line": "1o"}\n', encoding="utf-8")
    rows = records.read_jsonl(spark, str(p), model.SYMBOL)
    assert [r.symbol_id for r in rows.collect()] == ["x"] and rows.count() == 1
    kept = records.read_jsonl(spark, str(p), model.SYMBOL, keep_corrupt=True)
    assert kept.where(f"{records.CORRUPT} is not null").count() == 2
    assert records.read_jsonl(spark, str(tmp_path / "none"), model.SYMBOL).count() == 0
    records.write_jsonl(rows, str(tmp_path / "out"))
    records.write_jsonl(rows, str(tmp_path / "out"), "append")
    assert records.read_jsonl(spark, str(tmp_path / "out"), model.SYMBOL).count() == 2


def test_configuration(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"a": {"b": 3}, "x.y": 5, "questions": ["q1", {"question": " "}]}))
    c = records.load_config(str(p))
    assert records.setting(c, "a.b") == 3 and records.setting(c, "x.y") == 5 and records.setting(c, "a.z", 7) == 7
    assert records.limit_of({"m": 5, "n": 3, "z": 0}, "m", "n", "z", "q") == 3 and records.limit_of({}, "m") is None
    assert records.load_config(str(tmp_path / "none.yaml")) == {}


def test_questions_and_commits(spark, tmp_path):
    p = tmp_path / "q.json"
    p.write_text(json.dumps({"questions": ["How?", {"question": "Why?", "difficulty": "hard"}, "", {"x": 1}], "design_questions": [{"goal": "G", "constraints": ["c"]}, {"id": "X"}]}))
    assert [(r.question, r.difficulty) for r in records.user_questions(spark, str(p)).collect()] == [("How?", "medium"), ("Why?", "hard")]
    assert [(r.id, r.goal, r.constraints) for r in records.design_questions(spark, str(p)).collect()] == [("DQ-001", "G", ["c"])]
    assert records.repo_commit("abc", ".") == "abc" and records.repo_commit(None, str(tmp_path)) == records.UNKNOWN_COMMIT
    records.write_json({"repo_commit": "abc"}, str(tmp_path / "m.json"))
    assert records.parse_is_current(str(tmp_path / "m.json"), "abc") and not records.parse_is_current(str(tmp_path / "m.json"), "UNKNOWN_COMMIT")


def test_versions_never_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    a = records.write_version(df, str(tmp_path / "t"))
    b = records.write_version(a.selectExpr("v + 1 as v"), str(tmp_path / "t"))
    assert a.first().v == 1 and b.first().v == 2 and sorted(os.listdir(tmp_path / "t")) == ["v0000", "v0001"]


JAVA_SOURCE = """package demo.x;
// class Fake { void no() { } }
public class Outer {
    private String tpl = "public void alsoNot() { }";
    /** Does a thing.
     * @param n how often
     */
    @GetMapping(path = "/a", value = "v")
    public int twice(int n) throws Exception {
        if (n > 0) { return call(n); }
        return 0;
    }
    Outer(int a) { }
    private void hidden() { }
    static class Inner { void deep() { } }
}
"""
PYTHON_SOURCE = '''class A:
    """Doc."""
    @cached(times=3)
    def f(self):
        """Says é."""
        def g():
            pass
        return "def h(): pass"
    async def skipped(self):
        pass
def _private():
    pass
'''


def test_parsers(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/Outer.java").write_text(JAVA_SOURCE)
    (tmp_path / "m/a.py").write_text(PYTHON_SOURCE)
    (tmp_path / "m/bad.py").write_text("def broken(:\n")
    (tmp_path / "node_modules").mkdir()
    (tmp_path / "node_modules/x.py").write_text("def f(): pass")
    (tmp_path / "m/readme.txt").write_text("no")
    rules = code.ParseRules()
    files = code.source_files(spark, str(tmp_path), rules)
    assert sorted(r.path for r in files.select("path").collect()) == ["m/Outer.java", "m/a.py", "m/bad.py"]
    found, skipped = code.parse(files, "c1", rules)
    rows = {r.qualified_name: r for r in found.collect()}
    assert set(rows) == {"demo.x.Outer.twice", "demo.x.Outer.Outer", "demo.x.Outer.hidden", "demo.x.Inner.deep", "a.A", "a.f", "a.g"}
    t = rows["demo.x.Outer.twice"]
    assert t.doc == "/** Does a thing.\n* @param n how often\n*/" and t.annotations[0].name == "GetMapping" and t.annotations[0].arguments["path"] == '"/a"' 
    assert (t.start_line, t.end_line) == (8, 12) and t.symbol_id == "m/Outer.java:demo.x.Outer.twice:8"
    assert rows["a.f"].doc == "Says é." and rows["a.f"].annotations[0].name == "cached"
    assert [r.path for r in skipped.collect()] == ["m/bad.py"]
    assert distributions.parsing_report(found).where("symbol_type is null").first().symbols == 7


def test_long_sources_are_cut_and_then_hashed(spark):
    rules = code.ParseRules(most_chars=200)
    python = code.python_symbols("m.py", "def f():\n    x = '" + "a" * 500 + "'\n", "c", rules)[0]
    java = code.java_symbols("M.java", "class M { void f() { x(\"" + "b" * 500 + "\"); } }", "c", rules)[0]
    assert python["source"].endswith("\n... (truncated)") and len(python["source"]) == 216
    assert java["source"].startswith("void f()") and java["source"].endswith("); }") and f"/* TRUNCATED: {int(java['metadata']['original_chars']) - 200} chars omitted */" in java["source"]
    for r in (python, java):
        assert r["source_hash"] == hashlib.sha256(r["source"].encode()).hexdigest()
    df = spark.createDataFrame([("x" * 12,), ("x" * 3,), (None,)], "s string")
    assert [r[0] for r in df.select(text.cut_counted(F.col("s"), 5)).collect()] == ["xxxxx\n... [truncated, total 12 chars]", "xxx", None]


def test_java_declarations():
    src = """class A<T extends Comparable<T>> {
  int[] f = {1, 2}; Runnable r = () -> { run(); }; Object o = new Object() { void anon() { } };
  static { boot(); }
  @B(value = {"x(", "y"}, n = 3) @C("q") public <K> Map<K, List<T>> m(@D(a = 1) int x, Map<K, T> y) throws E, F { class L { int deep() { return 1; } } return null; }
  abstract void none();
  record P(int x) { }
  interface I { void no(); }
  enum N { ONE { void no() { } }; void no2() { } }
  String s() { return "class Fake { void bad() { } }"; } // void worse() { }
"""
    rows = {r["name"]: r for r in code.java_symbols("A.java", src, "c", code.ParseRules())}
    assert set(rows) == {"m", "deep", "none", "s"}
    assert [(m["name"], m["arguments"]) for m in rows["m"]["annotations"]] == [("B", {"n": "3"}), ("C", {"value": '"q"'})]
    assert rows["deep"]["qualified_name"] == "L.deep" and rows["m"]["start_line"] == 4


def test_python_rules():
    src = "@app.route('/x')\n@a.b\ndef r(): pass\nclass __P: pass\nclass T: pass\ndef __d__(): pass\ndef _p(): pass\ndef test_q(): pass\n"
    assert {r["name"]: [m["name"] for m in r["annotations"]] for r in code.python_symbols("m.py", src, "c", code.ParseRules())} == {"r": ["route", "b"], "T": [], "__d__": []}
    assert {r["name"] for r in code.python_symbols("tests/m.py", src, "c", code.ParseRules())} == {"T"}


def test_controls_in_json_strings(spark):
    raw = '{"a": "x\ny\t\\"z\r",\n "b": [1,\t2], "c": "\\\\"}'
    df = spark.createDataFrame([(raw,), (None,), ("",), ('{"open": "a\nb',)], "t string")
    got = [r[0] for r in df.select(text.escape_controls(F.col("t"))).collect()]
    assert json.loads(got[0]) == {"a": 'x\ny\t"z\r', "b": [1, 2], "c": "\\"} and got[1:] == [None, "", '{"open": "a\\nb']


# --- pipeline and streams


def test_pipeline_records_failures(spark):
    def fail(t, c):
        raise ValueError("no")

    steps = [pipeline.Step("a", lambda t, c: {"x": t["in"]}, ("in",)), pipeline.Step("b", fail), pipeline.Step("c", lambda t, c: {}, ("gone",)), pipeline.Step("d", lambda t, c: {}, flag="skip_d")]
    out = pipeline.run(spark, steps, {"in": spark.range(1)}, {"skip_d": True})
    assert [out.status(s.name) for s in steps] == ["success", "failed", "skipped", "skipped"]


def test_curation_end_to_end(spark, data, tmp_path):
    tables = {n: spark.read.parquet(f"{data}/{n}.parquet") for n in ("samples", "symbols")}
    out = pipeline.run(spark, pipeline.curation(), tables, {"targets": None, "skip_llm": True}, lambda df, n: records.write_version(df, str(tmp_path / n)))
    begun = ("parse", "method_understanding", "question_answer", "design")
    assert {s["step"]: s["status"] for s in out.summary} == {s.name: "skipped" if s.name in begun else "success" for s in pipeline.curation()}, out.summary
    assert out.tables["chat"].count() == out.tables["safe"].count() > 0
    assert set(out.tables) >= {"qa_question_types", "design_question_types", "qa_rejected", "dedup_mapping"}


def test_curation_from_files(spark, tmp_path):
    files = spark.createDataFrame([("m/Outer.java", bytearray(JAVA_SOURCE.encode())), ("m/a.py", bytearray(PYTHON_SOURCE.encode()))], "path string, content binary")
    goals = spark.createDataFrame([("DQ-1", "How should Outer be split?")], "id string, goal string")
    rules = validation.QualityRules(min_answer=5)
    out = pipeline.run(spark, pipeline.curation(), {"files": files, "design_questions": goals}, {"quality": rules}, lambda df, n: records.write_version(df, str(tmp_path / n)))
    assert {s["status"] for s in out.summary} == {"success"}, out.summary
    assert out.tables["profiles"].count() == 6 and out.tables["qa_raw"].count() == 6 and out.tables["design_raw"].count() == 1
    assert {r.measure: r.n for r in out.tables["retrieval_statistics"].collect()} == {"questions_direct": 6, "symbols_direct": 6, "positive_samples": 6}
    assert out.tables["qa_raw"].where("size(thought.evidence_refs) = 1 and context like '// File:%'").count() == 6
    assert out.tables["design_raw"].first().scenario == "arch_design" and out.tables["chat"].count() > 0


def test_merge_keeps_to_the_gate(spark, data):
    samples = spark.read.parquet(f"{data}/samples.parquet").select("rec_no", "scenario", "instruction", "answer").limit(5)
    steps = [s for s in pipeline.curation() if s.name in ("merge",)]
    run = lambda tables, **c: pipeline.run(spark, steps, tables, c)
    assert "gate" in run({"design_raw": samples}).summary[0]["error"] and run({"qa_raw": samples}).status("merge") == "failed"
    assert run({"qa_raw": samples, "design_clean": samples}).tables["merged"].count() == samples.count()
    assert run({"qa_raw": samples, "design_raw": samples}, quality_mode="report").tables["merged"].count() == 2 * samples.count()
    assert run({"qa_raw": samples}, quality_mode="report", allow_fallback=False).status("merge") == "failed"
    assert run({"qa_raw": samples, "qa_clean": samples.limit(0)}, write_clean=False).tables["merged"].count() == samples.count()

def test_stream_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    line = lambda i, at="2024-05-06T10:00:00Z": json.dumps({"sample_id": i, "scenario": "qa_rule", "instruction": "如何配置", "answer": "抱歉", "created_at": at})
    (tmp_path / "in/1.json").write_text(line("a") + "\n" + line("b") + "\n" + line("a") + "\n" + line("x", "never") + "\n")
    run = lambda: incremental.append(incremental.curated(incremental.sample_stream(spark, src)), out, ck).awaitTermination()
    run()
    got = spark.read.parquet(out)
    assert sorted(r.sample_id for r in got.collect()) == ["a", "b"] and got.first().tags.intent == "config" and got.first().blocked == ["抱歉"]
    (tmp_path / "in/2.json").write_text(line("b") + "\n" + line("c", "2024-05-06 11:00:00") + "\n")
    run()
    assert sorted(r.sample_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_windows(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in/1.json").write_text("\n".join(json.dumps({"sample_id": str(i), "scenario": s, "created_at": f"2024-05-0{d}T10:00:00Z"}) for i, (s, d) in enumerate([("qa_rule", 1), ("qa_rule", 1), (None, 2), ("qa_rule", 9)])))
    incremental.append(incremental.counts(incremental.sample_stream(spark, str(tmp_path / "in"))), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert sorted((str(r.start)[:10], r.scenario, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [("2024-05-01", "qa_rule", 2), ("2024-05-02", "unknown", 1)]
