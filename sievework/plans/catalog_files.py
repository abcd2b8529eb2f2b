"""Queries of readers, writers, configuration, parsing, generation and the pipeline: what goes out to files or models and comes back.

Files are written to the session's shared folder. The stand-in model answers by the SHA-256 of its prompt, so SQL can say its replies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import paths
from sievework.operators import distributions, export, generation, lookup, validation
from sievework.plans import pipeline, sql
from sievework.plans.registry import query
from sievework.plans.scratch import Scratch
from sievework.sources import code, model, records
from sievework.sources.tables import table


def folder(spark: SparkSession, name: str) -> str:
    return Scratch(spark, name).root


def numbered_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("rec_no", T.LongType()), *schema.fields])


def written(rows: DataFrame, schema: T.StructType, name: str) -> str:
    """The rows as JSON Lines, in the columns of the schema that they have."""
    path = folder(rows.sparkSession, name)
    records.write_jsonl(rows.select(*[c for c in schema.names if c in rows.columns]), path)
    return path


_TEXTS = "md5(coalesce(instruction, '')) as instruction, md5(coalesce(context, '')) as context, md5(coalesce(answer, '')) as answer"


# --- JSON Lines


@query(f"select rec_no, sample_id, scenario, {_TEXTS}, coalesce(len(thought.evidence_refs), 0) as n_refs, quality.coverage.bucket as bucket from samples")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    schema = numbered_schema(model.SAMPLE)
    back = records.read_jsonl(spark, written(table(spark, d, "samples"), schema, "samples-jsonl"), schema)
    texts = [F.md5(F.coalesce(c, F.lit(""))).alias(c) for c in ("instruction", "context", "answer")]
    return back.select("rec_no", "sample_id", "scenario", *texts, F.greatest(F.coalesce(F.size("thought.evidence_refs"), F.lit(0)), F.lit(0)).alias("n_refs"), "quality.coverage.bucket")


@query("select rec_no, symbol_id, md5(coalesce(source, '')) as source from symbols")
def jsonl_append(spark: SparkSession, d: str) -> DataFrame:
    path, rows = folder(spark, "symbols-jsonl"), table(spark, d, "symbols").select("rec_no", "symbol_id", "source")
    for i, mode in enumerate(("overwrite", "append", "append")):
        records.write_jsonl(rows.where(F.pmod("rec_no", F.lit(3)) == i), path, mode)
    return records.read_jsonl(spark, path, rows.schema).select("rec_no", "symbol_id", F.md5(F.coalesce("source", F.lit(""))).alias("source"))


@query("select rec_no % 10 = 0 as corrupt, count(*) as n, min(case when rec_no % 10 <> 0 then rec_no end) as first from samples group by 1")
def jsonl_corrupt_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth line lacks its closing bracket; blank lines stand between."""
    path = folder(spark, "corrupt-jsonl")
    line = F.concat(F.lit('{"rec_no": '), F.col("rec_no").cast("string"), F.when(F.col("rec_no") % 10 == 0, F.lit("")).otherwise(F.lit("}")), F.lit("\n  "))
    table(spark, d, "samples").select(line.alias("value")).write.text(path)
    back = records.read_jsonl(spark, path, T.StructType([T.StructField("rec_no", T.LongType())]), keep_corrupt=True)
    bad = F.col(records.CORRUPT).isNotNull()
    return back.groupBy(bad.alias("corrupt")).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~bad, F.col("rec_no"))).alias("first"))


@query("select 0::BIGINT as n")
def jsonl_missing(spark: SparkSession, d: str) -> DataFrame:
    return records.read_jsonl(spark, folder(spark, "nothing"), model.SAMPLE).agg(F.count(F.lit(1)).alias("n"))


@query("with c as (select coalesce(scenario, 'unknown') as value, count(*) as n from samples group by 1) select value, n, round(n / sum(n) over (), 4) as ratio from c")
def report_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "report") + "/report.json"
    records.write_json(distributions.distribution(table(spark, d, "samples"), F.col("scenario")), path)
    return spark.createDataFrame([(r["value"], r["n"], r["ratio"]) for r in records.read_json(path)], "value string, n bigint, ratio double")


_SYMBOL = "symbol_id is not null and name is not null and qualified_name is not null and file_path is not null and source is not null and source_hash is not null and symbol_type in ('class', 'method', 'field', 'file') and start_line >= 1 and end_line >= 1"


@query(f"select symbol_id, count(*) as n, min(start_line) as first_line from symbols where {_SYMBOL} group by 1")
def typed_symbols(spark: SparkSession, d: str) -> DataFrame:
    rows = records.load_symbols(spark, written(table(spark, d, "symbols"), model.SYMBOL, "typed-symbols"))
    return rows.groupBy("symbol_id").agg(F.count(F.lit(1)).alias("n"), F.min("start_line").alias("first_line"))


@query("select sample_id, count(*) as n, count(answer) as answers from samples group by 1")
def typed_samples(spark: SparkSession, d: str) -> DataFrame:
    rows = records.load_samples(spark, written(table(spark, d, "samples"), model.SAMPLE, "typed-samples"))
    return rows.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.count("answer").alias("answers"))


@query("select symbol_id, count(*) as n from symbols where symbol_id is not null and qualified_name is not null group by 1")
def typed_profiles(spark: SparkSession, d: str) -> DataFrame:
    path = written(table(spark, d, "symbols").withColumn("summary", F.col("doc")), model.PROFILE, "typed-profiles")
    return records.load_profiles(spark, path).groupBy("symbol_id").agg(F.count(F.lit(1)).alias("n"))


@query("select md5(coalesce(answer, '')) as answer, coalesce(scenario, 'unknown') as scenario, count(*) as n from samples group by 1, 2")
def typed_chat(spark: SparkSession, d: str) -> DataFrame:
    path = written(export.chat(table(spark, d, "samples"), "rec_no"), model.CHAT, "typed-chat")
    rows = records.load_chat(spark, path)
    return rows.groupBy(F.md5(F.col("messages")[2]["content"]).alias("answer"), "metadata.scenario").agg(F.count(F.lit(1)).alias("n"))


# --- configuration and questions


def config(spark: SparkSession, value: dict) -> str:
    path = folder(spark, "config") + "/config.json"
    records.write_json(value, path)
    return path


@query("select * from (values ('a.b', '3'), ('x.y', '5'), ('a.z', '7'), ('limit', '3'), ('no limit', null), ('missing file', '0'), ('no list', '0')) t(name, value)")
def config_values(spark: SparkSession, d: str) -> DataFrame:
    c = records.load_config(config(spark, {"a": {"b": 3}, "x.y": 5, "m": 5, "n": 3, "z": 0}))
    missing = folder(spark, "nothing") + "/none.json"
    got = [("a.b", records.setting(c, "a.b")), ("x.y", records.setting(c, "x.y")), ("a.z", records.setting(c, "a.z", 7)), ("limit", records.limit_of(c, "m", "n", "z", "q")), ("no limit", records.limit_of({}, "m")), ("missing file", len(records.load_config(missing))), ("no list", len(records.load_list(missing, "questions")))]
    return spark.createDataFrame([(n, None if v is None else str(v)) for n, v in got], "name string, value string")


def _id(question: str, kind: str) -> str:
    return f"substr(sha256('{question}:{kind}'), 1, 16)"


@query(f"select * from (values ('How?', 'how_to', 'medium', {_id('How?', 'how_to')}), ('Why?', 'error', 'hard', {_id('Why?', 'error')})) t(question, question_type, difficulty, question_id)")
def user_questions(spark: SparkSession, d: str) -> DataFrame:
    path = config(spark, {"questions": ["How?", {"question": " Why? ", "question_type": "error", "difficulty": "hard"}, "", {"x": 1}]})
    return records.user_questions(spark, path).select("question", "question_type", "difficulty", "question_id")


@query("select * from (values ('DQ-001', 'G', 'c|d', 'architecture'), ('X', 'H', '', 'api')) t(id, goal, constraints, question_type)")
def design_questions(spark: SparkSession, d: str) -> DataFrame:
    path = config(spark, {"design_questions": [{"goal": " G ", "constraints": ["c", "d"]}, {"id": "X", "goal": "H", "question_type": "api"}, {"id": "Y"}, {"goal": " "}]})
    return records.design_questions(spark, path).select("id", "goal", F.array_join("constraints", "|").alias("constraints"), "question_type")


@query("select * from (values ('configured', 'abc'), ('no repository', 'UNKNOWN_COMMIT'), ('same commit', 'true'), ('other commit', 'false'), ('unknown commit', 'false'), ('no record', 'false')) t(name, value)")
def parse_state(spark: SparkSession, d: str) -> DataFrame:
    """The commit of a run, and whether its files were parsed at that commit before."""
    path = config(spark, {"repo_commit": "abc"})
    current = lambda p, c: str(records.parse_is_current(p, c)).lower()
    got = [("configured", records.repo_commit("abc", "/")), ("no repository", records.repo_commit(None, "/nowhere")), ("same commit", current(path, "abc")), ("other commit", current(path, "abd")), ("unknown commit", current(path, "UNKNOWN_COMMIT")), ("no record", current(folder(spark, "nothing") + "/none.json", "abc"))]
    return spark.createDataFrame(got, "name string, value string")


# --- files and parsing


@query("select symbol_type as kind, count(*) as lines from symbols where symbol_type <> 'class' and rec_no is not null group by 1")
def scanned_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder tree with one line a symbol, one folder a type, found again by extension; folders of classes are ignored."""
    root = folder(spark, "tree")
    rows = table(spark, d, "symbols").where("symbol_type is not null and rec_no is not null")
    rows.select("symbol_type", F.col("rec_no").cast("string").alias("value")).write.partitionBy("symbol_type").text(root)
    files = code.source_files(spark, root, code.ParseRules(extensions=(".txt",), ignore=("symbol_type=class",)))
    kind = F.regexp_extract("path", "symbol_type=([^/]*)/", 1)
    return files.groupBy(kind.alias("kind")).agg(F.sum(F.regexp_count(F.col("content").cast("string"), F.lit("\n"))).alias("lines"))


@query("select rec_no, file_path is null or not regexp_matches(file_path, '[.]java$') as skipped from symbols where symbol_type = 'method' and source is not null")
def skipped_files(spark: SparkSession, d: str) -> DataFrame:
    """Sources under a syntax error: Python files are skipped and logged, Java ones are parsed as far as they go."""
    rows = table(spark, d, "symbols").where("symbol_type = 'method' and source is not null")
    java = F.coalesce(F.col("file_path").rlike("[.]java$"), F.lit(False))
    name = F.concat(F.col("rec_no").cast("string"), F.when(java, ".java").otherwise(".py"))
    files = rows.select(name.alias("path"), F.concat(F.lit("class X {\ndef (:\n"), "source").cast("binary").alias("content"))
    log = code.parse(files, "UNKNOWN_COMMIT")[1].where("error is not null").select(F.substring_index("path", ".", 1).cast("bigint").alias("rec_no"), F.lit(True).alias("hit")).distinct()
    return rows.select("rec_no").join(log, "rec_no", "left").select("rec_no", F.coalesce("hit", F.lit(False)).alias("skipped"))


@query(sql.VALIDATED + "select rec_no, quality.coverage.bucket as bucket, quality.coverage.polarity as polarity from verdicts where v_passed")
def coverage_kept(spark: SparkSession, d: str) -> DataFrame:
    """The tags of samples that passed, out of the quality that validation wrote."""
    good = validation.clean(validation.validate(table(spark, d, "samples"), table(spark, d, "symbols")))
    return good.select("rec_no", "quality.coverage.bucket", "quality.coverage.polarity")


# --- generation


def _hash(prompt: str) -> str:
    return f"sha256({prompt})"


def _filled(template: str, **values: str) -> str:
    """The SQL of a template: {name} by an expression."""
    out, parts = [], template.split("{")
    out.append(sql.quoted(parts[0]))
    for p in parts[1:]:
        name, _, rest = p.partition("}")
        out += [values[name], sql.quoted(rest)]
    return " || ".join(out).replace("\n", "' || chr(10) || '")


_CODE = {c: f"coalesce({c}, '')" for c in ("qualified_name", "file_path", "source")}


@query(f"select rec_no, 'Summary ' || substr(h, 1, 6) as summary, substr(h, 1, 2) || '|' || substr(h, 3, 2) as tags from (select rec_no, {_hash(_filled(generation.PROFILE.template, **_CODE))} as h from symbols where symbol_type = 'method')")
def written_profiles(spark: SparkSession, d: str) -> DataFrame:
    good, _ = generation.profiles(table(spark, d, "symbols").where("symbol_type = 'method'"))
    return good.select("rec_no", "summary", F.array_join("tags", "|").alias("tags"))


@query("""with s as (select rec_no, symbol_id, (10 * len(list_filter(coalesce(annotations, []), lambda a: a.name in (""" + ",".join(sql.quoted(a) for a in sql.JAVA.business_annotations) + """))) + case when length(doc) > 0 then 5 else 0 end + case when end_line - start_line + 1 between 10 and 100 then 5 else 0 end)::INT as priority from symbols where symbol_type = 'method'),
best as (select * from s order by priority desc, rec_no limit 300) select rec_no from best where symbol_id is null or symbol_id not in (select symbol_id from evidence_refs where symbol_id is not null)""")
def resumed_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The best 300 methods less those that are done: here those that some reference names."""
    good, _ = generation.understand(table(spark, d, "symbols"), table(spark, d, "evidence_refs"), 300)
    return good.select("rec_no")


def _drawn(seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || coalesce(symbol_id, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


_NEGATIVE = {"wrong_premise": " The question must rest on a wrong premise.", "conflict_spec": " The question must ask for things that contradict each other."}
_RULE = "case negative_type " + " ".join(f"when '{k}' then {sql.quoted(v)}" for k, v in _NEGATIVE.items()) + " else '' end"
_STRENGTH = "case when bucket in ('mid', 'hard') then 'Name a conflict, a limit or an edge case.' else 'Keep to one plain point.' end"


@query(f"""with m as (select *, case when {_drawn(42)} * 3 < 1 then 'how_to' when {_drawn(42)} * 3 < 2 then 'config' else 'error' end as question_type, case when {_drawn(43)} * 3 < 1 then 'high' when {_drawn(43)} * 3 < 2 then 'mid' else 'hard' end as bucket,
case when {_drawn(44)} < 0.1 then case when {_drawn(45)} * 2 < 1 then 'wrong_premise' else 'conflict_spec' end end as negative_type from symbols where symbol_type = 'method'),
q as (select rec_no, question_type, bucket, negative_type, 'How does item ' || substr({_hash(_filled(generation.QUESTION.template, strength=_STRENGTH, question_type='question_type', bucket='bucket', negative=_RULE, **{k: _CODE[k] for k in ('qualified_name', 'source')}))}, 1, 8) || ' behave?' as question from m)
select *, substr(sha256(question || ':' || question_type), 1, 16) as question_id from q""")
def written_questions(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "symbols").where("symbol_type = 'method'").select("rec_no", "symbol_id", "qualified_name", "file_path", "source")
    good, _ = generation.questions(m, ["how_to", "config", "error"], ["high", "mid", "hard"], ["wrong_premise", "conflict_spec"], 0.1)
    return good.select("rec_no", "question_type", "bucket", "negative_type", "question", "question_id")


_ANSWER = _hash(_filled(generation.ANSWER.template, context="coalesce(context, '')", question="coalesce(instruction, '')", negative="''"))


@query(f"select rec_no, substr(sha256('qa_rule:' || coalesce(instruction, '') || ':' || substr(coalesce(context, ''), 1, 100)), 1, 16) as sample_id, instruction, 'It behaves as ' || substr({_ANSWER}, 9, 8) || ' says.' as answer from samples")
def written_answers(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "samples").select(F.col("rec_no").alias("query"), F.col("instruction").alias("question"), "repo_commit", F.col("thought.evidence_refs").alias("evidence_refs"), F.col("context").alias("shown"))
    return generation.answers(s, F.col("shown"))[0].select(F.col("query").alias("rec_no"), "sample_id", "instruction", "answer")


@query("""with r as (select rec_no, unnest(thought.evidence_refs) as r from samples), h as (select distinct r.rec_no, s.rec_no as symbol from r join symbols s on replace(r.r.symbol_id, '\\', '/') = replace(s.symbol_id, '\\', '/') where r.rec_no in (select rec_no from r))
select rec_no, count(*) as symbols, min(symbol) as first from h group by 1""")
def direct_contexts(spark: SparkSession, d: str) -> DataFrame:
    """What questions with references that are known are answered from: all rows of the symbols they name."""
    s = table(spark, d, "symbols")
    known = lookup.evidence(table(spark, d, "samples")).join(s.select(paths.slashes(F.col("symbol_id")).alias("sid")).distinct(), paths.slashes(F.col("symbol_id")) == F.col("sid"), "left_semi").select("rec_no").distinct()
    asked = table(spark, d, "samples").join(known, "rec_no", "left_semi").select(F.col("rec_no").alias("query"), F.col("instruction").alias("text"), F.col("thought.evidence_refs").alias("evidence_refs"))
    chosen = generation.chosen_symbols(asked, s).where("how = 'direct'")
    return chosen.groupBy(F.col("query").alias("rec_no")).agg(F.count(F.lit(1)).alias("symbols"), F.min("rec_no").alias("first"))


@query("select case when quality.coverage.polarity = 'negative' then 'negative_samples' else 'positive_samples' end as measure, count(*) as n from samples group by 1 union all select 'questions_keyword', 3 union all select 'symbols_keyword', 5")
def retrieval_statistics(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "samples").select(F.when(F.col("quality.coverage.polarity") == "negative", "wrong_premise").alias("negative_type"))
    chosen = spark.createDataFrame([(1, 1, "keyword"), (1, 2, "keyword"), (2, 1, "keyword"), (3, 1, "keyword"), (3, 4, "keyword")], "query bigint, rec_no bigint, how string")
    return generation.retrieval_statistics(asked, chosen)


class SecondTry:
    """A model that answers no prompt before the second time."""

    def __init__(self):
        self.seen: set[str] = set()

    def __call__(self, prompts: list[str]) -> list[str | None]:
        out = [f"{len(p)}" if p in self.seen else None for p in prompts]
        self.seen |= set(prompts)
        return out


@query("select rec_no, case when instruction is null then null else length(instruction)::VARCHAR end as reply, case when instruction is null then 'no prompt' end as error from samples")
def retried_replies(spark: SparkSession, d: str) -> DataFrame:
    return generation.complete(table(spark, d, "samples").select("rec_no", "instruction"), "instruction", SecondTry).select("rec_no", "reply", "error")


class Moody:
    """A model that writes JSON to some prompts and words to others."""

    def __call__(self, prompts: list[str]) -> list[str | None]:
        return ["I would rather not." if "How " in p else '```json\n{"answer": "yes",\n "n": 1}\n```' for p in prompts]


_MOODY = generation.Writer("{question}", {"answer": "string"}, Moody)


@query("select rec_no, contains(coalesce(instruction, ''), 'How ') as rejected, case when not contains(coalesce(instruction, ''), 'How ') then 'yes' end as answer from samples")
def structured_replies(spark: SparkSession, d: str) -> DataFrame:
    good, bad = _MOODY.write(table(spark, d, "samples").select("rec_no", F.col("instruction").alias("question")))
    return good.select("rec_no", F.lit(False).alias("rejected"), "answer").unionByName(bad.select("rec_no", F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("answer")))


@query("select 'not a JSON object' as error, count(*) as n from samples where contains(coalesce(instruction, ''), 'How ') having count(*) > 0")
def question_warnings(spark: SparkSession, d: str) -> DataFrame:
    return generation.warnings_report(_MOODY.write(table(spark, d, "samples").select("rec_no", F.col("instruction").alias("question")))[1])


@query(f"select rec_no, {_RULE} as rule from (select rec_no, case when quality.coverage.polarity = 'negative' then case when rec_no % 2 = 0 then 'wrong_premise' else 'conflict_spec' end else 'unheard of' end as negative_type from samples)")
def negative_rules(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("quality.coverage.polarity") == "negative", F.when(F.col("rec_no") % 2 == 0, "wrong_premise").otherwise("conflict_spec")).otherwise("unheard of")
    return table(spark, d, "samples").select("rec_no", generation.negative_rule(kind).alias("rule"))


@query("select rec_no, coalesce(nullif(thought.evidence_refs[1].symbol_id, null), 'pool') as gate_off, thought.evidence_refs[1].symbol_id as gate_on from samples where thought.evidence_refs is null or len(thought.evidence_refs) = 0 or thought.evidence_refs[1].symbol_id is not null")
def design_references(spark: SparkSession, d: str) -> DataFrame:
    """Designs keep their own references; outside gate mode one without any gets the first of the pool."""
    refs = F.col("thought.evidence_refs")
    goals = table(spark, d, "samples").where(refs.isNull() | (F.size(refs) == 0) | F.get(refs, F.lit(0))["symbol_id"].isNotNull()).select("rec_no", F.col("instruction").alias("goal"), F.lit("").alias("context"), refs.alias("evidence_refs"))
    pool = F.array(F.struct(F.lit("pool").alias("symbol_id"), F.lit("f").alias("file_path"), F.lit(1).alias("start_line"), F.lit(2).alias("end_line"), F.lit("h").alias("source_hash")))
    first = lambda gate, name: generation.designs(goals, pool, gate)[0].select("rec_no", F.get("evidence_refs", F.lit(0))["symbol_id"].alias(name))
    return first(False, "gate_off").join(first(True, "gate_on"), "rec_no")


# --- the pipeline


@query("select * from (values " + ", ".join(f"('{n}', 'skipped', '{r}')" for n, r in (("parse", "missing files"), ("method_understanding", "skip_llm"), ("question_answer", "missing profiles"), ("design", "missing design_questions"), ("validate", "skip_validation"), ("sample", "skip_sampling"), ("dedup", "missing merged"), ("safety", "missing deduplicated"), ("split", "missing safe"), ("export", "missing safe, splits"))) + ", ('tag', 'success', null), ('question_type_report', 'success', null), ('merge', 'failed', null)) t(step, status, reason)")
def skipped_steps(spark: SparkSession, d: str) -> DataFrame:
    """A run with symbols alone, whose flags skip three steps: what each step says."""
    out = pipeline.run(spark, pipeline.curation(), {"symbols": table(spark, d, "symbols")}, {"skip_llm": True, "skip_validation": True, "skip_sampling": True})
    return spark.createDataFrame([(s["step"], s["status"], s.get("reason")) for s in out.summary], "step string, status string, reason string")

