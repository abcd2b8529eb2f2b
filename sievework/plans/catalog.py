"""All queries of the core by name, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import coverage, layers, paths, safety, similarity, text
from sievework.operators import assemble, dedup, distributions, export, generation, lookup, metrics, retrieval, sampling, splitting, tagging, validation
from sievework.plans import sql
from sievework.plans.registry import QUERIES, SQL, Query, query
from sievework.plans.scratch import Scratch
from sievework.sources.code import ParseRules, parse
from sievework.sources.tables import table

QUESTION = "How is a lost heartbeat handled by the carrier service when the outbox is drained"
TARGETS = {"high": 0.5, "mid": 0.3, "hard": 0.2}


def joined(c):
    return F.array_join(c, "|")


def sample_key():
    return F.concat(F.coalesce("instruction", F.lit("")), F.lit("\n"), F.coalesce("answer", F.lit("")))


# --- tags and distributions


@query(f"""with t as (select lower(coalesce(text,'')) as low from documents), u as (select {sql.intent('low')} as intent, low from t),
v as (select intent, {sql.bucket('intent', "'single'", 'low')} as bucket from u),
c as (select 'bucket' as dimension, bucket as value, count(*) as n from v group by bucket union all select 'intent', intent, count(*) from v group by intent)
select dimension, value, n, round(n / sum(n) over (partition by dimension), 4) as ratio from c""")
def distribution_by_tag(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lower(F.coalesce("text", F.lit(""))).alias("low")).withColumn("intent", coverage.topic_of(F.col("low")))
    docs = docs.withColumn("bucket", coverage.level_of(F.col("intent"), F.lit("single"), F.col("low")))
    return distributions.distributions(docs, {"bucket": (F.col("bucket"), "unknown"), "intent": (F.col("intent"), "unknown")})


@query(sql.TAGGED + "select rec_no, t_intent as intent, t_span as module_span, t_bucket as bucket, coalesce(quality.coverage.source, 'auto') as source, coalesce(scenario, '') as scenario from tagged")
def tag_samples(spark: SparkSession, d: str) -> DataFrame:
    return tagging.tag(table(spark, d, "samples")).select("rec_no", "tags.intent", "tags.module_span", "tags.bucket", "tags.source", "tags.scenario")


@query(sql.TAGGED + "select t_bucket as bucket, count(*) as n from tagged group by 1")
def tagged_bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    return tagging.tag(table(spark, d, "samples")).groupBy(F.col("tags.bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("select rec_no, case when quality.coverage.bucket in ('mid','hard') then 'strong' else 'weak' end as strength from samples")
def question_strength(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", coverage.constraint_strength("hybrid", F.coalesce("quality.coverage.bucket", F.lit(""))).alias("strength"))


@query("with c as (select coalesce(quality.coverage.question_type, 'unknown') as value, count(*) as n from samples group by 1) select value, n, round(n / sum(n) over (), 4) as ratio from c")
def distribution_of_question_type(spark: SparkSession, d: str) -> DataFrame:
    return distributions.distribution(table(spark, d, "samples"), F.col("quality.coverage.question_type"))


@query("""with t as (select coalesce(nullif(quality.coverage.bucket,''),'high') as bucket, coalesce(nullif(quality.coverage.intent,''),'unknown') as intent, coalesce(nullif(quality.coverage.module_span,''),'unknown') as module_span, coalesce(nullif(quality.coverage.polarity,''),'positive') as polarity from samples),
c as (select 'bucket' as dimension, bucket as value, count(*) as n from t group by bucket union all select 'intent', intent, count(*) from t group by intent union all select 'module_span', module_span, count(*) from t group by module_span union all select 'polarity', polarity, count(*) from t group by polarity)
select dimension, value, n, round(n / sum(n) over (partition by dimension), 4) as ratio from c""")
def coverage_distributions(spark: SparkSession, d: str) -> DataFrame:
    return distributions.coverage_distributions(table(spark, d, "samples"))


@query("""select count(*) as samples, min(length(coalesce(instruction,''))) as instruction_min, max(length(coalesce(instruction,''))) as instruction_max, round(avg(length(coalesce(instruction,''))),4) as instruction_avg,
min(length(coalesce(context,''))) as context_min, max(length(coalesce(context,''))) as context_max, round(avg(length(coalesce(context,''))),4) as context_avg,
min(length(coalesce(answer,''))) as answer_min, max(length(coalesce(answer,''))) as answer_max, round(avg(length(coalesce(answer,''))),4) as answer_avg,
min(coalesce(len(thought.evidence_refs),0)) as evidence_min, max(coalesce(len(thought.evidence_refs),0)) as evidence_max, round(avg(coalesce(len(thought.evidence_refs),0)),4) as evidence_avg from samples""")
def dataset_statistics(spark: SparkSession, d: str) -> DataFrame:
    return distributions.statistics(table(spark, d, "samples"))


@query("with c as (select coalesce(scenario, 'unknown') as value, count(*) as n from samples group by 1) select value, n, round(n / sum(n) over (), 4) as ratio from c")
def scenario_distribution(spark: SparkSession, d: str) -> DataFrame:
    return distributions.distribution(table(spark, d, "samples"), F.col("scenario"))


@query("select code, count(*) as n from (select unnest(quality.errors) as code from samples) group by 1 order by n desc, code limit 20")
def stored_top_errors(spark: SparkSession, d: str) -> DataFrame:
    return distributions.top_codes(table(spark, d, "samples").select("quality.errors"), "errors", 20)


@query("select symbol_type, count(*) as symbols, count(distinct replace(file_path, '\\', '/')) as files from symbols group by rollup(symbol_type)")
def parsing_report(spark: SparkSession, d: str) -> DataFrame:
    return distributions.parsing_report(table(spark, d, "symbols"))


@query("""with c as (select coalesce(nullif(quality.coverage.bucket,''),'high') as value, count(*) as n from samples group by 1), r as (select value, round(n / sum(n) over (), 4) as ratio from c),
t(value, target) as (values ('high', 0.5::DOUBLE), ('mid', 0.3::DOUBLE), ('hard', 0.2::DOUBLE)), x as (select t.value, coalesce(ratio, 0.0) as ratio, target from t left join r on t.value = r.value)
select value, round(ratio, 4) as ratio, target, round(abs(ratio - target), 4) as delta from x where abs(ratio - target) > 0.1""")
def target_regressions(spark: SparkSession, d: str) -> DataFrame:
    actual = distributions.distribution(table(spark, d, "samples"), F.coalesce(F.nullif("quality.coverage.bucket", F.lit("")), F.lit("high")))
    return distributions.compare_targets(actual, TARGETS, 0.1).select("value", "ratio", "target", F.round("delta", 4).alias("delta"))


@query(sql.TAGGED + """, a as (select coalesce(quality.coverage.bucket, 'unknown') as value, count(*) as n from samples group by 1), b as (select t_bucket as value, count(*) as n from tagged group by 1)
select coalesce(a.value, b.value) as value, coalesce(a.n, 0) as reported, coalesce(b.n, 0) as actual from a full join b on a.value = b.value where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def report_cross_check(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "samples")
    return distributions.cross_check(distributions.distribution(s, F.col("quality.coverage.bucket")), distributions.distribution(tagging.tag(s), F.col("tags.bucket")))


@query("""with t as (select coalesce(scenario,'unknown') as scenario, length(coalesce(answer,'')) as p, length(coalesce(context,'')) as r,
(len(list_filter(coalesce(thought.evidence_refs, []), lambda x: length(regexp_extract(x.symbol_id, '([^.:]+):[^:]*$', 1)) > 0 and contains(answer, regexp_extract(x.symbol_id, '([^.:]+):[^:]*$', 1)))) > 0)::INT as h from samples)
select scenario, count(*) as n, round(avg(p),4) as prediction_avg, round(avg(r),4) as reference_avg, round(avg(coalesce(h,0)),4) as hit_rate from t group by rollup(scenario)""")
def evaluation_report(spark: SparkSession, d: str) -> DataFrame:
    return distributions.evaluation(table(spark, d, "samples"), "answer", "context", "thought.evidence_refs")


# --- symbols, references and validation


@query("select replace(symbol_id, '\\', '/') as sid, max(rec_no) as rec_no from symbols where symbol_id is not null group by 1")
def symbol_map(spark: SparkSession, d: str) -> DataFrame:
    return lookup.symbol_map(table(spark, d, "symbols")).select("sid", "rec_no")


@query("select rec_no, replace(file_path, '\\', '/') as path from symbols")
def normalised_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", paths.slashes(F.col("file_path")).alias("path"))


@query("select rec_no from samples where scenario = 'qa_rule'")
def qa_samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").where("scenario = 'qa_rule'").select("rec_no")


@query("select rec_no from symbols where symbol_type = 'method'")
def methods(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").where("symbol_type = 'method'").select("rec_no")


@query(f"select rec_no, {sql.layer()} as layer from symbols")
def symbol_layers(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.with_layer(table(spark, d, "symbols")).select("rec_no", "layer")


@query(f"select coalesce({sql.layer()}, 'other') as layer, count(*) as n from symbols group by 1")
def layer_distribution(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.with_layer(table(spark, d, "symbols")).groupBy(F.coalesce("layer", F.lit("other")).alias("layer")).agg(F.count(F.lit(1)).alias("n"))


@query(sql.VALIDATED + "select rec_no, v_passed as passed, array_to_string(errors, '|') as errors, array_to_string(warnings, '|') as warnings, case when ok then case when v_trace then 'warn' else 'pass' end end as trace from verdicts")
def validate_samples(spark: SparkSession, d: str) -> DataFrame:
    v = validation.validate(table(spark, d, "samples"), table(spark, d, "symbols"))
    return v.select("rec_no", "verdict.passed", joined("verdict.errors").alias("errors"), joined("verdict.warnings").alias("warnings"), F.try_element_at("verdict.checks", F.lit("trace")).alias("trace"))


@query(sql.VALIDATED + "select count(*) as total, count(*) filter (v_passed) as passed, count(*) filter (not v_passed) as failed, round(count(*) filter (v_passed) / count(*), 4) as pass_rate, count(*) filter (v_trace) as warning_samples, round(count(*) filter (v_trace) / count(*), 4) as warning_rate from verdicts")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    v = validation.validate(table(spark, d, "samples"), table(spark, d, "symbols"))
    return distributions.pass_rates(v.select("verdict.passed", "verdict.checks"))


@query(sql.VALIDATED + "select code, count(*) as n from (select unnest(errors) as code from verdicts) group by 1 order by n desc, code limit 20")
def validation_top_errors(spark: SparkSession, d: str) -> DataFrame:
    v = validation.validate(table(spark, d, "samples"), table(spark, d, "symbols"))
    return distributions.top_codes(v.select("verdict.errors"), "errors", 20)


@query(sql.VALIDATED + "select code, count(*) as n from (select unnest(warnings) as code from verdicts) where starts_with(code, 'TRACE_') group by 1 order by n desc, code limit 10")
def validation_trace_warnings(spark: SparkSession, d: str) -> DataFrame:
    v = validation.validate(table(spark, d, "samples"), table(spark, d, "symbols"))
    return distributions.top_codes(v.select(F.filter("verdict.warnings", lambda c: c.startswith("TRACE_")).alias("w")), "w", 10)


@query(sql.VALIDATED + "select rec_no as line, scenario, errors[1] as error, case when length(instruction) > 100 then substr(instruction, 1, 100) || '...' else instruction end as instruction from verdicts where not v_passed")
def rejected_samples(spark: SparkSession, d: str) -> DataFrame:
    v = validation.validate(table(spark, d, "samples"), table(spark, d, "symbols"))
    return validation.rejected(v).select("line", "scenario", "error", "instruction")


@query("select rec_no, coalesce(sha256(source) = source_hash, false) as fits from symbols")
def hash_check(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", paths.hash_fits(F.col("source"), F.col("source_hash")).alias("fits"))


@query("select rec_no, coalesce(len(thought.observations) + len(thought.inferences) + len(thought.assumptions) + len(thought.evidence_refs) = 0, true) as empty from samples")
def empty_traces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", validation.trace_empty(F.col("thought")).alias("empty"))


@query("select rec_no, coalesce(len(thought.evidence_refs) = 0 or len(list_filter(thought.evidence_refs, lambda r: coalesce(r.symbol_id,'') = '' or coalesce(r.file_path,'') = '' or r.start_line is null or r.end_line is null or coalesce(r.source_hash,'') = '')) > 0, true) as incomplete from samples")
def incomplete_refs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", lookup.refs_incomplete(F.col("thought.evidence_refs")).alias("incomplete"))


@query("""with t as (select rec_no, thought.evidence_refs as refs, thought.evidence_refs[1] as df from samples where len(thought.evidence_refs) > 0 and thought.evidence_refs[1].symbol_id <> '' and thought.evidence_refs[1].file_path <> '' and thought.evidence_refs[1].source_hash <> '' and thought.evidence_refs[1].start_line is not null and thought.evidence_refs[1].end_line is not null),
u as (select rec_no, 0 as pos, df.symbol_id as sid, df.start_line as a, df.end_line as b from t union all
 select rec_no, pos, case when same then coalesce(nullif(r.symbol_id,''), df.symbol_id) else r.symbol_id end, case when same then coalesce(nullif(r.start_line,0), df.start_line) else r.start_line end, case when same then coalesce(nullif(r.end_line,0), df.end_line) else r.end_line end
 from (select rec_no, df, unnest(refs) as r, generate_subscripts(refs, 1) as pos from t) z, lateral (select coalesce(r.symbol_id = df.symbol_id, false) or coalesce(r.file_path = df.file_path, false) as same) q
 where case when same then true else coalesce(r.symbol_id,'') <> '' and coalesce(r.file_path,'') <> '' and coalesce(r.source_hash,'') <> '' and r.start_line is not null and r.end_line is not null end),
w as (select rec_no, sid, a, b, min(pos) as pos from u group by all), x as (select *, row_number() over (partition by rec_no order by pos) as k from w)
select rec_no, array_to_string(list(sid || '@' || a || '-' || b order by pos), '|') as refs from x where k <= 3 group by rec_no""")
def available_refs(spark: SparkSession, d: str) -> DataFrame:
    first = F.get("thought.evidence_refs", F.lit(0))
    rows = table(spark, d, "samples").where(F.size("thought.evidence_refs") > 0).withColumn("first", first).where(lookup.complete(F.col("first")))
    got = lookup.available_refs(F.col("thought.evidence_refs"), F.col("first"))
    return rows.select("rec_no", joined(F.transform(got, lambda r: F.concat(r["symbol_id"], F.lit("@"), r["start_line"].cast("string"), F.lit("-"), r["end_line"].cast("string")))).alias("refs"))


@query(f"with {sql.SYMBOL_MAP}, refs as (select rec_no, unnest(thought.evidence_refs) as r, generate_subscripts(thought.evidence_refs, 1) - 1 as pos from samples) select refs.rec_no, pos::INT as pos, sym.sid is not null as found, sym.rec_no as symbol_rec from refs left join sym on replace(r.symbol_id, '\\', '/') = sym.sid")
def evidence_join(spark: SparkSession, d: str) -> DataFrame:
    refs = lookup.evidence(table(spark, d, "samples"))
    return lookup.evidence_symbols(refs, table(spark, d, "symbols")).select("rec_no", "pos", "found", F.col("s_rec_no").alias("symbol_rec"))


@query(f"with {sql.SYMBOL_MAP} select e.ref_no, sym.rec_no as symbol_rec from evidence_refs e join sym on replace(e.symbol_id, '\\', '/') = sym.sid")
def profile_join(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "evidence_refs").select("ref_no", "symbol_id")
    return lookup.profile_symbols(refs, table(spark, d, "symbols")).select("ref_no", F.col("rec_no").alias("symbol_rec"))


@query("select rec_no from symbols s where exists (select 1 from evidence_refs e where replace(e.symbol_id, '\\', '/') = replace(s.symbol_id, '\\', '/'))")
def cited_symbols(spark: SparkSession, d: str) -> DataFrame:
    return lookup.cited_symbols(table(spark, d, "symbols"), table(spark, d, "evidence_refs")).select("rec_no")


@query("select rec_no from symbols s where symbol_type = 'method' and not exists (select 1 from evidence_refs e where e.symbol_id = s.symbol_id)")
def unprocessed_methods(spark: SparkSession, d: str) -> DataFrame:
    return lookup.unprocessed(table(spark, d, "symbols").where("symbol_type = 'method'"), table(spark, d, "evidence_refs")).select("rec_no")


@query("""with s as (select rec_no, replace(symbol_id, '\\', '/') as sid, replace(file_path, '\\', '/') as fp, start_line, end_line from symbols where symbol_id is not null),
ex as (select sid, arg_min(struct_pack(i := sid, f := fp, a := start_line, b := end_line), rec_no) as m from s group by sid),
lo as (select regexp_replace(sid, ':[^:]*$', '') as prefix, arg_min(struct_pack(i := sid, f := fp, a := start_line, b := end_line), rec_no) as m from s group by 1),
j as (select e.ref_no, e.symbol_id, e.file_path, e.start_line, e.end_line, ex.m as m1, lo.m as m2 from evidence_refs e left join ex on replace(e.symbol_id, '\\', '/') = ex.sid left join lo on contains(e.symbol_id, ':') and regexp_replace(replace(e.symbol_id, '\\', '/'), ':[^:]*$', '') = lo.prefix)
select ref_no, case when m1 is not null then 'exact' when m2 is not null then 'prefix' else 'none' end as how, case when coalesce(m1, m2) is null then symbol_id else coalesce(m1, m2).i end as symbol_id,
case when coalesce(m1, m2) is null then file_path else coalesce(m1, m2).f end as file_path, case when coalesce(m1, m2) is null then start_line else coalesce(m1, m2).a end as start_line, case when coalesce(m1, m2) is null then end_line else coalesce(m1, m2).b end as end_line
from j where coalesce(m1, m2) is not null or file_path is not null""")
def corrected_refs(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "evidence_refs").select("ref_no", "symbol_id", "file_path", "start_line", "end_line", "source_hash")
    return lookup.corrected_refs(refs, table(spark, d, "symbols")).select("ref_no", "how", "symbol_id", "file_path", "start_line", "end_line")


CALLS = f"""calls as (select distinct rec_no as caller, unnest(list_filter(list_transform(regexp_extract_all(coalesce(source,''), '[\\p{{L}}\\p{{N}}_]+\\s*\\('), lambda x: regexp_replace(x, '\\s*\\($', '')),
 lambda x: regexp_matches(x, '^[A-Za-z_][A-Za-z0-9_]*$') and x not in ({",".join(sql.quoted(w) for w in text.CALL_STOPWORDS)}))) as name from symbols)"""


@query(f"with {CALLS} select caller as rec_no, array_to_string(list(name order by name), '|') as names from calls group by 1")
def called_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", joined(F.sort_array(text.call_names(F.col("source")))).alias("names")).where("names <> ''")


@query(f"with {CALLS} select caller, count(*) as callees, min(m.rec_no) as first_callee from calls join symbols m on m.symbol_type = 'method' and m.name = calls.name group by 1")
def call_edges(spark: SparkSession, d: str) -> DataFrame:
    return lookup.call_edges(table(spark, d, "symbols")).groupBy("caller").agg(F.sum("callees").alias("callees"), F.min("first_callee").alias("first_callee"))


@query(f"""with recursive {CALLS}, own as (select symbol_id, min(rec_no) as rec_no from symbols group by 1), edges as (select distinct c.caller, m.rec_no as callee from calls c join own o on o.rec_no = c.caller join symbols m on m.symbol_type = 'method' and m.name = c.name join own o2 on o2.rec_no = m.rec_no),
seeds as (select rec_no from own where rec_no % 3 = 0), d1 as (select distinct callee from edges where caller in (select rec_no from seeds) and callee not in (select rec_no from seeds)),
d2 as (select distinct callee from edges where caller in (select callee from d1) and callee not in (select rec_no from seeds) and callee not in (select callee from d1))
select rec_no, depth::INT as depth from (select callee as rec_no, 1 as depth from d1 union all select callee, 2 from d2) order by depth, rec_no limit 200""")
def call_expansion(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "symbols")
    first = s.groupBy("symbol_id").agg(F.min("rec_no").alias("rec_no"))
    return lookup.expand_calls(first.where("rec_no % 3 = 0").select("rec_no"), s, 2, 200)


@query("with f as (select replace(symbol_id, '\\', '/') as sid, min(rec_no) as rec_no from symbols group by 1) select rec_no from f")
def first_symbols(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "symbols")
    return dedup.first_by(s.select("rec_no", "symbol_id"), paths.slashes(F.col("symbol_id")), "rec_no").select("rec_no")


@query("select min(rec_no) as rec_no from samples group by substr(md5(lower(coalesce(instruction,''))), 1, 16)")
def question_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.question_dedup(table(spark, d, "samples").select("rec_no", "instruction"), "instruction", "rec_no").select("rec_no")


# --- groups and splits


@query(sql.GROUP_KEY + "select rec_no, group_key from keyed")
def sample_group_keys(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_keys(table(spark, d, "samples"), table(spark, d, "symbols")).select("rec_no", "group_key")


@query(sql.GROUP_KEY + """, g as (select group_key, split, count(*) as n from keyed group by all), p as (select group_key, count(distinct split) as places from keyed group by 1)
select split, sum(n)::BIGINT as samples, count(*) as groups, count(*) filter (places > 1) as shared_groups, round(sum(n) / (select count(*) from keyed), 4) as ratio from g join p using (group_key) group by split""")
def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    keyed = splitting.group_keys(table(spark, d, "samples"), table(spark, d, "symbols")).select("group_key", "split")
    return distributions.split_report(keyed).select("split", F.col("samples").cast("bigint").alias("samples"), "groups", "shared_groups", "ratio")


@query("""select rec_no, case when len(string_split(qualified_name, '.')) >= 3 then array_to_string(string_split(qualified_name, '.')[1:len(string_split(qualified_name, '.')) - 2], '.') when len(string_split(qualified_name, '.')) = 2 then string_split(qualified_name, '.')[1] else '' end as package,
case when contains(replace(file_path, '\\', '/'), '/') then regexp_extract(replace(file_path, '\\', '/'), '^(.*)/[^/]*$', 1) else '' end as directory from symbols where qualified_name is not null""")
def packages(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "symbols").where("qualified_name is not null")
    return s.select("rec_no", paths.package_of(F.col("qualified_name")).alias("package"), paths.directory_of(paths.slashes(F.col("file_path"))).alias("directory"))


def _cuts(n: str) -> str:
    """(a, b) of n groups or rows: the shares of train and val rounded down, at least one each."""
    a, b = f"greatest(floor({n} * 0.8::DOUBLE), 1)", f"greatest(floor({n} * 0.1::DOUBLE), 1)"
    return f"case when {a} + {b} >= {n} then greatest(1, {n} - 2) else {a} end as a, case when {a} + {b} >= {n} then 1 else {b} end as b"


def _split_sql(where: str) -> str:
    return f"""select rec_no, group_key, case when r <= a then 'train' when r <= a + b then 'val' else 'test' end as split from
     (select *, {_cuts("n")} from (select group_key, row_number() over (order by md5('42:' || group_key), group_key) as r, count(*) over () as n from (select distinct group_key from keyed where {where}))) join keyed using (group_key) where {where}"""


@query(sql.GROUP_KEY + _split_sql("true"))
def group_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.group_split(table(spark, d, "samples"), table(spark, d, "symbols"))


@query(sql.GROUP_KEY + ", labelled as (select keyed.*, samples.scenario from keyed join samples using (rec_no)) " + " union all ".join(f"select *, '{n}' as part from ({_split_sql(w).replace('keyed', 'labelled')})" for n, w in (("all", "true"), ("qa", "scenario = 'qa_rule'"), ("design", "scenario = 'arch_design'"))))
def scenario_splits(spark: SparkSession, d: str) -> DataFrame:
    parts = splitting.split_all(table(spark, d, "samples"), table(spark, d, "symbols"))
    return assemble.union(*[p.withColumn("part", F.lit(n)) for n, p in parts.items()])


# --- sampling


@query("select rec_no, rank from (select rec_no, row_number() over (order by md5('42:' || rec_no), rec_no) as rank from samples) where rank <= 100")
def reservoir_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.reservoir(table(spark, d, "samples").select("rec_no"), 100, "rec_no")


_IN_STRATUM = "row_number() over (partition by {0} order by md5('42:' || rec_no), rec_no)"


_SCENARIO = "coalesce(scenario, 'unknown')"


@query(f"select * from (select rec_no, {_SCENARIO} as stratum, {_IN_STRATUM.format(_SCENARIO)} as rank from samples) where rank <= 20")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified(table(spark, d, "samples").select("rec_no", "scenario"), F.col("scenario"), 20, "rec_no").select("rec_no", "stratum", "rank")


@query(f"select * from (select rec_no, quality.coverage.bucket as bucket, {_IN_STRATUM.format('quality.coverage.bucket')} as rank from samples) where rank <= case bucket when 'high' then 250 when 'mid' then 150 when 'hard' then 100 end")
def coverage_sample(spark: SparkSession, d: str) -> DataFrame:
    s = sampling.by_coverage(table(spark, d, "samples").select("rec_no", "quality"), TARGETS, 500, "rec_no")
    return s.select("rec_no", F.col("quality.coverage.bucket").alias("bucket"), "rank")


def _quota_sql(ratio: float) -> str:
    """Seats from counts, then the rows by their rank: negatives first where positives lack, borrowing hard from mid and high, mid from high."""
    levels = ("high", "mid", "hard")
    wide = ", ".join(f"max({c}) filter (lvl = '{b}') as {c}_{b}" for b in levels for c in ("neg", "pos", "ln", "lp", "gap"))
    return f"""with c as (select rec_no, case when quality.coverage.bucket in ('high', 'mid', 'hard') then quality.coverage.bucket else 'high' end as lvl, coalesce(quality.coverage.polarity = 'negative', false) as negative from samples),
    t(lvl, share) as (values ('high', {TARGETS['high']}::DOUBLE), ('mid', {TARGETS['mid']}::DOUBLE), ('hard', {TARGETS['hard']}::DOUBLE)),
    n as (select t.lvl, share, count(*) filter (negative) as cn, count(*) filter (not negative) as cp, sum(count(rec_no)) over () as total from t left join c on c.lvl = t.lvl group by t.lvl, share),
    w as (select *, (round_even(total * share, 0) + case when lvl = 'high' then total - sum(round_even(total * share, 0)) over () else 0 end)::BIGINT as seats from n),
    g as (select *, least(cn, greatest(round_even(seats * {ratio}::DOUBLE, 0)::BIGINT, seats - cp)) as neg from w),
    p as (select *, least(cp, seats - neg) as pos from g),
    l as (select *, cn - neg as ln, cp - pos as lp, seats - neg - pos as gap from p),
    o as (select {wide} from l),
    h as (select *, least(gap_hard, ln_mid) as h1 from o), h2 as (select *, least(gap_hard - h1, lp_mid) as h2 from h), h3 as (select *, least(gap_hard - h1 - h2, ln_high) as h3 from h2), h4 as (select *, least(gap_hard - h1 - h2 - h3, lp_high) as h4 from h3),
    m1 as (select *, least(gap_mid, ln_high - h3) as m1 from h4), m2 as (select *, least(gap_mid - m1, lp_high - h4) as m2 from m1),
    cuts(lvl, negative, after, upto, filled) as ({" union all ".join([f"select '{b}', true, 0, neg_{b}, '{b}' from m2 union all select '{b}', false, 0, pos_{b}, '{b}' from m2" for b in levels] + ["select 'mid', true, neg_mid, neg_mid + h1, 'hard' from m2", "select 'mid', false, pos_mid, pos_mid + h2, 'hard' from m2", "select 'high', true, neg_high, neg_high + h3, 'hard' from m2", "select 'high', false, pos_high, pos_high + h4, 'hard' from m2", "select 'high', true, neg_high + h3, neg_high + h3 + m1, 'mid' from m2", "select 'high', false, pos_high + h4, pos_high + h4 + m2, 'mid' from m2"])}),
    r as (select *, {_IN_STRATUM.format("lvl, negative")} as rank from c)
    select rec_no, filled from r join cuts using (lvl, negative) where rank > after and rank <= upto"""


@query(_quota_sql(0.1))
def coverage_quota_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.quota_sample(table(spark, d, "samples").select("rec_no", "quality"), TARGETS, "rec_no", 42, 0.1)[0].select("rec_no", "filled")


_LEVELS = "count(*) filter (filled = 'high') as high, count(*) filter (filled = 'mid') as mid, count(*) filter (filled = 'hard') as hard"


@query(f"select 'hybrid' as mode, {_LEVELS}, count(*) as n from ({_quota_sql(0.1)}) union all select 'upstream', null, null, null, count(*) from samples union all select 'small', null, null, null, count(*) from samples")
def quota_reports(spark: SparkSession, d: str) -> DataFrame:
    """What the sampler reports, and how many rows pass it untouched where it is bypassed."""
    s = table(spark, d, "samples").select("rec_no", "quality")
    parts = []
    for mode, options in (("hybrid", {"negative_ratio": 0.1}), ("upstream", {"mode": "upstream"}), ("small", {"min_size": 1 << 60})):
        out, report = sampling.sample_or_pass(s, TARGETS, "rec_no", **options)
        levels = [F.lit(report.get("final_counts", {}).get(b)).cast("bigint").alias(b) for b in coverage.BUCKETS]
        parts.append(out.agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("mode"), *levels, "n"))
    return assemble.union(*parts)


@query(f"select * from (select rec_no, {_SCENARIO} as scenario, {_IN_STRATUM.format(_SCENARIO)} as rank from samples) where rank <= 5")
def human_evaluation_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "samples").select("rec_no", F.coalesce("scenario", F.lit("unknown")).alias("scenario"))
    return sampling.hashed_sample(rows, 5, ["scenario"], ["rec_no"])


@query("select rec_no from samples order by rec_no limit 100")
def first_samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").orderBy("rec_no").limit(100).select("rec_no")


def _drawn(seed: int, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || coalesce({key}::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"


@query(f"""select rec_no, case when a <= 0.8 then 'high' when a <= 0.95 then 'mid' when a <= 1.0 then 'hard' else 'high' end as bucket, case when b < 0.1 then case when c < 0.5 then 'wrong_premise' else 'conflict_spec' end end as negative_type
from (select rec_no, {_drawn(1, "rec_no")} as a, {_drawn(2, "rec_no")} as b, {_drawn(3, "rec_no")} as c from symbols)""")
def drawn_labels(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("rec_no")
    return table(spark, d, "symbols").select("rec_no", sampling.weighted_choice({"high": 0.8, "mid": 0.15, "hard": 0.05}, "high", sampling.uniform(1, key)).alias("bucket"), sampling.maybe(0.1, ["wrong_premise", "conflict_spec"], sampling.uniform(2, key), sampling.uniform(3, key)).alias("negative_type"))


# --- deduplication


@query(sql.SIMHASH + "select rec_no as row, fp from fp")
def simhash_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return dedup.fingerprints(table(spark, d, "samples"), sample_key(), "rec_no")


@query(sql.SIMHASH + ", r as (select fp, min(rec_no) as row from fp group by fp) select x.row as a, y.row as b, bit_count(xor(x.fp, y.fp))::INT as distance from r x join r y on x.row < y.row where bit_count(xor(x.fp, y.fp)) <= 3")
def simhash_pairs(spark: SparkSession, d: str) -> DataFrame:
    fps = dedup.fingerprints(table(spark, d, "samples"), sample_key(), "rec_no")
    scratch = Scratch(spark, "pairs")
    return dedup.near_pairs(scratch.write(fps.groupBy("fp").agg(F.min("row").alias("row")), "fps"), 3)


# one row after the other: a fingerprint is kept unless a kept one is near; then the first kept row that near of every row
_GREEDY = """, u as (select fp, min(rec_no) as row from fp group by fp), n as (select *, row_number() over (order by row) as i from u),
step(i, kept) as (select 0::BIGINT, []::BIGINT[] union all select n.i, case when len(list_filter(kept, lambda k: bit_count(xor(k, n.fp)) <= 3)) > 0 then kept else list_append(kept, n.fp) end from step join n on n.i = step.i + 1),
k as (select unnest(kept) as fp from (select kept from step order by i desc limit 1)), kr as (select u.* from u join k using (fp)),
b as (select u.fp, min(struct_pack(row := kr.row, distance := bit_count(xor(u.fp, kr.fp))::INT)) as m from u join kr on bit_count(xor(u.fp, kr.fp)) <= 3 and kr.row <= u.row group by u.fp)
select fp.rec_no as row, fp.rec_no = m.row as kept, m.row as kept_row, m.distance as distance from fp join b using (fp)"""


@query(sql.SIMHASH.replace("with src", "with recursive src", 1) + _GREEDY)
def simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.simhash_dedup(dedup.fingerprints(table(spark, d, "samples"), sample_key(), "rec_no"), 3)


@query(sql.SIMHASH + """, o as (select fp, lag(fp) over (order by rec_no) as before from fp)
select count(*) as total, count(distinct fp) as unique_hashes, round(avg(bit_count(xor(fp, before))) , 4) as avg_hamming, min(bit_count(xor(fp, before)))::INT as min_hamming, max(bit_count(xor(fp, before)))::INT as max_hamming, round(count(distinct fp) / count(*), 4) as uniqueness_rate from o""")
def diversity(spark: SparkSession, d: str) -> DataFrame:
    fps = dedup.fingerprints(table(spark, d, "samples"), sample_key(), "rec_no").withColumnRenamed("row", "rec_no")
    return distributions.diversity(lookup.numbered(Scratch(spark, "diversity").write(fps, "fps"), "rec_no"))


_COSINE = "with e as ({1}) select x.vec_id as a, y.vec_id as b, round(list_cosine_similarity(x.v, y.v), 4) as similarity from e x join e y on x.vec_id < y.vec_id where list_cosine_similarity(x.v, y.v) >= {0}"
_VECTORS = "select vec_id, embedding::DOUBLE[] as v from embeddings"


@query(_COSINE.format(0.92, f"{_VECTORS} union all select vec_id + 1099511627776, list_transform(v, lambda x: 2 * x) from ({_VECTORS}) where vec_id % 5 = 0"))
def near_equal_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Pairs at the threshold of deduplication; every fifth vector is there a second time, twice as long."""
    vecs = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").cast("array<double>").alias("vec"))
    longer = vecs.where("row % 5 = 0").select((F.col("row") + (1 << 40)).alias("row"), F.transform("vec", lambda x: x * 2).alias("vec"))
    return dedup.cosine_pairs(vecs.unionByName(longer), 0.92).select("a", "b", F.round("similarity", 4).alias("similarity"))


@query(_COSINE.format(0.4, _VECTORS))
def semantic_pairs(spark: SparkSession, d: str) -> DataFrame:
    vecs = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("vec"))
    return dedup.cosine_pairs(vecs, 0.4).select("a", "b", F.round("similarity", 4).alias("similarity"))


@query("""with recursive e as (select vec_id, embedding::DOUBLE[] as v, row_number() over (order by vec_id) as i from embeddings),
near as (select y.i, list(x.i order by x.i) as before from e y join e x on x.i < y.i and list_cosine_similarity(x.v, y.v) >= 0.4 group by y.i),
step(i, kept) as (select 0::BIGINT, []::BIGINT[] union all select e.i, case when list_has_any(kept[greatest(len(kept) - 1999, 1):], coalesce(near.before, [])) then kept else list_append(kept, e.i) end from step join e on e.i = step.i + 1 left join near on near.i = e.i),
r as (select e.*, coalesce(near.before, []) as before, step.kept[greatest(len(step.kept) - 1999, 1):] as window_ from e join step on step.i = e.i - 1 left join near on near.i = e.i),
f as (select vec_id, v, list_filter(window_, lambda x: list_contains(before, x))[1] as hit from r)
select f.vec_id as row, hit is null as kept, coalesce(o.vec_id, f.vec_id) as kept_row, round(list_cosine_similarity(f.v, o.v), 4) as similarity from f left join e o on o.i = hit""")
def semantic_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.semantic_dedup(table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("vec")), 0.4, 2000)


# --- retrieval


@query("""with q as (select embedding::DOUBLE[] as v from embeddings order by vec_id limit 1), s as (select vec_id as row, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) as score from embeddings, q)
select row, score from s order by score desc, row limit 10""")
def vector_top(spark: SparkSession, d: str) -> DataFrame:
    vecs = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("vec"))
    first = vecs.orderBy("row").limit(1).first()
    return retrieval.nearest(vecs, list(first["vec"]) if first else [], 10).select("row", "score")


@query("""with e as (select vec_id, embedding::DOUBLE[] as v from embeddings), s as (select q.vec_id as query, e.vec_id as row, round(list_cosine_similarity(q.v, e.v), 6) as score from e q join e on q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query order by score desc, row) as rank from s) select query, rank::INT as rank, row, score from r where rank <= 10""")
def vector_search(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    rows = e.select(F.col("vec_id").alias("row"), F.col("embedding").alias("vec"))
    return retrieval.nearest_all(rows, e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vec")), 10)


def _keyword_sql(most: int) -> str:
    words = sorted(set(QUESTION.lower().split()))
    n, p, s = "lower(coalesce(qualified_name,''))", "lower(coalesce(file_path,''))", "lower(coalesce(source,''))"
    score = " + ".join(f"case when contains({n}, '{w}') then 10.0::DOUBLE when contains({p}, '{w}') then 5.0 when contains({s}, '{w}') then 1.0 else 0.0 end" for w in words)
    return f"select rec_no, score from (select rec_no, {score} as score from symbols) where score > 0 order by score desc, rec_no limit {most}"


@query(_keyword_sql(20))
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.keyword_top(table(spark, d, "symbols"), QUESTION, 20).select("rec_no", "score")


_MARKS = ",".join(sql.quoted(a) for a in layers.JAVA.business_annotations)


@query(f"""select rec_no, priority from (select rec_no, (10 * len(list_filter(coalesce(annotations, []), lambda a: a.name in ({_MARKS}))) + case when length(doc) > 0 then 5 else 0 end + case when end_line - start_line + 1 between 10 and 100 then 5 else 0 end)::INT as priority from symbols where symbol_type = 'method') order by priority desc, rec_no limit 200""")
def top_methods(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.top_methods(table(spark, d, "symbols"), 200).select("rec_no", "priority")


def _retrieve_sql(k: int, most: int) -> str:
    n, p, s = "lower(coalesce(qualified_name,''))", "lower(coalesce(file_path,''))", "lower(coalesce(source,''))"
    words = sorted(set(QUESTION.lower().split()))
    weight = " + ".join(f"case when contains({n}, '{w}') then {layers.JAVA.name_weight}::DOUBLE when contains({p}, '{w}') then {layers.JAVA.path_weight} when contains({s}, '{w}') then {layers.JAVA.source_weight} else 0.0 end" for w in words)
    bonus = " + ".join(f"contains({n}, '{w}')::INT" for w in layers.JAVA.keywords)
    titles = ", ".join(f"('{t}')" for t in layers.JAVA.layers)
    return f"""with {CALLS}, scored as (select rec_no, {sql.layer()} as layer, {weight} + {bonus} as score from symbols),
    base as (select rec_no, score from scored where score > 0 order by score desc, rec_no limit {k}),
    own as (select min(rec_no) as rec_no from symbols group by symbol_id),
    called as (select distinct m.rec_no from calls c join symbols m on m.symbol_type = 'method' and m.name = c.name where c.caller in (select rec_no from base) and c.caller in (select rec_no from own) and m.rec_no in (select rec_no from own) and m.rec_no not in (select rec_no from base) order by 1 limit {most}),
    chosen as (select rec_no from base union all select rec_no from called),
    lacking as (select l.layer from (values {titles}) l(layer) where l.layer not in (select layer from scored where layer is not null and rec_no in (select rec_no from chosen))),
    extra as (select rec_no from (select rec_no, layer, row_number() over (partition by layer order by score desc, rec_no) as r from scored where layer in (select layer from lacking)) where r = 1),
    every as (select rec_no, 0 as stage, -score as sort, 'keyword' as how from base union all select rec_no, 1, 1.0, 'call' from called union all select rec_no, 2, 0.0, 'layer' from extra)
    select rec_no, how, row_number() over (order by stage, sort, rec_no)::INT as place from every"""


@query(_retrieve_sql(6, 20))
def retrieve_symbols(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.retrieve(table(spark, d, "symbols"), QUESTION)


@query(f"""with {sql.SYMBOL_MAP}, refs as (select rec_no, unnest(thought.evidence_refs) as r, generate_subscripts(thought.evidence_refs, 1) as pos from samples)
select refs.rec_no, md5(array_to_string(list('// File: ' || replace(coalesce(sym.file_path,''), '\\', '/') || chr(10) || '// Method: ' || coalesce(sym.qualified_name,'') || chr(10) || coalesce(sym.source,'') order by pos), chr(10) || chr(10))) as context from refs join sym on replace(r.symbol_id, '\\', '/') = sym.sid group by 1""")
def sample_contexts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "symbols")
    refs = lookup.evidence_symbols(lookup.evidence(table(spark, d, "samples")), s).where("found")
    chosen = refs.select(F.col("rec_no").alias("sample"), F.col("pos").alias("place"), F.col("s_rec_no").alias("rec_no"))
    return retrieval.context(chosen, s, "sample").select(F.col("sample").alias("rec_no"), F.md5("context").alias("context"))


def _layered_sql() -> str:
    names = [*layers.JAVA.layers]
    rank = "case layer " + " ".join(f"when '{n}' then {i}" for i, n in enumerate(names)) + f" else {len(names)} end"
    title = f"case {rank} " + " ".join(f"when {i} then chr(10) || '# {n.capitalize()} 层'" for i, n in enumerate(names)) + " else chr(10) || '# Other Components' end"
    part = f"'## ' || coalesce(qualified_name, '') || ' (File: ' || replace(file_path, '\\', '/') || ' Lines: ' || start_line || '-' || end_line || ')' || chr(10) || '```{layers.JAVA.name}' || chr(10) || substr(source, 1, 800) || chr(10) || '```'"
    return f"""with chosen as ({_retrieve_sql(6, 20)}), j as (select place, {part} as part, {rank} as rank, {title} as title from (select c.place, s.*, {sql.layer()} as layer from chosen c join symbols s using (rec_no))),
    bodies as (select rank, any_value(title) || chr(10) || string_agg(part, chr(10) order by place) as body from j group by rank)
    select string_agg(body, chr(10) order by rank) as context from bodies"""


@query(_layered_sql())
def layered_context(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "symbols")
    return retrieval.layered_context(retrieval.retrieve(s, QUESTION), s)


@query("""select rec_no, array_to_string(list_filter([nullif(qualified_name,''), nullif(doc,''), case when len(annotations) > 0 then '业务规则: ' || array_to_string(list_transform(annotations, lambda a: a.name), '; ') end], lambda x: x is not null), ' | ') as text from symbols""")
def embedding_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", text.embedding_text(F.col("qualified_name"), F.col("doc"), layers.annotation_names(F.col("annotations")), F.array().cast("array<string>")).alias("text"))


# --- exports

_USER = "coalesce(instruction,'') || case when length(coalesce(context,'')) > 0 then chr(10) || chr(10) || '代码上下文：' || chr(10) || context else '' end"


@query(f"select rec_no, md5({_USER}) as user_content, md5(coalesce(answer,'')) as answer, coalesce(scenario,'unknown') as scenario, coalesce(repo_commit,'UNKNOWN_COMMIT') as repo_commit from samples")
def chat_export(spark: SparkSession, d: str) -> DataFrame:
    c = export.chat(table(spark, d, "samples"), "rec_no")
    return c.select("rec_no", F.md5(F.col("messages")[1]["content"]).alias("user_content"), F.md5(F.col("messages")[2]["content"]).alias("answer"), "metadata.scenario", "metadata.repo_commit")


@query("select rec_no, coalesce(instruction,'') as instruction, md5(coalesce(context,'')) as input, md5(coalesce(answer,'')) as output from samples")
def alpaca_export(spark: SparkSession, d: str) -> DataFrame:
    return export.alpaca(table(spark, d, "samples"), "rec_no").select("rec_no", "instruction", F.md5("input").alias("input"), F.md5("output").alias("output"))


def _trace(part: str, title: str) -> str:
    return f"case when len(thought.{part}) > 0 then '### {title}' || chr(10) || array_to_string(list_transform(thought.{part}, lambda x: '- ' || x || chr(10)), '') || chr(10) else '' end"


@query(f"select rec_no, md5('## 推理过程' || chr(10) || chr(10) || {_trace('observations', '观察')} || {_trace('inferences', '推断')} || {_trace('assumptions', '假设')} || '## 最终答案' || chr(10) || chr(10) || coalesce(answer,'')) as content from samples")
def trace_export(spark: SparkSession, d: str) -> DataFrame:
    return export.chat_with_trace(table(spark, d, "samples"), "rec_no").select("rec_no", F.md5(F.col("messages")[2]["content"]).alias("content"))


@query(f"select rec_no, md5('<|im_start|>system' || chr(10) || {sql.quoted(export.SYSTEM)} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {_USER} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || coalesce(answer,'') || '<|im_end|>' || chr(10)) as text from samples")
def chat_template(spark: SparkSession, d: str) -> DataFrame:
    return export.chat(table(spark, d, "samples"), "rec_no").select("rec_no", F.md5(export.rendered(F.col("messages"))).alias("text"))


@query("select rec_no, 'clean' as source from samples where quality.passed and scenario = 'qa_rule' union all select rec_no, 'clean' from samples where quality.passed and scenario = 'arch_design'")
def merged_samples(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "samples").select("rec_no", "scenario", "quality")
    clean = s.where("quality.passed").withColumn("source", F.lit("clean"))
    raw = s.withColumn("source", F.lit("raw"))
    qa, design = (lambda x: x.where("scenario = 'qa_rule'")), (lambda x: x.where("scenario = 'arch_design'"))
    return assemble.merge(qa(clean), qa(raw), design(clean), design(raw)).select("rec_no", "source")


# --- safety


def _count_sql(column: str) -> str:
    return ", ".join(f"sum(len(regexp_extract_all(coalesce({column},''), {sql.quoted(p)})))::BIGINT as {k}" for k, p in safety.SECRET_PATTERNS.items())


@query(f"select {_count_sql('source')} from symbols")
def secret_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").agg(*[F.sum(c).alias(k) for k, c in safety.secret_counts(F.col("source")).items()])


def _findings_sql(rows: str, key: str, column: str) -> str:
    """Every match of every pattern with its place: the lengths of the pieces between matches, and of the matches before."""
    parts = []
    for i, (kind, p) in enumerate(safety.SECRET_PATTERNS.items()):
        p = sql.quoted(p)
        parts.append(f"""select {key}, {column}, '{kind}' as type, {i} as kind_no, (list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::INT as start, length(ms[i])::INT as length, ms[i] as m
        from (select *, unnest(generate_series(1, len(ms))) as i from (select {key}, {column}, string_split_regex({column}, {p}) as pieces, regexp_extract_all({column}, {p}) as ms from {rows} where regexp_matches({column}, {p})))""")
    return " union all ".join(parts)


@query(f"""select rec_no, type, start, start + length as end, case when length > 50 then substr(m, 1, 20) || '...' || right(m, 10) when length > 10 then substr(m, 1, 10) || '...' else m end as matched, length from ({_findings_sql("symbols", "rec_no", "source")})""")
def secret_findings(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "symbols").select("rec_no", F.explode(safety.find_secrets("source")).alias("f"))
    return found.select("rec_no", "f.type", "f.start", "f.end", "f.matched", "f.length")


def _redacted_sql(rows: str, key: str, column: str) -> str:
    """Of overlapping findings the first: those that no finding which begins before them, or with them and is of an earlier kind, reaches into."""
    return f"""with f as ({_findings_sql(rows, key, column)}),
    kept as (select f.* from f where not exists (select 1 from f g where g.{key} = f.{key} and (g.start < f.start or g.start = f.start and g.kind_no < f.kind_no) and g.start + g.length > f.start)),
    cut as (select *, coalesce(lag(start + length) over (partition by {key} order by start), 0) as before, row_number() over (partition by {key} order by start desc) as last from kept),
    new as (select {key}, string_agg(substr({column}, before + 1, start - before) || '[REDACTED_' || type || ']' || case when last = 1 then substr({column}, start + length + 1) else '' end, '' order by start) as text from cut group by {key})
    select r.{key}, coalesce(new.text, r.{column}) as {column} from {rows} r left join new using ({key})"""


@query(_redacted_sql("symbols", "rec_no", "source"))
def secrets_redacted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", safety.redact_secrets("source").alias("source"))


_BLOCKED = ["sorry", "unable to comply", "抱歉", "无法"]


@query("select rec_no, array_to_string(list_filter([" + ", ".join(f"case when contains(lower(coalesce(answer,'')), '{p}') then '{p}' end" for p in _BLOCKED) + "], lambda x: x is not null), '|') as hits from samples")
def blocked_phrases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", joined(safety.blocked_hits(F.col("answer"), _BLOCKED)).alias("hits"))


@query("select rec_no, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(answer, 'sorry', '[REDACTED]', 'gi'), 'unable to comply', '[REDACTED]', 'gi'), '抱歉', '[REDACTED]', 'gi'), '无法', '[REDACTED]', 'gi')) as answer from samples")
def blocked_redacted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", F.md5(safety.redact_blocked(F.col("answer"), _BLOCKED)).alias("answer"))


def _license_sql() -> str:
    scored = ", ".join(f"struct_pack(score := ({' + '.join(f'regexp_matches(t, {sql.quoted("(?i)" + p)})::INT' for p in ps)}) / {len(ps)}, k := {-i}, name := '{n}')" for i, (n, ps) in enumerate(safety.LICENSE_PATTERNS.items()))
    return f"with x as (select doc_id, list_max([{scored}]) as b from (select doc_id, coalesce(text,'') as t from documents)) select doc_id, case when b.score > 0 then b.name end as name, case when b.score > 0 then case when b.score >= 0.8 then 'high' when b.score >= 0.5 then 'medium' else 'low' end end as confidence from x"


@query(_license_sql())
def license_detection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", safety.license_of(F.col("text")).alias("l")).select("doc_id", "l.name", "l.confidence")


def _safety_sql() -> str:
    kinds = "list_filter([" + ", ".join("case when " + " or ".join(f"regexp_matches(coalesce({c},''), {sql.quoted(p)})" for c in assemble.SCANNED) + f" then '{k}' end" for k, p in safety.SECRET_PATTERNS.items()) + "], lambda x: x is not null)"
    hits = "list_filter([" + ", ".join("case when " + " or ".join(f"contains(lower(coalesce({c},'')), '{p}')" for c in assemble.SCANNED) + f" then '{p}' end" for p in _BLOCKED) + "], lambda x: x is not null)"
    return f"select rec_no, 'drop' as action, array_to_string(list_sort(secrets), '|') as secrets, array_to_string(list_sort(blocked), '|') as blocked from (select rec_no, {kinds} as secrets, {hits} as blocked from samples) where len(secrets) > 0 or len(blocked) > 0"


@query(_safety_sql())
def safety_report(spark: SparkSession, d: str) -> DataFrame:
    report = assemble.apply_safety(table(spark, d, "samples"), "drop", _BLOCKED)[1]
    return report.select("rec_no", "action", joined(F.sort_array("secrets")).alias("secrets"), joined(F.sort_array("blocked")).alias("blocked"))


@query(f"with f as ({_safety_sql()}) select rec_no from samples where rec_no not in (select rec_no from f)")
def safe_samples(spark: SparkSession, d: str) -> DataFrame:
    return assemble.apply_safety(table(spark, d, "samples"), "drop", _BLOCKED)[0].select("rec_no")


def _sanitized_sql() -> str:
    columns = ", ".join("case when f.rec_no is null then s.{0} else ".format(c) + "regexp_replace(" * len(_BLOCKED) + f"coalesce(r_{c}.{c}, '')" + "".join(f", '{p}', '[REDACTED]', 'gi')" for p in _BLOCKED) + f" end as {c}" for c in assemble.SCANNED)
    parts = " ".join(f"left join (select rec_no, {c} from ({_redacted_sql('samples', 'rec_no', c)})) r_{c} on r_{c}.rec_no = s.rec_no" for c in assemble.SCANNED)
    return f"select s.rec_no, {columns} from samples s left join ({_safety_sql()}) f on f.rec_no = s.rec_no {parts}"


@query(_sanitized_sql())
def sanitized_samples(spark: SparkSession, d: str) -> DataFrame:
    return assemble.apply_safety(table(spark, d, "samples"), "sanitize", _BLOCKED)[0].select("rec_no", "instruction", "context", "answer")


# --- texts, ids and scores


@query("select rec_no, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(answer,''), '[A-Za-z0-9_]{4,}|[\\x{4e00}-\\x{9fff}]{2,}'), lambda x: lower(x)))), '|') as tokens from samples")
def alignment_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", joined(F.sort_array(text.alignment_tokens(F.col("answer")))).alias("tokens"))


@query("select rec_no, md5(case when length(source) > 200 then substr(source, 1, 200) || '...' else source end) as head, md5(case when length(source) > 200 then substr(source, 1, 100) || chr(10) || '    // ... (truncated) ...' || chr(10) || right(source, 100) else source end) as both_ends from symbols")
def truncated_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "symbols").select("rec_no", F.md5(text.cut(F.col("source"), 200)).alias("head"), F.md5(text.cut_middle(F.col("source"), 200)).alias("both_ends"))


@query("select rec_no, substr(sha256(coalesce(scenario,'') || ':' || coalesce(instruction,'') || ':' || substr(coalesce(context,''), 1, 100)), 1, 16) as sample_id from samples")
def sample_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", paths.sample_id(F.col("scenario"), F.col("instruction"), F.col("context")).alias("sample_id"))


@query("select rec_no, md5('Q: ' || coalesce(instruction,'') || chr(10) || '{\"scenario\": \"' || coalesce(scenario,'') || '\"}') as prompt from samples")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").select("rec_no", F.md5(text.fill('Q: {instruction}\n{{"scenario": "{scenario}"}}', instruction=F.col("instruction"), scenario=F.col("scenario"))).alias("prompt"))


@query("select rec_no, instruction, scenario from samples")
def model_replies(spark: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.lit("Here:\n```json\n"), F.to_json(F.struct("instruction", "scenario")), F.lit("\n```"))
    parsed = table(spark, d, "samples").select("rec_no", text.model_json(F.replace(reply, F.lit("\\n"), F.lit("\n"))).alias("v"))
    return parsed.select("rec_no", F.try_variant_get("v", "$.instruction", "string").alias("instruction"), F.try_variant_get("v", "$.scenario", "string").alias("scenario"))


@query("select count(*) as n, round(avg((trim(coalesce(answer,''), chr(32) || chr(9) || chr(10) || chr(13)) = trim(coalesce(instruction,''), chr(32) || chr(9) || chr(10) || chr(13)))::INT), 4) as exact_match from samples")
def exact_matches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "samples").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(metrics.exact_match(F.col("answer"), F.col("instruction"))), 4).alias("exact_match"))


@query()
def prediction_scores(spark: SparkSession, d: str) -> DataFrame:
    return metrics.corpus_scores(table(spark, d, "samples").select("answer", "instruction"), "answer", "instruction")


# --- generation and parsing, with stand-ins for the services


@query()
def embedded_texts(spark: SparkSession, d: str) -> DataFrame:
    return generation.embed(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "vec")


@query("select rec_no, name, true as fits from symbols where symbol_type = 'method' and source is not null and regexp_matches(file_path, '[.]java$')")
def parsed_methods(spark: SparkSession, d: str) -> DataFrame:
    """The Java methods parsed anew, each in a class of its own: the name that is found, and whether the stored source fits its hash."""
    rows = table(spark, d, "symbols").where("symbol_type = 'method' and source is not null and file_path rlike '[.]java$'")
    owner = F.coalesce(F.try_element_at(F.split("qualified_name", "[.]"), F.lit(-2)), F.lit("Owner"))
    files = rows.select(F.concat(F.col("rec_no").cast("string"), F.lit(".java")).alias("path"), F.concat(F.lit("class "), owner, F.lit(" {\n"), "source", F.lit("\n}")).cast("binary").alias("content"))
    found = parse(files, "UNKNOWN_COMMIT", ParseRules(most_chars=300))[0].select(F.substring_index("file_path", ".", 1).cast("bigint").alias("rec_no"), "name", "start_line", paths.hash_fits(F.col("source"), F.col("source_hash")).alias("fits"))
    return found.groupBy("rec_no").agg(F.min_by("name", "start_line").alias("name"), F.every("fits").alias("fits"))


_MARKED = "case when length(source) > 200 then {0} else source end"


@query(f"""select rec_no, md5({_MARKED.format("substr(source, 1, 200) || chr(10) || '... [truncated, total ' || length(source) || ' chars]'")}) as counted, md5({_MARKED.format("substr(source, 1, 200) || chr(10) || '... (truncated)'")}) as python,
md5({_MARKED.format("substr(source, 1, 50) || chr(10) || chr(10) || '... /* TRUNCATED: ' || (length(source) - 200) || ' chars omitted */ ...' || chr(10) || chr(10) || right(source, 50)")}) as java from symbols""")
def truncation_marks(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source")
    return table(spark, d, "symbols").select("rec_no", F.md5(text.cut_counted(s, 200)).alias("counted"), F.md5(text.cut_parsed(s, 200, "python")).alias("python"), F.md5(text.cut_parsed(s, 200, "java")).alias("java"))


@query()
def parsed_symbols(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "symbols").where("symbol_type = 'file' and file_path rlike '[.](java|py)$'").select(paths.slashes(F.col("file_path")).alias("path"), F.col("source").cast("binary").alias("content"))
    return parse(files, "UNKNOWN_COMMIT", ParseRules(private=True, tests=True))[0].select("symbol_id", "symbol_type", "name", "start_line", "end_line", "source_hash")


from sievework.plans import catalog_files as _files  # noqa: E402, F401 - its queries register themselves


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
