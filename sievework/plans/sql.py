"""Pieces of SQL that the checks of several queries share. Built from the same fixed values as the expressions they check."""

from __future__ import annotations

from sievework.functions.coverage import HARD_KEYWORDS, INTENT_KEYWORDS
from sievework.functions.layers import JAVA


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def contains_any(text: str, words: list[str] | tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({text}, {quoted(w)})" for w in words) + ")" if words else "false"


def intent(low: str) -> str:
    return "case " + " ".join(f"when {contains_any(low, w)} then {quoted(k)}" for k, w in INTENT_KEYWORDS.items()) + " else 'how_to' end"


def bucket(topic: str, span: str, low: str) -> str:
    return f"case when {topic} in ('compatibility','edge') or {contains_any(low, HARD_KEYWORDS)} then 'hard' when {span} = 'multi' or {topic} in ('perf','consistency') then 'mid' else 'high' end"


def layer() -> str:
    cases = []
    names = "coalesce(list_transform(annotations, lambda a: a.name), [])"
    for title, rule in JAVA.layers.items():
        marks = "[" + ",".join(map(quoted, rule.annotations)) + "]"
        parts = [f"list_has_any({names}, {marks})", contains_any("lower(coalesce(name,''))", rule.names), contains_any("lower(coalesce(qualified_name,''))", rule.names), contains_any("lower(coalesce(file_path,''))", rule.paths)]
        cases.append(f"when {' or '.join(parts)} then {quoted(title)}")
    return "case " + " ".join(cases) + " end"


TAGGED = f"""
with t as (select *, lower(coalesce(instruction,'') || ' ' || coalesce(answer,'')) as low, coalesce(len(thought.evidence_refs), 0) as n_refs,
  coalesce(len(list_distinct(list_filter(list_transform(thought.evidence_refs, lambda r: split_part(replace(coalesce(r.file_path,''), '\\', '/'), '/', 1)), lambda x: x <> ''))), 0) as tops from samples),
u as (select *, coalesce(quality.coverage.intent, {intent('low')}) as t_intent, coalesce(quality.coverage.module_span, case when tops > 1 then 'multi' else 'single' end) as t_span from t),
v as (select *, {bucket('t_intent', 't_span', 'low')} as base from u),
tagged as (select *, coalesce(quality.coverage.bucket, case when n_refs >= 3 then 'hard' when n_refs >= 2 and base = 'high' then 'mid' else base end) as t_bucket from v)
"""

SYMBOL_MAP = """
latest as (select replace(symbol_id, '\\', '/') as sid, max(rec_no) as rec_no from symbols where symbol_id is not null group by 1),
sym as (select l.sid, s.* from latest l join symbols s on s.rec_no = l.rec_no)
"""

VALIDATED = f"""
with {SYMBOL_MAP},
refs as (select rec_no, repo_commit, unnest(thought.evidence_refs) as r, generate_subscripts(thought.evidence_refs, 1) as pos from samples),
coded as (select refs.rec_no, pos,
  case when sym.sid is null then ['EVIDENCE_SYMBOL_NOT_FOUND'] else list_filter([
    case when r.source_hash is distinct from sym.source_hash then 'EVIDENCE_SOURCE_HASH_MISMATCH' end,
    case when r.start_line < 1 or r.end_line < r.start_line then 'EVIDENCE_LINE_RANGE_INVALID' end,
    case when replace(r.file_path, '\\', '/') is distinct from replace(sym.file_path, '\\', '/') then 'EVIDENCE_FILE_PATH_MISMATCH' end], lambda x: x is not null) end as e,
  list_filter([
    case when sym.sid is not null and r.end_line - r.start_line > 500 then 'EVIDENCE_RANGE_LARGE' end,
    case when sym.sid is not null and refs.repo_commit <> 'UNKNOWN_COMMIT' and sym.repo_commit <> 'UNKNOWN_COMMIT' and refs.repo_commit <> sym.repo_commit then 'COMMIT_MISMATCH' end], lambda x: x is not null) as w
  from refs left join sym on replace(r.symbol_id, '\\', '/') = sym.sid),
issues as (select rec_no, flatten(list(e order by pos)) as re, flatten(list(w order by pos)) as rw from coded group by rec_no),
parts as (select s.*, coalesce(re, []) as re, coalesce(rw, []) as rw, coalesce(len(thought.evidence_refs), 0) as n,
  coalesce(thought.observations, []) as obs, coalesce(thought.inferences, []) as inf, coalesce(thought.assumptions, []) as ass,
  length(coalesce(answer, '')) as la, length(coalesce(instruction, '')) as li,
  coalesce(scenario in ('qa_rule', 'arch_design'), false) and instruction is not null and context is not null and answer is not null and repo_commit is not null
    and len(list_filter(coalesce(thought.evidence_refs, []), lambda r: r.symbol_id is null or r.file_path is null or r.source_hash is null or coalesce(r.start_line, 0) < 1 or coalesce(r.end_line, 0) < 1)) = 0 as ok
  from samples s left join issues i on s.rec_no = i.rec_no),
judged as (select *,
  case when not ok then ['SCHEMA_INVALID'] else list_concat(case when n = 0 then ['EVIDENCE_MISSING'] else [] end, re) end as errors,
  case when not ok then [] else list_concat(rw, list_filter([
    case when li < 10 then 'INSTRUCTION_TOO_SHORT' end, case when la < 20 then 'ANSWER_TOO_SHORT' end, case when la > 6000 then 'ANSWER_TOO_LONG' end,
    case when scenario = 'arch_design' and n > 0 and n < 2 then 'DESIGN_EVIDENCE_TOO_FEW' end,
    case when thought is null then 'TRACE_MISSING' end, case when n = 0 then 'TRACE_EVIDENCE_ANCHOR' end,
    case when len(obs) = 0 and len(inf) = 0 then 'TRACE_EMPTY' end, case when n > 0 and len(obs) = 0 and len(inf) = 0 then 'TRACE_EVIDENCE_ALIGNMENT' end,
    case when len(obs) < 1 then 'TRACE_MIN_OBSERVATIONS' end, case when len(obs) > 8 then 'TRACE_MAX_OBSERVATIONS' end,
    case when len(inf) < 1 then 'TRACE_MIN_INFERENCES' end, case when len(inf) > 8 then 'TRACE_MAX_INFERENCES' end,
    case when len(ass) > 5 then 'TRACE_MAX_ASSUMPTIONS' end], lambda x: x is not null)) end as warnings
  from parts),
verdicts as (select *, len(errors) = 0 as v_passed, ok and len(list_filter(warnings, lambda x: starts_with(x, 'TRACE_'))) > 0 as v_trace from judged)
"""

GROUP_KEY = f"""
with {SYMBOL_MAP},
keyed as (select s.rec_no, s.split, case when coalesce(len(s.thought.evidence_refs), 0) = 0 then '_NO_EVIDENCE_' when sym.sid is null then '_UNKNOWN_SYMBOL_' else
  coalesce(nullif(case when len(string_split(sym.qualified_name, '.')) >= 3 then array_to_string(string_split(sym.qualified_name, '.')[1:len(string_split(sym.qualified_name, '.')) - 2], '.') when len(string_split(sym.qualified_name, '.')) = 2 then string_split(sym.qualified_name, '.')[1] else '' end, ''), '_DEFAULT_PACKAGE_') end as group_key
  from samples s left join sym on replace(s.thought.evidence_refs[1].symbol_id, '\\', '/') = sym.sid)
"""

SIMHASH = """
with src as (select rec_no, lower(coalesce(instruction,'') || chr(10) || coalesce(answer,'')) as low from samples),
grams as (
  select rec_no, unnest(list_filter(regexp_split_to_array(low, '[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x{85}]+'), lambda x: x <> '')) as g from src
  union all
  select rec_no, unnest(list_transform(generate_series(1, length(low) - 2), lambda i: substr(low, i, 3))) as g from src where length(low) >= 3),
hashed as (select rec_no, ('0x' || substr(md5(g), 17, 16))::UBIGINT as h from grams),
bits as (select rec_no, i, sum(((h >> i) & 1)::BIGINT) * 2 > count(*) as on_ from hashed, generate_series(0, 63) t(i) group by rec_no, i),
fps as (select rec_no, sum(case when on_ then (1::HUGEINT << i::INT) else 0 end)::HUGEINT as u from bits group by rec_no),
fp as (select rec_no, (case when u >= 9223372036854775808 then u - 18446744073709551616 else u end)::BIGINT as fp from fps)
"""
