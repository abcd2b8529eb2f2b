"""Declared schemas of the records."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B, D = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ANNOTATION = struct(name=S, arguments=T.MapType(S, S), raw_text=S)
SYMBOL = struct(symbol_id=S, symbol_type=S, name=S, qualified_name=S, file_path=S, start_line=I, end_line=I, source=S, doc=S, annotations=T.ArrayType(ANNOTATION), metadata=T.MapType(S, S), repo_commit=S, source_hash=S)
EVIDENCE = struct(symbol_id=S, file_path=S, start_line=I, end_line=I, source_hash=S)
THOUGHT = struct(observations=T.ArrayType(S), inferences=T.ArrayType(S), assumptions=T.ArrayType(S), evidence_refs=T.ArrayType(EVIDENCE))
COVERAGE = struct(bucket=S, intent=S, module_span=S, polarity=S, question_type=S, source=S)
QUALITY = struct(passed=B, gate_version=S, errors=T.ArrayType(S), warnings=T.ArrayType(S), checks=T.MapType(S, S), coverage=COVERAGE)
SAMPLE = struct(sample_id=S, scenario=S, instruction=S, context=S, thought=THOUGHT, answer=S, repo_commit=S, quality=QUALITY, created_at=S)
PROFILE = struct(symbol_id=S, qualified_name=S, file_path=S, summary=S, business_rules=T.ArrayType(S), tags=T.ArrayType(S), inputs=T.ArrayType(T.MapType(S, S)), outputs=T.ArrayType(S), dependencies=T.ArrayType(S), side_effects=T.ArrayType(S), error_handling=T.ArrayType(S), consistency=T.ArrayType(S), security_notes=T.ArrayType(S), evidence_refs=T.ArrayType(EVIDENCE), repo_commit=S)
QUESTION = struct(question_id=S, question=S, question_type=S, difficulty=S, evidence_refs=T.ArrayType(EVIDENCE), evidence_autofill=B, repo_commit=S)
DESIGN_QUESTION = struct(id=S, goal=S, constraints=T.ArrayType(S), acceptance_criteria=T.ArrayType(S), non_goals=T.ArrayType(S), evidence_refs=T.ArrayType(EVIDENCE), question_type=S)
EMBEDDING = struct(symbol_id=S, file_path=S, qualified_name=S, embedding=T.ArrayType(T.FloatType()), text=S, repo_commit=S)
CHAT = struct(messages=T.ArrayType(struct(role=S, content=S)), metadata=struct(scenario=S, repo_commit=S, evidence_refs=T.ArrayType(EVIDENCE)))
