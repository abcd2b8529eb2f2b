"""Questions, answers, designs and method profiles written by a model behind an interface.

A model is a function from texts to texts; it is built once in every Python worker by a factory, so it may hold connections. Without a
service, ``EchoModel`` answers every prompt in the same way each time. Prompts are columns, answers come back as VARIANT.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.layers import JAVA, LanguageProfile
from sievework.functions.paths import question_id, sample_id, slashes
from sievework.functions.text import fill, model_json
from sievework.operators.lookup import unprocessed
from sievework.operators.retrieval import context, retrieve_all, top_methods
from sievework.operators.sampling import maybe, one_of, uniform
from sievework.plans.scratch import Scratch

Model = Callable[[list[str]], list[str | None]]
ModelFactory = Callable[[], Model]


class EchoModel:
    """A stand-in that needs no service: a JSON object made of the prompt's hash, in a code fence as models like to write."""

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            h = hashlib.sha256(p.encode()).hexdigest()
            body = {"question": f"How does item {h[:8]} behave?", "answer": f"It behaves as {h[8:16]} says.", "summary": f"Summary {h[:6]}", "tags": [h[:2], h[2:4]], "observations": [h[16:24]], "inferences": [h[24:32]]}
            out.append("```json\n" + json.dumps(body) + "\n```")
        return out


class HashEmbedder:
    """A stand-in for an embedding service: signed hashes of the words, of length one; null for empty texts."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: Iterable[str | None]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for t in texts:
            v = np.zeros(self.dim)
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % self.dim] += 1 if h >> 63 else -1
            n = np.linalg.norm(v)
            out.append((v / n).tolist() if n > 0 else None)
        return out


def complete(df: DataFrame, prompt: str, factory: ModelFactory = EchoModel, attempts: int = 3) -> DataFrame:
    """``df`` with reply (text), attempts used, and error; prompts without a reply are asked again, and a failing batch row by row.

    After the last attempt the reply is null and error says why. Null prompts are not asked.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("reply", T.StringType()), T.StructField("tries", T.IntegerType()), T.StructField("error", T.StringType())])

    def run(batches: Iterable[pd.DataFrame]):
        model = factory()
        for pdf in batches:
            reply: list[str | None] = [None] * len(pdf)
            error: list[str | None] = [None if p is not None else "no prompt" for p in pdf[prompt]]
            tries = [0] * len(pdf)
            todo = [i for i, p in enumerate(pdf[prompt]) if p is not None]
            for _ in range(attempts):
                if not todo:
                    break
                groups = [todo] if tries[todo[0]] == 0 else [[i] for i in todo]
                for group in groups:
                    for i in group:
                        tries[i] += 1
                    try:
                        for i, r in zip(group, model([pdf[prompt].iloc[i] for i in group])):
                            reply[i], error[i] = r, None if r is not None else "no reply"
                    except Exception as e:  # noqa: BLE001 - whatever the service raises is recorded
                        for i in group:
                            error[i] = f"{type(e).__name__}: {e}"[:500]
                todo = [i for i in todo if reply[i] is None]
            yield pdf.assign(reply=reply, tries=np.array(tries, dtype=np.int32), error=error)

    return df.mapInPandas(run, schema)


def embed(df: DataFrame, text: str, factory: Callable[[], Callable] = HashEmbedder) -> DataFrame:
    """``df`` with vec, the embedding of the text; null where there is none."""
    schema = T.StructType([*df.schema.fields, T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterable[pd.DataFrame]):
        model = factory()
        for pdf in batches:
            yield pdf.assign(vec=model(pdf[text].tolist()))

    return df.mapInPandas(run, schema)


@dataclass(frozen=True)
class Writer:
    """What one kind of text needs: a template whose {names} are columns, and the fields to take from the reply with their types."""

    template: str
    fields: dict[str, str]
    model: ModelFactory = EchoModel
    attempts: int = 3

    def write(self, rows: DataFrame, **values: Column) -> tuple[DataFrame, DataFrame]:
        """(written, rejected): rows with the fields of their reply, and rows (with prompt, reply, error) whose reply is no JSON object."""
        prompted = rows.withColumn("prompt", fill(self.template, **(values or {c: F.col(c) for c in rows.columns})))
        done = complete(prompted, "prompt", self.model, self.attempts).withColumn("parsed", model_json(F.col("reply")))
        good = F.col("parsed").isNotNull() & (F.schema_of_variant("parsed").startswith("OBJECT"))
        taken = {n: F.try_variant_get("parsed", f"$.{n}", t) for n, t in self.fields.items()}
        fine = F.coalesce(good, F.lit(False))
        return done.where(fine).withColumns(taken).drop("prompt", "reply", "tries", "error", "parsed"), done.where(~fine).drop("parsed")


#: Templates of the four writers; projects bring their own.
PROFILE = Writer("Describe the method {qualified_name} of {file_path}.\n\n{source}\n\nAnswer with one JSON object: summary, tags.", {"summary": "string", "tags": "array<string>"})
QUESTION = Writer("{strength} Ask one {question_type} question of difficulty {bucket} about {qualified_name}.{negative}\n\n{source}\n\nAnswer with one JSON object: question.", {"question": "string"})
ANSWER = Writer("{context}\n\nQuestion: {question}\n{negative}\nAnswer with one JSON object: answer, observations, inferences.", {"answer": "string", "observations": "array<string>", "inferences": "array<string>"})
DESIGN = Writer("Design question for these components:\n{context}\n\nGoal: {goal}\nAnswer with one JSON object: question.", {"question": "string"})


def profiles(methods: DataFrame, writer: Writer = PROFILE) -> tuple[DataFrame, DataFrame]:
    return writer.write(methods, qualified_name=F.col("qualified_name"), file_path=F.col("file_path"), source=F.col("source"))


def questions(profiled: DataFrame, types: list[str], buckets: list[str], negatives: list[str], negative_ratio: float, seed: int = 42, writer: Writer = QUESTION) -> tuple[DataFrame, DataFrame]:
    """Questions with their question_id; type, difficulty and kind of negative are drawn from the seed and the symbol."""
    key = F.col("symbol_id")
    drawn = profiled.withColumns({"question_type": one_of(types, uniform(seed, key)), "bucket": one_of(buckets, uniform(seed + 1, key)), "negative_type": maybe(negative_ratio, negatives, uniform(seed + 2, key), uniform(seed + 3, key))})
    strength = F.when(F.col("bucket").isin("mid", "hard"), "Name a conflict, a limit or an edge case.").otherwise("Keep to one plain point.")
    good, bad = writer.write(drawn, strength=strength, question_type=F.col("question_type"), bucket=F.col("bucket"), qualified_name=F.col("qualified_name"), negative=negative_rule(F.col("negative_type")), source=F.col("source"))
    return good.withColumn("question_id", question_id(F.col("question"), F.col("question_type"))), bad


def negative_rule(kind: Column, rules: dict[str, str] | None = None) -> Column:
    """What a prompt says for a kind of negative question; nothing for null and unknown kinds."""
    rules = rules or {"insufficient_evidence": " The code shown must not be enough to answer.", "wrong_premise": " The question must rest on a wrong premise.", "conflict_spec": " The question must ask for things that contradict each other.", "ambiguous_question": " The question must be open to several readings."}
    out = F
    for name, text in rules.items():
        out = out.when(kind == name, F.lit(text))
    return out.otherwise(F.lit(""))


def answers(asked: DataFrame, context: Column, writer: Writer = ANSWER, scenario: str = "qa_rule") -> tuple[DataFrame, DataFrame]:
    """Samples with their sample_id, from rows with question, repo_commit and the references that the context is made of (evidence_refs);
    the column query stays if there is one."""
    good, bad = writer.write(asked.withColumn("context", context), context=F.col("context"), question=F.col("question"), negative=negative_rule(F.col("negative_type")) if "negative_type" in asked.columns else F.lit(""))
    thought = F.struct(F.coalesce("observations", F.array()).alias("observations"), F.coalesce("inferences", F.array()).alias("inferences"), F.array().cast("array<string>").alias("assumptions"), F.col("evidence_refs"))
    kind = F.lit(scenario)
    kept = [c for c in asked.columns if c == "query"]
    return good.select(*kept, sample_id(kind, F.col("question"), F.col("context")).alias("sample_id"), kind.alias("scenario"), F.col("question").alias("instruction"), "context", thought.alias("thought"), "answer", "repo_commit"), bad


def designs(goals: DataFrame, pool: Column, gate: bool = True, writer: Writer = DESIGN) -> tuple[DataFrame, DataFrame]:
    """Design questions with references: their own, or outside gate mode the first of the pool where they have none."""
    good, bad = writer.write(goals, context=F.col("context"), goal=F.col("goal"))
    own = F.col("evidence_refs")
    refs = own if gate else F.when(F.coalesce(F.size(own), F.lit(0)) > 0, own).otherwise(F.slice(pool, 1, 1))
    return good.withColumn("evidence_refs", refs), bad


# --- drivers: what is written from what, and where a run goes on


def understand(symbols: DataFrame, done: DataFrame | None = None, most: int = 1000, writer: Writer = PROFILE) -> tuple[DataFrame, DataFrame]:
    """(profiles, rejected): the methods most worth a profile, less those that are ``done`` (symbol_id), with summary and tags.

    The best ``most`` are chosen first and the done ones taken out of them, so a run that is resumed writes what the first one left.
    """
    chosen = top_methods(symbols, most)
    good, bad = profiles(unprocessed(chosen, done) if done is not None else chosen, writer)
    first = F.array(F.struct(slashes(F.col("symbol_id")).alias("symbol_id"), slashes(F.col("file_path")).alias("file_path"), "start_line", "end_line", "source_hash"))
    return good.withColumn("evidence_refs", first), bad


def chosen_symbols(asked: DataFrame, symbols: DataFrame, k: int = 6, vectors: DataFrame | None = None, profile: LanguageProfile = JAVA, order: str = "rec_no", **options) -> DataFrame:
    """(query, order, place, how): the symbols that each question of (query, text, evidence_refs) is answered from.

    The symbols that its own references name, in their order, all rows of an id (how: direct); for questions without such, what retrieval
    finds.
    """
    scratch = Scratch(asked.sparkSession, "context")
    ids = asked.select("query", F.explode("evidence_refs").alias("r")).select("query", slashes(F.col("r.symbol_id")).alias("sid")).where("sid is not null").distinct()
    hits = symbols.select(order, slashes(F.col("symbol_id")).alias("sid")).join(ids, "sid").select("query", order)
    direct = scratch.write(hits.select("query", order, F.col(order).alias("place"), F.lit("direct").alias("how")), "direct")
    columns = ["query", "text", *[c for c in asked.columns if c == "vec"]]
    rest = scratch.write(asked.select(*columns).join(direct, "query", "left_anti"), "rest")
    found = retrieve_all(symbols, rest, k, vectors, profile, order=order, **options)
    return direct.unionByName(found.select("query", order, F.col("place").cast("bigint").alias("place"), "how"))


def answer_all(asked: DataFrame, symbols: DataFrame, done: DataFrame | None = None, writer: Writer = ANSWER, order: str = "rec_no", scenario: str = "qa_rule", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, rejected, statistics) of the questions (query, question, repo_commit, evidence_refs, and negative_type if there is one).

    Questions whose ``query`` is in ``done`` are left out. Context and references of a sample are those of its chosen symbols; statistics
    count questions and symbols by how they were found, and samples that ask for something wrong.
    """
    todo = asked.join(done.select("query").where("query is not null").distinct(), "query", "left_anti") if done is not None else asked
    scratch = Scratch(asked.sparkSession, "answers")
    chosen = scratch.write(chosen_symbols(todo.withColumn("text", F.col("question")), symbols, order=order, **options), "chosen")
    ref = F.struct(slashes(F.col("symbol_id")).alias("symbol_id"), slashes(F.col("file_path")).alias("file_path"), "start_line", "end_line", "source_hash")
    refs = chosen.join(symbols.select(order, ref.alias("ref")), order).groupBy("query").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", order, "ref"))), lambda r: r["ref"]).alias("evidence_refs"))
    shown = context(chosen, symbols, "query", order).withColumnRenamed("context", "_shown")
    rows = todo.drop("evidence_refs").join(refs, "query", "left").join(shown, "query", "left")
    good, bad = answers(rows, F.col("_shown"), writer, scenario)
    return good, bad, retrieval_statistics(todo, chosen)


def retrieval_statistics(asked: DataFrame, chosen: DataFrame) -> DataFrame:
    """(measure, n): questions and symbols by how they were found, and positive and negative questions."""
    negative = F.col("negative_type").isNotNull() if "negative_type" in asked.columns else F.lit(False)
    by = chosen.groupBy("how").agg(F.count_distinct("query").alias("questions"), F.count(F.lit(1)).alias("symbols"))
    stacked = by.select(F.explode(F.array(F.struct(F.concat(F.lit("questions_"), "how").alias("measure"), F.col("questions").alias("n")), F.struct(F.concat(F.lit("symbols_"), "how").alias("measure"), F.col("symbols").alias("n")))).alias("x")).select("x.*")
    signs = asked.groupBy(F.when(negative, "negative_samples").otherwise("positive_samples").alias("measure")).agg(F.count(F.lit(1)).alias("n"))
    return stacked.unionByName(signs)


def warnings_report(rejected: DataFrame) -> DataFrame:
    """(error, n): why replies were rejected."""
    return rejected.groupBy(F.coalesce("error", F.lit("not a JSON object")).alias("error")).agg(F.count(F.lit(1)).alias("n"))
