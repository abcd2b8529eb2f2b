"""Training formats, as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default prompts and titles of the formats.
SYSTEM = "你是一个专业的代码助手。你的任务是根据提供的代码上下文，准确回答问题或提供设计方案。"
REASONING = SYSTEM + "在回答时，请先展示你的推理过程，然后给出最终答案。"
CONTEXT_TITLE = "\n\n代码上下文：\n"
TRACE_TITLE, ANSWER_TITLE = "## 推理过程\n\n", "## 最终答案\n\n"
TRACE_PARTS = (("observations", "### 观察\n"), ("inferences", "### 推断\n"), ("assumptions", "### 假设\n"))
UNKNOWN_COMMIT = "UNKNOWN_COMMIT"


def text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_content() -> Column:
    return F.concat(text("instruction"), F.when(F.length(text("context")) > 0, F.concat(F.lit(CONTEXT_TITLE), F.col("context"))).otherwise(F.lit("")))


def trace_content() -> Column:
    out = [F.lit(TRACE_TITLE)]
    for part, title in TRACE_PARTS:
        xs = F.col(f"thought.{part}")
        body = F.concat(F.lit(title), F.array_join(F.transform(xs, lambda x: F.concat(F.lit("- "), x, F.lit("\n"))), ""), F.lit("\n"))
        out.append(F.when(F.coalesce(F.size(xs), F.lit(0)) > 0, body).otherwise(F.lit("")))
    return F.concat(*out, F.lit(ANSWER_TITLE), text("answer"))


def metadata(*extra: str) -> Column:
    return F.struct(F.coalesce("scenario", F.lit("unknown")).alias("scenario"), F.coalesce("repo_commit", F.lit(UNKNOWN_COMMIT)).alias("repo_commit"), F.col("thought.evidence_refs").alias("evidence_refs"), *extra)


def chat(samples: DataFrame, *keep: str, system: str = SYSTEM) -> DataFrame:
    """(keep, messages, metadata): system, user and assistant; the context follows the instruction if there is one. Nulls count as empty."""
    messages = F.array(message("system", F.lit(system)), message("user", user_content()), message("assistant", text("answer")))
    return samples.select(*keep, messages.alias("messages"), metadata("quality").alias("metadata"))


def chat_with_trace(samples: DataFrame, *keep: str, system: str = REASONING) -> DataFrame:
    """The same with observations, inferences and assumptions before the answer; empty ones are left out."""
    messages = F.array(message("system", F.lit(system)), message("user", user_content()), message("assistant", trace_content()))
    return samples.select(*keep, messages.alias("messages"), metadata().alias("metadata"))


def alpaca(samples: DataFrame, *keep: str) -> DataFrame:
    return samples.select(*keep, text("instruction").alias("instruction"), text("context").alias("input"), text("answer").alias("output"), metadata().alias("metadata"))


def rendered(messages: Column, generation: bool = False) -> Column:
    """The messages in the chat template of the fine-tuned models, with the assistant's opening if text is to be generated."""
    body = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if generation else body
