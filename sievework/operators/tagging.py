"""Coverage tags of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.coverage import evidence_bucket, level_of, module_span, question_text, topic_of


def tag(samples: DataFrame, default_source: str = "auto", mode: str = "assist", mid_min: int = 2, hard_min: int = 3) -> DataFrame:
    """``samples`` with the tags that are missing in quality.coverage filled in: intent, module_span, bucket, source, scenario.

    A tag that is there stays, an empty string too; null is missing. Null quality, coverage, thought and texts are allowed. The tags are
    returned as the column ``tags``; the columns of ``samples`` stay as they are.
    """
    tmp = ["_tag_low", "_tag_span", "_tag_topic", "_tag_level"]
    if clash := set(tmp) & set(samples.columns):
        raise ValueError(f"columns {sorted(clash)} are used by tag")
    cov = F.col("quality.coverage")
    refs = F.col("thought.evidence_refs")
    # one projection after the other: what several expressions read is computed once
    staged = samples.withColumns({"_tag_low": F.lower(question_text(F.col("instruction"), F.col("answer"))), "_tag_span": F.coalesce(cov["module_span"], module_span(refs), F.lit("single"))})
    staged = staged.withColumn("_tag_topic", F.coalesce(cov["intent"], topic_of(F.col("_tag_low"))))
    staged = staged.withColumn("_tag_level", level_of(F.col("_tag_topic"), F.col("_tag_span"), F.col("_tag_low")))
    level = evidence_bucket(F.col("_tag_level"), F.greatest(F.coalesce(F.size(refs), F.lit(0)), F.lit(0)), mode, mid_min, hard_min)
    tags = F.struct(
        F.col("_tag_topic").alias("intent"),
        F.col("_tag_span").alias("module_span"),
        F.coalesce(cov["bucket"], level).alias("bucket"),
        cov["polarity"].alias("polarity"),
        cov["question_type"].alias("question_type"),
        F.coalesce(cov["source"], F.lit(default_source)).alias("source"),
        F.coalesce(F.col("scenario"), F.lit("")).alias("scenario"),
    )
    return staged.withColumn("tags", tags).drop(*tmp)
