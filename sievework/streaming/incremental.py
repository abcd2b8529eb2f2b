"""Samples as they arrive: an extension beyond batch runs, which append as they go and resume where they stopped.

New files of JSON Lines are tagged and scanned in micro-batches; the checkpoint remembers which files were seen, so a restarted stream
resumes without repeating them. Repeated sample ids within the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievework.operators.assemble import scan
from sievework.operators.tagging import tag
from sievework.sources.model import SAMPLE


def sample_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", files_per_batch).json(folder)


def curated(stream: DataFrame, delay: str = "3 days") -> DataFrame:
    """Tagged and scanned samples, each sample_id once within ``delay``; rows without an id or time are left out.

    ``created_at`` is read in both spellings of ISO 8601; its latest value less the delay is the watermark.
    """
    timed = stream.withColumn("created", F.try_to_timestamp("created_at")).where("sample_id is not null and created is not null")
    once = timed.withWatermark("created", delay).dropDuplicatesWithinWatermark(["sample_id"])
    return scan(tag(once))


def counts(stream: DataFrame, window: str = "1 day", delay: str = "3 days") -> DataFrame:
    """Samples by scenario in tumbling windows of their creation."""
    timed = stream.withColumn("created", F.try_to_timestamp("created_at")).where("created is not null").withWatermark("created", delay)
    grouped = timed.groupBy(F.window("created", window), F.coalesce("scenario", F.lit("unknown")).alias("scenario")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "scenario", "n")


def append(rows: DataFrame, to: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends the stream as Parquet; with ``once`` what is there is processed and the query ends."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(to)
