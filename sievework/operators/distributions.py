"""Counts, shares and statistics of data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.similarity import hamming

UNKNOWN = "unknown"


def shares(counts: DataFrame, *within: str) -> DataFrame:
    """Counts with their ratio to the total (of ``within``), four digits."""
    total = F.sum("n").over(Window.partitionBy(*within)) if within else F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("ratio", F.round(F.col("n") / total, 4))


def distribution(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """(name, n, ratio): rows by value, null as unknown. The counts, not the rows, are summed for the total."""
    return shares(df.groupBy(F.coalesce(value, F.lit(UNKNOWN)).alias(name)).agg(F.count(F.lit(1)).alias("n")))


def distributions(df: DataFrame, values: dict[str, tuple[Column, str]]) -> DataFrame:
    """(dimension, value, n, ratio): several distributions in one pass over the rows. values: name to column and what null or empty means."""
    flat = df.select(*[F.coalesce(F.nullif(c, F.lit("")), F.lit(d)).alias(k) for k, (c, d) in values.items()])
    sets = flat.groupingSets([[flat[k]] for k in values], *[flat[k] for k in values]).agg(F.count(F.lit(1)).alias("n"))
    dimension = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in values])
    counts = sets.select(dimension.alias("dimension"), F.coalesce(*values).alias("value"), "n").where("dimension is not null")
    return shares(counts, "dimension")


def coverage_distributions(samples: DataFrame) -> DataFrame:
    cov = F.col("quality.coverage")
    return distributions(samples, {"bucket": (cov["bucket"], "high"), "intent": (cov["intent"], UNKNOWN), "module_span": (cov["module_span"], UNKNOWN), "polarity": (cov["polarity"], "positive")})


def statistics(samples: DataFrame) -> DataFrame:
    """One row: samples, and least, largest and mean lengths of instruction, context and answer and numbers of references. Null counts as empty."""
    parts = {"instruction": F.length(F.coalesce("instruction", F.lit(""))), "context": F.length(F.coalesce("context", F.lit(""))), "answer": F.length(F.coalesce("answer", F.lit(""))), "evidence": F.greatest(F.coalesce(F.size("thought.evidence_refs"), F.lit(0)), F.lit(0))}
    aggs = [F.count(F.lit(1)).alias("samples")]
    for name, value in parts.items():
        aggs += [F.min(value).cast("bigint").alias(f"{name}_min"), F.max(value).cast("bigint").alias(f"{name}_max"), F.round(F.avg(value), 4).alias(f"{name}_avg")]
    return samples.agg(*aggs)


def top_codes(codes: DataFrame, column: str, most: int) -> DataFrame:
    """(code, n): the most common elements of an array column, of equals the smaller code."""
    return codes.select(F.explode(column).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code").limit(most)


def pass_rates(judged: DataFrame) -> DataFrame:
    """One row of a table with passed and checks: totals, pass rate, and how many have a trace warning."""
    warned = F.count(F.when(F.col("checks")["trace"] == "warn", 1))
    total = F.count(F.lit(1))
    passed = F.count(F.when(F.col("passed"), 1))
    return judged.agg(total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"), F.round(passed / total, 4).alias("pass_rate"), warned.alias("warning_samples"), F.round(warned / total, 4).alias("warning_rate"))


def parsing_report(symbols: DataFrame) -> DataFrame:
    """(symbol_type, symbols, files): by type, and in all under the type null; paths that differ only in their separators are one file."""
    norm = symbols.select("symbol_type", F.replace(F.col("file_path"), F.lit("\\"), F.lit("/")).alias("path"))
    return norm.rollup("symbol_type").agg(F.count(F.lit(1)).alias("symbols"), F.countDistinct("path").alias("files"))


def diversity(fingerprints: DataFrame, fp: str = "fp", row: str = "row") -> DataFrame:
    """One row: total, distinct fingerprints, and mean, least and largest Hamming distance of neighbours.

    ``row`` numbers the rows 0, 1, ... without gaps; neighbours meet in a join on it, so no task sees all rows.
    """
    a = fingerprints.select(F.col(row).alias("_i"), F.col(fp).alias("_a"))
    b = fingerprints.select((F.col(row) - 1).alias("_i"), F.col(fp).alias("_b"))
    near = a.join(b, "_i").agg(F.round(F.avg(hamming(F.col("_a"), F.col("_b"))), 4).alias("avg_hamming"), F.min(hamming(F.col("_a"), F.col("_b"))).alias("min_hamming"), F.max(hamming(F.col("_a"), F.col("_b"))).alias("max_hamming"))
    base = fingerprints.agg(F.count(F.lit(1)).alias("total"), F.countDistinct(fp).alias("unique_hashes"))
    one = F.lit(1).alias("_k")
    out = base.select("*", one).join(near.select("*", one), "_k").drop("_k")
    return out.withColumn("uniqueness_rate", F.round(F.col("unique_hashes") / F.col("total"), 4))


def split_report(assigned: DataFrame, group: str = "group_key", split: str = "split") -> DataFrame:
    """(split, samples, groups, ratio, shared_groups): by split, and how many of its groups are in another split as well."""
    spread = assigned.groupBy(group, split).agg(F.count(F.lit(1)).alias("n"))
    places = assigned.groupBy(group).agg(F.countDistinct(split).alias("places"))
    joined = spread.join(places, spread[group].eqNullSafe(places[group])).select(spread[split], "n", "places")
    counts = joined.groupBy(split).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.count(F.when(F.col("places") > 1, 1)).alias("shared_groups"))
    return shares(counts).withColumnRenamed("n", "samples")


def compare_targets(actual: DataFrame, targets: dict[str, float], max_delta: float = 0.1) -> DataFrame:
    """(value, ratio, target, delta, warning): the targets that the distribution (value, ratio) misses by more than max_delta."""
    spark = actual.sparkSession
    goal = spark.createDataFrame(list(targets.items()), "value string, target double")
    joined = F.broadcast(goal).join(actual.select("value", "ratio"), "value", "left").withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    joined = joined.withColumn("delta", F.abs(F.col("ratio") - F.col("target"))).where(F.col("delta") > max_delta)
    return joined.withColumn("warning", F.format_string("%s ratio %.4f exceeds target %.4f by %.4f", "value", "ratio", "target", "delta"))


def cross_check(reported: DataFrame, actual: DataFrame) -> DataFrame:
    """(value, reported, actual): the values whose counts in a report and in the data differ; missing counts as 0."""
    r, a = reported.select("value", F.col("n").alias("reported")), actual.select("value", F.col("n").alias("actual"))
    both = r.join(a, "value", "full_outer").fillna(0, ["reported", "actual"])
    return both.where("reported <> actual")


def evaluation(predictions: DataFrame, prediction: str, reference: str, evidence: str) -> DataFrame:
    """(scenario, n, prediction_avg, reference_avg, hit_rate): by scenario and in all (scenario null). A hit names a cited symbol's method.

    The method of a symbol id path:package.Class.method:line is what stands between its last dot and its last colon.
    """
    name = lambda sid: F.regexp_extract(sid, r"([^.:]+):[^:]*$", 1)
    hit = F.exists(F.col(evidence), lambda r: (F.length(name(r["symbol_id"])) > 0) & F.contains(F.col(prediction), name(r["symbol_id"])))
    rows = predictions.select(F.coalesce("scenario", F.lit(UNKNOWN)).alias("scenario"), F.length(F.coalesce(prediction, F.lit(""))).alias("p"), F.length(F.coalesce(reference, F.lit(""))).alias("r"), F.coalesce(hit, F.lit(False)).cast("int").alias("h"))
    return rows.rollup("scenario").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 4).alias("prediction_avg"), F.round(F.avg("r"), 4).alias("reference_avg"), F.round(F.avg("h"), 4).alias("hit_rate"))
