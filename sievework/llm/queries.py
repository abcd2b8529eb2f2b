"""The queries of the training-data operators: each takes a session and a directory of Parquet tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import documented, group_split, mixture, near_duplicates, pair_defects, personal, quota_sample, secrets, split_overlap, tokens
from sievework.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return secrets.credentials(table(spark, d, "symbols")).select("rec_no", F.explode("lines").alias("line_no")).distinct()


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    return secrets.credentials(table(spark, d, "symbols")).select("rec_no", "source", F.size("lines").cast("bigint").alias("credentials"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.all_pairs(*near_duplicates.near_duplicate_links(table(spark, d, "samples")))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(table(spark, d, "samples"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return pair_defects.defects(table(spark, d, "samples"), table(spark, d, "documents"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap.overlap_pairs(*split_overlap.overlap_links(table(spark, d, "samples")))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap.overlapping_records(table(spark, d, "samples"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap.overlap_report(table(spark, d, "samples"))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.quota_plan(table(spark, d, "samples"), table(spark, d, "quota_targets"))


def p5_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_report(spark, d).where("short").select("scenario", "bucket", "polarity")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).select("scenario", "bucket", "polarity", "pool_records", "wanted", "short")


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.quota_sample(table(spark, d, "samples"), table(spark, d, "quota_targets"))


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the sample holds of each cell."""
    drawn = p5_sample(spark, d)
    return drawn.groupBy("scenario", "bucket", "polarity").agg(F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("floor"), 1)).alias("floor_records"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return documented.documented_functions(table(spark, d, "symbols")).select("rec_no", "line_no").distinct()


def p6_pairs(spark: SparkSession, d: str) -> DataFrame:
    return documented.documented_functions(table(spark, d, "symbols"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return group_split.sample_groups(table(spark, d, "evidence_refs"))


def p7_splits(spark: SparkSession, d: str) -> DataFrame:
    return group_split.group_splits(table(spark, d, "samples"), table(spark, d, "evidence_refs"), table(spark, d, "split_targets"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Every split: its rows within one in a hundred of the target, or where groups are coarser within one group, and groups that lie in
    several splits (there must be none)."""
    placed = p7_splits(spark, d)
    groups = placed.groupBy("group_no").agg(F.count(F.lit(1)).alias("n"), F.min("split").alias("a"), F.max("split").alias("b"))
    total, most, divided = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.count(F.when(F.col("a") != F.col("b"), 1))).first()
    goal = table(spark, d, "split_targets").join(placed.groupBy("split").agg(F.count(F.lit(1)).alias("n")), "split", "left")
    return goal.select("split", (F.abs(F.coalesce("n", F.lit(0)) - F.col("target_share") * total) <= max(total * 0.01, most)).alias("at_target"), F.lit(divided).alias("divided_groups"), F.lit(total).alias("samples"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents")).select("doc_id", "ids")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decode(tokens.encode(table(spark, d, "documents")))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Every source: no more repeats than allowed, and within one in a thousand of its share (or 1,024 tokens, about a document, where that
    is more), which grows where capped sources leave their places to it."""
    shares = p9_shares(spark, d)
    full = F.when(F.col("capped"), F.lit(1.0)).otherwise(F.lit(0.0))
    taken, left, whole, tokens_ = shares.agg(F.sum(full * F.coalesce("actual_share", F.lit(0.0))), F.sum(full * F.col("target_share")), F.sum("target_share"), F.sum("tokens")).first()
    due = F.when(F.col("capped"), F.col("actual_share")).otherwise(F.col("target_share") * F.lit((1 - taken) / max(whole - left, 1e-9)))
    return shares.select("source", (F.col("repeats") <= F.col("max_repeats")).alias("within_repeats"), (F.abs(F.col("actual_share") - due) <= max(0.001, 1024 / max(tokens_, 1))).alias("at_target"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_findings(spark, d).select("doc_id", "kind", "start_at").distinct()


def _pseudonym_key(spark: SparkSession) -> bytes:
    """The key that the session names, else one of this run alone: then nobody can undo the pseudonyms."""
    named = spark.conf.get("spark.sievework.pseudonymKey", None)
    return named.encode() if named else os.urandom(32)


def p10_findings(spark: SparkSession, d: str) -> DataFrame:
    return personal.findings(table(spark, d, "documents"), table(spark, d, "contributors"), _pseudonym_key(spark))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(table(spark, d, "documents"), table(spark, d, "contributors"), _pseudonym_key(spark)).select("doc_id", "text", F.size("findings").cast("bigint").alias("pieces"))


def queries() -> dict[str, Query]:
    names = [p1_found, p1_redacted, p2_found, p2_groups, p3_found, p4_found, p4_records, p4_report, p5_found, p5_report, p5_plan, p5_sample, p5_counts, p6_found, p6_pairs, p7_found, p7_splits, p7_report, p8_ids, p8_decoded, p9_mixture, p9_shares, p9_report, p10_found, p10_findings, p10_redacted]
    return {f.__name__: f for f in names}


_CELLS = """
spelled as (select rec_no, nullif(regexp_replace(regexp_replace(lower(scenario), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '[\\s\\p{Z}-]', '_', 'g'), '') as scenario,
  nullif(regexp_replace(regexp_replace(lower(quality.coverage.bucket), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '[\\s\\p{Z}-]', '_', 'g'), '') as bucket,
  nullif(regexp_replace(regexp_replace(lower(quality.coverage.polarity), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '[\\s\\p{Z}-]', '_', 'g'), '') as polarity from samples where quality.passed),
size as (select floor(0.3 * count(*) + 1e-9) as n from samples where quality.passed),
cells as (select q.scenario, q.bucket, q.polarity, count(s.rec_no) as have, greatest(q.target_share * any_value(size.n), q.min_rows) as want from quota_targets q cross join size left join spelled s on s.scenario = q.scenario and s.bucket = q.bucket and s.polarity = q.polarity group by q.scenario, q.bucket, q.polarity, q.target_share, q.min_rows)
"""

# the rule itself: floors first, then the smallest (rank - 0.5) / share, until the sample is full
_DRAWN = f"""{_CELLS}, ranked as (select s.*, q.target_share, q.min_rows, row_number() over (partition by s.scenario, s.bucket, s.polarity order by md5('11:' || rec_no), rec_no) as rank
  from spelled s join quota_targets q on s.scenario = q.scenario and s.bucket = q.bucket and s.polarity = q.polarity),
seated as (select *, (rank - 0.5) / target_share as priority, rank <= min_rows as floor from ranked),
ordered as (select *, row_number() over (order by floor desc, priority, scenario, bucket, polarity) as place from seated),
drawn as (select ordered.* from ordered, size where place <= n)
"""

_FILES = """
links as (select distinct sample_no as rec_no, nullif(regexp_replace(regexp_replace(coalesce(nullif(file_path, ''), split_part(symbol_id, ':', 1)), '[\\\\/]+', '/', 'g'), '^(\\./)+', ''), '') as file from evidence_refs where sample_no is not null)
"""


def _similar_pairs(second: str, where: str) -> str:
    """Every pair of rows, by counting shared substrings through the substrings of the instruction: what the definition says, written out."""
    text = lambda c: f"regexp_replace(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
    cut = lambda c: f"list_distinct(list_transform(generate_series(1, length({c}) - 4), lambda i: substr({c}, i, 5)))"
    return f"""with n as (select rec_no, split, {text("instruction")} as x, {text(second)} as y from samples),
    s as (select rec_no, split, {cut("x")} as sx, {cut("y")} as sy from n where length(x) >= 20 and length(y) >= 60),
    g as (select rec_no, len(sx) as n, unnest(sx) as gram from s),
    c as (select a.rec_no as rec_a, b.rec_no as rec_b, count(*) as k, any_value(a.n) as na, any_value(b.n) as nb from g a join g b on a.gram = b.gram and a.rec_no < b.rec_no group by 1, 2),
    p as (select rec_a, rec_b from c where k >= 0.6 * (na + nb - k))
    select rec_a, rec_b from p join s a on a.rec_no = rec_a join s b on b.rec_no = rec_b
    where len(list_intersect(a.sy, b.sy)) >= 0.6 * (len(a.sy) + len(b.sy) - len(list_intersect(a.sy, b.sy))) {where}"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _similar_pairs("answer", ""),
        "p4_found": _similar_pairs("context", "and a.split in ('train', 'val', 'test') and b.split in ('train', 'val', 'test') and (a.split = 'train') <> (b.split = 'train')"),
        "p5_found": f"with {_CELLS} select scenario, bucket, polarity from cells where have < want",
        "p5_sample": f"with {_DRAWN} select rec_no, scenario, bucket, polarity, rank, priority, floor from drawn",
        "p5_counts": f"with {_DRAWN} select scenario, bucket, polarity, count(*) as records, count(*) filter (floor) as floor_records from drawn group by all",
        "p7_report": "select split, true as at_target, 0 as divided_groups, (select count(*) from samples) as samples from split_targets",
        "p8_decoded": "select doc_id, text from documents",
        "p9_report": "select source, true as within_repeats, true as at_target from mix_targets",
        "p5_report": f"with {_CELLS} select scenario, bucket, polarity, have as pool_records, want as wanted, have < want as short from cells",
        # the smallest rec_no that every sample reaches over shared files
        "p7_found": f"""with recursive {_FILES}, known as (select rec_no, file from links where file is not null),
            edge as (select distinct a.rec_no as u, b.m as v from known a join (select file, min(rec_no) as m from known group by file) b on a.file = b.file),
            steps as (select u, v from edge union select v, u from edge),
            reach(u, v) as (select u, v from steps union select r.u, s.v from reach r join steps s on r.v = s.u)
            select u as rec_no, min(v) as group_no from reach group by u""",
    }
