"""Joins of samples, references and symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.paths import slashes, without_line
from sievework.functions.text import call_names
from sievework.plans.scratch import Scratch


def symbol_map(symbols: DataFrame, order: str = "rec_no") -> DataFrame:
    """One row for each normalised symbol_id, the last by ``order``; rows without a symbol_id are left out. Adds the column ``sid``.

    The join has the id as its only key, so finding the last row and dropping what repeats it need one shuffle of the symbols.
    """
    named = symbols.where("symbol_id is not null").withColumn("sid", slashes(F.col("symbol_id")))
    latest = named.groupBy("sid").agg(F.max(order).alias("_last"))
    return named.join(latest, (named["sid"] == latest["sid"]) & (named[order] >= latest["_last"])).drop(latest["sid"]).drop("_last").dropDuplicates(["sid"])


def evidence(samples: DataFrame, key: str = "rec_no", refs: str = "thought.evidence_refs", *extra: str) -> DataFrame:
    """(key, pos, ref.*, extra): one row for each reference, with its position."""
    return samples.select(key, *extra, F.posexplode(F.col(refs)).alias("pos", "ref")).select(key, *[c.split(".")[-1] for c in extra], "pos", "ref.*")


def evidence_symbols(refs: DataFrame, symbols: DataFrame) -> DataFrame:
    """References with the symbol they name: columns of the symbol under s_, nulls for a miss, found tells which."""
    known = symbol_map(symbols)
    renamed = known.select("sid", *[F.col(c).alias(f"s_{c}") for c in known.columns if c != "sid"], F.lit(True).alias("hit"))
    joined = refs.join(renamed, slashes(refs["symbol_id"]) == renamed["sid"], "left")
    return joined.withColumn("found", F.coalesce("hit", F.lit(False))).drop("sid", "hit")


def profile_symbols(profiles: DataFrame, symbols: DataFrame) -> DataFrame:
    """Profiles with their symbol; profiles without one are dropped."""
    known = symbol_map(symbols).drop("symbol_id")
    left = profiles.withColumn("sid", slashes(F.col("symbol_id")))
    clash = [c for c in known.columns if c in left.columns and c != "sid"]
    return left.join(known.drop(*clash), "sid").drop("sid")


def unprocessed(candidates: DataFrame, done: DataFrame, key: str = "symbol_id") -> DataFrame:
    """Candidates whose key has not been processed; a null key never has."""
    return candidates.join(done.select(F.col(key).alias("_done")).where("_done is not null").distinct(), F.col(key) == F.col("_done"), "left_anti")


def cited_symbols(symbols: DataFrame, refs: DataFrame) -> DataFrame:
    """The symbols that some reference names: the direct context of a question."""
    ids = refs.select(slashes(F.col("symbol_id")).alias("_sid")).where("_sid is not null").distinct()
    return symbols.join(ids, slashes(symbols["symbol_id"]) == ids["_sid"], "left_semi")


def corrected_refs(refs: DataFrame, symbols: DataFrame, order: str = "rec_no") -> DataFrame:
    """References as the symbols have them: by id, else by the id without its line number; the first symbol by ``order`` counts.

    How is exact, prefix or none; a reference without a symbol stays as it is if it has a file, and is dropped if it has none.
    """
    fields = ("symbol_id", "file_path", "start_line", "end_line", "source_hash")
    s = symbols.where("symbol_id is not null").select(order, slashes(F.col("symbol_id")).alias("sid"), *[F.col(f).alias(f"_{f}") for f in fields])
    packed = F.struct(*[f"_{f}" for f in fields])
    exact = s.groupBy("sid").agg(F.min_by(packed, order).alias("exact"))
    loose = s.groupBy(without_line(F.col("sid")).alias("prefix")).agg(F.min_by(packed, order).alias("loose"))
    r = refs.withColumn("_id", slashes(F.col("symbol_id")))
    joined = r.join(exact, r["_id"] == exact["sid"], "left").drop("sid")
    joined = joined.join(loose, F.when(F.contains("_id", F.lit(":")), without_line(F.col("_id"))) == loose["prefix"], "left").drop("prefix")
    best = F.coalesce("exact", "loose")
    how = F.when(F.col("exact").isNotNull(), "exact").when(F.col("loose").isNotNull(), "prefix").otherwise("none")
    value = {f: F.when(best.isNull(), F.col(f)).otherwise(slashes(best[f"_{f}"]) if f in ("symbol_id", "file_path") else best[f"_{f}"]) for f in fields}
    return joined.withColumn("how", how).withColumns(value).drop("exact", "loose", "_id").where("how <> 'none' or file_path is not null")


def complete(ref: Column) -> Column:
    """Whether a reference has all its fields, none null or empty."""
    text = [F.length(F.coalesce(ref[f], F.lit(""))) > 0 for f in ("symbol_id", "file_path", "source_hash")]
    return text[0] & text[1] & text[2] & ref["start_line"].isNotNull() & ref["end_line"].isNotNull()


def refs_incomplete(refs: Column) -> Column:
    """Whether references are missing, or one of them lacks a field."""
    return F.coalesce((F.size(refs) <= 0) | ~F.forall(refs, complete), F.lit(True))


def repaired_refs(refs: Column, default: Column) -> Column:
    """References of the default's symbol or file with their gaps filled from it."""

    def fix(r: Column) -> Column:
        same = F.coalesce(r["symbol_id"] == default["symbol_id"], F.lit(False)) | F.coalesce(r["file_path"] == default["file_path"], F.lit(False))
        filled = F.struct(
            *[F.coalesce(F.nullif(r[f], F.lit("")), default[f]).alias(f) for f in ("symbol_id", "file_path")],
            *[F.coalesce(F.nullif(r[f], F.lit(0)), default[f]).alias(f) for f in ("start_line", "end_line")],
            F.coalesce(F.nullif(r["source_hash"], F.lit("")), default["source_hash"]).alias("source_hash"),
        )
        return F.when(same, filled).otherwise(r)

    return F.transform(refs, fix)


def available_refs(refs: Column, default: Column, most: int = 3) -> Column:
    """The default and then the complete references, each (symbol, lines) once, at most ``most``."""
    every = F.concat(F.array(default), F.filter(repaired_refs(refs, default), complete))
    key = lambda r: F.struct(r["symbol_id"], r["start_line"], r["end_line"])
    first = F.filter(every, lambda r, i: ~F.exists(F.slice(every, F.lit(1), i), lambda q: key(q) == key(r)))
    return F.slice(first, 1, most)


def calls(symbols: DataFrame, order: str = "rec_no") -> DataFrame:
    """(caller, name): every name that a symbol's source calls, once. Calls stay by name: with the methods of a name they are the edges of
    the call graph, and a common name costs its callers and its callees, not their product."""
    return symbols.select(F.col(order).alias("caller"), F.explode(call_names(F.col("source"))).alias("name"))


def call_edges(symbols: DataFrame, order: str = "rec_no") -> DataFrame:
    """(caller, name, callees, first_callee): for every called name the number of methods that have it, and the first of them."""
    index = symbols.where("symbol_type = 'method'").groupBy("name").agg(F.count(F.lit(1)).alias("callees"), F.min(order).alias("first_callee"))
    return calls(symbols, order).join(index, "name").select("caller", "name", "callees", "first_callee")


def expand_calls(seeds: DataFrame, symbols: DataFrame, max_depth: int = 1, most: int = 20, order: str = "rec_no") -> DataFrame:
    """(rec_no, depth): symbols reached from the seeds over calls, nearest first and then by ``order``, at most ``most``; seeds are not returned.

    A symbol is known by its symbol_id, so of repeated rows the first counts. Ties that the order of a set once decided go by ``order``.
    Calls are only extracted from the symbols at the front, and their distinct names pick the methods.
    """
    if max_depth <= 0 or most <= 0:
        return symbols.select(order).limit(0).withColumn("depth", F.lit(0))
    scratch = Scratch(symbols.sparkSession, "calls")
    first = symbols.groupBy("symbol_id").agg(F.min(order).alias(order)).select(order)
    methods = symbols.where("symbol_type = 'method' and name is not null").select(F.col(order).alias("node"), "name")
    front = seen = scratch.write(seeds.select(F.col(order).alias("node")).distinct().withColumn("depth", F.lit(0)), "front")
    for d in range(1, max_depth + 1):
        sources = symbols.select(order, "source").join(front.select(F.col("node").alias(order)), order, "left_semi").join(first, order, "left_semi")
        names = calls(sources, order).select("name").distinct()
        step = methods.join(names, "name", "left_semi").select("node").join(first.select(F.col(order).alias("node")), "node", "left_semi")
        front = scratch.write(step.join(seen, "node", "left_anti").distinct().withColumn("depth", F.lit(d)), "front")
        seen = seen.unionByName(front)
    return seen.where("depth > 0").orderBy("depth", "node").limit(most).select(F.col("node").alias(order), "depth")


def numbered(df: DataFrame, order: str, name: str = "row", within: str | None = None) -> DataFrame:
    """``df`` with the position (0, 1, ...) of each row by ``order``, in all or ``within`` each value of a column of few values (not null).

    No task sorts all rows: they are range-partitioned, and the sizes of the partitions, one number for each (and value), are summed on the
    driver. The bounds of the ranges come from a random sample that each run of a plan draws anew, so the partitioned rows are written once
    and read by both the count and the result; give this function the columns that are needed, not whole texts.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = Scratch(spark, "numbered").write(df.repartitionByRange(n, order).withColumn("_part", F.spark_partition_id()))
    keys = ["_part", *([within] if within else [])]
    before: dict = {}
    offsets = []
    for r in sorted(ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_part"]):
        value = r[within] if within else None
        offsets.append((*([r["_part"], value] if within else [r["_part"]]), before.get(value, 0)))
        before[value] = before.get(value, 0) + r["n"]
    kind = f", `{within}` {df.schema[within].dataType.simpleString()}" if within else ""
    starts = spark.createDataFrame(offsets, f"_part int{kind}, _before bigint")
    inside = Window.partitionBy(*keys).orderBy(order)
    return ranged.join(F.broadcast(starts), keys).withColumn(name, F.col("_before") + F.row_number().over(inside) - 1).drop("_part", "_before")
