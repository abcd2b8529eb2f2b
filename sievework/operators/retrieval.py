"""Retrieval of symbols: by vector, by keyword, along calls, balanced over layers; and the context made of them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.layers import JAVA, LanguageProfile, keyword_score, layer, priority
from sievework.functions.paths import slashes
from sievework.functions.similarity import cosine
from sievework.functions.text import query_tokens
from sievework.operators.dedup import unit_vectors
from sievework.operators.lookup import calls
from sievework.plans.scratch import Scratch


def nearest(vectors: DataFrame, query: list[float], k: int, order: str = "row", digits: int = 6) -> DataFrame:
    """The k rows of (row, vec, ...) with the largest cosine to the query, of equals the first; vectors of another length are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.where(F.size("vec") == len(query)).withColumn("score", F.round(cosine(F.col("vec"), q), digits))
    return scored.orderBy(F.desc("score"), order).limit(k)


def nearest_all(vectors: DataFrame, queries: DataFrame, k: int, most_bytes: int = 64 << 20, digits: int = 6) -> DataFrame:
    """(query, rank, row, score): for each (query, vec) the k rows of (row, vec) with the largest cosine, of equals the first.

    Queries are sent to all tasks in blocks of at most ``most_bytes``; for each block the rows are streamed once where they are, never
    shuffled, and a task keeps k rows for each query. Nulls, zeros and vectors of another length than the query are left out.
    """
    spark = vectors.sparkSession
    named = queries.select(F.col("query").cast("bigint").alias("query"), "vec", F.size("vec").alias("dim")).where("query is not null and vec is not null and dim > 0")
    sizes = [(r.dim, r.n) for r in named.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()]
    rows = vectors.select(F.col("row").cast("bigint"), "vec")
    found = []
    for dim, n in sizes:
        blocks = max(1, math.ceil(n * dim * 8 / most_bytes))
        for i in range(blocks):
            part = named.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("query"), F.lit(blocks)) == i)).select("query", "vec").toArrow()
            ids, units = unit_vectors(part["query"].combine_chunks(), part["vec"].combine_chunks(), dim)
            if len(ids):
                found.append(rows.mapInArrow(_best(spark.sparkContext.broadcast((ids, units)), dim, k, digits), FOUND))
    if not found:
        return spark.createDataFrame([], "query bigint, rank int, row bigint, score double")
    return _ranked(found, k)


class _Top:
    """The k largest scores of each query so far, of equal ones those with the smaller row."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.scores, self.rows = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)

    def update(self, lo: int, scores: np.ndarray, rows: np.ndarray) -> None:
        """scores: queries from ``lo`` on x rows; minus infinity never counts."""
        for i in np.flatnonzero(((scores >= self.scores[lo : lo + len(scores), -1:]) & (scores > -np.inf)).any(axis=1)):
            new = (scores[i] >= self.scores[lo + i, -1]) & (scores[i] > -np.inf)
            s, r = np.concatenate([self.scores[lo + i], scores[i][new]]), np.concatenate([self.rows[lo + i], rows[new]])
            order = np.lexsort((r, -s))[: self.k]
            self.scores[lo + i], self.rows[lo + i] = s[order], r[order]

    def batch(self) -> pa.RecordBatch:
        i, j = np.nonzero(self.scores > -np.inf)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[i]), pa.array(self.rows[i, j]), pa.array(self.scores[i, j])], ["query", "row", "score"])


FOUND = "query bigint, row bigint, score double"


def _ranked(found: list[DataFrame], k: int) -> DataFrame:
    """The k best of what the tasks have found; of every partition only k rows a query are shuffled."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "row"))
    return reduce(DataFrame.unionByName, found).withColumn("rank", place).where(F.col("rank") <= k).select("query", "rank", "row", "score")


def _best(block, dim: int, k: int, digits: int):
    """What a task does with its rows: a matrix product with all queries, of which the k best of each are kept."""

    def run(batches):
        ids, q = block.value
        top = _Top(ids, k)
        for batch in batches:
            at, v = unit_vectors(batch.column(0), batch.column(1), dim)
            for lo in range(0, len(ids), 512):
                top.update(lo, np.round(q[lo : lo + 512] @ v.T, digits) + 0.0, at)
        yield top.batch()

    return run


def _in_blocks(named: DataFrame, most_rows: int) -> Iterator[list]:
    """The rows of (query, ...) in blocks of about ``most_rows``, one after the other on the driver; few rows are read at once."""
    few = named.limit(most_rows + 1).collect()
    if len(few) <= most_rows:
        yield few
        return
    blocks = math.ceil(named.count() / most_rows)
    for i in range(blocks):
        yield named.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i).collect()


def keyword_all(symbols: DataFrame, queries: DataFrame, k: int, profile: LanguageProfile | None = None, order: str = "rec_no", least: float = 0.0, by: str | None = None, most_queries: int = 10_000) -> DataFrame:
    """(query, rank, row, score, by): for each (query, text) the k symbols with the largest keyword score above ``least``, of equals the
    first; with ``by``, a column of few values, the k of each value.

    As ``nearest_all``: queries go to all tasks in bounded blocks, symbols are streamed where they are. Each word is looked for once a
    symbol, however many queries have it.
    """
    spark = symbols.sparkSession
    weights = (profile.name_weight, profile.path_weight, profile.source_weight) if profile else (10.0, 5.0, 1.0)
    keywords = profile.keywords if profile else ()
    named = queries.select(F.col("query").cast("bigint").alias("query"), query_tokens(F.col("text")).alias("tokens")).where("query is not null")
    part = F.coalesce(F.col(by), F.lit("")) if by else F.lit("")
    columns = symbols.select(F.col(order).cast("bigint"), *[F.lower(F.coalesce(c, F.lit(""))) for c in ("qualified_name", "file_path", "source")], part.alias("_by"))
    found = []
    for rows_of in _in_blocks(named, most_queries):
        block = spark.sparkContext.broadcast([(r.query, r.tokens) for r in rows_of])

        def run(batches, block=block):
            ids = np.array([q for q, _ in block.value], dtype=np.int64)
            words = sorted({t for _, ts in block.value for t in ts})
            at = {t: j for j, t in enumerate(words)}
            asked = np.zeros((len(ids), len(words)))
            for j, (_, ts) in enumerate(block.value):
                asked[j, [at[t] for t in ts]] = 1
            some = asked.any(axis=1)
            tops: dict[str, _Top] = {}
            for batch in batches:
                rows, parts = batch.column(0).to_numpy(zero_copy_only=False), np.array(batch.column(4).to_pylist())
                for lo in range(0, batch.num_rows, 256):
                    texts = list(zip(*(batch.column(c).slice(lo, 256).to_pylist() for c in (1, 2, 3))))
                    worth = np.array([[weights[0] if t in n else weights[1] if t in p else weights[2] if t in s else 0.0 for t in words] for n, p, s in texts]).reshape(len(texts), len(words))
                    bonus = np.array([float(sum(w in n for w in keywords)) for n, _, _ in texts])
                    scores = asked @ worth.T + bonus * some[:, None]
                    scores = np.where(scores > least, scores, -np.inf)
                    for value in np.unique(parts[lo : lo + 256]):
                        mine = parts[lo : lo + 256] == value
                        tops.setdefault(str(value), _Top(ids, k)).update(0, scores[:, mine], rows[lo : lo + 256][mine])
            for value, top in tops.items():
                out = top.batch()
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array([value] * out.num_rows, pa.string())], [*out.schema.names, "by"])

        found.append(columns.mapInArrow(run, FOUND + ", by string"))
    place = F.row_number().over(Window.partitionBy("query", "by").orderBy(F.desc("score"), "row"))
    return reduce(DataFrame.unionByName, found).withColumn("rank", place).where(F.col("rank") <= k).select("query", "rank", "row", "score", "by")


def keyword_top(symbols: DataFrame, query: Column | str, k: int, profile: LanguageProfile | None = None, order: str = "rec_no") -> DataFrame:
    """The k symbols with the largest keyword score above 0, of equals the first by ``order``."""
    tokens = query_tokens(F.lit(query) if isinstance(query, str) else query)
    scored = symbols.withColumn("score", keyword_score(tokens, F.col("qualified_name"), F.col("file_path"), F.col("source"), profile))
    return scored.where("score > 0").orderBy(F.desc("score"), order).limit(k)


def top_methods(symbols: DataFrame, most: int, profile: LanguageProfile = JAVA, order: str = "rec_no") -> DataFrame:
    """The methods most worth a profile: by priority, of equals the first."""
    scored = symbols.where("symbol_type = 'method'").withColumn("priority", priority(profile, F.col("annotations"), F.col("doc"), F.col("start_line"), F.col("end_line")))
    return scored.orderBy(F.desc("priority"), order).limit(most)


def with_layer(symbols: DataFrame, profile: LanguageProfile = JAVA) -> DataFrame:
    return symbols.withColumn("layer", layer(profile, F.col("annotations"), F.col("name"), F.col("qualified_name"), F.col("file_path")))


def balanced(selected: DataFrame, symbols: DataFrame, queries: DataFrame, profile: LanguageProfile = JAVA, order: str = "rec_no") -> DataFrame:
    """(query, order): for every query of (query, text) and every layer without a symbol selected for it, in (query, order), the symbol of
    that layer that fits the query best, or its first if none does. All layers are looked through in one pass."""
    layered = with_layer(symbols, profile).where("layer is not null")
    there = selected.join(layered.select(order, "layer"), order).select("query", F.col("layer").alias("by")).distinct()
    return keyword_all(layered, queries, 1, profile, order, -1.0, "layer").join(there, ["query", "by"], "left_anti").select("query", F.col("row").alias(order))


def called_by(base: DataFrame, symbols: DataFrame, k: int, max_depth: int, most: int, scratch: Scratch, order: str = "rec_no") -> DataFrame:
    """(query, order, depth): what the symbols selected for each query, in (query, order) and at most ``k`` of them, call: nearest first and
    then by ``order``, at most ``most`` for a query, none that is selected. A symbol is known by its symbol_id, so of repeated rows the first
    counts."""
    first = symbols.groupBy("symbol_id").agg(F.min(order).alias(order)).select(order)
    # of a common name no more methods can count than are wanted and are known already
    place = F.row_number().over(Window.partitionBy("name").orderBy(order))
    named = symbols.where("symbol_type = 'method' and name is not null").select(order, "name").join(first, order, "left_semi").withColumn("_place", place).where(F.col("_place") <= k + most * max_depth).drop("_place")
    front, seen = base.select("query", order), base.select("query", order, F.lit(0).alias("depth"))
    for d in range(1, max_depth + 1):
        callers = symbols.select(order, "source").join(front.select(order).distinct(), order, "left_semi").join(first, order, "left_semi")
        names = calls(callers, order).select(F.col("caller").alias(order), "name")
        step = front.join(names, order).select("query", "name").distinct().join(named, "name").select("query", order).distinct()
        new = step.join(seen.select("query", order), ["query", order], "left_anti").withColumn("depth", F.lit(d))
        front = scratch.write(new, "front")
        seen = seen.unionByName(front)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("depth", order))
    return seen.where("depth > 0").withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def retrieve_all(symbols: DataFrame, queries: DataFrame, k: int = 6, vectors: DataFrame | None = None, profile: LanguageProfile = JAVA, max_depth: int = 1, max_expansion: int = 20, order: str = "rec_no") -> DataFrame:
    """(query, order, place, how): the symbols for each query of (query, text), best first.

    By vector where there are vectors (of symbol_id, vec, row) and the queries have one (vec), else by keyword, else the first k; then what
    they call, then one symbol of every layer that is missing. A symbol is returned once, under the first reason.
    """
    scratch = Scratch(symbols.sparkSession, "retrieval")
    if vectors is not None and "vec" in queries.columns:
        near = nearest_all(vectors, queries.select("query", "vec"), k)
        named = near.join(vectors.select("row", slashes(F.col("symbol_id")).alias("sid")), "row")
        known = symbols.groupBy(slashes(F.col("symbol_id")).alias("sid")).agg(F.min(order).alias(order))
        hits = named.join(known, "sid").groupBy("query", order).agg(F.max("score").alias("score"), F.min("row").alias("tie")).withColumn("how", F.lit("vector"))
    else:
        hits = keyword_all(symbols, queries, k, profile, order).select("query", F.col("row").alias(order), "score", F.col("row").alias("tie"), F.lit("keyword").alias("how"))
    base = scratch.write(hits.select("query", order, (-F.col("score")).alias("sort"), "tie", "how"), "hits")
    if "vec" not in queries.columns or vectors is None:
        rest = queries.select("query").join(base, "query", "left_anti")
        if not rest.isEmpty():
            some = [r[0] for r in symbols.orderBy(order).limit(k).select(order).collect()]
            plain = rest.select("query", F.explode(F.array(*map(F.lit, some)).cast("array<bigint>")).alias(order))
            base = scratch.write(base.unionByName(plain.select("query", order, F.lit(0.0).alias("sort"), F.col(order).alias("tie"), F.lit("first").alias("how"))), "base")
    chosen = base.select("query", order)
    parts = [base]
    if max_depth > 0 and max_expansion > 0:
        called = called_by(chosen, symbols, k, max_depth, max_expansion, scratch, order)
        chosen = chosen.unionByName(called.select("query", order))
        parts.append(called.select("query", order, F.col("depth").cast("double").alias("sort"), F.col(order).alias("tie"), F.lit("call").alias("how")))
    extra = balanced(chosen, symbols, queries.select("query", "text"), profile, order)
    parts.append(extra.select("query", order, F.lit(0.0).alias("sort"), F.col(order).alias("tie"), F.lit("layer").alias("how")))
    stage = F.when(F.col("how") == "call", 1).when(F.col("how") == "layer", 2).otherwise(0)
    every = reduce(DataFrame.unionByName, parts).withColumn("stage", stage)
    once = every.groupBy("query", order).agg(F.min(F.struct("stage", "sort", "tie", "how")).alias("m")).select("query", order, "m.*")
    # a query has at most k + max_expansion symbols and one for each layer
    return once.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("stage", "sort", "tie", order))).select("query", order, "place", "how")


def retrieve(symbols: DataFrame, query: str, k: int = 6, vectors: DataFrame | None = None, query_vector: list[float] | None = None, profile: LanguageProfile = JAVA, max_depth: int = 1, max_expansion: int = 20, order: str = "rec_no") -> DataFrame:
    """(order, place, how): ``retrieve_all`` for one query."""
    one = symbols.sparkSession.createDataFrame([(0, query, query_vector)], "query bigint, text string, vec array<double>")
    if query_vector is None:
        one = one.drop("vec")
    return retrieve_all(symbols, one, k, vectors, profile, max_depth, max_expansion, order).drop("query")


def context(chosen: DataFrame, symbols: DataFrame, group: str | None = None, order: str = "rec_no") -> DataFrame:
    """(group, context): sources of the chosen (group, order, place), each under its file and name, joined in the order of their places."""
    header = F.concat(F.lit("// File: "), slashes(F.coalesce("file_path", F.lit(""))), F.lit("\n// Method: "), F.coalesce("qualified_name", F.lit("")), F.lit("\n"), F.coalesce("source", F.lit("")))
    j = chosen.join(symbols.select(order, header.alias("part")), order)
    packed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", order, "part"))), lambda r: r["part"]), "\n\n").alias("context")
    return j.groupBy(*([group] if group else [])).agg(packed)


def layered_context(chosen: DataFrame, symbols: DataFrame, profile: LanguageProfile = JAVA, most: int = 800, order: str = "rec_no") -> DataFrame:
    """(context): the chosen symbols under the titles of their layers, sources cut to ``most`` characters, other components last."""
    names = [*profile.layers]
    rank = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), F.col("layer")) - 1, F.lit(len(names)))
    titles = [f"\n# {n.capitalize()} 层" for n in names] + ["\n# Other Components"]
    part = F.concat(F.lit("## "), F.coalesce("qualified_name", F.lit("")), F.lit(" (File: "), slashes(F.col("file_path")), F.lit(" Lines: "), F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string"), F.lit(f")\n```{profile.name}\n"), F.substring("source", 1, most), F.lit("\n```"))
    rows = with_layer(symbols, profile).join(chosen.select(order, "place"), order).select(rank.cast("int").alias("rank"), "place", part.alias("part"))
    by_layer = rows.groupBy("rank").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "part"))), lambda r: r["part"]), "\n").alias("body"))
    titled = by_layer.select("rank", F.concat(F.element_at(F.array(*[F.lit(t) for t in titles]), F.col("rank") + 1), F.lit("\n"), "body").alias("body"))
    return titled.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "body"))), lambda r: r["body"]), "\n").alias("context"))
