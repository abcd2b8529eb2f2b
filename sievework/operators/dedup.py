"""Exact, near (SimHash) and semantic deduplication in the order of the rows: the first of each neighbourhood is kept.

Greedy keeping in order is the lexicographically first maximal independent set of the graph of near pairs. It is found in rounds: rows
without an undecided earlier neighbour are kept, their neighbours dropped, and decided rows leave the graph. Long chains, of which a round
settles two rows, are walked through block by block.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.similarity import hamming, simhash
from sievework.operators.lookup import numbered
from sievework.operators.ranking import bounded_sample
from sievework.plans.scratch import Scratch

#: Vectors in a block; two blocks are multiplied at once.
PACK = 1024
#: Cells that vectors are spread over, at most, and the sample their centres come from.
CELLS, CENTRE_SAMPLE = 1024, 4096
#: Edges that one task walks through in order; rounds of the plain rule before that begins.
WALK, PLAIN_ROUNDS = 1_000_000, 3


def first_by(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row by ``order`` of each key, nulls being one key. Only (key, order) is shuffled twice, rows once."""
    keyed = df.withColumn("_key", key)
    least = keyed.groupBy("_key").agg(F.min(order).alias("_first")).select(F.col("_first").alias(order)).distinct()
    return keyed.join(least, order, "left_semi").drop("_key")


def question_dedup(questions: DataFrame, text: str, order: str, most: int | None = None) -> DataFrame:
    """The first of each question by the MD5 of its lower-cased text (16 digits), at most ``most`` in order."""
    kept = first_by(questions, F.substring(F.md5(F.lower(F.coalesce(F.col(text), F.lit("")))), 1, 16), order)
    return kept.orderBy(order).limit(most) if most is not None else kept


def fingerprints(df: DataFrame, text: Column, row: str) -> DataFrame:
    """(row, fp)"""
    return df.select(F.col(row).alias("row"), simhash(text).alias("fp"))


def _blocks(bits: int, n: int) -> list[tuple[int, int]]:
    """(first bit, width) of n blocks of nearly equal width."""
    cuts = [round(i * bits / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def near_pairs(fps: DataFrame, max_hamming: int, bits: int = 64, spare: int = 2) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different fingerprints at most ``max_hamming`` bits apart; fps has one row for each fp.

    The bits are cut into max_hamming + spare blocks. Two fingerprints that near agree in at least ``spare`` of them, so they meet under the
    key of some choice of ``spare`` blocks: no pair is lost, and a key is spare blocks wide, which keeps its bucket small.

    Both sides are sorted. Catalyst takes the size of the posts from the files of the fingerprints, each of which it thus counts once and not
    once for every key, and would broadcast through the driver what does not fit there.
    """
    blocks = _blocks(bits, max_hamming + spare)
    keys = []
    for choice in combinations(range(len(blocks)), spare):
        mask = 0
        for i in choice:
            at, width = blocks[i]
            mask |= ((1 << width) - 1) << at
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(len(keys)), F.col("fp").bitwiseAND(F.lit(signed))))
    posts = fps.select("row", "fp", F.explode(F.array(*keys)).alias("key"))
    x, y = posts.alias("x"), posts.alias("y").hint("merge")
    d = hamming(F.col("x.fp"), F.col("y.fp"))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.row") < F.col("y.row")) & (d <= max_hamming))
    return met.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"), d.cast("int").alias("distance")).distinct()


def _walk(batches):
    """(b, kept) of the rows that can be decided from edges (a, b, open) in the order of b: dropped beside a kept row, kept if all earlier
    neighbours are dropped. An earlier row that is not open is kept; an open one that is not here is not known."""
    state: dict[int, bool | None] = {}
    at, kept, unknown = None, False, False

    def close() -> None:
        if at is not None:
            state[at] = False if kept else None if unknown else True

    for batch in batches:
        for a, b, open_ in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if b != at:
                close()
                at, kept, unknown = b, False, False
            known = state.get(a) if open_ else True
            kept |= known is True
            unknown |= known is None
    close()
    rows = [(b, k) for b, k in state.items() if k is not None]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_())], ["b", "kept"])


def greedy(pairs: DataFrame, scratch: Scratch, walk: int = WALK) -> DataFrame:
    """(b): the rows that greedy keeping in order drops, of the pairs (a, b), a < b. Exact, however long the chains are.

    A round drops the neighbours of every row that is no longer open, that is, has no undecided earlier neighbour. After PLAIN_ROUNDS
    rounds, or where a single task can take all edges, ranges of rows with about ``walk`` edges are also walked through in order, one range a task, which settles a chain of any length
    inside a range; rows with more than ``walk`` edges wait for the plain rule. Every round settles at least the first open row.

    All joins sort: row numbers pack so well in files that Catalyst takes far more of them than the driver can hold for a small table.
    """
    e = scratch.write(pairs.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).distinct(), "open")
    drops: list[DataFrame] = []
    rounds = 0
    while n := e.count():
        later = e.select(F.col("b").alias("a")).distinct().withColumn("_later", F.lit(True)).hint("merge")
        marked = e.join(later, "a", "left").select("a", "b", F.coalesce("_later", F.lit(False)).alias("open"))
        gone = marked.where("not open").select("b")
        if rounds >= PLAIN_ROUNDS or n <= walk:
            marked = scratch.write(marked, "marked")
            few = marked.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= walk).select("b").hint("merge")
            ranged = marked.join(few, "b", "left_semi").select("a", "b", "open").repartitionByRange(math.ceil(n / walk), "b").sortWithinPartitions("b")
            gone = marked.where("not open").select("b").unionByName(ranged.mapInArrow(_walk, "b bigint, kept boolean").where("not kept").select("b"))
        drop = scratch.write(gone.distinct(), "dropped")
        lost = drop.hint("merge")
        after = scratch.write(e.join(lost, "b", "left_anti").join(lost.select(F.col("b").alias("a")), "a", "left_anti"), "open")
        scratch.drop(e)
        drops.append(drop)
        if len(drops) > 16:  # keeps the plan of the result short
            drops = [scratch.write(reduce(DataFrame.unionByName, drops), "dropped")]
        e, rounds = after, rounds + 1
    return reduce(DataFrame.unionByName, drops) if drops else e.select("b")


def simhash_dedup(fps: DataFrame, max_hamming: int = 3, bits: int = 64) -> DataFrame:
    """(row, kept, kept_row, distance) of (row, fp): for a dropped row the first kept row that near, for a kept one itself and 0.

    Rows of one fingerprint are joined once, through the first of them. Row numbers are unique.
    """
    scratch = Scratch(fps.sparkSession, "simhash")
    fps = scratch.write(fps.select("row", "fp"), "fps")
    reps = scratch.write(fps.groupBy("fp").agg(F.min("row").alias("row")), "reps")
    pairs = scratch.write(near_pairs(reps, max_hamming, bits), "pairs")
    gone = greedy(pairs, scratch).hint("merge")
    met = pairs.join(gone, "b", "left_semi").join(gone.select(F.col("b").alias("a")), "a", "left_anti")
    best = met.groupBy(F.col("b").alias("rep")).agg(F.min(F.struct(F.col("a").alias("kept_row"), "distance")).alias("m")).hint("merge")
    # there can be as many representatives as rows: they are sorted, not broadcast
    members = fps.join(reps.select("fp", F.col("row").alias("rep")).hint("merge"), "fp").join(best, "rep", "left")
    kept = (F.col("row") == F.col("rep")) & F.col("m").isNull()
    return members.select("row", kept.alias("kept"), F.coalesce("m.kept_row", "rep").alias("kept_row"), F.coalesce("m.distance", F.lit(0)).cast("int").alias("distance"))


def unit_vectors(ids: pa.Array, vectors: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the vectors of length one of the rows that have a vector of ``dim`` numbers, none null, not all zeros."""
    good = pc.fill_null(pc.and_(pc.equal(pc.list_value_length(vectors), dim), pc.is_valid(ids)), False)
    ids, vectors = ids.filter(good), vectors.filter(good)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # null becomes NaN
    norm = np.linalg.norm(flat, axis=1)
    ok = norm > 0
    return ids.to_numpy(zero_copy_only=False).astype(np.int64)[ok], flat[ok] / norm[ok, None]


def vector_batch(columns: list[np.ndarray], names: list[str], units: np.ndarray) -> pa.RecordBatch:
    dim = units.shape[1]
    listed = pa.ListArray.from_arrays(pa.array(np.arange(0, units.size + 1, dim, dtype=np.int32)), pa.array(units.ravel()))
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), listed], [*names, "unit"])


def centres_of(vectors: DataFrame, rows: int, seed: int) -> np.ndarray:
    """Unit vectors far from each other, one for every PACK rows but at most CELLS, from a sample of about CENTRE_SAMPLE rows."""
    named = vectors.select(F.col("row").cast("bigint").alias("row"), "vec").where("vec is not null and row is not null")
    picked = bounded_sample(named, CENTRE_SAMPLE, ["row"], seed).toArrow().sort_by("row")
    sizes = [n for n in pc.list_value_length(picked["vec"]).to_pylist() if n]
    if not sizes:
        return np.zeros((0, 0))
    _, unit = unit_vectors(picked["row"].combine_chunks(), picked["vec"].combine_chunks(), max(set(sizes), key=sizes.count))
    if not len(unit):
        return np.zeros((0, 0))
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(CELLS, rows // PACK + 1, len(unit)):  # the farthest point each time
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def cosine_pairs(vectors: DataFrame, threshold: float, seed: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """(a, b, similarity), a < b: all pairs of (row, vec) with a cosine of at least ``threshold``; exact.

    Every vector belongs to the cell of its nearest centre; the number of cells grows with the input, and their centres are picked from a
    bounded sample, which decides the speed, not the result. By the triangle inequality on angles a vector can only have partners in cells
    whose centre is at most the cell's radius and the threshold's angle away; it visits these cells and no others. Cells are cut into blocks
    of about PACK vectors, and every two blocks that meet are one group of their own, so no cell, however large, is one task's work. Data
    without structure visits all cells: then this is a product of all blocks, the least that an exact answer needs.

    Null vectors, zero vectors, vectors with a null and vectors of another length than most of the sample have no pairs.
    """
    spark = vectors.sparkSession
    none = "a bigint, b bigint, similarity double"
    scratch = scratch or Scratch(spark, "cosine")
    c = centres_of(vectors, vectors.count(), seed)
    if not len(c):
        return spark.createDataFrame([], none)
    dim, angle = c.shape[1], math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def settle(batches):
        for batch in batches:
            ids, units = unit_vectors(batch.column(0), batch.column(1), dim)
            if len(ids):
                near = units @ c.T
                home = near.argmax(axis=1)
                away = np.arccos(np.clip(near[np.arange(len(ids)), home], -1, 1))
                yield vector_batch([ids, home.astype(np.int32), away], ["row", "cell", "away"], units)

    homes = scratch.write(vectors.select(F.col("row").cast("bigint"), "vec").mapInArrow(settle, "row bigint, cell int, away double, unit array<double>"), "homes")
    radius, parts = np.full(len(c), -np.inf), np.zeros(len(c), dtype=np.int64)
    for r in homes.groupBy("cell").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():  # one row a cell
        radius[r.cell], parts[r.cell] = r.away, math.ceil(r.n / PACK)

    def visit(batches):
        for batch in batches:
            ids, home, units = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).flatten().to_numpy().reshape(-1, dim)
            own = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[home]
            i, j = np.nonzero(np.arccos(np.clip(units @ c.T, -1, 1)) <= radius[None, :] + angle)
            # every block of the cell that is visited; of two blocks of one cell, and of two cells, the smaller comes first
            n = parts[j]
            i, j = np.repeat(i, n), np.repeat(j, n)
            q = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            first = (home[i] < j) | ((home[i] == j) & (own[i] <= q))
            cell_x, cell_y = np.where(first, home[i], j), np.where(first, j, home[i])
            part_x, part_y = np.where(first, own[i], q), np.where(first, q, own[i])
            for lo in range(0, len(i), 4 * PACK):
                at = slice(lo, lo + 4 * PACK)
                yield vector_batch([cell_x[at].astype(np.int32), part_x[at].astype(np.int32), cell_y[at].astype(np.int32), part_y[at].astype(np.int32), first[at], ids[i[at]]], ["cx", "px", "cy", "py", "first", "row"], units[i[at]])

    def multiply(block: pa.Table) -> pa.Table:
        side, ids = block["first"].to_numpy(), block["row"].to_numpy()
        units = block["unit"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        alone = block["cx"][0] == block["cy"][0] and block["px"][0] == block["py"][0]
        x, y = (slice(None), slice(None)) if alone else (side, ~side)
        sim, xr, yr = units[x] @ units[y].T, ids[x], ids[y]
        u, v = np.nonzero((sim >= threshold) & (xr[:, None] < yr[None, :] if alone else xr[:, None] != yr[None, :]))
        return pa.table({"a": np.minimum(xr[u], yr[v]), "b": np.maximum(xr[u], yr[v]), "similarity": sim[u, v]})

    met = homes.mapInArrow(visit, "cx int, px int, cy int, py int, first boolean, row bigint, unit array<double>")
    return met.groupBy("cx", "px", "cy", "py").applyInArrow(multiply, none)


def semantic_dedup(vectors: DataFrame, threshold: float = 0.92, max_candidates: int | None = 2000) -> DataFrame:
    """(row, kept, kept_row, similarity) of (row, vec): a row is dropped if one of the last ``max_candidates`` rows kept before it is that
    near; kept_row is the first such. A null vector is always kept. Row numbers are unique.

    The window counts kept rows, so it depends on what is dropped: the search is repeated with the window of the last result until nothing
    changes. What does not change obeys the rule for every row in order, so it is the one result; each round is right for more rows from
    the first on, so there is always an end.
    """
    scratch = Scratch(vectors.sparkSession, "semantic")
    pairs = scratch.write(cosine_pairs(vectors, threshold, scratch=scratch), "pairs")
    rows = scratch.write(numbered(vectors.select("row"), "row", "i"), "rows")
    every, use, last = pairs.count(), pairs, None
    while True:
        gone = scratch.write(greedy(use, scratch).select(F.col("b").alias("row")), "gone")
        if max_candidates is None:
            break
        kept = scratch.write(numbered(rows.join(gone, "row", "left_anti"), "row", "k").select("row", "k"), "kept")
        # the kept rows before b: the position of b less the dropped rows before it
        lost = scratch.write(numbered(rows.join(gone, "row", "left_semi"), "row", "d").select("row", "i", (F.col("i") - F.col("d")).alias("k")), "lost")
        place = kept.unionByName(lost.select("row", "k"))
        near = pairs.join(place.select(F.col("row").alias("b"), F.col("k").alias("kb")), "b").join(place.select(F.col("row").alias("a"), F.col("k").alias("ka")), "a")
        use = scratch.write(near.where(F.col("kb") - F.col("ka") <= max_candidates).select("a", "b", "similarity"), "use")
        now = use.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last or now[0] == every:
            break
        last = now
    met = use.join(gone.select(F.col("row").alias("b")), "b", "left_semi").join(gone.select(F.col("row").alias("a")), "a", "left_anti")
    best = met.groupBy(F.col("b").alias("row")).agg(F.min(F.struct(F.col("a").alias("kept_row"), "similarity")).alias("m"))
    return rows.join(best, "row", "left").select("row", F.col("m").isNull().alias("kept"), F.coalesce("m.kept_row", "row").alias("kept_row"), F.round("m.similarity", 4).alias("similarity"))
