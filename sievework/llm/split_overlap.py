"""Same or near-same records across splits, by an exact prefix-filter join on rare shingles.

Shingles of the instruction are ordered from rare to frequent. If two sets of sizes m and n have a similarity of at least t, they share c
shingles among the first m - ceil(t m) + c of one and the first n - ceil(t n) + c of the other. Prefixes of the evaluation records are
joined with prefixes of the training records; a length filter, a position filter and a bitmap filter (the bits in which two hashed sets
differ are a lower bound of their symmetric difference) run inside the join, and pairs that met fewer than c times are dropped; where the
overlap that is needed is below c, it takes its place. None of this loses a pair. Survivors are checked on the texts.
The order comes from shingle counts over all records, hashed into a table that grows with the input up to a fixed size: any fixed order is
exact, a good one is fast, and the frequent shingles, which it is there to avoid, stand out in a full table too.
Once ordered, a shingle is known by 32 bits: two that share them only let more pairs meet. The join goes over the shingles in slices, and
what a step has shuffled, or alone has read, is removed when it ends, so that the disk holds one slice and not all of them.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.pairs import verify, with_representatives
from sievework.llm.shingles import MIN_INSTRUCTION, MIN_LONG, Normal, blocks, mix
from sievework.plans.scratch import Scratch

#: Counters: 2^17 up to a million records, twice as many for four times the records, at most 2^21.
COUNT_BITS, MOST_COUNT_BITS, COUNTED_RECORDS = 17, 21, 1_000_000
BITMAP_WORDS = 4
COMMON = 4
#: The shingles are joined in so many parts. A position has so many bits beside its shingle; later ones count as the last, which only filters less.
SLICES, POSITION_BITS = 2, 16
SIGNED = "rec_no bigint, evaluation boolean, k1 bigint, k2 bigint, n int, bitmap array<bigint>, prefix array<int>"


def _usable(samples: DataFrame) -> DataFrame:
    side = F.col("split").isin("val", "test")
    return samples.select("rec_no", side.alias("evaluation"), "instruction", "context").where("rec_no is not null and split in ('train', 'val', 'test') and instruction is not null and context is not null")


def _batches(batches):
    for batch in batches:
        rec, side, ins, con = (batch.column(i).to_pylist() for i in range(4))
        for lo, hi in blocks(len(rec)):
            yield rec[lo:hi], side[lo:hi], ins[lo:hi], con[lo:hi]


def count_bits(records: int) -> int:
    return min(MOST_COUNT_BITS, COUNT_BITS + max(0, math.ceil(math.log2(max(records, 1) / COUNTED_RECORDS) / 2)))


def shingle_counts(samples: DataFrame) -> np.ndarray:
    """Occurrences of instruction shingles over all records, by the low bits of their hash."""
    bits = count_bits(_usable(samples).count())
    mask = np.uint64((1 << bits) - 1)

    def run(batches):
        total = np.zeros(1 << bits, dtype=np.int64)
        for _, _, ins, _ in _batches(batches):
            h, _ = Normal(ins).shingles()
            total += np.bincount((h & mask).astype(np.int64), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])

    rows = _usable(samples).mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << bits, dtype=np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out


def _prefixes(samples: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    width = len(counts).bit_length() - 1
    ranks = samples.sparkSession.sparkContext.broadcast(np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.uint64))
    mask = np.uint64((1 << width) - 1)

    def run(batches):
        order = ranks.value
        for rec, side, ins, con in _batches(batches):
            a, b = Normal(ins), Normal(con)
            ok = np.flatnonzero((a.lengths >= MIN_INSTRUCTION) & (b.lengths >= MIN_LONG))
            if not len(ok):
                continue
            h, sizes = a.shingles()
            ends = np.cumsum(sizes)
            k1, k2, n, bitmaps, prefix = [], [], [], [], []
            for i in ok:
                own = np.unique(h[ends[i] - sizes[i] : ends[i]])
                keep = len(own) - math.ceil(threshold * len(own) - 1e-9) + COMMON
                rank = (order[(own & mask).astype(np.int64)] << np.uint64(64 - width)) | (own >> np.uint64(width))
                prefix.append(own[np.argsort(rank)[:keep]].astype(np.uint32).view(np.int32))
                bits = np.zeros(64 * BITMAP_WORDS, dtype=np.uint8)
                bits[(own >> np.uint64(40)) % np.uint64(64 * BITMAP_WORDS)] = 1
                bitmaps.append(np.packbits(bits, bitorder="little").view(np.int64))
                n.append(len(own))
                d = np.frombuffer(a.digest(i) + b.digest(i), dtype=np.uint64)
                k1.append(int((mix(d[:1]) + d[2])[0].astype(np.int64)))
                k2.append(int((mix(d[1:2]) + d[3])[0].astype(np.int64)))
            cut = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            words = np.arange(0, BITMAP_WORDS * len(ok) + 1, BITMAP_WORDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rec[i] for i in ok], pa.int64()),
                    pa.array([side[i] for i in ok], pa.bool_()),
                    pa.array(k1, pa.int64()),
                    pa.array(k2, pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(words), pa.array(np.concatenate(bitmaps))),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(prefix))),
                ],
                ["rec_no", "evaluation", "k1", "k2", "n", "bitmap", "prefix"],
            )

    return _usable(samples).mapInArrow(run, SIGNED)


def _met(chosen: DataFrame, threshold: float, part: int) -> DataFrame:
    """(a, b, need): a training and an evaluation record that may be similar, once for each shingle of the slice both prefixes have."""
    at = F.shiftleft(F.col("token").cast("bigint"), POSITION_BITS).bitwiseOR(F.least("pos", F.lit((1 << POSITION_BITS) - 1)).cast("bigint"))
    posts = chosen.select("rec_no", "evaluation", "n", *[F.col("bitmap")[i].alias(f"b{i}") for i in range(BITMAP_WORDS)], F.posexplode("prefix").alias("pos", "token"))
    posts = posts.where(F.pmod("token", F.lit(SLICES)) == part).select(F.col("rec_no").alias("rep"), "evaluation", "n", *[f"b{i}" for i in range(BITMAP_WORDS)], at.alias("at"))
    x, y = posts.where("not evaluation").drop("evaluation").alias("x"), posts.where("evaluation").drop("evaluation").alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    need = F.ceil((nx + ny) * (threshold / (1 + threshold)) - 1e-9)
    differ = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(BITMAP_WORDS)), F.lit(0))
    fits = (nx >= F.ceil(ny * threshold - 1e-9)) & (ny >= F.ceil(nx * threshold - 1e-9))
    token = lambda side: F.shiftright(f"{side}.at", POSITION_BITS)
    pos = lambda side: F.col(f"{side}.at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    place = F.least(nx - pos("x"), ny - pos("y")) + (COMMON - 1) >= need
    met = x.join(y, (token("x") == token("y")) & fits & place & ((nx + ny - differ) >= 2 * need))
    return met.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), need.alias("need"))


def overlap_links(samples: DataFrame, threshold: float = 0.6, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (train, other, sim_instruction, sim_context) between representatives of a training and an evaluation text,
    members (rec_no, evaluation, rep) with every comparable record of a named split under the smallest rec_no of its side with its texts.

    Rows whose split, instruction, context or rec_no is null, and texts with too few letters and digits, are like none and in neither
    table. Repeated rows are joined once, through their representative. Other columns are ignored. Empty tables give empty tables.
    """
    scratch = scratch or Scratch(samples.sparkSession, "split-overlap")
    signed = scratch.write(_prefixes(samples, shingle_counts(samples), threshold), "prefixes")
    members = scratch.write(with_representatives(signed, ["evaluation", "k1", "k2"], ["evaluation"]), "members", release=True)
    chosen = signed.select("rec_no", "evaluation", "n", "bitmap", "prefix").join(members.where("rec_no = rep").select("rec_no").distinct(), "rec_no", "left_semi")
    chosen = scratch.write(chosen.dropDuplicates(["rec_no"]), "chosen", release=True)
    scratch.drop(signed)
    met = [scratch.write(_met(chosen, threshold, part), "met", release=True) for part in range(SLICES)]
    scratch.drop(chosen)
    # times >= least(COMMON, need), as one sum
    whole = math.lcm(*range(1, COMMON + 1))
    weight = F.expr(" ".join(["case", *[f"when need <= {k} then {whole // k}" for k in range(1, COMMON)], f"else {whole // COMMON} end"]))
    times = reduce(DataFrame.unionByName, met).groupBy("a", "b").agg(F.sum(weight).alias("times"))
    candidates = scratch.write(times.where(F.col("times") >= whole).select("a", "b"), "candidates", release=True)
    for part in met:
        scratch.drop(part)
    links = verify(candidates, samples, "rec_no", "instruction", "context", threshold)
    links = scratch.write(links.select(F.col("a").alias("train"), F.col("b").alias("other"), F.col("sim_first").alias("sim_instruction"), F.col("sim_second").alias("sim_context")), "links", release=True)
    scratch.drop(candidates)
    return links, members


def overlap_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: every pair of rows, one of the training split, behind the links."""
    train = members.where("not evaluation").select(F.col("rep").alias("train"), F.col("rec_no").alias("rt"))
    other = members.where("evaluation").select(F.col("rep").alias("other"), F.col("rec_no").alias("ro"))
    return links.select("train", "other").join(train, "train").join(other, "other").select(F.least("rt", "ro").alias("rec_a"), F.greatest("rt", "ro").alias("rec_b"))


def overlapping_records(samples: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(rec_no, split, source, representative, links, exact): one row for each record that overlaps with the other side.

    links is the number of different texts of the other side it overlaps with, exact whether one of them has its very letters and digits.
    """
    scratch = Scratch(samples.sparkSession, "split-overlap")
    links, members = overlap_links(samples, threshold, scratch)
    ends = links.select(F.explode(F.array(F.struct(F.col("train").alias("rep"), F.lit(False).alias("evaluation"), "sim_instruction", "sim_context"), F.struct(F.col("other").alias("rep"), F.lit(True).alias("evaluation"), "sim_instruction", "sim_context"))).alias("e")).select("e.*")
    count = ends.groupBy("rep", "evaluation").agg(F.count(F.lit(1)).cast("bigint").alias("links"), F.max(F.expr("sim_instruction = 1 and sim_context = 1")).alias("exact"))
    about = samples.select("rec_no", "split", F.col("quality.coverage.source").alias("source"))
    return members.join(count, ["rep", "evaluation"]).join(about, "rec_no").select("rec_no", "split", "source", F.col("rep").alias("representative"), "links", "exact")


def overlap_report(samples: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(split, source, records, overlapping, exact): for every split and quality.coverage.source, null source included, the number of
    records in all and of those that overlap with the other side."""
    found = overlapping_records(samples, threshold).select(F.col("rec_no").alias("_r"), "exact")
    every = samples.where("split in ('train', 'val', 'test')").select("rec_no", "split", F.col("quality.coverage.source").alias("source"))
    joined = every.join(found, F.col("rec_no") == F.col("_r"), "left")
    return joined.groupBy("split", "source").agg(F.count(F.lit(1)).alias("records"), F.count("_r").alias("overlapping"), F.count(F.when(F.col("exact"), 1)).alias("exact"))
