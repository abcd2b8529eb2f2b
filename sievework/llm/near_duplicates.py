"""Near-duplicate records with small edits, by b-bit MinHash.

The shingles of instruction and answer, tagged by field, form one set. If both fields have a similarity of at least t, so has the union,
so one signature serves both. All minima make band keys; of each minimum only the lowest ``bits`` bits are kept, packed in bit planes.
Records that share a band key are compared by bit counts: the share of equal low bits, corrected for chance collisions (1 / 2^bits),
estimates the similarity, and only pairs within four standard errors of the threshold reach the exact check on the texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.pairs import verify, with_representatives
from sievework.llm.shingles import MIN_INSTRUCTION, MIN_LONG, Normal, blocks, mix
from sievework.operators.components import connected_components
from sievework.plans.scratch import Scratch


@dataclass(frozen=True)
class MinHashPlan:
    """threshold: similarity of each field. bands x rows minima; a pair at the threshold meets in a band with 1 - (1 - t^rows)^bands (0.9987)."""

    threshold: float = 0.6
    bands: int = 48
    rows: int = 4
    bits: int = 1
    seed: int = 20240229

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def words(self) -> int:
        return self.hashes // 64

    @property
    def least_equal(self) -> int:
        """Equal low bits that a pair needs: the expectation at the threshold less four standard errors."""
        chance = 2.0**-self.bits
        p = chance + (1 - chance) * self.threshold
        return math.floor(self.hashes * p - 4 * math.sqrt(self.hashes * p * (1 - p)))


def _signer(plan: MinHashPlan):
    rng = np.random.default_rng(plan.seed)
    mul = rng.integers(0, 2**32, plan.hashes, dtype=np.uint32) | np.uint32(1)
    add = rng.integers(0, 2**32, plan.hashes, dtype=np.uint32)
    salt = mix(np.arange(plan.bands, dtype=np.uint64) + np.uint64(plan.seed))

    def minima(first, second) -> np.ndarray:
        """hashes x records"""
        (ha, na), (hb, nb) = first.shingles(1 << 40), second.shingles(3 << 40)
        n = na + nb
        start = np.cumsum(n) - n
        x = np.empty(int(n.sum()), dtype=np.uint32)
        x[np.arange(len(ha)) + np.repeat(start - (np.cumsum(na) - na), na)] = (ha >> np.uint64(32)).astype(np.uint32)
        x[np.arange(len(hb)) + np.repeat(start + na - (np.cumsum(nb) - nb), nb)] = (hb >> np.uint64(32)).astype(np.uint32)
        out = np.empty((plan.hashes, len(n)), dtype=np.uint32)
        h = np.empty_like(x)
        for k in range(plan.hashes):
            np.multiply(x, mul[k], out=h)
            np.add(h, add[k], out=h)
            np.minimum.reduceat(h, start, out=out[k])
        return out

    def sign(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys (records x bands) and bit planes (records x bits * words) as int64."""
        wide = m.reshape(plan.bands, plan.rows, -1).astype(np.uint64)
        key = np.zeros((plan.bands, m.shape[1]), dtype=np.uint64)
        for r in range(plan.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, r] + salt[:, None])
        low = m ^ (m >> np.uint32(15))
        low = low * np.uint32(0x2C1B3C6D)
        low ^= low >> np.uint32(12)
        planes = []
        for b in range(plan.bits):
            bit = ((low >> np.uint32(b)) & np.uint32(1)).astype(np.uint8)
            planes.append(np.packbits(bit, axis=0, bitorder="little").T.copy().view(np.int64))
        return key.T.astype(np.int64), np.concatenate(planes, axis=1)

    return minima, sign


SIGNED = "rec_no bigint, k1 bigint, k2 bigint, bands array<bigint>, sig array<bigint>"


def signatures(samples: DataFrame, plan: MinHashPlan) -> DataFrame:
    """One row for each record with at least 20 letters and digits in its instruction and 60 in its answer; the others are like none."""

    def run(batches):
        minima, sign = _signer(plan)
        for batch in batches:
            recs, ins, ans = (batch.column(i).to_pylist() for i in range(3))
            for lo, hi in blocks(len(recs)):
                a, b = Normal(ins[lo:hi]), Normal(ans[lo:hi])
                ok = np.flatnonzero((a.lengths >= MIN_INSTRUCTION) & (b.lengths >= MIN_LONG))
                if not len(ok):
                    continue
                if len(ok) < hi - lo:
                    a, b = Normal([ins[lo + i] for i in ok]), Normal([ans[lo + i] for i in ok])
                keys, sig = sign(minima(a, b))
                # both digests, keyed by their order: equal texts in both fields
                d = np.frombuffer(b"".join(a.digest(i) + b.digest(i) for i in range(len(ok))), dtype=np.uint64).reshape(-1, 4)
                k1, k2 = mix(d[:, 0]) + d[:, 2], mix(d[:, 1]) + d[:, 3]
                flat = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(x).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([recs[lo + i] for i in ok], pa.int64()), pa.array(k1.astype(np.int64)), pa.array(k2.astype(np.int64)), flat(keys), flat(sig)], ["rec_no", "k1", "k2", "bands", "sig"])

    return samples.select("rec_no", "instruction", "answer").where("rec_no is not null and instruction is not null and answer is not null").mapInArrow(run, SIGNED)


def near_duplicate_links(samples: DataFrame, plan: MinHashPlan = MinHashPlan(), scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (a, b, sim_instruction, sim_answer) between representatives of different texts, a < b, and members
    (rec_no, rep) with every comparable record under the smallest rec_no of the records with its very texts.

    Null, empty and short texts are like none and in neither table; so are rows without a rec_no. Repeated rows become members of one
    representative before anything is compared, so a text with a third of all rows costs no more than another. Other columns are ignored.
    """
    scratch = scratch or Scratch(samples.sparkSession, "near-duplicates")
    signed = scratch.write(signatures(samples, plan), "signatures")
    members = scratch.write(with_representatives(signed, ["k1", "k2"], []), "members")
    chosen = signed.join(members.where("rec_no = rep").select(F.col("rec_no")).distinct(), "rec_no", "left_semi")
    words = [F.col("sig")[i].alias(f"s{i}") for i in range(plan.words * plan.bits)]
    posts = chosen.dropDuplicates(["rec_no"]).select(F.col("rec_no").alias("rep"), *words, F.explode("bands").alias("band"))
    x, y = posts.alias("x"), posts.alias("y")
    equal = None
    for w in range(plan.words):
        differ = None
        for b in range(plan.bits):
            i = b * plan.words + w
            d = F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))
            differ = d if differ is None else differ.bitwiseOR(d)
        same = F.lit(64) - F.bit_count(differ)
        equal = same if equal is None else equal + same
    met = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.rep") < F.col("y.rep")) & (equal >= plan.least_equal))
    candidates = scratch.write(met.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct(), "candidates")
    links = verify(candidates, samples, "rec_no", "instruction", "answer", plan.threshold)
    links = scratch.write(links.select("a", "b", F.col("sim_first").alias("sim_instruction"), F.col("sim_second").alias("sim_answer")), "links")
    return links, members


def all_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: every pair of rows behind the links, and the pairs of copies."""
    m, o = members.alias("m"), members.alias("o")
    copies = m.join(o, (F.col("m.rep") == F.col("o.rep")) & (F.col("m.rec_no") < F.col("o.rec_no"))).select(F.col("m.rec_no").alias("rec_a"), F.col("o.rec_no").alias("rec_b"))
    across = links.select("a", "b").join(members.select(F.col("rep").alias("a"), F.col("rec_no").alias("ra")), "a").join(members.select(F.col("rep").alias("b"), F.col("rec_no").alias("rb")), "b")
    return copies.unionByName(across.select(F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b")))


def near_duplicate_groups(samples: DataFrame, plan: MinHashPlan = MinHashPlan()) -> DataFrame:
    """(rec_no, group_no, representative, links): one row for each row of ``samples`` with a rec_no.

    group_no is the smallest rec_no that can be reached over links, representative the smallest with the same texts, links the number of
    other texts it is linked with. Records that are like none (null, empty or short texts) form a group of their own.
    """
    scratch = Scratch(samples.sparkSession, "near-duplicates")
    links, members = near_duplicate_links(samples, plan, scratch)
    groups = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    known = members.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").join(degree, "rep", "left")
    known = known.select("rec_no", F.coalesce("component", "rep").alias("group_no"), F.col("rep").alias("representative"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
    rest = samples.select("rec_no").where("rec_no is not null").join(known.select("rec_no"), "rec_no", "left_anti")
    return known.unionByName(rest.select("rec_no", F.col("rec_no").alias("group_no"), F.col("rec_no").alias("representative"), F.lit(0).cast("bigint").alias("links")))
