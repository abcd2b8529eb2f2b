"""Mixing sources to target weights, by subset-sum budget fitting.

Documents are counted by source and exact token length; only these counts reach the driver (lengths from LONG on are counted in 64 classes
an octave, so the table is bounded whatever the corpus). A source's budget is met by whole repeats, then by a part of one more repeat: the
same part of every length first (of the long classes together, rounded once), then single documents from the longest down, and for the last
tokens a bounded knapsack over the lengths that still have documents. Which documents of a length are taken is decided by a seeded order.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.quota_sample import spelled
from sievework.llm.tokens import VOCABULARY, encode
from sievework.operators.ranking import hashed_rank
from sievework.plans.scratch import Scratch

LONG = 1 << 14
KNAPSACK = 20_000


def length_class(n: Column) -> Column:
    """The length itself below LONG, else minus the number of its class (64 an octave)."""
    return F.when(n < LONG, n).otherwise(-F.floor(F.log2(n.cast("double")) * 64)).cast("bigint")


def budgets(total: int, sources: list[tuple[str, float, int, int]]) -> dict[str, int]:
    """Tokens for each source (name, target share, size, max repeats): shares of ``total``; what a source lacks goes to the others in
    proportion to their shares, as far as their repeats allow."""
    room = {s: size * most for s, _, size, most in sources}
    share = {s: t for s, t, _, _ in sources if t > 0 and room[s]}
    out = {s: 0 for s, *_ in sources}
    left = total
    while share and left > 0:
        weight = sum(share.values())
        full = [s for s in share if left * share[s] / weight >= room[s]]
        if not full:
            exact = {s: left * share[s] / weight for s in share}
            for s in share:
                out[s] = int(exact[s])
            for s in sorted(share, key=lambda s: (int(exact[s]) - exact[s], s))[: left - sum(int(x) for x in exact.values())]:
                out[s] += out[s] < room[s]
            break
        for s in full:
            out[s] = room[s]
            left -= room[s]
            del share[s]
    return out


def knapsack(target: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length to take so that their sum is as near below ``target`` as possible; counts bound the numbers."""
    parts, reach, kept = [], 1, [1]
    mask = (1 << (target + 1)) - 1
    for length in sorted(counts):
        if length > target or reach >> target & 1:
            break
        n, size = min(counts[length], target // length), 1
        while n > 0:
            take = min(size, n)
            parts.append((length, take))
            reach |= (reach << (length * take)) & mask
            kept.append(reach)
            n, size = n - take, size * 2
    at, out = reach.bit_length() - 1, defaultdict(int)
    for i in range(len(parts) - 1, -1, -1):
        if not kept[i] >> at & 1:
            length, take = parts[i]
            out[length] += take
            at -= length * take
    return dict(out)


def fit(target: int, counts: dict[int, int]) -> dict[int, int]:
    """Documents of each length whose sum is near below ``target``, spread over all lengths; counts bound the numbers."""
    size = sum(n * c for n, c in counts.items())
    if target >= size:
        return dict(counts)
    share = target / size if size else 0.0
    out = {n: int(c * share) for n, c in counts.items()}
    rest = target - sum(n * k for n, k in out.items())
    while rest > KNAPSACK:
        before = rest
        for n in sorted(counts, reverse=True):
            if rest <= KNAPSACK:
                break
            if out[n] < counts[n] and n <= rest:
                out[n] += 1
                rest -= n
        if rest == before:
            break
    for n, k in knapsack(min(rest, KNAPSACK), {n: c - out[n] for n, c in counts.items() if c > out[n]}).items():
        out[n] += k
    return out


def fit_long(target: int, share: float, classes: dict[int, tuple[int, int]]) -> dict[int, int]:
    """How many of each class (documents, greatest length) to take: ``share`` of all, from the longest down. What a class is due beyond
    whole documents goes on to the next one, so small classes lose none; even with their greatest lengths all stay within ``target``."""
    out, due, left = {}, 0.5, target
    for c, (n, most) in sorted(classes.items(), key=lambda x: -x[1][1]):
        due += n * share
        out[c] = min(n, int(due), left // most)
        due -= out[c]
        left -= out[c] * most
    return out


@dataclass
class MixPlan:
    """whole: repeats of every document of a source; more: by (source, length class), documents that get one repeat more."""

    total: int = 0
    whole: dict[str, int] = field(default_factory=dict)
    more: dict[tuple[str, int], int] = field(default_factory=dict)


def sized(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, length), the source in its plain spelling; rows without tokens (null, empty) have n_tokens 0."""
    ids = encode(documents.where("doc_id is not null"), vocabulary=vocabulary).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"))
    sources = documents.select("doc_id", spelled(F.col("source")).alias("source"))
    return sources.join(ids, "doc_id").withColumn("length", length_class(F.col("n_tokens")))


def plan_mixture(sizes: DataFrame, targets: DataFrame, seed: int) -> MixPlan:
    rows = {spelled_: (share, most) for spelled_, share, most in targets.select(spelled(F.col("source")), "target_share", "max_repeats").collect()}
    counted = sizes.groupBy("source", "length").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("most")).collect()
    plan = MixPlan(total=sum(r.tokens for r in counted))
    size, short, long = defaultdict(int), defaultdict(dict), defaultdict(dict)
    for r in counted:
        if r.source in rows and r.tokens:
            size[r.source] += r.tokens
            if r.length > 0:
                short[r.source][r.length] = r.n
            else:
                long[r.source][r.length] = r.n, r.most
    budget = budgets(plan.total, [(s, share, size[s], most) for s, (share, most) in sorted(rows.items())])
    part = {}
    for s in rows:
        if size[s]:
            plan.whole[s] = min(budget[s] // size[s], rows[s][1])
            part[s] = budget[s] - plan.whole[s] * size[s] if plan.whole[s] < rows[s][1] else 0
    for s in part:
        for c, k in fit_long(part[s], part[s] / size[s], long[s]).items():
            plan.more[s, c] = k
    rest, grown = dict(part), True
    while grown:
        if any(plan.more.values()):  # the exact size of the long documents taken
            taken = _ranked(sizes.where("length < 0"), plan, seed).where("rank <= k").groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()
            rest = part | {r.source: part[r.source] - r.tokens for r in taken}
        grown = False
        for s in part:  # long documents more, where all short ones would not fill the rest
            room, small = rest[s], sum(n * k for n, k in short[s].items())
            for c, (n, most) in sorted(long[s].items(), key=lambda x: -x[1][1]):
                while plan.more[s, c] < n and most <= room and room > small:
                    plan.more[s, c] += 1
                    room -= most
                    grown = True
    for s in part:
        for n, k in fit(rest[s], short[s]).items():
            plan.more[s, n] = k
    return plan


def _ranked(sizes: DataFrame, plan: MixPlan, seed: int) -> DataFrame:
    spark = sizes.sparkSession
    more = spark.createDataFrame([(s, c, k) for (s, c), k in plan.more.items()], "source string, length bigint, k bigint")
    return hashed_rank(sizes.join(F.broadcast(more), ["source", "length"]), ["source", "length"], ["doc_id"], seed, slices=16)


def mixture(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, seed: int = 9) -> tuple[DataFrame, DataFrame]:
    """(mix, shares): mix (doc_id, source, n_tokens, copies) with every document taken at least once, shares (source, target_share,
    actual_share, tokens, available_tokens, max_repeats, repeats, capped) with one row for each row of ``targets``.

    The mixture is to be as large as the corpus, in tokens; documents of a null or unknown source count for that size but are in no share.
    Texts without tokens are never taken. copies never exceed max_repeats; where all repeats of a source are used up (capped), the others
    fill its place in proportion. An empty corpus gives no rows and shares of null.
    """
    scratch = Scratch(documents.sparkSession, "mixture")
    sizes = scratch.write(sized(documents, vocabulary), "sizes")
    plan = plan_mixture(sizes, targets, seed)
    spark = documents.sparkSession
    whole = spark.createDataFrame([(s, k) for s, k in plan.whole.items()], "source string, whole bigint")
    ranked = _ranked(sizes.where("n_tokens > 0"), plan, seed)
    copies = F.col("whole") + (F.col("rank") <= F.col("k")).cast("bigint")
    mix = ranked.join(F.broadcast(whole), "source").select("doc_id", "source", "n_tokens", copies.alias("copies")).where("copies > 0")
    mix = scratch.write(mix, "mixture")
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    used = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("repeats"), F.min("copies").alias("least"))
    goal = targets.select(spelled(F.col("source")).alias("source"), "target_share", F.col("max_repeats").cast("bigint").alias("max_repeats"))
    total = mix.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0]
    shares = goal.join(have, "source", "left").join(used, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    shares = shares.select("source", "target_share", (zero("tokens") / F.lit(total).cast("bigint")).alias("actual_share"), zero("tokens").alias("tokens"), zero("available_tokens").alias("available_tokens"), "max_repeats", zero("repeats").alias("repeats"), (zero("tokens") >= zero("available_tokens") * F.col("max_repeats")).alias("capped"))
    return mix, shares
