"""Mixing sources to target weights (problem 8).

The mix is as large as the scarcest source allows with its capped repeats. It is cut into equal-token
blocks, which Sainte-Laguë apportionment gives to the sources by highest quotients, and within each source to
the shards in the same way: integer quotas. In each (source, shard) the documents are laid end to end and cut into
blocks of that size (a document belongs to the block of its middle); the blocks are drawn in seeded order until the
quota is full, the last of them as far as needed. A quota above what is there uses everything so many times, then draws
for the rest.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardloom.llm.corpus_tokens import VOCABULARIES, token_counts
from boardloom.plans.work import durable, join_small, spread

#: Tokens a shard should hold, and blocks per shard. Beyond MAX_SHARDS shards grow instead: their sums, a row for each source and
#: shard, are all that reaches the driver, and a shard's few numbers per document are sorted externally.
SHARD_TOKENS, MAX_SHARDS, BLOCKS = 2_000_000, 65_536, 1_000
#: A share is met if it is so near to its target.
TOLERANCE = 0.01
SEED = 29


def apportion(weights: dict, seats: int, caps: dict | None = None) -> dict:
    """Sainte-Laguë: seats go one by one to the highest quotient weight / (2 k + 1), up to each cap.

    Ties go to the smaller key. Whole steps are given in bulk first: nobody gets less than the floor of the
    exact share minus one by this method, so only the rest runs through the heap.
    """
    caps = caps or {}
    live = {k: Fraction(w) for k, w in weights.items() if w > 0}
    total = sum(live.values())
    given = {k: 0 for k in weights}
    if not total:
        return given
    for k, w in live.items():
        given[k] = max(0, min(int(w / total * seats) - 1, caps.get(k, seats)))
    heap = [(-w / (2 * given[k] + 1), k) for k, w in live.items() if given[k] < caps.get(k, seats)]
    heapq.heapify(heap)
    left = seats - sum(given.values())
    while left > 0 and heap:
        _, k = heapq.heappop(heap)
        given[k] += 1
        left -= 1
        if given[k] < caps.get(k, seats):
            heapq.heappush(heap, (-live[k] / (2 * given[k] + 1), k))
    return given


@dataclass
class Plan:
    """Block size in tokens and the quota of blocks of every (source, shard)."""

    block: int
    shards: int
    quota: dict[tuple[str, int], int]


def plan(tokens: dict[tuple[str, int], int], targets: dict[str, tuple[float, int]], shards: int) -> Plan:
    """Quotas from the tokens there are per (source, shard) and the targets (share, most repeats) per source."""
    there = {s: sum(n for (x, _), n in tokens.items() if x == s) for s in targets}
    fed = {s: t for s, t in targets.items() if there[s] > 0 and t[0] > 0 and t[1] > 0}
    if not fed:
        return Plan(1, shards, {})
    weight = sum(t[0] for t in fed.values())
    size = min(there[s] * reps * weight / share for s, (share, reps) in fed.items())
    blocks = max(1, min(shards * BLOCKS, int(size)))
    block = max(1, int(size / blocks))
    seats = apportion({s: share for s, (share, _) in fed.items()}, blocks, {s: there[s] * reps // block for s, (_, reps) in fed.items()})
    quota = {}
    for s, n in seats.items():
        own = {h: x for (src, h), x in tokens.items() if src == s and x > 0}
        for h, q in apportion(own, n, {h: x * fed[s][1] // block for h, x in own.items()}).items():
            quota[s, h] = q
    return Plan(block, shards, quota)


def sized(documents: DataFrame, targets: DataFrame, name: str, folder: str) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents of the targets' sources that have tokens."""
    wanted = targets.select("source").where("source IS NOT NULL").distinct()
    source = join_small(documents.select("doc_id", "source", "text"), wanted, "source")
    return token_counts(spread(source), ["doc_id", "source"], F.col("text"), name, folder).where("n_tokens > 0")


def mix(documents: DataFrame, targets: DataFrame, name: str = "byte_bpe_50k", folder: str = VOCABULARIES, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, uses): the documents of the mix and how often each is used.

    Defined cases: documents without text or of other sources take no part; a source without tokens is left
    out and the others keep their proportions; repeated texts are documents of their own; an empty table or no
    target gives no rows. The share of a source is off by less than one block and one document a shard.
    """
    counted = durable(sized(documents, targets, name, folder))
    total = counted.agg(F.sum("n_tokens")).head()[0] or 0
    shards = max(1, min(MAX_SHARDS, int(total) // SHARD_TOKENS))
    dealt = counted.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(shards)).cast("int"))
    sums = {(r["source"], r["shard"]): r["n"] for r in dealt.groupBy("source", "shard").agg(F.sum("n_tokens").alias("n")).collect()}
    wanted = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in targets.where("source IS NOT NULL").collect()}
    made = plan(sums, wanted, shards)
    rows = [(f"{s}\u0001{h}", q * made.block // sums[s, h], q * made.block % sums[s, h]) for (s, h), q in made.quota.items() if q > 0]
    kind = T.StructType([T.StructField("k", T.StringType()), T.StructField("rounds", T.LongType()), T.StructField("rest", T.LongType())])
    quotas = documents.sparkSession.createDataFrame(rows, kind)
    keyed = join_small(dealt.withColumn("k", F.concat_ws("\u0001", "source", "shard")), quotas, "k")
    shard = Window.partitionBy("source", "shard")
    line = F.sum("n_tokens").over(shard.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0))
    keyed = keyed.withColumn("block", F.floor((line - F.col("n_tokens") / 2) / made.block))
    drawn = shard.orderBy(F.xxhash64(F.lit(seed + 1), "source", "shard", "block"), "block", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(drawn), F.lit(0))
    # a document belongs to the rest if the greater part of it does
    used = keyed.withColumn("uses", F.col("rounds") + (before * 2 + F.col("n_tokens") <= F.col("rest") * 2).cast("long"))
    return used.where("uses > 0").select("doc_id", "source", "n_tokens", "uses")


def mix_report(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, documents, most_uses, tokens, share): what the mix really holds of each source."""
    used = mix(documents, targets).groupBy("source").agg(F.count("*").alias("documents"), F.max("uses").alias("most_uses"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"))
    every = Window.partitionBy(F.lit(1))
    full = targets.where("source IS NOT NULL").select("source", "target_share").join(used, "source", "left").fillna(0, ["documents", "most_uses", "tokens"])
    return full.withColumn("share", F.coalesce(F.try_divide("tokens", F.sum("tokens").over(every)), F.lit(0.0)))


def targets_met(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, met, kept): whether each share is within TOLERANCE, or one document, of its target, and no document used too often."""
    used = mix(documents, targets).groupBy("source").agg(F.max("uses").alias("most"), F.max("n_tokens").alias("longest"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"))
    told = targets.where("source IS NOT NULL").join(used, "source", "left").fillna(0, ["most", "longest", "tokens"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    met = F.abs(F.col("tokens") - F.col("target_share") * total) <= F.greatest(TOLERANCE * total, F.col("longest") * F.col("max_repeats"))
    return told.select("source", "target_share", "max_repeats", met.alias("met"), (F.col("most") <= F.col("max_repeats")).alias("kept"))
