"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

A source's share p of all tokens (words) becomes the weight p**a / sum(p**a). The exponent a in [0, 1] is bisected:
the largest that reaches a target entropy (as a share of that of equal weights), but no smaller than the one at which
the most repeated source meets the repetition limit. Weights times the budget give each source's tokens. Its documents
fall into BLOCKS blocks by a keyed hash; each epoch is a keyed permutation of the blocks, taken from the front until
the source's tokens are used up; of the last block parts in a keyed order, of the last part document by document. Without a given budget it is the least that
keeps every document: the source that gains least is taken exactly once.

Only counts by source and block move, whatever a source's size: hot sources are summed before the shuffle, and
documents meet the plan (sources x BLOCKS x epochs rows, broadcast after its size is checked) where they are.

Defined results: a null source is a source of its own; a text without words counts as one token; repeated rows fall
into one block and are each taken; an empty table gives an empty result; other columns are ignored by plan() and kept
by realise().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import settled

BLOCKS = 1024
#: Bits of a keyed order that tell the parts of a source's last block.
PART_BITS = 10
#: Rows of a plan that are broadcast at most; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bisection steps that one pass over the sources makes, and passes.
STEPS, PASSES = 4, 9


def marked(docs: DataFrame, seed: str) -> DataFrame:
    """docs and, as struct _mix, the source's key, the block and the keyed order of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), text)
    return docs.withColumn("_mix", F.struct(key.alias("key"), F.pmod(order, F.lit(BLOCKS)).cast("int").alias("block"), order.alias("order")))


def tokens() -> Column:
    """The words of a row, one at least."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def at_exponents(sizes: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: entropy of the weights, largest and smallest quotient of weight and share."""
    rows = sizes.select("p", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    x = F.pow("p", F.col("a"))
    got = rows.groupBy("a").agg(F.sum(x).alias("z"), F.sum(x * F.log("p")).alias("l"), F.max(x / F.col("p")).alias("hi"), F.min(x / F.col("p")).alias("lo")).collect()
    by = {r.a: (math.log(r.z) - r.a * r.l / r.z, r.hi / r.z, r.lo / r.z) for r in got}
    return [by[a] for a in exponents]


def bisect(sizes: DataFrame, holds, low: float = 0.0, high: float = 1.0) -> float:
    """The bound in [low, high] below which holds(values at an exponent) is true; it is true up to there, false after.

    STEPS halvings are decided in one pass: all their points are computed together.
    """
    if holds(*at_exponents(sizes, [high])[0]):
        return high
    for _ in range(PASSES):
        n = 1 << STEPS
        points = [low + (high - low) * k / n for k in range(1, n)]
        ok = [holds(*v) for v in at_exponents(sizes, points)]
        k = next((i for i, x in enumerate(ok) if not x), len(ok))
        low, high = ([low, *points][k], [*points, high][k])
    return low


def exponent(sizes: DataFrame, n_sources: int, entropy: float, repetition: float, scale: float | None) -> float:
    """The mixing exponent. scale: budget / all tokens, None for the least budget that keeps every document."""
    if n_sources < 2:
        return 1.0
    for_entropy = bisect(sizes, lambda h, hi, lo: h >= entropy * math.log(n_sources))
    repeated = lambda hi, lo: hi / lo if scale is None else hi * scale
    for_limit = bisect(sizes, lambda h, hi, lo: repeated(hi, lo) > repetition)
    return max(for_entropy, for_limit)


def weights(blocks: DataFrame, entropy: float, repetition: float, budget: int | None) -> DataFrame:
    """key, tokens, weight and target (tokens to take) of each source."""
    by_key = settled(blocks.groupBy("key").agg(F.sum("tokens").alias("tokens")))
    total, n = by_key.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n:
        return by_key.select("key", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("target"))
    sizes = by_key.select("key", "tokens", (F.col("tokens") / F.lit(float(total))).alias("p"))
    a = exponent(sizes, n, entropy, repetition, None if budget is None else budget / total)
    z = sizes.agg(F.sum(F.pow("p", F.lit(a))).alias("z")).first().z
    weight = F.pow("p", F.lit(a)) / F.lit(z)
    if budget is None:
        budget = total / sizes.agg(F.min(weight / F.col("p")).alias("m")).first().m
    return sizes.select("key", "tokens", weight.alias("weight"), F.round(weight * F.lit(float(budget))).cast("long").alias("target"))


def plan(docs: DataFrame, entropy: float = 0.95, repetition: float = 4.0, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """What to take: key, block, epoch, position of the block in its epoch, take (tokens) and whole (all of the block)."""
    blocks = settled(marked(docs, seed).groupBy("_mix.key", "_mix.block").agg(F.sum(tokens()).alias("tokens")))
    sources = weights(blocks, entropy, repetition, budget).withColumnRenamed("tokens", "size")
    epochs = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("target") / F.col("size")).cast("long") - 1, F.lit(0).cast("long")))
    each = blocks.join(sources, "key").select("key", "block", "tokens", "size", "target", "weight", F.explode(epochs).alias("epoch"))
    order = Window.partitionBy("key", "epoch").orderBy(F.sha2(F.concat_ws(":", F.lit(seed), "key", "epoch", "block"), 256), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.col("target") - F.col("epoch") * F.col("size") - before
    each = each.withColumn("position", F.row_number().over(order).cast("long") - 1).withColumn("take", F.least("tokens", left)).filter("take > 0")
    return settled(each.select("key", "block", "epoch", "position", "take", (F.col("take") == F.col("tokens")).alias("whole"), "weight"))


def realise(docs: DataFrame, planned: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of docs as often as planned, with struct _mix that also has epoch, position and weight."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = ("key", "block", "epoch", "position", "weight")

    def met(p: DataFrame, *more: str) -> DataFrame:
        """docs with the rows of p of their block; tokens are counted for those alone."""
        p = (F.broadcast(p) if p.count() <= BROADCAST_ROWS else p).alias("p")
        rows = marked(docs, seed).join(p, (F.col("_mix.key") == F.col("p.key")) & (F.col("_mix.block") == F.col("p.block")))
        extra = [F.col("_mix.order").alias("order"), tokens().alias("tokens"), *(F.col(f"p.{c}").alias(c) for c in (*kept, *more))]
        return rows.select(*names, F.struct(*extra).alias("_mix"))

    whole = met(planned.filter("whole"))
    cut = planned.filter("not whole")
    # the last block of each source in a keyed order: sums of its parts tell which to take, rows those of the last part
    hashed = F.xxhash64("_mix.order", "_mix.epoch")
    part = F.shiftright(hashed, 64 - PART_BITS).cast("int")
    sums = met(cut, "take").groupBy("_mix.key", "_mix.block", "_mix.epoch", "_mix.take", part.alias("part")).agg(F.sum("_mix.tokens").alias("tokens"))
    by_part = Window.partitionBy("key", "block", "epoch").orderBy("part")
    before = F.coalesce(F.sum("tokens").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = settled(sums.withColumn("before", before).filter("before < take").select("key", "block", "epoch", "part", "before", (F.col("before") + F.col("tokens") <= F.col("take")).alias("all")))
    p = (F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts).alias("q")
    same = [F.col(f"_mix.{c}") == F.col(f"q.{c}") for c in ("key", "block", "epoch")] + [part == F.col("q.part")]
    taken = met(cut, "take").join(p, same)
    plain = F.struct(*(F.col(f"_mix.{c}").alias(c) for c in ("order", "tokens", *kept))).alias("_mix")
    order = Window.partitionBy("_mix.key", "_mix.epoch", "_mix.block").orderBy(hashed, "_mix.order", "doc_id")
    inside = F.col("q.before") + F.coalesce(F.sum("_mix.tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = taken.filter(~F.col("q.all")).withColumn("_inside", inside).filter("_inside < _mix.take").select(*names, plain)
    return whole.select(*names, plain).unionByName(taken.filter("q.all").select(*names, plain)).unionByName(last)


def mix(docs: DataFrame, entropy: float = 0.95, repetition: float = 4.0, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """doc_id, source, epoch, block, position, n_tokens and weight of every document taken."""
    rows = docs.select("doc_id", "text", "source")
    got = realise(rows, plan(rows, entropy, repetition, budget, seed), seed)
    col = lambda c: F.col(f"_mix.{c}").alias(c)
    return got.select("doc_id", "source", col("epoch"), col("block"), col("position"), F.col("_mix.tokens").alias("n_tokens"), col("weight"))
