"""Leak-free stratified splits: apportionment of duplicate groups, deterministic shuffles, round-robin samples."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")
RATIOS = (0.70, 0.15, 0.15)


def checked_ratios(ratios) -> tuple[float, ...]:
    """Three positive finite ratios that sum to 1."""
    ratios = tuple(float(r) for r in ratios)
    if len(ratios) != len(SPLITS) or not all(math.isfinite(r) and r > 0 for r in ratios) or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError(f"bad_ratios: {ratios}")
    return ratios


def quotas(strata: DataFrame, ratios=RATIOS, total: str = "n") -> DataFrame:
    """For each row of strata (one a stratum, total its groups): split_index, split and quota.

    Floors first, then the largest remainders get one more (the earlier split of equals). Splits that are still empty
    get one each from the largest split: with z empty splits, the first largest gives z.
    """
    ratios = checked_ratios(ratios)
    keys = [c for c in strata.columns if c != total]
    split = F.posexplode(F.array(*map(F.lit, ratios))).alias("split_index", "ratio")
    exact = F.col(total).cast("double") * F.col("ratio")
    rows = strata.select(*keys, total, split).withColumn("low", F.floor(exact).cast("long")).withColumn("rest", exact - F.floor(exact))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    by_rest = whole.orderBy(F.desc("rest"), "split_index")
    rows = rows.withColumn("spare", F.col(total) - F.sum("low").over(whole))
    rows = rows.withColumn("count", F.col("low") + (F.row_number().over(by_rest) <= F.col("spare")).cast("long"))
    empty = F.sum((F.col("count") == 0).cast("long")).over(whole)
    giver = F.row_number().over(whole.orderBy(F.desc("count"), "split_index")) == 1
    rows = rows.withColumn("empty", empty).withColumn("giver", giver)
    quota = F.when(F.col("giver"), F.col("count") - F.col("empty")).when(F.col("count") == 0, F.lit(1)).otherwise(F.col("count"))
    return rows.select(*keys, F.col("split_index").cast("int").alias("split_index"), F.element_at(F.array(*map(F.lit, SPLITS)), F.col("split_index") + 1).alias("split"), quota.cast("long").alias("quota"))


def shuffle_key(seed: Column, stratum: Column, key: Column) -> Column:
    return F.sha2(F.concat(F.lit("split-v1:"), seed.cast("string"), F.lit(":"), stratum, F.lit(":"), key), 256)


def _ranked_scaled(groups: DataFrame, stratum: str, key: str, seed: int, buckets: int, share: DataFrame) -> DataFrame:
    """Ranks of a stratum without one task for all of it: buckets by the first digits of the shuffle key, which is
    uniform, are counted, offsets are summed over buckets, and ranks run inside each bucket. The stratum's bounds
    (share) come along with the offsets."""
    digest = shuffle_key(F.lit(seed), F.coalesce(F.col(stratum).cast("string"), F.lit("")), F.col(key).cast("string"))
    rows = groups.withColumn("_k", digest).withColumn("_b", (F.conv(F.substring("_k", 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int"))
    sizes = rows.groupBy(F.col(stratum).alias("_os"), F.col("_b").alias("_ob")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_os").orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    sizes = sizes.join(share, F.col("_os").eqNullSafe(F.col("_bs"))).drop("_bs")
    inner = Window.partitionBy(stratum, "_b").orderBy("_k", key)
    rows = rows.withColumn("_r", F.row_number().over(inner)).join(sizes, F.col(stratum).eqNullSafe(F.col("_os")) & (F.col("_b") == F.col("_ob")))
    return rows.withColumn("rank", (F.col("_before") + F.col("_r")).cast("long")).drop("_k", "_b", "_r", "_before", "_os", "_ob")


def _compat(groups: DataFrame, stratum: str, key: str, seed: int, prefix: str) -> DataFrame:
    """Ranks by Python's seeded shuffle of each stratum's keys, sorted; a stratum is one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        order = list(range(len(pdf)))
        random.Random(f"{prefix}:{seed}:{pdf[stratum].iloc[0]}").shuffle(order)
        return pdf.iloc[order].assign(rank=range(1, len(pdf) + 1))

    kinds = ", ".join(f"`{n}` {t}" for n, t in groups.dtypes)
    return groups.groupBy(stratum).applyInPandas(run, f"{kinds}, rank long")


def assign(rows: DataFrame, stratum: str, digest: str, name: str, ratios=RATIOS, seed: int = 42, mode: str = "hash", buckets: int = 256, prefix: str = "split-v1") -> DataFrame:
    """rows with their split: rows of equal digest go together, strata are apportioned by groups.

    mode hash (default) shuffles by a digest, compat by Python's generator, seeded with prefix:seed:stratum. A null
    stratum is a stratum, and the rows without a digest of a stratum are one group, so all rows are kept.
    """
    groups = rows.groupBy(stratum, digest).agg(F.min(name).alias("_first"))
    totals = groups.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("quota").over(Window.partitionBy(stratum).orderBy("split_index").rowsBetween(Window.unboundedPreceding, 0))
    share = quotas(totals, ratios).withColumn("hi", upto)
    share = share.groupBy(F.col(stratum).alias("_bs")).agg(F.array_sort(F.collect_list(F.struct("split_index", "hi", "split"))).alias("_bounds"))  # three each
    if mode == "compat":
        ranked = _compat(groups, stratum, "_first", seed, prefix).join(share, F.col(stratum).eqNullSafe(F.col("_bs"))).drop("_bs")
    else:
        ranked = _ranked_scaled(groups, stratum, "_first", seed, buckets, share)
    split = F.filter("_bounds", lambda b: F.col("rank") <= b["hi"])[0]["split"]
    chosen = ranked.select(F.col(stratum).alias("_cs"), F.col(digest).alias("_cd"), split.alias("split"))
    return rows.join(chosen, F.col(stratum).eqNullSafe(F.col("_cs")) & F.col(digest).eqNullSafe(F.col("_cd"))).drop("_cs", "_cd")


def summary(rows: DataFrame, condition: str, normal: str, n_boxes: Column) -> DataFrame:
    """split, images, normal, anomaly and boxes, with a row for every split even if it is empty."""
    names = rows.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    got = rows.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col(condition) == normal).alias("normal"), F.count_if(F.col(condition) != normal).alias("anomaly"), F.sum(n_boxes).cast("long").alias("boxes"))
    return F.broadcast(names).join(got, "split", "left").na.fill(0, ["images", "normal", "anomaly", "boxes"])


def round_robin(rows: DataFrame, bucket: str, key: str, count: int, seed: int = 42) -> DataFrame:
    """count rows taken in turn from the buckets, each in its own keyed order, with their rank."""
    order = F.sha2(F.concat(F.lit(f"preview-v1:{seed}:"), F.col(bucket), F.lit(":"), F.col(key).cast("string")), 256)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(bucket).orderBy(order, key)).cast("long"))
    return ranked.filter(F.col("rank") <= count).orderBy("rank", bucket).limit(count)


def round_robin_compat(buckets: list[list], count: int, seed: int) -> Iterator:
    """The same with Python's generator: one generator shuffles the buckets in order, picks come from their ends."""
    rng = random.Random(seed)
    piles = [list(b) for b in buckets]
    for pile in piles:
        rng.shuffle(pile)
    taken = 0
    while taken < count and any(piles):
        for pile in piles:
            if pile and taken < count:
                yield pile.pop()
                taken += 1
