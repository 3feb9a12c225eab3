"""Inventories of images and masks, paired by key; orphans, collisions and set equality as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tagged_union(**scans: DataFrame) -> DataFrame:
    """All rows of the scans, with a column condition that names the scan."""
    out = None
    for condition, df in scans.items():
        df = df.withColumn("condition", F.lit(condition))
        out = df if out is None else out.unionByName(df)
    return out


def paired(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """Images with the mask of the same key; images of conditions without masks keep null."""
    return images.join(masks, key, "left")


def missing(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    return images.join(masks, key, "left_anti")


def pair_status(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """key and status (matched, missing_mask, extra_mask) in one pass."""
    left = images.select(key).distinct().withColumn("_image", F.lit(True))
    right = masks.select(key).distinct().withColumn("_mask", F.lit(True))
    status = F.when(F.col("_image").isNull(), "extra_mask").when(F.col("_mask").isNull(), "missing_mask").otherwise("matched")
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def collisions(rows: DataFrame, key: Column, name: str, most_listed: int = 10) -> DataFrame:
    """key, n and the first names of keys that several rows share; names are ranked per key, never all gathered."""
    keyed = rows.select(key.alias("key"), F.col(name).alias("name"))
    many = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("name"))
    first = keyed.join(many.select("key"), "key", "left_semi").withColumn("rank", rank).filter(F.col("rank") <= most_listed)
    return many.join(first.groupBy("key").agg(F.array_sort(F.collect_list("name")).alias("names")), "key")


def first_of_each(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key, like an ordered distinct."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")


def inventory_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows with side missing or unexpected; empty if both hold the same rows as often."""
    return expected.exceptAll(actual).withColumn("side", F.lit("missing")).unionByName(actual.exceptAll(expected).withColumn("side", F.lit("unexpected")))


def changed(recorded: DataFrame, found: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """Keys whose recorded digest is not the one found."""
    a, b = recorded.select(key, F.col(digest).alias("recorded")), found.select(key, F.col(digest).alias("found"))
    return a.join(b, key).filter("recorded <> found")


def allowed(files: DataFrame, report: DataFrame, key: str = "path") -> DataFrame:
    """Files that the report lists."""
    return files.join(report, key, "left_semi")
