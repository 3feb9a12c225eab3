"""Label files: rows of text, their validation, per-split counts with explicit negatives, orphans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a number may look like: the forms that both Python and SQL read alike.
NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
NOT_FINITE = r"(?i)^[+-]?(?:nan|inf|infinity)$"
EPSILON = 1e-8


def lines(files: DataFrame, text: str = "value") -> DataFrame:
    """A row for each line with content: the other columns, line_no (from 1 among those) and raw."""
    kept = F.filter(F.split(F.col(text), r"\r\n|\r|\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != "")
    names = [c for c in files.columns if c != text]
    return files.select(*names, F.posexplode(F.transform(kept, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))).alias("line_no", "raw")).withColumn("line_no", (F.col("line_no") + 1).cast("int"))


def check_line(raw: Column) -> Column:
    """Why a label line is invalid: bad_row, non_finite, out_of_range, out_of_image; null if it is valid.

    Five columns, the class literally 0, finite numbers, centre in [0, 1], size in (0, 1], edges in the image but for
    rounding of 1e-8.
    """
    cols = F.split(F.trim(F.regexp_replace(raw, r"\s+", " ")), " ")
    nums = F.slice(cols, 2, 4)
    n = lambda i: F.get(cols, F.lit(i)).try_cast("double")
    x, y, w, h = n(1), n(2), n(3), n(4)
    readable = F.forall(nums, lambda c: c.rlike(NUMBER) | c.rlike(NOT_FINITE))
    finite = F.forall(nums, lambda c: c.rlike(NUMBER)) & F.forall(nums, lambda c: F.abs(c.try_cast("double")) < float("inf"))
    in_range = x.between(0, 1) & y.between(0, 1) & (w > 0) & (w <= 1) & (h > 0) & (h <= 1)
    edge = lambda c, s: (c - s / 2 >= -EPSILON) & (c + s / 2 <= 1 + EPSILON)
    return F.when((F.size(cols) != 5) | (F.get(cols, F.lit(0)) != "0") | ~readable, "bad_row").when(~finite, "non_finite").when(~in_range, "out_of_range").when(~(edge(x, w) & edge(y, h)), "out_of_image")


def split_stats(images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """split, images, positive, negative, boxes. labels has a row for each line; an image without lines is negative."""
    n = labels.groupBy(key).agg(F.count(F.lit(1)).alias("_lines"))
    got = images.join(n, key, "left").withColumn("_lines", F.coalesce("_lines", F.lit(0)))
    return got.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("_lines") > 0).alias("positive"), F.count_if(F.col("_lines") == 0).alias("negative"), F.sum("_lines").cast("long").alias("boxes"))


def one_class_only(stats: DataFrame) -> DataFrame:
    """Splits that lack positives or negatives."""
    return stats.filter((F.col("positive") == 0) | (F.col("negative") == 0))


def orphans(label_files: DataFrame, images: DataFrame, label_stem: str, image_stem: str) -> DataFrame:
    """Label files whose stem, but for case, no image has."""
    return label_files.join(images.select(F.lower(image_stem).alias("_stem")).distinct(), F.lower(F.col(label_stem)) == F.col("_stem"), "left_anti")
