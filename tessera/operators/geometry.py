"""Predicates, sums and notices over boxes and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box_in_bounds(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Exact bounds: a box of positive size inside an image of positive size."""
    return (width > 0) & (height > 0) & (w > 0) & (h > 0) & (x >= 0) & (y >= 0) & (x + w <= width) & (y + h <= height)


def union_box(boxes: Column) -> Column:
    """The least box around all, from an array of x, y, w, h; null for none."""
    low = lambda f: F.array_min(F.transform(boxes, lambda b: b[f]))
    high = lambda f, n: F.array_max(F.transform(boxes, lambda b: b[f] + b[n]))
    return F.when(F.size(boxes) > 0, F.struct(low("x").alias("x"), low("y").alias("y"), (high("x", "w") - low("x")).alias("w"), (high("y", "h") - low("y")).alias("h")))


def padded(boxes: Column, padding: int, width: Column, height: Column) -> Column:
    """Boxes grown on all sides and clamped to the image, distinct, by y, x, h, w."""

    def grow(b: Column) -> Column:
        x, y = F.greatest(b["x"] - padding, F.lit(0)), F.greatest(b["y"] - padding, F.lit(0))
        r, low = F.least(b["x"] + b["w"] + padding, width), F.least(b["y"] + b["h"] + padding, height)
        return F.struct(y.alias("y"), x.alias("x"), (low - y).alias("h"), (r - x).alias("w"))

    return F.array_sort(F.array_distinct(F.transform(boxes, grow)))


def nested_annotations(boxes: Column, cls: int = 0) -> Column:
    """Boxes as class_id, x, y, width, height."""
    return F.transform(boxes, lambda b: F.struct(F.lit(cls).alias("class_id"), b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("width"), b["h"].alias("height")))


def mask_values(values: Column) -> Column:
    """The sorted distinct raw values of a mask."""
    return F.array_sort(F.array_distinct(values))


def notices(labelled: DataFrame, many: int = 20, high: float = 0.8) -> DataFrame:
    """Images, boxes, fragmented masks (more than many boxes) and those covered above high; of mask rows with sizes."""
    n = F.size("boxes")
    covered = F.col("foreground_pixels") / (F.col("width") * F.col("height")).cast("double") > high
    return labelled.agg(F.count(F.lit(1)).alias("images"), F.sum(n).cast("long").alias("boxes"), F.count_if(n > many).alias("fragmented"), F.count_if(covered).alias("high_coverage"), F.sum("removed_components").cast("long").alias("removed_components"), F.sum("removed_pixels").cast("long").alias("removed_pixels"))
