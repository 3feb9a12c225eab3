"""Connected components of masks: run-length union-find in numpy, one mask a row, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Masks that go to a Python worker at once.
BATCH_MASKS = 64
BOX = "struct<x:int,y:int,w:int,h:int,area:long,line:string>"
SCHEMA = f"mask_id long, boxes array<{BOX}>, components int, removed_components int, removed_pixels long, duplicate_boxes int, foreground_pixels long"


def components(mask: np.ndarray, connectivity: int = 8) -> np.ndarray:
    """x, y, w, h, area of each component of the non-zero pixels, in the order of their first pixels."""
    if connectivity not in (4, 8):
        raise ValueError("connectivity must be 4 or 8")
    height, width = mask.shape
    edges = np.diff((mask != 0).astype(np.int8), axis=1, prepend=0, append=0)
    y, x0 = np.nonzero(edges == 1)
    _, x1 = np.nonzero(edges == -1)  # half-open runs, in raster order
    if not len(y):
        return np.zeros((0, 5), np.int64)
    stride, reach = width + 2, int(connectivity == 8)
    start, end = y * stride + x0, y * stride + x1
    # of the runs in the row above, those that touch a run are neighbours in the order of runs
    first = np.searchsorted(end, start - stride - reach, "right")
    last = np.searchsorted(start, end - stride + reach, "left")
    n = np.maximum(last - first, 0)
    below = np.repeat(np.arange(len(y)), n)
    above = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    label = np.arange(len(y))
    while len(at := np.nonzero(label[below] != label[above])[0]):
        a, b = label[below[at]], label[above[at]]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up
    roots, group = np.unique(label, return_inverse=True)
    out = np.zeros((len(roots), 5), np.int64)
    low_x, low_y = np.full(len(roots), width), np.full(len(roots), height)
    high_x, high_y = np.zeros(len(roots), np.int64), np.zeros(len(roots), np.int64)
    np.minimum.at(low_x, group, x0)
    np.maximum.at(high_x, group, x1)
    np.minimum.at(low_y, group, y)
    np.maximum.at(high_y, group, y + 1)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = low_x, low_y, high_x - low_x, high_y - low_y
    out[:, 4] = np.bincount(group, x1 - x0, minlength=len(roots))
    return out


@dataclass(frozen=True)
class Options:
    """How boxes come from components: one each or their union, a least area, padding, 4 or 8 neighbours."""

    mode: str = "components"
    min_area: int = 1
    padding: int = 0
    connectivity: int = 8

    def __post_init__(self):
        if self.mode not in ("components", "union") or self.min_area < 1 or self.padding < 0 or self.connectivity not in (4, 8):
            raise ValueError(f"invalid box options: {self}")


def label_line(x: int, y: int, w: int, h: int, width: int, height: int, cls: int = 0) -> str:
    """A normalised label line: class, centre and size, ten decimals of the exact binary values."""
    if not (width > 0 and height > 0 and w > 0 and h > 0 and 0 <= x and x + w <= width and 0 <= y and y + h <= height):
        raise ValueError(f"box ({x}, {y}, {w}, {h}) is not inside an image of {width} x {height}")
    return f"{cls} {(x + w / 2) / width:.10f} {(y + h / 2) / height:.10f} {w / width:.10f} {h / height:.10f}"


def boxes(mask: np.ndarray, options: Options = Options()) -> dict:
    """Boxes (distinct, by y, x, h, w) and tallies of a mask.

    Components below the least area are removed first, then the union is taken, then boxes are padded and clamped to
    the image, and equal ones become one. The number of components counts those removed.
    """
    height, width = mask.shape
    found = components(mask, options.connectivity)
    keep = found[found[:, 4] >= options.min_area]
    corners = np.column_stack([keep[:, 0], keep[:, 1], keep[:, 0] + keep[:, 2], keep[:, 1] + keep[:, 3], keep[:, 4]])
    if options.mode == "union" and len(corners):
        corners = np.concatenate([corners[:, :2].min(0), corners[:, 2:4].max(0), [corners[:, 4].sum()]])[None, :]
    p = options.padding
    padded = {}
    for x, y, r, b, area in corners.tolist():
        x, y, r, b = max(0, x - p), max(0, y - p), min(width, r + p), min(height, b + p)
        padded.setdefault((y, x, b - y, r - x), area)
    out = [{"x": x, "y": y, "w": w, "h": h, "area": a, "line": label_line(x, y, w, h, width, height)} for (y, x, h, w), a in sorted(padded.items())]
    return {
        "boxes": out,
        "components": len(found),
        "removed_components": len(found) - len(keep),
        "removed_pixels": int(found[:, 4].sum() - keep[:, 4].sum()),
        "duplicate_boxes": len(corners) - len(padded),
        "foreground_pixels": int(found[:, 4].sum()),
    }


def label_masks(masks: DataFrame, options: Options = Options()) -> DataFrame:
    """SCHEMA of each mask (mask_id, width, height, pixels: row-major bytes). No shuffle; a mask is one row."""
    spark = masks.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(BATCH_MASKS * 16, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = pa.struct([("x", pa.int32()), ("y", pa.int32()), ("w", pa.int32()), ("h", pa.int32()), ("area", pa.int64()), ("line", pa.string())])
        schema = pa.schema([("mask_id", pa.int64()), ("boxes", pa.list_(box)), ("components", pa.int32()), ("removed_components", pa.int32()), ("removed_pixels", pa.int64()), ("duplicate_boxes", pa.int32()), ("foreground_pixels", pa.int64())])
        for b in batches:
            rows = []
            for r in b.to_pylist():
                mask = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"])
                rows.append({"mask_id": r["mask_id"], **boxes(mask, options)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return masks.select("mask_id", "width", "height", "pixels").mapInArrow(run, SCHEMA)
