"""Previews: an image with its mask blended in and its boxes drawn, and a page of them."""

from __future__ import annotations

import html

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.functions import png

#: Share of the image under a mask; the rest is red. Colour of boxes. Rows of the band above the image.
BLEND, MASK_COLOUR, BOX_COLOUR, BAND = 0.60, (255, 0, 0), (0, 255, 0), 4


def rendered(image: np.ndarray, mask: np.ndarray | None, boxes: list[dict]) -> np.ndarray:
    """RGB pixels; blended values are cut off to whole numbers."""
    out = (image if image.shape[2] == 3 else np.repeat(image[:, :, :1], 3, axis=2)).astype(np.uint8)
    if mask is not None:
        at = mask > 0
        out[at] = (out[at] * BLEND + np.array(MASK_COLOUR) * (1 - BLEND)).astype(np.uint8)
    for b in boxes:
        x, y, r, low = b["x"], b["y"], b["x"] + b["w"] - 1, b["y"] + b["h"] - 1
        out[y, x : r + 1] = out[low, x : r + 1] = BOX_COLOUR
        out[y : low + 1, x] = out[y : low + 1, r] = BOX_COLOUR
    return np.concatenate([np.full((BAND, out.shape[1], 3), 32, np.uint8), out])


def previews(rows: DataFrame) -> DataFrame:
    """name and preview (PNG bytes) of rows with name, image, mask (bytes or null) and boxes."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():  # a raster at a time
                mask = png.mask(r["mask"])[0] if r["mask"] is not None else None
                data = png.encode(rendered(png.decode(r["image"])[0], mask, r["boxes"]))
                yield pa.RecordBatch.from_pylist([{"name": r["name"], "preview": data}], pa.schema([("name", pa.string()), ("preview", pa.binary())]))

    return rows.select("name", "image", "mask", "boxes").mapInArrow(run, "name string, preview binary")


def page(cards: list[tuple[str, str, str]]) -> str:
    """An HTML page of cards (file, caption, detail); all text is escaped."""
    one = "<figure><img src=\"{0}\" alt=\"{1}\"><figcaption>{1}<br>{2}</figcaption></figure>"
    body = "\n".join(one.format(*(html.escape(x, quote=True) for x in c)) for c in cards)
    return f"<!doctype html>\n<meta charset=\"utf-8\">\n<title>Previews</title>\n{body}\n"
