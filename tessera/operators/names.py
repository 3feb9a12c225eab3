"""File-name projections and identifier predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions of images and of masks, and system files that listings skip.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp")
MASK_EXTENSIONS = (".png", ".bmp", ".tif", ".tiff")
SYSTEM_FILES = ("thumbs.db", "desktop.ini")

_PARTS = r"(?s)^(.+?)(\.[^.]+)?$"


def base(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """The name up to its last dot; a leading dot begins no suffix."""
    return F.regexp_extract(name, _PARTS, 1)


def suffix(name: Column) -> Column:
    return F.regexp_extract(name, _PARTS, 2)


def key(name: Column) -> Column:
    """The pairing key: the lower-case stem. (Full case folding differs for a few letters outside ASCII.)"""
    return F.lower(stem(name))


def output_name(category: Column, condition: Column, name: Column) -> Column:
    """category_condition_stem with every other character of the stem as _, and the lower-case suffix."""
    return F.concat(category, F.lit("_"), condition, F.lit("_"), F.regexp_replace(stem(name), "[^A-Za-z0-9_-]", "_"), F.lower(suffix(name)))


def listed(name: Column) -> Column:
    """Whether a listing shows the file: neither hidden nor a system file."""
    return ~name.startswith(".") & ~F.lower(name).isin(*SYSTEM_FILES)


def has_extension(name: Column, extensions: tuple[str, ...]) -> Column:
    return F.lower(suffix(name)).isin(*extensions)


def safe_identifier(name: Column) -> Column:
    """Letters, digits, _ and -, beginning with a letter or digit, at most 63."""
    return name.rlike(r"^[A-Za-z0-9][A-Za-z0-9_-]{0,62}$")


def inside(child: Column, parent: Column) -> Column:
    """Whether a normalised path is parent or below it."""
    return (child == parent) | child.startswith(F.concat(parent, F.lit("/")))


def html(text: Column) -> Column:
    """Text as it may stand in a page or an attribute."""
    for mark, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "#x27")):
        text = F.replace(text, F.lit(mark), F.lit(f"&{name};"))
    return text


def caption(split: Column, condition: Column, n_boxes: Column) -> Column:
    """What stands under a preview."""
    return html(F.concat_ws(" / ", split, condition, F.concat(n_boxes.cast("string"), F.lit(" boxes"))))
