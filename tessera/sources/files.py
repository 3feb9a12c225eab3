"""Scans: flat image and mask folders, label files, split folders; names listed on the driver, bytes read by workers."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators import names
from tessera.operators.checks import DatasetError

#: Folders of a category, each matched without regard to case.
LAYOUT = (("Data", "Images", "Normal"), ("Data", "Images", "Anomaly"), ("Data", "Masks", "Anomaly"))


def child(parent: str, name: str) -> str | None:
    """The one directory of parent with this name but for case."""
    if not os.path.isdir(parent):
        return None
    found = [x for x in os.listdir(parent) if x.casefold() == name.casefold() and os.path.isdir(os.path.join(parent, x))]
    if len(found) > 1:
        raise DatasetError(f"source_layout: {parent} has several folders named {name}")
    return os.path.join(parent, found[0]) if found else None


def walk(root: str, *parts: str) -> str | None:
    for part in parts:
        if root is None:
            return None
        root = child(root, part)
    return root


def locate(source: str, category: str) -> str:
    """The category's folder: source itself, a folder of that name in it, or one a level below; exactly one must fit."""
    if not os.path.isdir(source):
        raise DatasetError(f"source_layout: {source} is no folder")
    near = [source, child(source, category)]
    near += [child(os.path.join(source, d), category) for d in sorted(os.listdir(source)) if os.path.isdir(os.path.join(source, d))]
    fits = {os.path.realpath(p) for p in near if p and all(walk(p, *f) for f in LAYOUT)}
    if len(fits) != 1:
        raise DatasetError(f"source_layout: {len(fits)} folders fit {category} under {source}")
    return fits.pop()


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """name and is_dir of everything in a folder, for the checks of a flat folder."""
    return spark.createDataFrame([(x.name, x.is_dir()) for x in sorted(os.scandir(folder), key=lambda x: (x.name.casefold(), x.name))], "name string, is_dir boolean")


def paths(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """name, path and length of the regular files of a folder, by name. Spark's file sources would hide names that begin
    with an underscore and files of no length, so the driver lists; links and other odd files are an error."""
    found = []
    for x in sorted(os.scandir(folder), key=lambda x: x.name):
        if x.is_symlink() or not (x.is_dir() or x.is_file()):
            raise DatasetError(f"not_regular: {x.path}")
        if x.is_file():
            found.append((x.name, x.path, x.stat().st_size))
    return found


def scan(spark: SparkSession, folder: str, masks: bool = False) -> DataFrame:
    """path, name, stem, key and length of a folder's images or masks. Workers read contents where they need them (read
    and digests below), so bytes never pass a shuffle; the folder is one that driver and executors share."""
    wanted = names.MASK_EXTENSIONS if masks else names.IMAGE_EXTENSIONS
    files = spark.createDataFrame(paths(spark, folder), "name string, path string, length long")
    rows = files.select("path", "name", names.stem(F.col("name")).alias("stem"), names.key(F.col("name")).alias("key"), "length")
    return rows.filter(names.listed(F.col("name")) & names.has_extension(F.col("name"), wanted))


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def digests(rows: DataFrame, path: str = "path", out: str = "sha256") -> DataFrame:
    """rows with the digest of the file that a column names, read in pieces; null where there is none."""
    return with_column(rows, path, out, lambda p: None if p is None else sha256(p))


def with_column(rows: DataFrame, path: str, out: str, body: Callable[[str | None], str | None]) -> DataFrame:
    """rows with a string column made from a column of paths by the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([body(p) for p in b.column(path).to_pylist()], pa.string())], [*b.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, StringType())]))


def label_files(spark: SparkSession, folder: str) -> DataFrame:
    """stem, value (the whole text), sha256 and bytes of every label file of a folder; empty ones are images without
    objects."""
    listed = [x for x in paths(spark, folder) if x[0].endswith(".txt") and not x[0].startswith(".")]
    found = digests(spark.createDataFrame(listed, "name string, path string, bytes long"))
    found = with_column(found, "path", "value", lambda p: read(p).decode("utf-8", "replace"))
    return found.select(names.stem(F.col("name")).alias("stem"), "value", "sha256", "bytes")


def split_images(spark: SparkSession, root: str, splits: tuple[str, ...]) -> DataFrame:
    """split, path, name, stem, sha256 and bytes of the images of each split; a split without any is an error."""
    out = None
    for split in splits:
        for kind in ("images", "labels"):
            folder = os.path.join(root, kind, split)
            if not os.path.isdir(folder) or os.path.islink(folder):
                raise DatasetError(f"missing_dir: {folder}")
        rows = scan(spark, os.path.join(root, "images", split))
        if not rows.head(1):
            raise DatasetError(f"no_images: {os.path.join(root, 'images', split)}")
        rows = digests(rows).select(F.lit(split).alias("split"), "path", "name", "stem", "sha256", F.col("length").alias("bytes"))
        out = rows if out is None else out.unionByName(rows)
    return out
