"""Verified, atomic sinks of a detection dataset: staged beside the target, checked, then renamed.

The dataset's folder is one that driver and executors share, as files are named by row and Spark's writers cannot do
that. Every file is written under a temporary name first, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row

from tessera.operators.checks import DatasetError
from tessera.sources.files import sha256


def put(path: str, data: bytes) -> None:
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temp, "wb") as f:
        f.write(data)
    os.replace(temp, path)


def staged(output: str) -> str:
    """A new folder beside output, which must not exist."""
    if os.path.lexists(output):
        raise DatasetError(f"output_exists: {output}")
    stage = f"{output.rstrip('/')}.{uuid.uuid4().hex}.staging"
    os.makedirs(stage)
    return stage


def published(stage: str, output: str, fill) -> None:
    """Fill the stage and rename it to output; on any error nothing is left."""
    try:
        fill(stage)
        if os.path.lexists(output):
            raise DatasetError(f"output_exists: {output}")
        os.rename(stage, output)
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise


def copy_images(rows: DataFrame, stage: str) -> None:
    """Copy each image to images/<split>/<output_name> and write labels/<split>/<stem>.txt.

    rows: split, output_name, source and mask (paths), image_sha256, mask_sha256, label_text. The written copy and the
    mask must have the recorded digests, else a source has changed since it was read.
    """
    for split in ("train", "val", "test"):
        for kind in ("images", "labels"):
            os.makedirs(os.path.join(stage, kind, split), exist_ok=True)

    def write(part: Iterator[Row]) -> None:
        for r in part:
            target = os.path.join(stage, "images", r.split, r.output_name)
            temp = f"{target}.{uuid.uuid4().hex}.tmp"
            shutil.copyfile(r.source, temp)
            if sha256(temp) != r.image_sha256 or r.mask is not None and sha256(r.mask) != r.mask_sha256:
                raise DatasetError(f"source_changed: {r.output_name}")
            os.replace(temp, target)
            put(os.path.join(stage, "labels", r.split, os.path.splitext(r.output_name)[0] + ".txt"), r.label_text.encode())

    rows.select("split", "output_name", "source", "mask", "image_sha256", "mask_sha256", "label_text").foreachPartition(write)


def write_csv(rows: DataFrame, path: str) -> None:
    """A manifest with a header, comma separated with \\r\\n, in the order of rows; lists become JSON text.

    Rows are streamed to the driver a partition at a time; a manifest is text about images, never their content.
    """
    import csv

    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(rows.columns)
        for r in rows.toLocalIterator():
            out.writerow([json.dumps(x) if isinstance(x, list) else "" if x is None else x for x in r])


def write_jsonl(rows: DataFrame, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        for r in rows.toLocalIterator():
            f.write(json.dumps(r.asDict(recursive=True)) + "\n")


def write_json(path: str, value: dict) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, allow_nan=False)
        f.write("\n")


def write_descriptor(path: str, root: str, with_test: bool, class_name: str = "defect") -> None:
    """The dataset descriptor as YAML: root, split folders, class names."""
    text = f"path: {json.dumps(root)}\ntrain: images/train\nval: images/val\n" + "test: images/test\n" * with_test + f"names:\n  0: {class_name}\n"
    put(path, text.encode())
