"""Descriptors, staged copies of listed files, and extraction of archives that were checked first."""

from __future__ import annotations

import os
import shutil
import tarfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import archive, checks
from tessera.sources.files import sha256, with_column
from tessera.sources.sinks import write_json


def read_yaml(path: str) -> dict:
    """A YAML file whose top level is a mapping."""
    try:
        import yaml
    except ImportError as e:
        raise checks.DatasetError("yaml: PyYAML is not installed") from e
    with open(path, encoding="utf-8") as f:
        value = yaml.safe_load(f)
    if not isinstance(value, dict):
        raise checks.DatasetError(f"not_mapping: {path}")
    return value


def check_descriptor(value: dict, class_name: str = "defect", needed: tuple[str, ...] = ()) -> None:
    """The one class, no download, and for each split (those needed must be there) its folder in the dataset."""
    found = value.get("names")
    if found not in ({0: class_name}, {"0": class_name}, [class_name]):
        raise checks.DatasetError(f"yaml_names: {found}")
    if "download" in value:
        raise checks.DatasetError("yaml_download")
    for split in ("train", "val", "test"):
        path = value.get(split)
        if path is not None and path != f"images/{split}" or path is None and split in needed:
            raise checks.DatasetError(f"yaml_split_path: {split}: {path}")


def copy_listed(spark: SparkSession, root: str, report: DataFrame, target: str) -> int:
    """Copy the files that report (path, sha256, bytes) lists, and no other, verify them, and write a sorted manifest.

    All are verified before the first is copied, and each copy again; a path that leaves the folder is an error.
    """
    whole = F.concat(F.lit(os.path.realpath(root).rstrip("/") + "/"), F.col("path"))
    rows = report.select("path", "sha256", whole.alias("source"))
    bad = rows.withColumn("fault", archive.path_fault(F.col("path"))).filter("fault is not null")
    checks.raise_if_any(checks.offences(bad, "unsafe_path", F.col("path"), F.col("fault")))
    found = with_column(rows, "source", "found", lambda p: sha256(p) if os.path.isfile(p) and not os.path.islink(p) else None)
    wrong = found.filter("found is null or found <> sha256")
    checks.raise_if_any(checks.offences(wrong, F.when(F.col("found").isNull(), "missing_file").otherwise("source_changed"), F.col("path")))

    def write(part) -> None:
        for r in part:
            out = os.path.join(target, r.path)
            os.makedirs(os.path.dirname(out), exist_ok=True)
            temp = f"{out}.{uuid.uuid4().hex}.tmp"
            shutil.copyfile(r.source, temp)
            if sha256(temp) != r.sha256:
                raise checks.DatasetError(f"source_changed: {r.path}")
            os.replace(temp, out)

    os.makedirs(target, exist_ok=True)
    rows.foreachPartition(write)
    listed = [r.asDict() for r in report.select("path", "sha256", "bytes").orderBy("path").toLocalIterator()]
    write_json(os.path.join(target, "manifest.json"), {"files": listed})
    return len(listed)


def listed_members(path: str):
    """path, n, name, kind and size of a tar.gz's members, up to the first beyond a limit; contents are skipped."""
    total = 0
    with tarfile.open(path, mode="r:gz") as tar:
        for n, m in enumerate(tar):
            kind = "file" if m.isreg() else "dir" if m.isdir() else "link" if m.issym() or m.islnk() else "other"
            total += m.size
            yield path, n, m.name, kind, m.size
            if n >= archive.MOST_MEMBERS or total > archive.MOST_BYTES:
                return


def extract(spark: SparkSession, path: str, target: str) -> int:
    """Extract a tar.gz into a new folder, after all members passed the guards; nothing is left on an error."""
    if os.path.lexists(target):
        raise checks.DatasetError(f"output_exists: {target}")
    members = spark.createDataFrame(list(listed_members(path)), "path string, n long, name string, kind string, size long")
    bad = archive.guarded(members, "path", "n").filter("fault is not null")
    over = archive.totals(members, "path").filter("beyond_limits")
    checks.raise_if_any(checks.offences(bad, F.concat(F.lit("archive_"), "fault"), F.col("name")), checks.offences(over, "archive_limits", F.col("path")))
    stage = f"{target}.{uuid.uuid4().hex}.staging"
    n = 0
    try:
        os.makedirs(stage)
        with tarfile.open(path, mode="r:gz") as tar:
            for m in tar:
                out = os.path.join(stage, m.name)
                if m.isdir():
                    os.makedirs(out, exist_ok=True)
                else:
                    os.makedirs(os.path.dirname(out), exist_ok=True)
                    with open(out, "wb") as f:
                        shutil.copyfileobj(tar.extractfile(m), f)
                    n += 1
        os.rename(stage, target)
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise
    return n


def settings_for(base: dict, preset: dict, given: dict) -> dict:
    """Training settings: base, then a preset, then what the caller gave (None: not given); checked by their ranges."""
    out = base | preset | {k: v for k, v in given.items() if v is not None}
    if unknown := sorted(set(out) - set(base)):
        raise checks.DatasetError(f"unknown_key: {', '.join(unknown)}")
    return out


