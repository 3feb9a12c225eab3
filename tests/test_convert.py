import json
import os

import numpy as np
import pytest

from tessera.functions import png
from tessera.operators.checks import DatasetError
from tessera.plans.convert import convert, validate
from tests_shared import make


def test_convert_and_validate(spark, tmp_path):
    make(tmp_path)
    report = convert(spark, str(tmp_path / "set"), str(tmp_path / "out"), "thing")
    assert report["splits"] == {
        "train": {"images": 21, "normal": 14, "anomaly": 7, "boxes": 14},
        "val": {"images": 5, "normal": 3, "anomaly": 2, "boxes": 4},
        "test": {"images": 4, "normal": 3, "anomaly": 1, "boxes": 2},
    }
    lines = [len(open(tmp_path / "out/labels" / s / f).readlines()) for s in ("train", "val", "test") for f in os.listdir(tmp_path / "out/labels" / s)]
    assert sorted(lines) == [0] * 20 + [2] * 10
    got = validate(spark, str(tmp_path / "out"))
    assert got["splits"]["train"]["positive"] == 7 and got["n_files"] == 60
    manifest = open(tmp_path / "out/manifest.csv", newline="").read()
    assert manifest.count("\r\n") == 31
    assert len([json.loads(x) for x in open(tmp_path / "out/annotations.jsonl")]) == 30
    convert(spark, str(tmp_path / "set"), str(tmp_path / "again"), "thing")
    assert open(tmp_path / "again/manifest.csv", newline="").read() == manifest
    with pytest.raises(DatasetError, match="output_exists"):
        convert(spark, str(tmp_path / "set"), str(tmp_path / "out"), "thing")
    (tmp_path / "out/labels/train" / sorted(os.listdir(tmp_path / "out/labels/train"))[0]).write_text("0 nan 0.4 0.1 0.1\n")
    with pytest.raises(DatasetError, match="non_finite"):
        validate(spark, str(tmp_path / "out"))


def broken(data, what):
    if what == "missing_mask":
        (data / "Masks/Anomaly/003.png").unlink()
    elif what == "extra_mask":
        (data / "Masks/Anomaly/x.png").write_bytes((data / "Masks/Anomaly/003.png").read_bytes())
    elif what == "ambiguous_stem":
        (data / "Images/Normal/003.PNG").write_bytes((data / "Images/Normal/003.png").read_bytes())
    elif what == "dimension_mismatch":
        (data / "Masks/Anomaly/003.png").write_bytes(png.encode(np.ones((8, 9), np.uint8)))
    elif what == "empty_mask":
        (data / "Masks/Anomaly/003.png").write_bytes(png.encode(np.zeros((80, 100), np.uint8)))
    elif what == "conflicting_annotation":
        (data / "Images/Anomaly/003.png").write_bytes((data / "Images/Normal/003.png").read_bytes())
    elif what == "undecodable":
        (data / "Images/Normal/003.png").write_bytes(b"nothing")
    elif what == "nested_dir":
        (data / "Images/Normal/sub").mkdir()


@pytest.mark.parametrize("what", ["missing_mask", "extra_mask", "ambiguous_stem", "dimension_mismatch", "empty_mask", "conflicting_annotation", "undecodable", "nested_dir"])
def test_fatal(spark, tmp_path, what):
    data = make(tmp_path, 4, 4)
    broken(data, what)
    with pytest.raises(DatasetError, match=what):
        convert(spark, str(tmp_path / "set"), str(tmp_path / "out"), "thing")
    assert sorted(os.listdir(tmp_path)) == ["set"]


def test_layout_and_options(spark, tmp_path):
    with pytest.raises(DatasetError, match="source_layout"):
        convert(spark, str(tmp_path), str(tmp_path / "out"), "thing")
    with pytest.raises(DatasetError, match="bad_category"):
        convert(spark, str(tmp_path), str(tmp_path / "out"), "../x")
