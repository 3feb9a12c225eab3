import hashlib
import io
import os
import tarfile

import numpy as np
import pytest

from tessera.functions import png, preview
from tessera.operators.checks import DatasetError
from tessera.sources import staging


def test_copy_listed(spark, tmp_path):
    root = tmp_path / "a"
    (root / "sub").mkdir(parents=True)
    files = {"sub/x.txt": b"x", "y.txt": b"", "z.txt": b"not listed"}
    for p, data in files.items():
        (root / p).write_bytes(data)
    rows = [(p, hashlib.sha256(files[p]).hexdigest(), len(files[p])) for p in ("sub/x.txt", "y.txt")]
    report = spark.createDataFrame(rows, "path string, sha256 string, bytes long")
    assert staging.copy_listed(spark, str(root), report, str(tmp_path / "b")) == 2
    assert sorted(os.listdir(tmp_path / "b")) == ["manifest.json", "sub", "y.txt"] and (tmp_path / "b/sub/x.txt").read_bytes() == b"x"
    (root / "sub/x.txt").write_bytes(b"other")
    with pytest.raises(DatasetError, match="source_changed"):
        staging.copy_listed(spark, str(root), report, str(tmp_path / "c"))
    with pytest.raises(DatasetError, match="missing_file"):
        staging.copy_listed(spark, str(root), spark.createDataFrame([("no.txt", "", 1)], report.schema), str(tmp_path / "c"))


def test_extract(spark, tmp_path):
    def make(names):
        with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
            for n in names:
                info = tarfile.TarInfo(n)
                info.size = 4
                tar.addfile(info, io.BytesIO(b"best"))

    make(["weights/best.pt", "log.txt"])
    assert staging.extract(spark, str(tmp_path / "a.tar.gz"), str(tmp_path / "out")) == 2
    assert (tmp_path / "out/weights/best.pt").read_bytes() == b"best"
    for bad in ("../bad", "/tmp/bad", "C:/bad", "a\\b"):
        make(["ok", bad])
        with pytest.raises(DatasetError, match="archive_"):
            staging.extract(spark, str(tmp_path / "a.tar.gz"), str(tmp_path / "new"))
    assert not os.path.exists(tmp_path / "new")


def test_descriptor_and_settings(tmp_path):
    staging.check_descriptor({"names": {0: "defect"}, "train": "images/train", "path": "/gone"})
    for bad in ({"names": ["x"]}, {"names": ["defect"], "download": "x"}, {"names": ["defect"], "val": "../x"}):
        with pytest.raises(DatasetError):
            staging.check_descriptor(bad)
    base = {"epochs": 60, "batch": 1, "workers": 4}
    assert staging.settings_for(base, {"epochs": 1, "workers": 0}, {"batch": 4, "epochs": None}) == {"epochs": 1, "batch": 4, "workers": 0}
    with pytest.raises(DatasetError):
        staging.settings_for(base, {}, {"x": 1})


def test_preview(spark):
    image, mask = np.full((20, 30, 3), 100, np.uint8), np.zeros((20, 30), np.uint8)
    mask[5:10, 5:10] = 3
    box = {"x": 5, "y": 5, "w": 5, "h": 5}
    rows = spark.createDataFrame([("a", png.encode(image), png.encode(mask), [box]), ("b", png.encode(image), None, [])], "name string, image binary, mask binary, boxes array<struct<x:int,y:int,w:int,h:int>>")
    got = {r.name: png.decode(bytes(r.preview))[0] for r in preview.previews(rows).collect()}
    assert got["a"].shape == (24, 30, 3) and got["a"][4 + 5, 5].tolist() == [0, 255, 0] and got["a"][4 + 7, 7].tolist() == [162, 60, 60]
    assert (got["b"][4:] == 100).all()
    assert "&lt;b&gt;" in preview.page([("a.png", "<b>", "1 box")])
