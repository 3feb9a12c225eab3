"""Outputs of whole runs, and what a second look at a dataset must find."""

import csv
import hashlib
import io
import json
import os
import random
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.__main__ import main
from tessera.functions import png
from tessera.operators import archive, config, digest, splits
from tessera.operators.checks import DatasetError
from tessera.plans import convert as plans
from tessera.sources import files
from tests_shared import make


def dataset(root, images):
    """A dataset by hand: {split: {name: (pixels, label text)}}."""
    for split, members in images.items():
        for kind in ("images", "labels"):
            (root / kind / split).mkdir(parents=True)
        for name, (data, label) in members.items():
            (root / "images" / split / name).write_bytes(data)
            (root / "labels" / split / (os.path.splitext(name)[0] + ".txt")).write_text(label)
    (root / "data.yaml").write_text("path: /gone\ntrain: images/train\nval: images/val\ntest: images/test\nnames:\n  0: defect\n")


def picture(seed):
    return png.encode(np.random.default_rng(seed).integers(0, 256, (6, 7, 3), dtype=np.uint8))


BOX = "0 0.5 0.5 0.2 0.2\n"


def three(extra=()):
    out = {s: {"a.png": (picture(10 * k), BOX), "b.png": (picture(10 * k + 1), "")} for k, s in enumerate(splits.SPLITS)}
    for split, name, data, label in extra:
        out[split][name] = (data, label)
    return out


def test_fingerprint_is_in_path_order_and_escaped(spark, tmp_path):
    odd = 'ä "q" 😀.png'
    dataset(tmp_path, three([("train", "a-b.png", picture(77), ""), ("train", odd, picture(78), BOX), ("val", "_x.png", picture(79), BOX)]))
    got = plans.validate(spark, str(tmp_path))
    listed = []
    for split in splits.SPLITS:
        for name in sorted(os.listdir(tmp_path / "images" / split)):
            for p in (f"images/{split}/{name}", f"labels/{split}/{os.path.splitext(name)[0]}.txt"):
                data = (tmp_path / p).read_bytes()
                listed.append({"path": p, "sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data)})
    assert got["fingerprint"] == hashlib.sha256(json.dumps(listed, sort_keys=True).encode()).hexdigest()
    assert got["n_files"] == 18 and got["splits"]["val"]["images"] == 3


def test_json_text_equals_the_standard_one(spark):
    texts = ["", "plain", 'a"b\\c/d', "\n\r\t\b\f\x00\x1f\x7f", "é ü 王 😀 ￿ \U0010ffff", "~!#[]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(digest.json_text(F.col("t"))).collect()] == list(map(json.dumps, texts))


@pytest.mark.parametrize("what,reason", [("reencoded", "leak"), ("copied", "leak"), ("empty_image", "undecodable"), ("class", "yaml_names"), ("hook", "yaml_download"), ("place", "yaml_split_path"), ("orphan", "orphan_label"), ("link", "not_regular")])
def test_validation_finds(spark, tmp_path, what, reason):
    pixels = np.random.default_rng(1).integers(0, 256, (6, 7, 3), dtype=np.uint8)
    alpha = np.concatenate([pixels, np.full((6, 7, 1), 255, np.uint8)], axis=2)
    extra = {"reencoded": [("train", "c.png", png.encode(pixels), BOX), ("val", "c.png", png.encode(alpha), BOX)], "copied": [("train", "c.png", picture(5), BOX), ("test", "d.png", picture(5), "")], "empty_image": [("train", "c.png", b"", BOX)]}
    dataset(tmp_path, three(extra.get(what, ())))
    meta = tmp_path / "data.yaml"
    if what == "class":
        meta.write_text(meta.read_text().replace("defect", "thing"))
    elif what == "hook":
        meta.write_text(meta.read_text() + "download: x\n")
    elif what == "place":
        meta.write_text(meta.read_text().replace("images/val", "images/train"))
    elif what == "orphan":
        (tmp_path / "labels/val/z.txt").write_text("")
    elif what == "link":
        os.symlink(tmp_path / "images/val/a.png", tmp_path / "images/val/z.png")
    with pytest.raises(DatasetError, match=reason):
        plans.validate(spark, str(tmp_path))


def test_scan_lists_all_images(spark, tmp_path):
    for name, data in {"a.png": b"1", "_b.png": b"2", "c.png": b"", "d.PNG": b"4", ".e.png": b"5", "Thumbs.db": b"6", "f.txt": b"7"}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.name: (r.length, r.sha256) for r in files.digests(files.scan(spark, str(tmp_path))).collect()}
    assert got == {n: (len(x), hashlib.sha256(x).hexdigest()) for n, x in (("a.png", b"1"), ("_b.png", b"2"), ("c.png", b""), ("d.PNG", b"4"))}


def test_convert_writes_every_output(spark, tmp_path, capsys):
    data = make(tmp_path)
    (data / "Images/Normal/000.png").rename(data / "Images/Normal/_x.png")
    (data / "Images/Normal/copy.png").write_bytes((data / "Images/Normal/001.png").read_bytes())
    out = tmp_path / "out"
    plan = plans.convert(spark, str(tmp_path / "set"), str(out), "Thing", check_only=True)
    assert not out.exists() and plan["totals"] == {"images": 31, "boxes": 20, "removed_components": 0, "removed_pixels": 0, "previews": 0}
    report = plans.convert(spark, str(tmp_path / "set"), str(out), "thing", previews=7, mode="compat")
    assert json.load(open(out / "conversion_report.json")) == report and report["totals"]["previews"] == 7
    assert [g["images"] for g in report["duplicate_image_groups"]] == [["thing_normal_001.png", "thing_normal_copy.png"]] and report["warnings"][0].startswith("duplicate_groups: 1")
    assert report["parameters"]["split"] == [0.7, 0.15, 0.15] and report["parameters"]["previews_requested"] == 7
    rows = list(csv.DictReader(open(out / "manifest.csv", newline="")))
    assert tuple(rows[0]) == plans.RECORD and len(rows) == 31 and [(r["split"], r["image"]) for r in rows] == sorted((r["split"], r["image"]) for r in rows)
    nested = [json.loads(x) for x in open(out / "annotations.jsonl")]
    for r, n in zip(rows, nested):
        image = out / r["image"]
        assert hashlib.sha256(image.read_bytes()).hexdigest() == r["image_sha256"] and (out / r["label"]).exists()
        assert (data.parent / r["source_image"]).read_bytes() == image.read_bytes()
        assert (r["source_mask"] == "") == (r["condition"] == "normal") and len(n["boxes_xywh_pixels"]) == int(r["box_count"])
        assert tuple(n) == (*plans.RECORD, "boxes_xywh_pixels") and json.loads(r["mask_values"]) == n["mask_values"]
    assert (out / "classes.txt").read_text() == "defect\n" and (out / "SOURCE_ATTRIBUTION.md").exists()
    assert f'path: "{out}"' in (out / "data.yaml").read_text()
    shown = sorted(x for x in os.listdir(out / "previews") if x.endswith(".png"))
    assert len(shown) == 7 and all(x.startswith(("train_", "val_")) for x in shown) and all(x in (out / "previews/index.html").read_text() for x in shown)
    assert "thing_normal__x.png" in {os.path.basename(r["image"]) for r in rows}
    assert main(["validate", str(out)]) == 0 and json.loads(capsys.readouterr().out)["n_files"] == 62
    assert main(["prepare", "--category", "thing", "--output", str(out)]) == 0
    (out / "images/train/more.png").write_bytes(picture(1))
    with pytest.raises(DatasetError, match="export_image"):
        plans.validate_export(spark, str(out), spark.createDataFrame([(os.path.basename(r["image"]), r["split"], (out / r["label"]).read_text()) for r in rows], "name string, split string, label_text string"))


def test_assign_keeps_rows_without_stratum_or_digest(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([None, *"pqrstuvw"])) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, s string, d string")
    for mode in ("hash", "compat"):
        got = splits.assign(df, "s", "d", "k", mode=mode).collect()
        assert sorted(r.k for r in got) == list(range(200)) and all(r.split for r in got)
        where = {}
        assert all(where.setdefault((r.s, r.d), r.split) == r.split for r in got)


def test_nulls_are_no_empty_strings(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), ("y", ""), ("y", "")], "d string, p string")
    assert [tuple(r) for r in digest.conflicts(df, "d", "p").collect()] == [("x", 2)]


def test_overlay_of_whole_trees():
    low = {"a": {"b": 1, "c": {"d": [1]}}, "e": None, "f": {}}
    assert config.overlay(low, {}) == low
    assert config.overlay(low, {"a": {"c": {"d": {"x": 2}}}, "e": {"y": 1}}) == {"a": {"b": 1, "c": {"d": {"x": 2}}}, "e": {"y": 1}, "f": {}}
    for bad in ({"z": 1}, {"a": 3}, {"a": {"c": None}}, {"a": {"q": {"r": 1}}}, {"f": 2}, {"f": {"g": 1}}):
        with pytest.raises(DatasetError):
            config.overlay(low, bad)
    assert low == {"a": {"b": 1, "c": {"d": [1]}}, "e": None, "f": {}}
    assert config.picked({"b": 1, "a": 2}, ("a", "c", "b")) == {"a": 2, "b": 1} and config.numbers({"x": "1.5", "y": 2}) == {"x": 1.5, "y": 2.0}


def test_archive_reading_stops_at_the_limits(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for k in range(50):
            info = tarfile.TarInfo(f"f{k}")
            info.size = 10
            tar.addfile(info, io.BytesIO(b"0123456789"))
    whole = spark.read.format("binaryFile").load(str(tmp_path))
    assert archive.read_members(whole).count() == 50
    assert archive.read_members(whole, most_members=5).count() == 6
    got = archive.read_members(whole, True, most_bytes=95).collect()
    assert len(got) == 10 and [r.content is None for r in got] == [False] * 9 + [True]
