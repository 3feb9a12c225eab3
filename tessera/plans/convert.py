"""Whole runs: masks and images to an audited detection dataset, and the validation of such a dataset."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions import png, preview
from tessera.functions.labelling import BOX, Options, boxes
from tessera.operators import checks, digest, geometry, labels, names, pairing, splits
from tessera.sources import files, sinks, staging

VERSION = "1"
_BOXES = pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32()), ("w", pa.int32()), ("h", pa.int32()), ("area", pa.int64()), ("line", pa.string())]))
_ANALYSED = pa.schema([("name", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("image_sha256", pa.string()), ("mask_sha256", pa.string()), ("pixels_sha256", pa.string()), ("mask_width", pa.int32()), ("mask_height", pa.int32()), ("binary_mask_sha256", pa.string()), ("mask_values", pa.list_(pa.int32())), ("boxes", _BOXES), ("components", pa.int32()), ("removed_components", pa.int32()), ("removed_pixels", pa.int64()), ("foreground_pixels", pa.int64()), ("fault", pa.string())])
_COLUMNS = f"name string, width int, height int, image_sha256 string, mask_sha256 string, pixels_sha256 string, mask_width int, mask_height int, binary_mask_sha256 string, mask_values array<int>, boxes array<{BOX}>, components int, removed_components int, removed_pixels long, foreground_pixels long, fault string"
#: The columns of a manifest, in order, and the counts of the published category.
RECORD = ("source_image", "source_mask", "image", "label", "condition", "split", "width", "height", "box_count", "mask_values", "foreground_pixels", "components", "removed_components", "removed_pixels", "image_sha256", "pixels_sha256", "mask_sha256", "binary_mask_sha256")
PUBLISHED = {"chewinggum": {"normal": 503, "anomaly": 100}}


@dataclass(frozen=True)
class Request:
    """What a conversion was asked for."""

    category: str
    options: Options = Options()
    ratios: tuple[float, ...] = splits.RATIOS
    seed: int = 42
    mode: str = "hash"
    previews: int = 24
    attribution: str = "Images and masks are those of the source folder; see its licence.\n"
    class_name: str = "defect"


def _analysed(rows: DataFrame, options: Options) -> DataFrame:
    """What images and their masks (columns source and mask: paths, mask may be null) hold; a fault instead where either
    cannot be read. Workers read a file at a time, so no bytes are shuffled."""

    def one(r: dict) -> dict:
        out = {"name": r["name"], "boxes": [], "mask_values": [], "components": 0, "removed_components": 0, "removed_pixels": 0, "foreground_pixels": 0}
        try:
            data = files.read(r["source"])
            out["image_sha256"] = hashlib.sha256(data).hexdigest()
            rgb = png.rgb(data)
            out |= {"height": rgb.shape[0], "width": rgb.shape[1]}
            out["pixels_sha256"] = hashlib.sha256(f"{rgb.shape[1]}x{rgb.shape[0]}:RGB:".encode() + rgb.tobytes()).hexdigest()
            if r["mask"] is not None:
                data = files.read(r["mask"])
                out["mask_sha256"] = hashlib.sha256(data).hexdigest()
                mask, seen = png.mask(data)
                got = boxes(mask, options)
                got.pop("duplicate_boxes")
                out |= got | {"mask_height": mask.shape[0], "mask_width": mask.shape[1], "mask_values": seen, "binary_mask_sha256": hashlib.sha256(mask.tobytes()).hexdigest()}
        except png.ImageError as e:
            out["fault"] = e.reason
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([one(r) for r in b.to_pylist()], _ANALYSED)

    return rows.select("name", "source", "mask").mapInArrow(run, _COLUMNS)


def samples(spark: SparkSession, root: str, category: str) -> DataFrame:
    """name (of the output), condition, key, and the paths source and mask (null for normal images); no bytes."""
    scans = [files.scan(spark, files.walk(root, *f), masks=f[1] == "Masks") for f in files.LAYOUT]
    images = pairing.tagged_union(normal=scans[0], anomaly=scans[1])
    masks = scans[2].select(F.col("key"), F.lit("anomaly").alias("condition"), F.col("path").alias("mask"))
    name = names.output_name(F.lit(category), F.col("condition"), F.col("name"))
    return images.join(masks, ["key", "condition"], "left").select(name.alias("name"), "condition", "key", F.col("path").alias("source"), "mask")


def manifest(split: DataFrame, root: str) -> DataFrame:
    """RECORD of every sample, with its boxes."""
    relative = lambda c: F.substring(F.col(c), F.lit(len(root.rstrip("/")) + 2), F.length(c))
    out = {
        "source_image": relative("source"),
        "source_mask": F.coalesce(relative("mask"), F.lit("")),
        "image": F.concat(F.lit("images/"), "split", F.lit("/"), "name"),
        "label": F.concat(F.lit("labels/"), "split", F.lit("/"), names.stem(F.col("name")), F.lit(".txt")),
        "box_count": F.size("boxes"),
    }
    text = ("mask_sha256", "binary_mask_sha256")
    return split.select(*(out[c].alias(c) if c in out else F.coalesce(c, F.lit("")).alias(c) if c in text else F.col(c) for c in RECORD), "boxes", "name")


def label_text() -> Column:
    return F.concat(F.array_join(F.transform("boxes", lambda b: b["line"]), "\n"), F.when(F.size("boxes") > 0, "\n").otherwise(""))


def preview_rows(split: DataFrame, count: int, seed: int, mode: str) -> DataFrame:
    """Rows to preview, in turn from train and validation images, anomalies first; test images stay unseen."""
    rows = split.filter("split <> 'test'").withColumn("bucket", F.concat("split", F.lit("/"), "condition"))
    order = ("train/anomaly", "train/normal", "val/anomaly", "val/normal")
    if mode == "compat":  # one generator for all, over names alone
        piles = {r.bucket: r.names for r in rows.groupBy("bucket").agg(F.array_sort(F.collect_list("name")).alias("names")).collect()}
        picked = list(splits.round_robin_compat([piles.get(b, []) for b in order], count, seed))
        return rows.join(F.broadcast(rows.sparkSession.createDataFrame([(n, k) for k, n in enumerate(picked)], "name string, rank long")), "name")
    return splits.round_robin(rows, "bucket", "name", count, seed)


def write_previews(split: DataFrame, stage: str, request: Request) -> int:
    """previews/<split>_<stem>.png and a page of them; the number written. Rendered by workers, at most as many as asked."""
    if not request.previews:
        return 0
    rows = preview_rows(split, request.previews, request.seed, request.mode)
    os.makedirs(os.path.join(stage, "previews"))
    file = F.concat("split", F.lit("_"), names.stem(F.col("name")), F.lit(".png"))
    caption = F.concat_ws(" / ", "split", "condition", F.concat(F.size("boxes").cast("string"), F.lit(" boxes")))
    rows = rows.select(file.alias("file"), caption.alias("caption"), "source", "mask", "boxes", "rank", "bucket").persist()

    def write(part) -> None:
        for r in part:
            mask = None if r.mask is None else png.mask(files.read(r.mask))[0]
            drawn = preview.rendered(png.rgb(files.read(r.source)), mask, [b.asDict() for b in r.boxes])
            sinks.put(os.path.join(stage, "previews", r.file), png.encode(drawn))

    try:
        rows.select("file", "source", "mask", "boxes").foreachPartition(write)
        cards = [(r.file, r.file, r.caption) for r in rows.orderBy("rank", "bucket").select("file", "caption").collect()]  # bounded by the request
    finally:
        rows.unpersist()
    sinks.put(os.path.join(stage, "previews", "index.html"), preview.page(cards).encode())
    return len(cards)


def warnings(category: str, facts: dict, counts: dict, n_groups: int) -> list[str]:
    """What a reader of the report should look at."""
    out = []
    if n_groups:
        out.append(f"duplicate_groups: {n_groups} groups of equal pixels, each kept in one split; ratios are approximate")
    if facts["removed_components"]:
        out.append(f"removed_components: {facts['removed_components']} below the least area")
    if facts["fragmented"]:
        out.append(f"fragmented: {facts['fragmented']} images have over 20 boxes")
    if facts["high_coverage"]:
        out.append(f"high_coverage: {facts['high_coverage']} masks cover over 80 % of the image")
    if category in PUBLISHED and counts != PUBLISHED[category]:
        out.append(f"unpublished_counts: {counts}, published {PUBLISHED[category]}")
    return out


def convert(spark: SparkSession, source: str, output: str, category: str, options: Options = Options(), ratios=splits.RATIOS, seed: int = 42, mode: str = "hash", previews: int = 24, check_only: bool = False, attribution: str = Request.attribution) -> dict:
    """Convert a category to a dataset at output and return the report. Any offence raises before anything is left; with
    check_only nothing is written at all."""
    if not names_ok(category):
        raise checks.DatasetError(f"bad_category: {category}")
    if previews < 0:
        raise checks.DatasetError(f"bad_previews: {previews}")
    request = Request(category.lower(), options, splits.checked_ratios(ratios), seed, mode, previews, attribution)
    root = files.locate(source, request.category)
    real = os.path.realpath(output)
    if os.path.islink(output) or real == root or real.startswith(root + os.sep) or root.startswith(real + os.sep):
        raise checks.DatasetError(f"output_location: {output}")
    if not check_only and os.path.lexists(output):
        raise checks.DatasetError(f"output_exists: {output}")
    folders = [files.walk(root, *f) for f in files.LAYOUT]
    checks.raise_if_any(*(checks.listing(files.listing(spark, f), masks=k == 2) for k, f in enumerate(folders)))
    rows = samples(spark, root, request.category).persist()
    analysed = None
    try:
        masks = files.scan(spark, folders[2], masks=True).select("key")
        status = pairing.pair_status(rows.filter("condition = 'anomaly'").select("key"), masks, "key").filter("status <> 'matched'")
        same = pairing.collisions(rows, F.lower(names.stem(F.col("name"))), "source")
        checks.raise_if_any(checks.offences(status, F.col("status"), F.col("key")), checks.offences(same, "output_collision", F.col("key")))
        counts = {r.condition: r["count"] for r in rows.groupBy("condition").count().collect()}
        if empty := {"normal", "anomaly"} - set(counts):
            raise checks.DatasetError(f"empty_condition: {sorted(empty)}")
        analysed = _analysed(rows, options).join(rows, "name").persist()
        conflict = digest.conflicts(analysed, "pixels_sha256", "condition", "binary_mask_sha256")
        checks.raise_if_any(checks.offences(analysed.filter("fault is not null"), F.col("fault"), F.col("name")), checks.samples(analysed.filter("fault is null")), checks.offences(conflict, "conflicting_annotation", F.col("pixels_sha256")))
        few = analysed.select("condition", "pixels_sha256").distinct().groupBy("condition").count().filter("count < 3")
        checks.raise_if_any(checks.offences(few, "too_small", F.col("condition")))
        split = splits.assign(analysed, "condition", "pixels_sha256", "name", request.ratios, seed, mode).persist()
        try:
            checks.raise_if_any(checks.offences(digest.leaks(split, "split", pixels="pixels_sha256"), "export_leak", F.col("digest")))
            report = report_of(split, root, output, request, counts)
            if not check_only:
                sinks.published(sinks.staged(output), output, lambda stage: write(spark, split, root, output, stage, request, report))
            return report
        finally:
            split.unpersist()
    finally:
        rows.unpersist()
        if analysed is not None:
            analysed.unpersist()


def report_of(split: DataFrame, root: str, output: str, request: Request, counts: dict) -> dict:
    """The report as far as it is known before anything is written."""
    facts = geometry.notices(split).first().asDict()
    table = splits.summary(split, "condition", "normal", F.size("boxes"))
    groups = digest.duplicate_groups(split, "pixels_sha256", "name").orderBy("pixels_sha256")
    listed = [{"pixels_sha256": r.pixels_sha256, "images": r.members} for r in groups.toLocalIterator()]
    return {
        "converter_version": VERSION,
        "created_utc": datetime.now(timezone.utc).isoformat(),
        "source_category_root": root,
        "output_root": output,
        "category": request.category,
        "class_names": {"0": request.class_name},
        "parameters": {"split": list(request.ratios), "seed": request.seed, "shuffle": request.mode, "box_mode": request.options.mode, "connectivity": request.options.connectivity, "min_area": request.options.min_area, "padding": request.options.padding, "previews_requested": request.previews},
        "split_method": "conditions apart, groups of equal pixels together",
        "totals": {k: facts[k] for k in ("images", "boxes", "removed_components", "removed_pixels")} | {"previews": 0},
        "splits": {r.split: {k: r[k] for k in ("images", "normal", "anomaly", "boxes")} for r in table.collect()},
        "duplicate_image_groups": listed,
        "warnings": warnings(request.category, facts, counts, len(listed)),
    }


def write(spark: SparkSession, split: DataFrame, root: str, output: str, stage: str, request: Request, report: dict) -> None:
    """All files of a dataset, validated where they are staged."""
    sinks.copy_images(split.select("split", F.col("name").alias("output_name"), "source", "mask", "image_sha256", "mask_sha256", label_text().alias("label_text")), stage)
    records = manifest(split, root).orderBy("split", "name")
    sinks.write_csv(records.select(*RECORD), os.path.join(stage, "manifest.csv"))
    sinks.write_jsonl(records.select(*RECORD, geometry.nested_annotations(F.col("boxes")).alias("boxes_xywh_pixels")), os.path.join(stage, "annotations.jsonl"))
    sinks.write_descriptor(os.path.join(stage, "data.yaml"), os.path.abspath(output), True, request.class_name)
    sinks.put(os.path.join(stage, "classes.txt"), f"{request.class_name}\n".encode())
    sinks.put(os.path.join(stage, "SOURCE_ATTRIBUTION.md"), request.attribution.encode())
    report["totals"]["previews"] = write_previews(split, stage, request)
    sinks.write_json(os.path.join(stage, "conversion_report.json"), report)
    validate_export(spark, stage, split.select("name", "split", label_text().alias("label_text")))


def names_ok(category: str) -> bool:
    return re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]{0,62}", category) is not None


def validate_export(spark: SparkSession, root: str, expected: DataFrame) -> None:
    """The image and label files under root are exactly those expected, and labels have the expected text."""
    want = expected.select("split", "name", names.stem(F.col("name")).alias("stem"), "label_text")
    for split in splits.SPLITS:
        part = want.filter(F.col("split") == split)
        there = spark.createDataFrame([(n,) for n, *_ in files.paths(spark, os.path.join(root, "images", split))], "name string")
        diff = pairing.inventory_difference(part.select("name"), there)
        have = files.label_files(spark, os.path.join(root, "labels", split))
        text = pairing.inventory_difference(part.select("stem", F.col("label_text").alias("value")), have.select("stem", "value"))
        checks.raise_if_any(checks.offences(diff, "export_image", F.col("name"), F.col("side")), checks.offences(text, "export_label", F.col("stem"), F.col("side")))


def decoded(images: DataFrame) -> DataFrame:
    """images (column path) with the digest of their pixels, or a fault."""

    def one(path: str) -> tuple[str | None, str | None]:
        try:
            rgb = png.rgb(files.read(path))
        except png.ImageError as e:
            return None, e.reason
        return hashlib.sha256(f"({rgb.shape[1]}, {rgb.shape[0]})".encode() + rgb.tobytes()).hexdigest(), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(p) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([x[k] for x in got], pa.string()) for k in (0, 1))], [*b.schema.names, "pixels_sha256", "fault"])

    return images.mapInArrow(run, StructType([*images.schema.fields, StructField("pixels_sha256", StringType()), StructField("fault", StringType())]))


def validate(spark: SparkSession, root: str, include_test: bool = True) -> dict:
    """Re-validate a dataset: descriptor and layout, pairing, label rows, both classes in each split, images that decode,
    files or pixels in several splits; returns counts and the fingerprint of the ordered file list."""
    root = os.path.realpath(root)
    wanted = splits.SPLITS if include_test else splits.SPLITS[:2]
    staging.check_descriptor(staging.read_yaml(os.path.join(root, "data.yaml")), needed=wanted)
    images = files.split_images(spark, root, wanted)
    texts = None
    for split in wanted:
        got = files.label_files(spark, os.path.join(root, "labels", split)).withColumn("split", F.lit(split))
        texts = got if texts is None else texts.unionByName(got)
    key = F.concat_ws("/", "split", "stem")
    images, texts = decoded(images.withColumn("key", key)).persist(), texts.withColumn("key", key).persist()
    try:
        same = pairing.collisions(images, F.lower("key"), "name")
        missing = pairing.missing(images, texts, "key")
        orphan = labels.orphans(texts, images, "key", "key")
        rows = labels.lines(texts.select("key", "value"))
        bad = rows.withColumn("reason", labels.check_line(F.col("raw"))).filter("reason is not null")
        leak = digest.leaks(images, "split", file="sha256", pixels="pixels_sha256")
        checks.raise_if_any(
            checks.offences(images.filter("fault is not null"), F.col("fault"), F.col("key")),
            checks.offences(same, "duplicate_stem", F.col("key")),
            checks.offences(missing, "missing_label", F.col("key")),
            checks.offences(orphan, "orphan_label", F.col("key")),
            checks.offences(bad, F.col("reason"), F.col("key"), F.col("raw")),
            checks.offences(leak, "leak", F.col("digest"), F.concat("kind", F.lit(": "), F.array_join("splits", ", "))),
        )
        stats = labels.split_stats(images, rows, "key")
        checks.raise_if_any(checks.offences(labels.one_class_only(stats), "one_class_only", F.col("split")))
        # splits in their order, images by name, each followed by its label
        order = F.array_position(F.array(*map(F.lit, splits.SPLITS)), F.col("split")).alias("o")
        owners = images.select("key", "name")
        listed = images.select(order, "name", F.lit(0).alias("k"), F.concat(F.lit("images/"), "split", F.lit("/"), "name").alias("path"), "sha256", "bytes")
        listed = listed.unionByName(texts.join(owners, "key").select(order, "name", F.lit(1).alias("k"), F.concat(F.lit("labels/"), "split", F.lit("/"), "stem", F.lit(".txt")).alias("path"), "sha256", "bytes"))
        total = digest.fingerprint(listed, ["o", "name", "k"]).first()
        counts = {r.split: r.asDict() for r in stats.collect()}
        return {"root": root, "names": {"0": "defect"}, "splits": counts, "fingerprint": total.fingerprint, "n_files": total.n_files}
    finally:
        images.unpersist()
        texts.unpersist()


def prepare(spark: SparkSession, source: str, output: str, category: str, **options) -> dict:
    """The validation of the dataset at output, which is converted first only if it is not there."""
    if not os.path.lexists(output):
        convert(spark, source, output, category, **options)
    return validate(spark, output)
