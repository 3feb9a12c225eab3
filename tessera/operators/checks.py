"""Fatal conditions as queries: each returns its offending rows as reason, key, detail; none means that all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: States of a remote job that it does not leave.
TERMINAL = ("Completed", "Failed", "Stopped")


def terminal(state: Column) -> Column:
    return state.isin(*TERMINAL)


class DatasetError(ValueError):
    """A dataset or its options break a rule; the message lists reasons and the first offending keys."""


def offences(rows: DataFrame, reason: str | Column, key: Column, detail: Column | None = None) -> DataFrame:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return rows.select(reason.alias("reason"), key.cast("string").alias("key"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def first_true(*cases: tuple[str, Column]) -> Column:
    """The name of the first condition that holds, or null."""
    return reduce(lambda out, c: F.when(c[1], F.lit(c[0])).otherwise(out), reversed(cases), F.lit(None).cast("string"))


def raise_if_any(*found: DataFrame, listed: int = 10) -> None:
    """Raise DatasetError with the first offences in order; only so many rows come to the driver."""
    every = reduce(DataFrame.unionByName, found)
    rows = every.orderBy("reason", "key").limit(listed + 1).collect()
    if rows:
        shown = "; ".join(f"{r.reason}: {r.key}" + (f" ({r.detail})" if r.detail else "") for r in rows[:listed])
        raise DatasetError(shown + (" ..." if len(rows) > listed else ""))


def listing(files: DataFrame, masks: bool) -> DataFrame:
    """Offences of a flat folder (columns name, is_dir): nested directories, lossy masks, ambiguous stems."""
    from tessera.operators import names
    from tessera.operators.pairing import collisions

    seen = files.filter(names.listed(F.col("name")))
    nested = offences(seen.filter("is_dir"), "nested_dir", F.col("name"))
    plain = seen.filter("not is_dir")
    wanted = names.MASK_EXTENSIONS if masks else names.IMAGE_EXTENSIONS
    same = collisions(plain.filter(names.has_extension(F.col("name"), wanted)), names.key(F.col("name")), "name")
    out = nested.unionByName(offences(same, "ambiguous_stem", F.col("key"), F.array_join("names", ", ")))
    if masks:
        other = names.has_extension(F.col("name"), names.IMAGE_EXTENSIONS) & ~names.has_extension(F.col("name"), names.MASK_EXTENSIONS)
        out = out.unionByName(offences(plain.filter(other), "lossy_mask_format", F.col("name")))
    return out


def samples(rows: DataFrame) -> DataFrame:
    """Offences of analysed samples: size mismatch, empty mask, all components removed, box out of bounds."""
    from tessera.operators.geometry import box_in_bounds

    anomaly = F.col("mask_width").isNotNull()
    outside = F.exists("boxes", lambda b: ~box_in_bounds(b["x"], b["y"], b["w"], b["h"], F.col("width"), F.col("height")))
    reason = first_true(
        ("dimension_mismatch", anomaly & ((F.col("mask_width") != F.col("width")) | (F.col("mask_height") != F.col("height")))),
        ("empty_mask", anomaly & (F.col("foreground_pixels") == 0)),
        ("all_filtered", anomaly & (F.size("boxes") == 0)),
        ("out_of_bounds", outside),
    )
    return offences(rows.withColumn("_reason", reason).filter("_reason is not null"), F.col("_reason"), F.col("name"))


def settings(rows: DataFrame) -> DataFrame:
    """Offences of dotted settings (key, value): numbers and flags out of their ranges."""
    k, v = F.col("key"), F.col("value")
    whole = v.rlike(r"^\d{1,18}$")
    n = v.try_cast("long")
    is_ = lambda *names: F.element_at(F.split(k, r"\."), -1).isin(*names)
    reason = first_true(
        ("not_positive", is_("epochs", "batch", "imgsz") & ~(whole & F.coalesce(n > 0, F.lit(False)))),
        ("negative", is_("workers", "patience", "seed") & ~whole),
        ("not_multiple_of_32", is_("imgsz") & F.coalesce(n % 32 != 0, F.lit(False))),
        ("not_boolean", is_("amp", "evaluate_test", "export_onnx") & ~v.isin("true", "false")),
        ("below_60", is_("max_seconds") & ~(whole & F.coalesce(n >= 60, F.lit(False)))),
    )
    return offences(rows.withColumn("_reason", reason).filter("_reason is not null"), F.col("_reason"), k, v)
