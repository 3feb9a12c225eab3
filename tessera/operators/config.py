"""Configuration overlays: nested mappings on the driver, and their dotted form as rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.checks import DatasetError


Path = tuple[str, ...]


def leaves(tree: dict) -> dict[Path, Any]:
    """All that is no mapping (or an empty one), by its path."""
    todo: list[tuple[Path, Any]] = [((), tree)]
    out: dict[Path, Any] = {}
    while todo:
        path, value = todo.pop()
        if isinstance(value, dict) and (value or not path):
            todo += [((*path, k), v) for k, v in reversed(value.items())]
        else:
            out[path] = value
    return out


def rebuilt(found: dict[Path, Any]) -> dict:
    """The tree of such leaves."""
    out: dict = {}
    for path, value in found.items():
        at = out
        for k in path[:-1]:
            at = at.setdefault(k, {})
        at[path[-1]] = value
    return out


def overlay(low: dict, high: dict) -> dict:
    """low with the leaves of high, by the rule of overlaid(): paths that low lacks, and values where low has a
    mapping, are errors. What is a value in low is replaced by whatever high has there."""
    out = leaves(low)
    inner = {p[:k] for p in out for k in range(1, len(p))} | {p for p, v in out.items() if v == {}}
    for path, value in leaves(high).items():
        known = next((path[:k] for k in range(1, len(path) + 1) if path[:k] in out and path[:k] not in inner), None)
        if path in inner:
            if value != {}:
                raise DatasetError(f"not_mapping: {'.'.join(path)}")
        elif known is None:
            raise DatasetError(f"unknown_key: {'.'.join(path)}")
        else:
            at = high
            for k in known:
                at = at[k]
            out[known] = at
    return rebuilt(out)


def picked(tree: dict, names: tuple[str, ...]) -> dict:
    """The named keys that are there, in the given order."""
    return {k: tree[k] for k in names if k in tree}


def numbers(tree: dict) -> dict[str, float]:
    """All values as floats."""
    return {k: float(v) for k, v in tree.items()}


def dotted(tree: dict, at: str = "") -> list[tuple[str, str]]:
    """Leaves as (dotted key, text)."""
    out: list[tuple[str, str]] = []
    for key, value in tree.items():
        out += dotted(value, f"{at}{key}.") if isinstance(value, dict) else [(f"{at}{key}", text(value))]
    return out


def text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def overlaid(layers: DataFrame) -> DataFrame:
    """key, value and status of layered settings (layer 0 is the base): the highest layer that has a key wins; keys
    that the base lacks have status unknown_key."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("layer")))
    lowest = F.min("layer").over(Window.partitionBy("key"))
    rows = layers.withColumn("_rank", rank).withColumn("_lowest", lowest).filter("_rank = 1")
    return rows.select("key", "value", F.when(F.col("_lowest") > 0, "unknown_key").otherwise("ok").alias("status"))
