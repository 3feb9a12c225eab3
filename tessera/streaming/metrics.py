"""Metrics out of log lines, in batches or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What begins a metric in a line, unless the caller names another mark.
MARK = "METRIC"
#: The names that are watched.
WATCHED = ("metrics/mAP50(B)", "metrics/mAP50-95(B)")


def metric_value(line: Column, name: str, mark: str = MARK) -> Column:
    """The value of one metric in a line, or null."""
    quoted = "".join(c if c.isalnum() or c in "/-_" else "\\" + c for c in name)
    found = F.regexp_extract(line, rf"{mark} {quoted}=([0-9.eE+\-]+)", 1)
    return F.when(found != "", found).try_cast("double")


def extracted(lines: DataFrame, column: str = "value", names: tuple[str, ...] = WATCHED, mark: str = MARK) -> DataFrame:
    """lines that report a watched metric, with its name and value; append-only, so fit for streams."""
    each = F.array(*(F.struct(F.lit(n).alias("metric"), metric_value(F.col(column), n, mark).alias("metric_value")) for n in names))
    return lines.select("*", F.explode(F.filter(each, lambda x: x["metric_value"].isNotNull())).alias("_m")).select(*lines.columns, "_m.metric", "_m.metric_value")


def stream(spark: SparkSession, folder: str, mark: str = MARK) -> DataFrame:
    """Watched metrics of the text files that appear in a folder."""
    return extracted(spark.readStream.text(folder), mark=mark)


def line(values: dict, mark: str = MARK) -> str:
    """The line that reports metrics, one after another."""
    return " ".join(f"{mark} {k}={float(v)}" for k, v in values.items())
