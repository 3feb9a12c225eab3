"""What several operators share: the shared folder, checkpoints, batch bounds and table readers."""

from __future__ import annotations

import os
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import shared_dir

#: Rows that go to a Python worker at once; bounds the memory of a batch of long texts.
BATCH_ROWS = 512
#: Characters of texts that are encoded together.
TOGETHER = 1 << 23
#: A driver whose heap may take at most so many bytes collects its garbage, after so many seconds again.
SMALL_HEAP, TIDY_S = 4 << 30, 10
#: Ids of a label that are ranked, as a multiple of those wanted, and labels that can be learned.
SLACK, MOST_LABELS = 4, 1000


def settled(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared folder: computed once, and read again if an executor is lost."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    tidy(df.sparkSession)
    return out


_TIDIED = [0.0]


def tidy(spark: SparkSession) -> None:
    """Have a small driver collect its garbage, if TIDY_S have passed since the last time.

    Steps leave plans and the states of tasks and stages, hardly any of which lives on, but its heap grows by them and stays
    large until a full collection.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if time.monotonic() - _TIDIED[0] >= TIDY_S and heap.maxMemory() <= SMALL_HEAP:
        spark._jvm.java.lang.System.gc()
        _TIDIED[0] = time.monotonic()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that an operator wrote and nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that no other column, whatever its name, can clash with what an operator adds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo so many; an unlabelled id (null) counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def together(batches: Iterator[pa.RecordBatch], most: int = TOGETHER) -> Iterator[tuple[pa.Array, list[str]]]:
    """doc_ids and texts of consecutive rows, of most characters or what one text has beyond."""
    doc_ids: list[pa.Array] = []
    held: list[str] = []
    size = 0
    for b in batches:
        ids, first = b.column("doc_id"), 0
        for k, t in enumerate(b.column("text"), 1):
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size >= most:
                yield pa.concat_arrays([*doc_ids, ids[first:k]]), held
                doc_ids, held, size, first = [], [], 0, k
        if first < len(ids):
            doc_ids.append(ids[first:])
    if held:
        yield pa.concat_arrays(doc_ids), held


def told_apart(texts_: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of texts cut at each space, which of them each word is, and where each text's words begin.

    Arrow cuts and compares, so Python sees each distinct word of a batch once.
    """
    cut = pc.split_pattern(texts_, " ")
    words = cut.values.dictionary_encode()
    # distinct words have no spaces: put one after each and split, which is the quick way to Python's strings
    spaced = pc.binary_join_element_wise(words.dictionary, *(pa.scalar(x, pa.large_string()) for x in ("", " ")))
    return spaced.buffers()[2].to_pybytes().decode().split(" ")[: len(spaced)], words.indices.to_numpy(), cut.offsets.to_numpy()


def gathered(runs: list[bytes], width: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs (of values of width bytes) in the order of which, as bytes rows, and the size of each."""
    size = np.fromiter(map(len, runs), np.int64, len(runs)) // width
    start = np.cumsum(size) - size
    n = size[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(size.sum())) < 1 << 31 else np.int64
    step = np.repeat((start[which] - (ends - n)).astype(kind), n)
    step += np.arange(total, dtype=kind)
    return np.frombuffer(b"".join(runs), {1: np.uint8, 4: np.dtype("<u4")}[width]).take(step), n


def local_path(uri: str) -> str | None:
    """The path of a file: URI or plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if os.path.isabs(uri) else None


def labelled_sample(rows: DataFrame, label: str, per_label: int, total: int, max_chars: int) -> list:
    """At most per_label rows (doc_id, text, label) of each label and about total in all, in an order fixed by id and text.

    The bounds are the caller's documented parameters; of a longer text its first max_chars characters are taken, so what
    comes to the driver is at most total * max_chars characters. Ids below a cut-off of a uniform hash, about
    SLACK * per_label of each of the MOST_LABELS most frequent labels, are ranked on the driver; texts are then fetched for
    those taken. An id that several rows share counts once, by its least text.
    """
    fit = rows.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    fit = fit.withColumn("text", F.substring("text", 1, max_chars))
    place = F.xxhash64("doc_id")
    counts = fit.groupBy(label).agg(F.approx_count_distinct("doc_id").alias("n")).orderBy(F.desc("n"), label).limit(MOST_LABELS).collect()
    cut = F.lit(None).cast("long")
    for r in counts:
        below = (1 << 63) - 1 if r.n <= SLACK * per_label else -(1 << 63) + (1 << 64) * SLACK * per_label // r.n
        cut = F.when(F.col(label) == r[0], F.lit(below)).otherwise(cut)
    near = sorted((r.place, r.doc_id, r[1]) for r in fit.filter(place <= cut).select("doc_id", label, place.alias("place")).distinct().collect())
    seen: dict = {}
    ranked = []
    for _, d, y in near:
        seen[y] = seen.get(y, 0) + 1
        if seen[y] <= per_label:
            ranked.append((seen[y], y, d))
    ids = sorted({d for _, _, d in sorted(ranked)[:total]})
    taken = rows.sparkSession.createDataFrame([(d,) for d in ids], "doc_id long")
    texts_ = fit.join(F.broadcast(taken), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", label)).alias("r"))
    return texts_.select("doc_id", "r.text", F.col("r").getField(label).alias(label)).collect()
