"""Archive members: path guards, duplicates and limits as columns; a reader that yields members of tar.gz files."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most members and most bytes of an archive.
MOST_MEMBERS, MOST_BYTES = 20_000, 5 << 30
#: Members, and bytes of their content, that leave a worker together.
BATCH_MEMBERS, BATCH_BYTES = 1000, 16 << 20


def path_fault(name: Column) -> Column:
    """absolute, parent, backslash or colon for an unsafe path; null for a safe one."""
    return F.when(name.startswith("/"), "absolute").when(F.array_contains(F.split(name, "/"), ".."), "parent").when(name.contains("\\"), "backslash").when(name.contains(":"), "colon")


def guarded(members: DataFrame, archive: str, order: str) -> DataFrame:
    """members (name, kind, size) with fault: path faults, types other than file and dir, repeated files."""
    nth = F.row_number().over(Window.partitionBy(archive, "name").orderBy(order))
    repeated = (F.col("kind") == "file") & (F.col("_nth") > 1)
    fault = F.coalesce(path_fault(F.col("name")), F.when(~F.col("kind").isin("file", "dir"), "type"), F.when(repeated, "duplicate"))
    return members.withColumn("_nth", nth).withColumn("fault", fault).drop("_nth")


def totals(members: DataFrame, archive: str) -> DataFrame:
    """archive, members, bytes and whether either is beyond its limit."""
    got = members.groupBy(archive).agg(F.count(F.lit(1)).alias("members"), F.sum("size").cast("long").alias("bytes"))
    return got.withColumn("beyond_limits", (F.col("members") > MOST_MEMBERS) | (F.col("bytes") > MOST_BYTES))


def read_members(files: DataFrame, with_content: bool = False, most_members: int = MOST_MEMBERS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """path, n, name, kind, size and, if asked for, content of the members of tar.gz files (binaryFile rows).

    Reading stops at the first member beyond a limit, which is still listed so that totals() tells; members leave in
    batches of BATCH_MEMBERS rows or BATCH_BYTES of content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                total = 0
                with tarfile.open(fileobj=io.BytesIO(data), mode="r:gz") as tar:
                    for n, m in enumerate(tar):
                        kind = "file" if m.isreg() else "dir" if m.isdir() else "link" if m.issym() or m.islnk() else "other"
                        row = {"path": path, "n": n, "name": m.name, "kind": kind, "size": m.size}
                        total += m.size
                        over = n >= most_members or total > most_bytes
                        if with_content:
                            row["content"] = tar.extractfile(m).read() if kind == "file" and not over else None
                            held += m.size
                        rows.append(row)
                        if len(rows) >= BATCH_MEMBERS or held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                        if over:
                            break
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    fields = [("path", pa.string()), ("n", pa.int64()), ("name", pa.string()), ("kind", pa.string()), ("size", pa.int64())] + [("content", pa.binary())] * with_content
    schema = pa.schema(fields)
    return files.select("path", "content").mapInArrow(run, "path string, n long, name string, kind string, size long" + ", content binary" * with_content)
