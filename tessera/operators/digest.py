"""Digests, exact duplicates, conflicting annotations, leakage between splits, ordered fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def pixel_digest(width: Column, height: Column, pixels: Column) -> Column:
    """The digest of decoded pixels, told apart by size."""
    head = F.encode(F.concat(width.cast("string"), F.lit("x"), height.cast("string"), F.lit(":RGB:")), "UTF-8")
    return F.sha2(F.concat(head, pixels), 256)


def duplicate_groups(rows: DataFrame, digest: str, name: str) -> DataFrame:
    """digest, n, first and the sorted names of every digest that several rows share.

    All names of a group are one array; duplicate_members gives them as rows where a group may outgrow that.
    """
    groups = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("first")).filter("n > 1")
    members = duplicate_members(rows, digest, name).groupBy(digest).agg(F.array_sort(F.collect_list(name)).alias("members"))
    return groups.join(members, digest, "left")


def duplicate_members(rows: DataFrame, digest: str, name: str) -> DataFrame:
    """digest, n, first and name, a row for each of the rows whose digest several share.

    Counts and the first name are summed before the shuffle and joined back, so no group is gathered.
    """
    groups = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("first")).filter("n > 1")
    return rows.select(digest, name).join(groups, digest).select(digest, "n", "first", name)


def conflicts(rows: DataFrame, digest: str, *parts: str) -> DataFrame:
    """digest and n_variants of groups of equal content that differ in the parts (null is a value of its own, not '')."""
    variant = F.to_json(F.struct(*(F.col(p).cast("string").alias(f"p{k}") for k, p in enumerate(parts))), {"ignoreNullFields": "false"})
    return rows.select(digest, variant.alias("variant")).distinct().groupBy(digest).agg(F.count(F.lit(1)).alias("n_variants")).filter("n_variants > 1")


def leaks(rows: DataFrame, split: str, **digests: str) -> DataFrame:
    """kind, digest and sorted splits of every digest found in several splits; repeats inside a split are no leak."""
    tagged = [rows.select(F.lit(kind).alias("kind"), F.col(c).alias("digest"), F.col(split).alias("split")) for kind, c in digests.items()]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    found = every.filter(F.col("digest").isNotNull()).groupBy("kind", "digest").agg(F.array_sort(F.collect_set("split")).alias("splits"))
    return found.filter(F.size("splits") > 1)


def json_text(text: Column) -> Column:
    """A string as JSON in ASCII, quotes included: short escapes where JSON has them, else four hexadecimal digits, two
    such for characters beyond the basic plane."""
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n.cast("long")), 4, "0")))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        out = F.when(n < 0x20, unit(n)).when(n < 0x7F, c).when(n < 0x10000, unit(n))
        out = out.otherwise(F.concat(unit(F.floor((n - 0x10000) / 0x400) + 0xD800), unit((n - 0x10000) % 0x400 + 0xDC00)))
        for k, v in short.items():
            out = F.when(c == k, F.lit(v)).otherwise(out)
        return out

    each = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: one(F.substring(text, i, F.lit(1))))
    plain = text.rlike(r"^[ !#-\[\]-~]*$")
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(F.array_join(each, "")), F.lit('"'))


def file_json(path: Column, digest: Column, size: Column) -> Column:
    """One entry of a file list as JSON text with sorted keys and spaces after separators, ASCII paths."""
    return F.concat(F.lit('{"bytes": '), size.cast("string"), F.lit(', "path": '), json_text(path), F.lit(', "sha256": "'), digest, F.lit('"}'))


def fingerprint(files: DataFrame, order: list[str], by: str | None = None) -> DataFrame:
    """sha256 of the JSON text of the ordered file list (columns path, sha256, bytes), of each value of by if given.

    The list is part of the definition, so one task holds it: about 150 bytes a file, never the files.
    """
    entry = F.struct(*order, file_json(F.col("path"), F.col("sha256"), F.col("bytes")).alias("json"))
    listed = F.array_sort(F.collect_list(entry))
    text = F.concat(F.lit("["), F.array_join(F.transform(listed, lambda e: e["json"]), ", "), F.lit("]"))
    groups = files.groupBy(by) if by else files.groupBy()
    return groups.agg(F.count(F.lit(1)).alias("n_files"), F.sha2(text, 256).alias("fingerprint"))
