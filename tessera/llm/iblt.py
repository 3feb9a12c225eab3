"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame expressions alone.

A text's paragraphs are its lines, long lines being cut after PIECE_WORDS words; each has a 64-bit digest, and a text
is the set of its digests (a repeated paragraph counts once). A sketch adds each digest to three cells (count, xor of
digests, xor of checks). Subtracting two sketches leaves the differing digests, which peeling recovers: a cell that
holds one digest (its check proves it) gives it up, which may free others. The fingerprint is a sketch of CELLS cells;
where it is too small for a difference, the pair is tried again with larger sketches, split into groups of cells by
digest so that the work stays near linear, under a new seed each time. The likeness of two texts is the Jaccard
quotient of their digest sets, from the recovered difference. Should all sizes fail (about once in 100,000 pairs
of wholly different texts), the two digest arrays themselves are compared.

Defined results: null and empty texts, and texts of white space alone, have no paragraph; two such are alike (1.0).
The next document is the next lower doc_id, after the lowest the highest; rows that share an id follow each other in
the order of their texts' hashes (and meet in parts by these, should an id be shared by over a thousandth of all rows),
rows without an id come last, in the same order; a single document is its own next. All rows are
returned; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import texts

PIECE_WORDS, PIECE_CHARS = 32, 64
#: Cells in each of the three rows of the fingerprint, of a group of the larger sketches, and of a group that failed once
#: (a digest's cells are bits of a long, so 21 at most).
ROW, GROUP_ROW, GROUP_AGAIN = 16, 8, 20
#: Digests of both texts for each group of cells, at the first and second larger size; rounds of peeling.
LOADS = (8, 2)
ROUNDS = 7
#: Rows of a bucket of neighbouring ids, and buckets at most: SEGMENTS quantiles of as many equal parts. An id that fills
#: the space between two of QUANTILES is hot: it is a segment of its own, in parts by the texts' hashes.
BUCKET_ROWS, SEGMENTS, PARTS, QUANTILES = 64, 64, 4096, 1024
LOWEST = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    pattern = rf"(?:[^\s]{{1,{PIECE_CHARS}}}+[^\S\n]*+){{1,{PIECE_WORDS}}}+"
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(found, lambda u: F.xxhash64(u)))


def check(key: Column, seed: int) -> Column:
    """A digest's check, whose bits also choose its cells."""
    return F.xxhash64(key, F.lit(seed))


def item(key: Column, sign: Column, row: int, seed: int) -> Column:
    """A digest to add (sign 1) or take out (-1): h, its check, and m, a bit for its cell in each of the three rows."""

    def of(h: Column) -> Column:
        place = lambda j: (F.shiftrightunsigned(h, 20 + 14 * j).bitwiseAND(F.lit(0x3FFF)) % row + j * row).cast("int")
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place(j)) for j in range(3)]
        return F.struct(key.alias("k"), h.alias("h"), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).alias("m"), sign.alias("s"))

    return let(check(key, seed), of)


def added(cell: Column, items: Column, i: Column) -> Column:
    """Cell i with those of the items that fall into it."""
    new = lambda y, q: F.struct((y["c"] + q["s"]).alias("c"), y["k"].bitwiseXOR(q["k"]).alias("k"), y["h"].bitwiseXOR(q["h"]).alias("h"))
    return F.aggregate(items, cell, lambda y, q: F.when(F.call_function("getbit", q["m"], i) == 1, new(y, q)).otherwise(y))


def sketch(keys: Column, row: int = ROW, seed: int = 0, less: Column | None = None) -> Column:
    """The cells of a set of digests; with less, those of the difference of two sketches (cells are sums)."""
    zero = F.struct(F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("h"))
    cells = F.array(*map(F.lit, range(3 * row)))
    items = F.transform(keys, lambda k: item(k, F.lit(1), row, seed))
    if less is not None:
        items = F.concat(items, F.transform(less, lambda k: item(k, F.lit(-1), row, seed)))
    return let(items, lambda q: F.transform(cells, lambda i: added(zero, q, i)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")))


def peel(cells: Column, row: int, seed: int) -> Column:
    """Of a difference of sketches: ok (all cells emptied), and the digests left over on either side."""
    none = F.array().cast("array<bigint>")
    start = F.struct(cells.alias("t"), none.alias("a"), none.alias("b"), F.lit(True).alias("go"))
    alone = lambda x: (F.abs(x["c"]) == 1) & (check(x["k"], seed) == x["h"])

    def taken(s: Column, pure: Column) -> Column:
        side = lambda sign: F.array_distinct(F.transform(F.filter(pure, lambda x: x["c"] == sign), lambda x: x["k"]))

        def without(d: Column) -> Column:
            signed = lambda keys, sign: F.transform(keys, lambda k: item(k, F.lit(sign), row, seed))
            items = F.concat(signed(d["a"], -1), signed(d["b"], 1))
            rest = let(items, lambda q: F.transform(s["t"], lambda x, i: added(x, q, i)))
            return F.struct(rest.alias("t"), F.concat(s["a"], d["a"]).alias("a"), F.concat(s["b"], d["b"]).alias("b"), F.lit(True).alias("go"))

        return let(F.struct(side(1).alias("a"), side(-1).alias("b")), without)

    over = lambda s: F.struct(s["t"].alias("t"), s["a"].alias("a"), s["b"].alias("b"), F.lit(False).alias("go"))
    turn = lambda s: let(F.filter(s["t"], alone), lambda pure: F.when(F.size(pure) > 0, taken(s, pure)).otherwise(over(s)))
    step = lambda s, _: F.when(s["go"], turn(s)).otherwise(s)
    done = lambda s: F.struct(F.forall(s["t"], lambda x: (x["c"] == 0) & (x["h"] == 0)).alias("ok"), s["a"].alias("a"), s["b"].alias("b"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step, done)


def larger(a: Column, b: Column, load: int, seed: int) -> Column:
    """peel() over groups of cells, so many that each has about load digests of both sets; split in two steps."""
    bits = F.greatest(F.ceil(F.log2((F.size(a) + F.size(b) + 1) / F.lit(float(load)))), F.lit(0)).cast("int")
    high = F.shiftright(bits + 1, 1)
    groups = lambda n: F.sequence(F.lit(0), F.pow(F.lit(2.0), n).cast("int") - 1)

    def of(keys: Column, shift: int, n: Column, i: Column) -> Column:
        mask = F.pow(F.lit(2.0), n).cast("long") - 1
        return F.filter(keys, lambda k: F.shiftrightunsigned(check(k, seed), shift).bitwiseAND(mask) == i)

    def inner(x: Column, y: Column, n: Column) -> Column:
        at = lambda p, q, row, salt: peel(sketch(p, row, salt, q), row, salt)
        again = lambda s: let(at(s["x"], s["y"], GROUP_ROW, seed), lambda r: F.when(r["ok"], r).otherwise(at(s["x"], s["y"], GROUP_AGAIN, seed + 100)))
        return F.transform(groups(n), lambda j: let(F.struct(of(x, 10, n, j).alias("x"), of(y, 10, n, j).alias("y")), again))

    def outer(n: Column) -> Column:
        both = lambda i: F.struct(of(a, 0, n["h"], i).alias("x"), of(b, 0, n["h"], i).alias("y"))
        parts = F.transform(groups(n["h"]), lambda i: let(both(i), lambda s: inner(s["x"], s["y"], n["l"])))
        return let(F.flatten(parts), joined)

    joined = lambda g: F.struct(F.forall(g, lambda x: x["ok"]).alias("ok"), F.flatten(F.transform(g, lambda x: x["a"])).alias("a"), F.flatten(F.transform(g, lambda x: x["b"])).alias("b"))
    return let(F.struct(high.alias("h"), (bits - high).alias("l")), outer)


def with_differences(rows: DataFrame, a: str, others: list[str], out: str) -> DataFrame:
    """rows with out: for each of the others, digests of a alone and of it alone (columns of digests d and sketch s).

    By the fingerprints first, then by larger and larger sketches. Each try is a projection of its own, as one
    expression of all would nest deeper than the analyser goes; a pair that has its answer skips the later tries.
    """
    x, s = F.col(f"{a}.d"), F.col(f"{a}.s")

    def first(o: Column) -> Column:
        small = F.abs(F.size(x) - F.size(o["d"])) <= 3 * ROW
        return F.struct(o["d"].alias("y"), F.when(small, peel(subtract(s, o["s"]), ROW, 0)).alias("r"), F.lit(1).alias("tries"))

    def tries(again: Callable[[Column], Column]) -> DataFrame:
        one = lambda o: F.struct(o["y"].alias("y"), F.when(o["r"]["ok"], o["r"]).otherwise(again(o["y"])).alias("r"), (o["tries"] + F.when(o["r"]["ok"], 0).otherwise(1)).alias("tries"))
        return rows.withColumn(out, F.transform(out, one))

    rows = rows.withColumn(out, F.transform(F.array(*map(F.col, others)), first))
    for k, load in enumerate(LOADS, 1):
        rows = tries(lambda y: larger(x, y, load, k))
    return tries(lambda y: F.struct(F.lit(True).alias("ok"), F.array_except(x, y).alias("a"), F.array_except(y, x).alias("b")))


def likeness(n_a: Column, n_b: Column, diff: Column) -> Column:
    """Jaccard quotient of two sets of these sizes and difference; 1 if both are empty."""
    union = n_a + F.size(diff["b"])
    return F.when(union == 0, F.lit(1.0)).otherwise((n_a - F.size(diff["a"])).cast("double") / union)


def written(n: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of digests, then count, digests and half the checks of each cell in hex."""
    two = lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFF))), 2, "0")
    cell = lambda x: F.concat(two(x["c"]), F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["h"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.lower(F.concat(n.cast("string"), F.lit(":"), F.array_join(F.transform(cells, cell), "")))


def with_next(docs: DataFrame) -> DataFrame:
    """text and the next document's text (descending doc_id, after the last the first), with one shuffle of texts.

    Ids fall into buckets of neighbouring ids: quantiles, each cut into equal parts. The first row of each bucket is
    also sent to the bucket before it, so that every row meets the next one; the list of first rows is bounded by the
    number of buckets.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(LOWEST))).withColumn("h", F.xxhash64("text"))
    share = [k / QUANTILES for k in range(QUANTILES + 1)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("none"), F.percentile_approx("doc_id", share, 20_000).alias("q")).first()
    q = [int(x) for x in found.q or [0]]
    shares = {x: n / QUANTILES for x, n in Counter(q).items() if n > 2 and x < -(LOWEST + 1)}
    if found.none * QUANTILES > found.n:
        shares[LOWEST] = found.none / found.n
    bounds = sorted({*q[:: QUANTILES // SEGMENTS], *shares, *(x + 1 for x in shares)})
    usual = max(1, min(PARTS, round(found.n / BUCKET_ROWS / max(1, len(bounds) - 1))))
    parts = [max(1, min(PARTS, round(found.n * shares[x] / BUCKET_ROWS))) if x in shares else usual for x in bounds]
    widths = [max(1.0, (b - a) / n) for a, b, n in zip(bounds, bounds[1:], parts)] + [1.0]
    each = F.array(*(F.struct(F.lit(x).cast("bigint").alias("low"), F.lit(w).alias("width"), F.lit(n).alias("parts"), F.lit(x in shares).alias("hot")) for x, w, n in zip(bounds, widths, parts)))
    at = F.greatest(F.size(F.filter(each, lambda x: x["low"] <= F.col("key"))) - 1, F.lit(0))
    rows = rows.withColumn("at", at).withColumn("own", F.get(each, F.col("at")))
    by_id = F.floor((F.col("key").cast("double") - F.col("own.low").cast("double")) / F.col("own.width"))
    by_hash = F.col("own.parts") - 1 - F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * F.col("own.parts"))
    part = F.greatest(F.least(F.when(F.col("own.hot"), by_hash).otherwise(by_id), F.col("own.parts") - 1), F.lit(0))
    rows = rows.withColumn("bucket", (F.col("at") * PARTS + part).cast("int")).drop("at", "own")
    # in descending order of ids, then by hashes, the first row of a bucket: of the largest id the least hash
    first = F.max(F.struct("key", F.bitwise_not("h").alias("less"))).alias("f")
    firsts = sorted((r.bucket, r.f.key, ~r.f.less) for r in rows.groupBy("bucket").agg(first).collect())
    lent = [(key, h, firsts[(i + 1) % len(firsts)][0]) for i, (_, key, h) in enumerate(firsts)]
    lent = spark.createDataFrame(lent, "key long, h long, borrower int")
    homes = F.when(F.col("borrower").isNull(), F.array(F.struct(F.col("bucket"), F.lit(0).alias("lent")))).otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("lent")), F.struct(F.col("borrower").alias("bucket"), F.lit(1).alias("lent"))))
    dealt = rows.join(F.broadcast(lent), ["key", "h"], "left").select("doc_id", "text", "key", "h", F.explode(homes).alias("home")).select("doc_id", "text", "key", "h", "home.bucket", "home.lent")
    order = Window.partitionBy("bucket").orderBy("lent", F.desc("key"), "h")
    text = F.coalesce("text", F.lit(""))
    return dealt.withColumn("next_text", F.lead(text).over(order)).filter("lent = 0").select("doc_id", text.alias("text"), "next_text")


def fingerprint(text: Column) -> Column:
    """d: the digests, s: the sketch of a text."""
    return let(digests(text), lambda d: F.struct(d.alias("d"), sketch(d).alias("s")))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next document."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *(fingerprint(F.col(x)).alias(y) for x, y in (("text", "f"), ("edited", "e"), ("next_text", "x"))))
    size = lambda s: F.size(f"{s}.d")
    rows = with_differences(rows, "f", ["e", "x"], "diff")
    to_edited, to_next = F.get("diff", F.lit(0))["r"], F.get("diff", F.lit(1))["r"]
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        written(size("f"), F.col("f.s")).alias("fingerprint"),
        written(size("e"), F.col("e.s")).alias("edited_fingerprint"),
        likeness(size("f"), size("e"), to_edited).alias("near_edited"),
        likeness(size("f"), size("x"), to_next).alias("near_next"),
        F.size(to_edited["a"]).alias("n_removed"), F.size(to_edited["b"]).alias("n_added"),
        *(F.get("diff", F.lit(k))["tries"].alias(f"tries_{x}") for k, x in enumerate(("edited", "next"))),
    )
