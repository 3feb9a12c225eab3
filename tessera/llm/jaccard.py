"""SimHash near-duplicates at a wide radius: texts whose sets of word shingles have a Jaccard similarity of `least`.

Fingerprints within simhash.RADIUS bits are candidates by the shards and BK-trees of simhash.shard_edges, all of them. At
a similarity of 0.8 two fingerprints of 64 bits differ in about 10 bits and seldom in over 20, too many for shards by
blocks of their bits, so texts farther apart meet in shards keyed by min-hashes besides: candidates share one of BANDS
bands of ROWS min-hashes each, a pair at similarity 0.8 is missed with probability (1 - 0.8 ** ROWS) ** BANDS, about 1 in
8 million, and a closer one more rarely. Either kind is joined by stars, never by pairs; each group of candidates builds a
BK-tree of its fingerprints, follows only edges within RADIUS bits, and of the pairs that this leaves each is a link
only if the exact similarity of its sets reaches `least`. Two members already in one component are not compared. A group
of over GROUP members is confirmed by pairs of its blocks, so a task holds the sets of two blocks and no more.

Words are those of simhash (white space between, A-Z as a-z), a text of fewer words than a shingle is one shingle, and
shingles are compared by their 64-bit hashes; a fingerprint counts each distinct shingle once.

Defined results: texts without a word (null, empty) are alike; equal sets are one node, so repeated rows and ties fall
into one component; component_id is the smallest doc_id of a component (null only if all its ids are null); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import settled, small_batches, texts

SHINGLE_WORDS, LEAST = 5, 0.8
#: Bits in which fingerprints of alike sets differ at most: beyond 28 lies one pair at 0.8 in 100 million (binomial, 64
#: bits that differ with probability arccos(8/9) / pi each).
RADIUS = 28
BANDS, ROWS = 40, 5
#: Members of a group of candidates that are confirmed at once; of a larger group, every two blocks of about so many.
GROUP = 2000
#: Large groups that go to all tasks at most.
MOST_LISTED = 100_000
#: Shingles that a set has at least if its fingerprint may rule out a pair.
FEW = 20
#: Hashes whose min-hashes are taken at once.
CHUNK = 4096
_RANDOM = np.random.default_rng(simhash.SEED)
FACTORS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingles(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The hashes of the distinct shingles, ascending."""
    return np.unique(simhash.hashes(text, width))


def bands(found: np.ndarray) -> list[int]:
    """One signed number a band: the hash of its min-hashes and its place."""
    h = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), CHUNK):
        np.minimum(least, (FACTORS[:, None] * h[None, k : k + CHUNK] + SHIFTS[:, None]).min(axis=1), out=least)
    raw = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(raw[k].tobytes(), k) for k in range(BANDS)], np.uint64).view(np.int64).tolist()


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets reach the similarity."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    if not len(a) and not len(b):
        return True
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return both >= least * (len(a) + len(b) - both)


def groups(sets: list[np.ndarray], least: float, radius: int | None = None) -> list[int]:
    """For each set the index of the first member of its component.

    Pairs come from a BK-tree of the sets' fingerprints; small sets, whose bits vary more, are compared without it.
    """
    label = list(range(len(sets)))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    fps = np.array([simhash.majority(s) for s in sets], np.uint64)
    if radius is None:
        radius = RADIUS if min(map(len, sets)) >= FEW else 64
    roots, stale = np.arange(len(sets)), False
    for a, b in simhash.BKTree(fps).links(roots, radius):
        if stale:
            roots, stale = np.array([root(i) for i in range(len(sets))]), False
        at = np.nonzero((a < b) & (roots[a] != roots[b]))[0]  # a pair comes both ways
        for i, j in zip(a[at].tolist(), b[at].tolist()):
            if (x := root(i)) != (y := root(j)) and alike(sets[i], sets[j], least):
                label[max(x, y)] = min(x, y)
                stale = True
    return [root(i) for i in range(len(sets))]


def _marked(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, the digests of the text and of its set, the set's fingerprint and the bands."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t, width) for t in b.column("text").to_pylist()]
            keys = pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in found], pa.string())
            fps = pa.array(np.array([simhash.majority(s) for s in found], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), keys, fps, pa.array([bands(s) for s in found], pa.list_(pa.int64()))], ["doc_id", "digest", "key", "fp", "bands"])

    return texts(docs).withColumn("digest", simhash.digest(F.col("text"))).mapInArrow(run, "doc_id long, digest string, key string, fp long, bands array<long>")


def _confirmed(width: int, least: float):
    """Of rows sorted by comp and part: (key, root) for each set that is not the first of its component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(keys: list[str], sets: list[np.ndarray]) -> pa.RecordBatch:
            got = [(keys[i], keys[r]) for i, r in enumerate(groups(sets, least)) if i != r]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], pa.string()) for k in (0, 1)], ["key", "root"])

        held, keys, sets = None, [], []
        for b in batches:
            for comp, part, key, text in zip(*(b.column(x).to_pylist() for x in ("comp", "part", "key", "text"))):
                if (comp, part) != held:
                    if len(sets) > 1:
                        yield solved(keys, sets)
                    held, keys, sets = (comp, part), [], []
                keys.append(key)
                sets.append(shingles(text, width))
        if len(sets) > 1:
            yield solved(keys, sets)

    return run


def near_edges(reps: DataFrame, total: int) -> DataFrame:
    """Edges (a, b) that connect exactly the keys whose fingerprints (column fp) are connected within simhash.RADIUS bits.

    The keys of a fingerprint are a star about the first of them, and the first ones have the shards' edges.
    """
    first = settled(reps.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")))
    linked = settled(simhash.shard_edges(first.select("fp")).distinct())
    hubs = simhash.hot_keys(linked.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b", linked.count())
    a, b = (first.select(F.col("fp").alias(f"_{x}"), F.col("first").alias(f"key_{x}")) for x in "ab")
    edges = simhash.spread_join(linked.join(a, F.col("a") == F.col("_a")), b, "b", "_b", hubs).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    several = first.filter("n > 1").select(F.col("fp").alias("_fp"), "first", "n")
    same = simhash.spread_join(reps.select("key", "fp"), several, "fp", "_fp", simhash.hot_keys(several, "_fp", total))
    return edges.unionByName(same.filter("key <> first").select(F.col("key").alias("a"), F.col("first").alias("b")))


def hub_edges(met: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what the rows (key, first) of met connect, the first keys of a key's bands.

    A key has at most BANDS of them. It goes to the least, and so do the others, as edges that near copies share: a group
    of n copies that meet in all bands gives about n edges instead of n * BANDS.
    """
    of = met.groupBy("key").agg(F.collect_set("first").alias("hubs"))
    least = F.array_min("hubs").alias("b")
    return of.select(F.explode(F.array_union(F.array("key"), "hubs")).alias("a"), least).filter("a <> b").distinct()


def members(docs: DataFrame, least: float = LEAST, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, digest (of the text), key (of the set) and component_id for every row of docs."""
    marked = settled(_marked(docs, width))
    reps = settled(marked.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("digest").alias("digest"), F.min("fp").alias("fp"), F.min("bands").alias("bands")))
    total = reps.count()
    banded = reps.select("key", F.explode("bands").alias("band"))
    shared = settled(banded.groupBy("band").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    often = simhash.hot_keys(shared, "band", total)
    stars = simhash.spread_join(banded, shared.select(F.col("band").alias("_band"), "first"), "band", "_band", often)
    stars = hub_edges(stars.select("key", "first")).unionByName(near_edges(reps, total)).distinct()
    candidates = settled(simhash.components(stars).select(F.col("node").alias("key"), F.col("comp").alias("own")).join(reps.select("key", "digest"), "key"))
    sizes = candidates.groupBy("own").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > GROUP).select(F.col("own").alias("comp"), F.ceil(F.col("n") / GROUP).cast("int").alias("blocks"))
    few = large.limit(MOST_LISTED + 1).count() <= MOST_LISTED
    # a member of a large group meets each of the group's blocks: its part names its own block and the other
    block = lambda: F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(j, block()).cast("long") * F.lit(1 << 31) + F.greatest(j, block()))
    marked_ = candidates.join(F.broadcast(large) if few else large, F.col("own") == F.col("comp"), "left")
    dealt = marked_.select("own", "key", "digest", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(parts)).alias("part"))
    bodies = texts(docs).filter(F.col("text").isNotNull()).groupBy(simhash.digest(F.col("text")).alias("digest")).agg(F.min("text").alias("text"))
    dealt = dealt.join(bodies, "digest").select(F.col("own").alias("comp"), "part", "key", "text").repartition("comp", "part").sortWithinPartitions("comp", "part", "key")
    links = settled(dealt.mapInArrow(_confirmed(width, least), "key string, root string"))
    if large.head(1):  # links of different parts meet
        linked = simhash.components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    else:
        linked = links.select(F.col("key").alias("node"), F.col("root").alias("comp"))
    return simhash.linked(marked.select("doc_id", "digest", "key"), reps, linked, "key")


def near_duplicates(docs: DataFrame, least: float = LEAST, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and component_id for every row of docs."""
    return members(docs, least, width).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, least: float = LEAST, width: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of docs that stand for their component, as simhash.chosen tells them."""
    found = settled(members(docs, least, width))
    return simhash.chosen(docs, found.select("doc_id", "digest", "comp"))
