"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming radius by BK-trees over shards.

A fingerprint within the radius r of another agrees with it in at least one of r + 1 blocks of bits, so each distinct
fingerprint goes to one shard per block, keyed by the block's first bits: as many as make shards of about SHARD
members, as long as the block has them. A shard builds a BK-tree (children keyed by integer distance to the parent, at
most LEAF members scanned together) and sends all its members through it as one block of queries, following only
edges within the radius. What leaves a shard is one row per member that has a link (member, root of its group in the
shard), never the pairs, so that a group of n near copies gives O(n) rows. Groups of shards are joined by min-label
propagation with pointer jumping, checkpointed each round. Keys that over a thousandth of all rows share (at most a
thousand, by counting) are joined where their rows are, so that no hub, component or copied text makes one task.

Defined results: a null or empty text has fingerprint zero and links like any other; equal texts share a
fingerprint, so repeated rows and ties fall into one component; component_id is the smallest doc_id of a component
(null only if all its ids are null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import settled, small_batches, texts

SHINGLE_WORDS, RADIUS, SEED = 3, 3, 42
#: Members that a shard has on average, and members of a BK-tree's node that are scanned instead of split.
SHARD, LEAF = 512, 16
#: A key is hot that more rows share than this and than a thousandth of all.
HOT = 1000
#: Rows of edges from which hot keys of components are looked for.
MANY = 1_000_000
#: Shingles whose bits are unpacked at once.
CHUNK = 65536
#: Members of a shard beyond which it is dealt again by further bits.
BIG = 20_000


def hashes(text: str | None, width: int) -> np.ndarray:
    """The hashes of all shingles in order; fewer words than a shingle are one, no words none."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone, and the white space 9 to 13 and 32
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))


def majority(found: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; no hashes: 0."""
    if not len(found):
        return 0
    found = found.astype("<u8", copy=False)
    total = np.zeros(64, np.int64)
    for k in range(0, len(found), CHUNK):
        total += np.unpackbits(found[k : k + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(found), bitorder="little").view("<u8")[0])


def simhash(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The majority of the hashes of a text's shingles, repeats included."""
    return majority(hashes(text, width))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, with_digest: bool = False) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit integer fp; if asked for, the digest of the text."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "fp"] + ["digest"] * with_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t, width) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp), *map(b.column, names[2:])], names)

    rows = texts(docs)
    rows = rows.withColumn("digest", digest(F.col("text"))) if with_digest else rows
    return rows.mapInArrow(run, "doc_id long, fp long" + ", digest string" * with_digest)


class BKTree:
    """A tree over fps (uint64): a node is a pivot and its children by distance, or a leaf of at most LEAF members.

    followed and pruned count the edges that searches took and left out.
    """

    def __init__(self, fps: np.ndarray, leaf: int = LEAF):
        self.fps, self.leaf = fps, leaf
        self.followed = self.pruned = 0
        self.root = self._build(np.arange(len(fps)))

    def _build(self, members: np.ndarray):
        if len(members) <= self.leaf:
            return members
        pivot, rest = members[0], members[1:]
        d = np.bitwise_count(self.fps[rest] ^ self.fps[pivot])
        order = np.argsort(d, kind="stable")
        d, rest = d[order], rest[order]
        cuts = np.nonzero(d[1:] != d[:-1])[0] + 1
        keys = d[np.concatenate([[0], cuts])].astype(np.int16)
        return pivot, keys, [self._build(m) if len(m) > self.leaf else m for m in np.split(rest, cuts)]

    def links(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index arrays (query, member) of links, some at a time; edges beyond the radius are not followed."""
        todo = [(self.root, queries)]
        while todo:
            node, q = todo.pop()
            if isinstance(node, tuple):
                pivot, keys, children = node
                d = np.bitwise_count(self.fps[q] ^ self.fps[pivot]).astype(np.int16)
                hit = q[d <= radius]
                yield hit, np.full(len(hit), pivot)
                near = np.abs(d[None, :] - keys[:, None]) <= radius
                taken = int(near.sum())
                self.followed += taken
                self.pruned += near.size - taken
                todo += [(child, q[on]) for child, on, any_ in zip(children, near, near.any(axis=1)) if any_]
            else:
                step = max(1, CHUNK // max(1, len(node)))
                for k in range(0, len(q), step):
                    part = q[k : k + step]
                    i, j = np.nonzero(np.bitwise_count(self.fps[part][:, None] ^ self.fps[node][None, :]) <= radius)
                    yield part[i], node[j]


def groups(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each member the index of the root (first member) of its group of linked members."""
    label = np.arange(len(fps))
    for a, b in BKTree(fps).links(label.copy(), radius):
        x, y = label[a], label[b]
        while len(at := np.nonzero(x != y)[0]):
            lo, hi = np.minimum(x[at], y[at]), np.maximum(x[at], y[at])
            np.minimum.at(label, hi, lo)  # roots point to smaller labels
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
            x, y = label[a], label[b]
    return label


def _shard_links(radius: int):
    """Of rows sorted by shard: (member, root) for each member that is not its group's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            label = groups(fps.view(np.uint64), radius)
            out = np.nonzero(label != np.arange(len(fps)))[0]
            return fps[out], fps[label[out]]

        held_key, held = None, []
        for b in batches:
            shard, sub, fp = (b.column(x).to_numpy() for x in ("shard", "sub", "fp"))
            if not len(fp):
                continue
            cuts = np.nonzero((shard[1:] != shard[:-1]) | (sub[1:] != sub[:-1]))[0] + 1
            at = np.concatenate([[0], cuts])
            found = []
            for k, part in zip(zip(shard[at].tolist(), sub[at].tolist()), np.split(fp, cuts)):
                if k != held_key:
                    if sum(map(len, held)) > 1:
                        found.append(solved(np.concatenate(held)))
                    held_key, held = k, []
                held.append(part)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
        if sum(map(len, held)) > 1:
            a, b = solved(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def shard_edges(distinct: DataFrame, radius: int = RADIUS, big: int = BIG, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints of column fp that links connect.

    Two that agree in a block's first bits differ in at most radius of the other bits, so a shard of more than big
    members is dealt again by radius + 1 blocks of those. The list of big shards is bounded by their size.
    """
    blocks = radius + 1
    starts = [64 * k // blocks for k in range(blocks + 1)]
    bits = max(0, (distinct.count() // shard).bit_length() - 1)
    bounds = [(a, min(b, a + bits)) for a, b in zip(starts, starts[1:])]

    def rest(lo: int, hi: int) -> Column:
        """The other bits, moved together."""
        high = F.shiftleft(F.shiftrightunsigned("fp", hi), lo) if hi < 64 else F.lit(0).cast("long")
        return high.bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << lo) - 1)))

    def again(lo: int, hi: int) -> Column:
        """Block j of the other bits, as j and its value in one number."""
        n = 64 - (hi - lo)
        cuts = [n * j // blocks for j in range(blocks + 1)]
        return F.array(*(F.shiftrightunsigned(rest(lo, hi), x).bitwiseAND(F.lit((1 << (y - x)) - 1)) * blocks + j for j, (x, y) in enumerate(zip(cuts, cuts[1:]))))

    def of(k: int) -> Column:
        lo, hi = bounds[k]
        key = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) * blocks + k
        return F.struct(key.alias("shard"), again(lo, hi).alias("subs"))

    sharded = distinct.select("fp", F.explode(F.array(*map(of, range(blocks)))).alias("s")).select("fp", "s.shard", "s.subs")
    large = sharded.groupBy("shard").count().filter(F.col("count") > big).select("shard", F.lit(True).alias("large"))
    dealt = sharded.join(F.broadcast(large), "shard", "left").select("fp", "shard", F.explode(F.when(F.col("large"), F.col("subs")).otherwise(F.array(F.lit(-1).cast("long")))).alias("sub"))
    return dealt.repartition("shard", "sub").sortWithinPartitions("shard", "sub").mapInArrow(_shard_links(radius), "a long, b long")


def hot_keys(counts: DataFrame, key: str, total: int) -> list:
    """The values of key whose count n is over HOT and a thousandth of the total: at most a thousand."""
    return [r[0] for r in counts.filter(F.col("n") > max(HOT, total // 1000)).select(key).collect()]


def spread_join(rows: DataFrame, small: DataFrame, key: str, other: str, hot: list) -> DataFrame:
    """rows joined to small (one row a value of other); rows with hot values meet theirs without moving."""
    same = F.col(key) == F.col(other)
    if not hot:
        return rows.join(small, same)
    few = F.broadcast(small.filter(F.col(other).isin(hot)))
    return rows.filter(~F.col(key).isin(hot)).join(small, same).unionByName(rows.filter(F.col(key).isin(hot)).join(few, same))


def components(edges: DataFrame) -> DataFrame:
    """node and comp: the smallest node reachable over edges (a, b), for every node of an edge.

    Hot keys are looked for only among more than MANY nodes; below that a hot key's rows are few enough for one task.
    """
    both = settled(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    n = both.count()
    many = n > MANY
    hubs = hot_keys(both.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b", n) if many else []
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = spread_join(both, labels, "b", "node", hubs).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        low = labels.join(near, "node").select("node", "comp", F.least("comp", "m").alias("low"))
        # pointer jump: a component's label is itself a node, whose own label may be smaller
        up = labels.select(F.col("node").alias("up"), F.col("comp").alias("jump"))
        low = settled(low) if many else low
        full = hot_keys(low.groupBy("low").agg(F.count(F.lit(1)).alias("n")), "low", n) if many else []
        new = settled(spread_join(low, up, "low", "up", full).select("node", F.least("low", "jump").alias("comp"), (F.least("low", "jump") < F.col("comp")).alias("moved")))
        labels = new.select("node", "comp")
        if not new.filter("moved").head(1):
            return labels


def linked(rows: DataFrame, nodes: DataFrame, edges_comp: DataFrame, key: str) -> DataFrame:
    """rows (doc_id, key and others) with comp, and component_id: the smallest doc_id of all rows of the component.

    nodes has key, rep (the smallest doc_id) and n (rows) of each distinct key; edges_comp has node and comp.
    """
    of = nodes.join(edges_comp, nodes[key] == edges_comp["node"], "left").select(key, "rep", "n", F.coalesce("comp", key).alias("comp"))
    least = settled(of.groupBy("comp").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n")))
    total = nodes.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    full = hot_keys(least, "comp", total["keys"])
    by_key = spread_join(of.select(F.col(key).alias("_key"), F.col("comp").alias("own")), least.select("comp", "component_id"), "own", "comp", full)
    copied = hot_keys(nodes, key, total["rows"] or 0)
    return spread_join(rows, by_key.select("_key", "comp", "component_id"), key, "_key", copied).drop("_key")


def members(docs: DataFrame, radius: int, width: int, with_digest: bool = False) -> DataFrame:
    """doc_id, fp, comp and component_id (and digest) of every row of docs."""
    marked = settled(fingerprints(docs, width, with_digest))
    reps = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    return linked(marked, reps, components(shard_edges(reps.select("fp"), radius)), "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of docs."""
    return members(docs, radius, width).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of docs that stand for their component."""
    return chosen(docs, settled(members(docs, radius, width, True)).select("doc_id", "digest", "comp"))


def digest(text: Column) -> Column:
    """What tells texts apart; a null text has the empty string."""
    return F.coalesce(F.sha2(text.cast("string"), 256), F.lit(""))


def chosen(docs: DataFrame, members: DataFrame) -> DataFrame:
    """One row of docs, with all its columns, for each component (column comp) of members: the smallest doc_id's.

    members has doc_id, digest (of the text) and comp of every row. Rows without a doc_id come after all others, equal
    ids are told apart by their digests, and rows that agree in both by all their columns, so the choice is fixed.
    """
    keys = members.groupBy("comp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")).alias("f")
    keys = settled(keys.groupBy("comp").agg(first).select(F.col("f.doc_id").alias("id"), F.col("f.digest").alias("d"), F.col("f.n").alias("n")))

    def rows(wanted: DataFrame) -> DataFrame:
        same = docs["doc_id"].cast("long").eqNullSafe(wanted["id"]) & (digest(docs["text"]) == wanted["d"])
        return docs.join(wanted, same, "left_semi")

    once = rows(keys.filter("n = 1"))
    repeated = keys.filter("n > 1")
    if not repeated.head(1):
        return once
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = rows(repeated).groupBy(F.col("doc_id").alias("_id"), digest(F.col("text")).alias("_digest")).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias("_row"))
    return once.unionByName(one.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns)))
