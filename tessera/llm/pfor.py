"""Token-ID output: files of patched frame-of-reference blocks, written in ascending doc_id order and read back.

A block holds BLOCK ids. Its minimum is subtracted and the differences are packed at the smallest width that holds a
share PERCENTILE of them; the rest are exceptions, whose positions and high bits go to lists. A file (shard) holds the
ids of a contiguous range of documents:

    magic "PFR2"
    blocks, one after another: u32 minimum, u8 width, u16 exceptions, u16 ids, packed bits, u16 positions, u32 high bits
    documents: i64 doc_id each (null: 0), u8 null flag each, u64 length each
    block index: u64 offset of each block from the file's start
    u32 block size, u64 ids, u64 documents, u64 offset of the documents, magic

all little-endian, so that ids from any place are found by the index without unpacking what is before them, and blocks
go to the file as they are made. Shards are written to the shared folder under temporary names and moved to names that
depend on the range alone: a task that is run again after an executor was lost writes the same bytes to the same
place. Only a row a shard (its path and totals) comes to the driver, which sums them up to each shard's start.

Defined results: a null or empty text has the end id alone; documents without an id come first; rows that share an id
follow each other in the order of their texts, and repeated rows are written each; an empty table gives no shard
and no row; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import local_path, shared_dir, small_batches, texts, together, told_apart

MAGIC, BLOCK, PERCENTILE = b"PFR2", 1024, 0.98
#: Ids that a task holds before their blocks are packed.
HOLD = 1 << 20
#: Words whose ids a worker keeps; when the table is full, those of the batch at hand stay.
KEEP = 1_000_000
SHARDS_SCHEMA = "part int, path string, n_docs long, n_ids long, first long"


# -- blocks ------------------------------------------------------------------------------------------------------


def _overlaps(width: int) -> list[tuple[int, int, int]]:
    """Of eight values of so many bits in as many bytes: value, byte, and by how much the value moves to the right."""
    return [(i, j, (i + 1) * width - 8 * (j + 1)) for i in range(8) for j in range(i * width // 8, ((i + 1) * width + 7) // 8)]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Each row's values, most significant bit first, in whole bytes; eight values of width bits fill width bytes."""
    rows, n = values.shape
    if pad := -n % 8:
        values = np.pad(values, ((0, 0), (0, pad)))
    eight = np.ascontiguousarray(values.reshape(-1, 8).T)
    out = np.zeros((width, eight.shape[1]), np.uint8)
    for i, j, right in _overlaps(width):
        out[j] |= (eight[i] >> right if right >= 0 else eight[i] << -right).astype(np.uint8)
    return out.T.reshape(rows, -1)[:, : (n * width + 7) // 8]


def unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    """n values of width bits each, for every row of data."""
    rows = len(data)
    whole = -(-n // 8) * width
    if data.shape[1] < whole:
        data = np.pad(data, ((0, 0), (0, whole - data.shape[1])))
    bytes_ = np.ascontiguousarray(data.reshape(-1, max(width, 1)).T) if width else np.zeros((0, 0), np.uint8)
    out = np.zeros((8, rows * -(-n // 8)), np.uint32)
    for i, j, right in _overlaps(width):
        b = bytes_[j].astype(np.uint32)
        out[i] |= b << right if right >= 0 else b >> -right
    if width < 32:
        out &= np.uint32((1 << width) - 1)
    return np.ascontiguousarray(out.T).reshape(rows, -1)[:, :n]


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of the ids (uint32), BLOCK each but the last."""
    out: list[bytes] = [b""] * (-(-len(ids) // BLOCK))
    whole = len(ids) // BLOCK
    parts = [(0, ids[: whole * BLOCK].reshape(whole, BLOCK))] if whole else []
    if len(ids) % BLOCK:
        parts.append((whole, ids[whole * BLOCK :].reshape(1, -1)))
    for first, block in parts:
        n = block.shape[1]
        low = block.min(axis=1)
        rest = block - low[:, None]
        at_share = min(n - 1, int(np.ceil(percentile * n)) - 1)
        width = np.frexp(np.partition(rest, at_share, axis=1)[:, at_share].astype(np.float64))[1]  # its bit length
        for w in np.unique(width).tolist():
            at = np.nonzero(width == w)[0]
            like = rest[at]
            packed = pack(like & np.uint32((1 << w) - 1), w)
            high = like >> np.uint32(w) if w < 32 else np.zeros_like(like)
            row, place = np.nonzero(high)
            ends = np.searchsorted(row, np.arange(len(at) + 1)).tolist()
            place, high = place.astype("<u2"), high[row, place].astype("<u4")
            for k, (i, minimum) in enumerate(zip(at.tolist(), low[at].tolist())):
                a, b = ends[k], ends[k + 1]
                out[first + i] = struct.pack("<IBHH", minimum, w, b - a, n) + packed[k].tobytes() + place[a:b].tobytes() + high[a:b].tobytes()
    return out


def decode_blocks(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks at these offsets, in that order."""
    heads = [struct.unpack_from("<IBHH", data, s) for s in starts]
    out: list[np.ndarray | None] = [None] * len(starts)
    like: dict[tuple[int, int], list[int]] = {}
    for k, (_, w, _, n) in enumerate(heads):
        like.setdefault((w, n), []).append(k)
    for (w, n), ks in like.items():
        size = (n * w + 7) // 8
        rows = np.frombuffer(b"".join([data[starts[k] + 9 : starts[k] + 9 + size] for k in ks]), np.uint8).reshape(len(ks), size)
        values = unpack(rows, w, n)
        for row, k in zip(values, ks):
            low, _, odd, _ = heads[k]
            if odd:
                at = starts[k] + 9 + size
                row[np.frombuffer(data, "<u2", odd, at)] |= np.frombuffer(data, "<u4", odd, at + 2 * odd) << np.uint32(w)
            out[k] = row + np.uint32(low)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# -- files -------------------------------------------------------------------------------------------------------


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file that all executors share, and its path there."""
    if (path := local_path(uri)) is not None:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(uri)


class Writer:
    """A shard under a temporary name: ids and documents are added, close() moves it to its own name."""

    def __init__(self, uri: str):
        self.system, self.path = store(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.file = self.system.open_output_stream(self.temp)
        self.file.write(MAGIC)
        self.at, self.index = len(MAGIC), []
        self.doc_ids, self.no_id, self.lengths = [], [], []
        self.held: list[np.ndarray] = []
        self.size = self.n_ids = 0

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents, how many ids each has, and the ids of all."""
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.no_id.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.lengths.append(lengths.astype("<u8"))
        self.held.append(ids)
        self.size += len(ids)
        self.n_ids += len(ids)
        if self.size >= HOLD:
            self._flush(self.size // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        blocks = encode_blocks(ids[:n])
        for b in blocks:
            self.index.append(self.at)
            self.at += len(b)
        self.file.write(b"".join(blocks))
        self.held, self.size = [ids[n:].copy()], len(ids) - n

    def close(self) -> None:
        self._flush(self.size)
        columns = [np.concatenate(x) for x in (self.doc_ids, self.no_id, self.lengths)]
        self.file.write(b"".join(c.tobytes() for c in columns) + np.array(self.index, "<u8").tobytes())
        self.file.write(struct.pack("<IQQQ4s", BLOCK, self.n_ids, len(columns[0]), self.at, MAGIC))
        self.file.close()
        self.system.move(self.temp, self.path)


class Shard:
    """A shard opened for reading: its documents, and the ids of any range by the block index."""

    def __init__(self, uri: str):
        system, path = store(uri)
        self.file = system.open_input_file(path)
        end = self.file.size() - 32
        if end < len(MAGIC) or self._at(0, 4) != MAGIC or self._at(end + 28, 4) != MAGIC:
            raise ValueError(f"{uri} is not a whole shard")
        self.block, self.n_ids, n, at = struct.unpack("<IQQQ", self._at(end, 28))
        table = self._at(at, end - at)
        self.doc_ids = np.frombuffer(table, "<i8", n)
        self.no_id = np.frombuffer(table, np.uint8, n, 8 * n).astype(bool)
        self.lengths = np.frombuffer(table, "<u8", n, 9 * n).astype(np.int64)
        self.index = np.append(np.frombuffer(table, "<u8", offset=17 * n), at).astype(np.int64)

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        a, b = start // self.block, -(-stop // self.block)
        if a >= b:
            return np.zeros(0, np.uint32)
        base = int(self.index[a])
        data = self._at(base, int(self.index[b]) - base)
        return decode_blocks(data, (self.index[a:b] - base).tolist())[start - a * self.block : stop - a * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start within the shard and ids of each document; about HOLD ids are unpacked at once."""
        stops = np.cumsum(self.lengths)
        k = 0
        while k < len(stops):
            begin = int(stops[k - 1]) if k else 0
            last = max(k + 1, int(np.searchsorted(stops, begin + HOLD, "right")))
            ids = self.ids(begin, int(stops[last - 1]))
            for d in range(k, last):
                start = int(stops[d] - self.lengths[d])
                yield None if self.no_id[d] else int(self.doc_ids[d]), start, ids[start - begin : int(stops[d]) - begin]
            k = last


# -- encoding ----------------------------------------------------------------------------------------------------

#: The white space that the pre-tokenizer's pattern knows, but space and line feed.
_W = r"\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNKS = re.compile(f"[ \n{_W}]*[^ \n{_W}]+|[ \n{_W}]+")
#: Begins a word that has no space before it; a pattern for such words and what stands for them.
BARE = "\x01"
ENDS = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?]) ", rf"\1 {BARE}\2 "
_OTHER = [chr(c) for c in (1, 9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def odd(t: str) -> bool:
    """Whether a text has what the quick way does not know: other white space, spaces or line feeds next to each other,
    a space at an end, or BARE. Searches for fixed strings cost little next to one for a pattern of them all."""
    return "  " in t or "\n\n" in t or "\n " in t or " \n" in t or t[:1] == " " or t[-1:] == " " or any(c in t for c in _OTHER)


#: The pre-tokenizer's pattern, and the characters that stand for bytes in the vocabulary.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: b for b in _PRINTED} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class Encoder:
    """Ids of whole texts by the tokenizers library, with the ids of frequent words kept.

    The pre-tokenizer never joins a character to white space after it, so a text is the chain of its chunks (white
    space and what follows up to the next white space), each of which is encoded by itself. Words after a single space
    or line feed are cut into the pre-tokenizer's pieces, whose ids the library's model gives; chunks with other white
    space and texts with a special token's string go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: By word: with a space before it, or without if it begins with a line feed or (that being left out) BARE.
        self.kept: dict[str, bytes] = {}
        self.feed = self.whole("\n")
        if len(self.feed) != 4:
            raise ValueError("only tokenizers with one id for a line feed are supported")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def piece(self, p: str) -> bytes:
        """Ids of one piece of the pre-tokenizer."""
        plain = p.isascii() and p.isprintable()  # whose bytes but for the space stand for themselves
        ids = [t.id for t in self.model.tokenize(p.replace(" ", "Ġ") if plain else p.encode().decode("latin-1").translate(BYTES))]
        return array("I", ids).tobytes()

    def kept_piece(self, p: str) -> bytes:
        key = p[1:] if p[0] == " " else BARE + p
        if (got := self.kept.get(key)) is None:
            got = self.kept[key] = self.piece(p)
        return got

    def learn(self, w: str) -> bytes:
        """Ids of a word, with a space before it unless it begins with a line feed or BARE."""
        if w.isalpha():
            return self.piece(" " + w)
        if w[0] == "\n":
            return self.feed + b"".join([self.kept_piece(p) for p in PIECES.findall(w[1:])])
        if w[0] == BARE:
            return self.piece(w[1:])
        pieces = PIECES.findall(" " + w)
        return self.piece(pieces[0]) if len(pieces) == 1 else b"".join([self.kept_piece(p) for p in pieces])

    def batch(self, texts_: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by end_id, and how many ids each text has with it.

        Words are cut (an end mark after a letter is one) and told apart by Arrow, so Python sees each distinct word
        of the batch once; ids are then
        gathered by the words' places. The first word of a text has no space before it: it is looked up after a line
        feed, whose id is left out. A text that the quick way does not know is one word to all this.
        """
        if not texts_:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        strange: dict[int, bytes] = {}
        plain: list[str] = []
        for k, t in enumerate(texts_):
            if any(x in t for x in self.special):
                strange[k] = self.whole(t)
            elif odd(t):
                chunks = _CHUNKS.findall(t)
                one = {c: self.whole(c) for c in dict.fromkeys(chunks)}
                strange[k] = b"".join([one[c] for c in chunks])
            plain.append("\n" if k in strange else "\n" + t.replace("\n", " \n"))
        marked = pc.replace_substring_regex(pa.array(plain, pa.large_string()), ENDS[0], ENDS[1])
        distinct, which, first = told_apart(marked)
        known = self.of(distinct)
        runs = [*known, *strange.values(), struct.pack("<I", end_id)]
        size = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        start = np.cumsum(size) - size
        if size.sum() < 1 << 31:
            size, start = size.astype(np.int32), start.astype(np.int32)
        # an entry a word, and one more after each text for the end id
        which = np.insert(which, first[1:], len(runs) - 1)
        head = first[:-1] + np.arange(len(texts_))
        which[head[list(strange)]] = np.arange(len(known), len(known) + len(strange))
        n, at = size[which], start[which]
        usual = np.ones(len(texts_), bool)
        usual[list(strange)] = False
        n[head[usual]] -= 1
        at[head[usual]] += 1
        ends = np.cumsum(n, dtype=np.int64)
        step = np.repeat((at - (ends - n)).astype(at.dtype if ends[-1] < 1 << 31 else np.int64), n)
        step += np.arange(ends[-1], dtype=step.dtype)
        return np.frombuffer(b"".join(runs), "<u4").take(step), np.add.reduceat(n, head, dtype=np.int64)

    def of(self, words: list[str]) -> list[bytes]:
        """Id bytes of distinct words."""
        found = list(map(self.kept.get, words))
        if len(self.kept) > KEEP:  # words of this batch stay, frequent ones among them
            self.kept = {w: x for w, x in zip(words, found) if x is not None}
        kept = self.kept
        if None in found:
            for k, (w, x) in enumerate(zip(words, found)):
                if x is None:
                    found[k] = kept[w] = self.learn(w)
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shards: int | None = None) -> list:
    """Encode docs into shards under folder; their rows of SHARDS_SCHEMA, in ascending doc_id order.

    Texts are dealt by ranges of doc_id (and, within an id, of the texts' beginnings, should many rows share it) and
    sorted before they are encoded, so ids never pass a shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        path, first, out = f"{folder.rstrip('/')}/shard-{part:06d}.pfr", None, None
        for doc_ids, held in together(batches):
            if out is None:
                out, first = Writer(path), doc_ids[0].as_py()
            ids, lengths = own.batch(held, end_id)
            out.add(doc_ids, lengths, ids)
        if out is not None:
            out.close()
            row = {"part": part, "path": path, "n_docs": sum(map(len, out.lengths)), "n_ids": out.n_ids, "first": first}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first", pa.int64())]))

    dealt = texts(docs).repartitionByRange(shards, "doc_id", F.substring("text", 1, 16)).sortWithinPartitions("doc_id", "text")
    return sorted(dealt.mapInArrow(run, SHARDS_SCHEMA).collect(), key=lambda r: r.part)


def read(spark: SparkSession, shards: list) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    start, rows = 0, []
    for r in shards:
        rows.append((r.path, start))
        start += r.n_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["doc_id", "start", "n_tokens", "ids_crc32"])

        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                found: list = []
                for d, at, ids in Shard(path).documents():
                    found.append((d, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(found) >= 10_000:
                        yield batch(found)
                        found = []
                if found:
                    yield batch(found)

    listed = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write docs to a new folder in the shared one and return what the files say of each document."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/pfor-{uuid.uuid4().hex}"
    return read(spark, write(docs, folder, tokenizer, end_id))
