"""SentencePiece encoding and decoding of merge-type (BPE) models, without the library.

Encoding is exact by backtracking: Aho-Corasick gives all pieces of a chunk; the longest piece is tried first at each
place, a pair of neighbours is accepted only if merging their joined text anew gives the same two, a place that
turned out to lead nowhere is marked in a bitfield, and shorter pieces (the next shorter at the same place) follow.
Characters without a piece stand for themselves and become byte pieces.

No piece joins a non-space to a following space mark, and a line feed is in no piece but alone, so a text falls into
chunks (space marks and the word after them) that are encoded once and kept in a bounded table of the worker.

Defined results: a null or empty text gives the begin and end ids alone and decodes to an empty text; any white space
and very long texts are kept as they are; repeated rows are all returned; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import gathered, small_batches, texts, together, told_apart

MARK = "▁"
#: Chunks and pairs of neighbours that a worker keeps (about 350 bytes each); a table is emptied when full.
KEEP, KEEP_PAIRS = 200_000, 250_000
#: Characters of texts that are encoded together: about 100 bytes each are held meanwhile.
TOGETHER = 1_500_000


def _varint(b: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if b[at - 1] < 128:
            return value, at


def fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(b, at)
        else:
            n, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(b, at)
            value, at = b[at : at + n], at + n
        yield key >> 3, value


class Model:
    """Pieces, scores and kinds of a model file. Kinds: 1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        spec = {}
        for n, value in fields(data):
            if n == 1:
                x = dict(fields(value))
                self.pieces.append(x[1].decode())
                self.scores.append(struct.unpack("<f", x[2])[0] if 2 in x else 0.0)
                self.kinds.append(x.get(3, 1))
            elif n == 2:
                trainer = dict(fields(value))
                if trainer.get(3, 1) != 2:
                    raise ValueError("only merge-type (BPE) models are supported")
            elif n == 3:
                spec = dict(fields(value))
        if spec.get(2) or spec.get(4, 1) or not spec.get(3, 1) or not spec.get(5, 1):
            raise ValueError("only models without normalisation rules, with a dummy prefix and kept white space are supported")
        if any(k in (4, 5) for k in self.kinds) or any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("user-defined, unused and inner-space pieces are not supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == 1}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == 6}
        self.unknown = self.kinds.index(2)
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.score = {p: self.scores[i] for p, i in self.ids.items()}
        self.cuts_lines = not any("\n" in p for p in self.ids)
        self.base = len(self.pieces)
        self._fits: dict[int, bool] = {}
        self._steps_of: dict[int, list[tuple[float, str, str]]] = {}
        self.size = list(map(len, self.pieces))
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) > 1 and self._whole(p):  # others never result from merging
                self.automaton.add_word(p, (len(p), i))
        self.shorter = [-1] * self.base  # of each piece the next shorter that it begins with
        for p, (size, i) in self.automaton.items():
            shorter = next((p[:k] for k in range(size - 1, 1, -1) if p[:k] in self.automaton), p[0])
            self.shorter[i] = self.number(shorter)
        self.automaton.make_automaton()
        self.bytes_of = [self._bytes(i) for i in range(len(self.pieces))]

    def number(self, symbol: str) -> int:
        """A piece's id; of a character without a piece, its code point after all ids."""
        return self.base + ord(symbol) if (i := self.ids.get(symbol)) is None else i

    def text(self, number: int) -> str:
        return self.pieces[number] if number < self.base else chr(number - self.base)

    def _steps(self, text: str) -> list[tuple[float, str, str]]:
        """Before each merge and after the last: the score of the merge (then -inf), the first and the last symbol."""
        symbols, steps = list(text), []
        while True:
            best, at = -math.inf, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (at < 0 or s > best):
                    best, at = s, i
            steps.append((best, symbols[0], symbols[-1]))
            if at < 0:
                return steps
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _whole(self, text: str) -> bool:
        """Whether text merges to itself."""
        return self._steps(text)[-1][1] == text

    def merged(self, text: str) -> list[str]:
        """Symbols of text after all merges, best score first, leftmost of equals: the definition, for short texts."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two neighbours, each of which merges to itself, gives the same two.

        The merges inside either go on as if alone until one across the border is the best, the leftmost of equals.
        """
        key = left << 32 | right
        if (got := self._fits.get(key)) is None:
            if len(self._fits) >= KEEP_PAIRS:
                self._fits.clear()
            got = self._fits[key] = self._apart(self._alone(left), self._alone(right))
        return got

    def _alone(self, number: int) -> list[tuple[float, str, str]]:
        if number >= self.base:
            return self._steps(chr(number - self.base))
        if (got := self._steps_of.get(number)) is None:
            got = self._steps_of[number] = self._steps(self.pieces[number])
        return got

    def _apart(self, left: list, right: list) -> bool:
        i = j = 0
        (a, _, x), (b, y, _) = left[0], right[0]
        while True:
            across = self.score.get(x + y)
            if across is not None and across > a and across >= b:
                return False
            if a >= b:
                if a == -math.inf:
                    return True
                i += 1
                a, _, x = left[i]
            else:
                j += 1
                b, y, _ = right[j]

    def numbers(self, chunk: str) -> list[int]:
        """The pieces (or characters without one) that merging chunk gives, as numbers."""
        n, base, size, shorter, known = len(chunk), self.base, self.size, self.shorter, self._fits.get
        if n == 1:
            return [self.number(chunk)]
        longest = [-1] * n
        for end, (length, i) in self.automaton.iter(chunk):  # by ends, so a longer one at the same place comes later
            longest[end - length + 1] = i
        failed = bytearray((n >> 3) + 1)  # bitfield: places from which the rest can't be encoded
        out: list[int] = []
        pos, last = 0, -1
        if (s := longest[0]) < 0:
            s = self.number(chunk[0])
        while True:
            while s >= 0:
                end = pos + (size[s] if s < base else 1)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last < 0 or known(key := last << 32 | s) or key not in self._fits and self.fits(last, s):
                        break
                s = shorter[s] if s < base else -1
            if s >= 0:
                out.append(s)
                if end == n:
                    return out
                pos, last = end, s
                if (s := longest[pos]) < 0:
                    s = self.number(chunk[pos])
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                if not out:
                    raise AssertionError("every text has an encoding")
                s = out.pop()
                pos -= size[s] if s < base else 1
                s = shorter[s] if s < base else -1
                last = out[-1] if out else -1

    def symbols(self, chunk: str) -> list[str]:
        """The texts of numbers(chunk)."""
        return list(map(self.text, self.numbers(chunk)))

    def ids_of(self, chunk: str) -> list[int]:
        """Ids of a chunk. Long ones (no spaces) go through the same search; their cost is linear but for backtracking."""
        numbers = self.numbers(chunk)
        if max(numbers) < self.base:
            return numbers
        out = []
        for i in numbers:
            if i < self.base:
                out.append(i)
            elif self.byte_ids:  # a character that is no piece
                out += [self.byte_ids[b] for b in chr(i - self.base).encode()]
            else:
                out.append(self.unknown)
        return out

    def _bytes(self, i: int) -> bytes:
        if self.kinds[i] == 6:
            return bytes([int(self.pieces[i][3:5], 16)])
        return b"" if self.kinds[i] == 3 else b" \xe2\x81\x87 " if self.kinds[i] == 2 else self.pieces[i].replace(MARK, " ").encode()

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


#: With spaces written as marks: space marks and what follows them, cut after and before line feeds.
CHUNKS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


class Codec:
    """encode(text) as little-endian id bytes with begin and end ids, and the text that they decode to."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = Model(f.read())
        self.kept: dict[str, tuple[bytes, bytes]] = {}  # by a word: with a space mark before it, or after a line feed
        self.bare: dict[str, tuple[bytes, bytes]] = {}  # by a chunk as it is
        self.pattern = CHUNKS if self.model.cuts_lines else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def _make(self, table: dict, key: str, chunk: str) -> tuple[bytes, bytes]:
        ids = self.model.ids_of(chunk)
        got = array("I", ids).tobytes(), self.model.decode_bytes(ids)
        if len(key) <= 64:
            if len(table) >= KEEP:
                table.clear()
            table[key] = got
        return got

    def chunk(self, c: str) -> tuple[bytes, bytes]:
        return self.bare.get(c) or self._make(self.bare, c, c)

    def word(self, w: str) -> tuple[bytes, bytes]:
        """Of a word with a space mark before it, or one that begins with a line feed and has none."""
        if w[:1] != "\n" or not self.model.cuts_lines:
            return self._make(self.kept, w, MARK + w)
        feed, rest = self.chunk("\n"), self.chunk(w[1:]) if len(w) > 1 else (b"", b"")
        got = self.kept[w] = feed[0] + rest[0], feed[1] + rest[1]
        return got

    def of(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Id bytes and decoding of distinct words; when the table is full, those of the batch at hand stay."""
        found = list(map(self.kept.get, words))
        if len(self.kept) > KEEP:
            self.kept = {w: x for w, x in zip(words, found) if x is not None}
        return [x or self.word(w) for w, x in zip(words, found)]

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """Of a text with any spaces, chunk by chunk."""
        parts = list(map(self.chunk, self.pattern.findall(MARK + text.replace(" ", MARK))))
        return b"".join([x for x, _ in parts]), b"".join([y for _, y in parts])

    def batch(self, texts_: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its id bytes, and the UTF-8 of their decoding. Single spaces each begin a chunk; a text with
        others, or with marks of its own, is one word to all this."""
        if not texts_:
            return []
        strange: dict[int, tuple[bytes, bytes]] = {}
        plain: list[str] = []
        for k, t in enumerate(texts_):
            if not t:
                strange[k] = b"", b""
            elif "  " in t or t[0] == " " or MARK in t or not self.model.cuts_lines:
                strange[k] = self.whole(t)
            plain.append("" if k in strange else t.replace("\n", " \n"))
        distinct, which, first = told_apart(pa.array(plain, pa.large_string()))
        runs = [*self.of(distinct), *strange.values()]
        which = which.copy()
        which[first[list(strange)]] = np.arange(len(distinct), len(runs))
        begin, end = struct.pack("<I", self.model.begin), struct.pack("<I", self.model.end)
        out = []
        for width, k in ((4, 0), (1, 1)):
            values, sizes = gathered([r[k] for r in runs], width, which)
            data, stops = values.tobytes(), (np.add.reduceat(sizes, first[:-1]).cumsum() * width).tolist()
            out.append([data[a:b] for a, b in zip([0, *stops], stops)])
        return [(begin + x + end, y[1:] if y[:1] == b" " else y) for x, y in zip(*out)]

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """The same of one text."""
        return self.batch([text])[0]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec; it outlives a task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (int array) and decoded."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        sha = hashlib.sha256
        for doc_ids, held in together(batches, TOGETHER):
            rows = own.batch(held)
            cols = [
                doc_ids,
                pa.array([len(x) // 4 for x, _ in rows], pa.int64()),
                pa.array([sha(x).hexdigest() for x, _ in rows], pa.string()),
                pa.array([sha(y).hexdigest() for _, y in rows], pa.string()),
            ]
            if with_text:
                cols += [pa.array([list(struct.unpack(f"<{len(x) // 4}I", x)) for x, _ in rows], pa.list_(pa.int32())), pa.array([y.decode() for _, y in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_text
    names = [x.split()[0] for x in schema.split(", ")]
    return texts(docs).mapInArrow(run, schema)
