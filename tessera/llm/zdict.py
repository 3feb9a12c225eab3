"""Quality by compression: how much better a text compresses with a dictionary of good text than with one of bad text.

Two zstandard dictionaries are built on the driver from labelled rows (a sample bounded by PER_LABEL, MAX_CHARS and
DICT_BYTES). A text's feature is the difference of its two compressed sizes per raw byte; texts that the dictionaries
reach in another way are set apart by a second quotient, the size with neither. Both pass a logistic curve that is
fitted on labelled rows kept out of the dictionaries, which gives the calibrated score. Long texts are compressed in
windows of WINDOW bytes, as a dictionary helps only near the start of a frame; every byte is read.

Defined results: a null or empty text has difference 0 and gets the curve's value there; without labelled rows of both
kinds the score is the smoothed share of label 1; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_sample, small_batches, texts

#: The sample's bounds (rows of a label, characters of a text) and the dictionaries' size.
PER_LABEL, MAX_CHARS, DICT_BYTES = 1500, 8000, 65_536
WINDOW, LEVEL = 4096, 3


def windows(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[k : k + WINDOW] for k in range(0, len(raw), WINDOW)]


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    _tools: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_tools": []}

    def tools(self) -> list:
        if not self._tools and self.good and self.bad:
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                self._tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
            self._tools.append(zstandard.ZstdCompressor(level=1, write_checksum=False, write_content_size=False))
        return self._tools

    def sizes(self, text: str | None) -> tuple[int, int, int, int]:
        """Raw bytes and compressed bytes with the good dictionary, with the bad one and with none."""
        parts = windows(text or "")
        n = sum(map(len, parts))
        if not n or not self.tools():
            return n, 0, 0, 0
        good, bad, plain = self.tools()
        g = b = 0
        for part in parts:
            g += len(good.compress(part))
            b += len(bad.compress(part))
        return n, g, b, len(plain.compress(b"".join(parts)))

    def inputs(self, text: str | None) -> tuple[float, float]:
        n, g, b, p = self.sizes(text)
        # eight bytes more, so that a few letters do not make a large quotient
        return ((b - g) / (n + 8), p / (n + 8)) if n else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        d, p = self.inputs(text)
        a, c, b = self.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * d + c * p + b))))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def fit(rows: list[tuple[str, int]]) -> Model:
    """A model of (text, label) rows; every third row fits the curve, the others the dictionaries."""
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    if len({y for _, y in rows}) < 2:
        return Model(b"", b"", (0.0, 0.0, math.log(share / (1 - share))))
    train = [r for i, r in enumerate(rows) if i % 3 or len(rows) < 30]
    model = Model(*(dictionary([p for t, y in train if y == want for p in windows(t)]) for want in (1, 0)))
    held = [r for i, r in enumerate(rows) if not i % 3 or len(rows) < 30]
    x = np.array([model.inputs(t) for t, _ in held])
    model.weights = logistic(x, np.array([y for _, y in held], float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weights and, last, the intercept of y over x, by damped Newton steps under a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (len(w) - 1) + [1e-9])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - keep @ w
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + keep
        step = np.linalg.solve(h, g)
        step *= min(1.0, 20.0 / max(1e-12, float(np.abs(step).max())))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def fit_on(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality") -> Model:
    """A model of the labelled documents for whose doc_id may_learn holds."""
    marked = labels.filter(may_learn & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = texts(docs).join(marked, "doc_id")
    got = sorted(labelled_sample(rows, "label", PER_LABEL, 2 * PER_LABEL, MAX_CHARS), key=lambda r: (r.doc_id * 2654435761 & 0xFFFFFFFF, r.doc_id))
    return fit([(r.text, r.label) for r in got])


def predict(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """doc_id, score and predicted for every row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            p = [own.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64()), pa.array([int(x >= least) for x in p], pa.int32())], ["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")
