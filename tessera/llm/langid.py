"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are mapped to an alphabet learned from the sample (the ALPHABET most frequent letters, case folded; other
letters by their blocks of code points, which keeps scripts apart; all else is a word boundary); features are its 1- to 3-grams found in enough documents. Weights are trained with follow-the-regularised-leader
(proximal, per coordinate) under an elastic net, whose L1 part sets most of them to zero; then one temperature is
fitted on rows kept out of training, so that scores are probabilities. The model is fitted on the driver from a
sample bounded by PER_LABEL, TOTAL and MAX_CHARS; predictions read every whole text.

Defined results: a null text, an empty one and one without a letter are `und` with score 0; without any training row
every text is `und`; repeated rows are predicted alike and all returned; other columns are ignored. Bounds of the model:
ALPHABET letters, FEATURES n-grams, and the labels of common.MOST_LABELS; they bound what is learned, not what is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_sample, small_batches, texts

#: The sample's bounds: rows of a language, rows in all, characters of a text.
PER_LABEL, TOTAL, MAX_CHARS = 1000, 6000, 8000
ALPHABET, FEATURES, MIN_DOCS, EPOCHS = 200, 16_000, 5, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.02
UNKNOWN = "und"


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


_LETTERS: list[np.ndarray] = []


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Model:
    labels: list[str]
    alphabet: str
    grams: np.ndarray  # codes of the features, ascending
    idf: np.ndarray
    weights: np.ndarray  # features x labels
    bias: np.ndarray
    temperature: float = 1.0
    _table: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_table": {}}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Lookups: code point to alphabet code (0: boundary), n-gram code to feature or -1."""
        if not self._table:
            if not _LETTERS:
                _LETTERS.append(letters())
            # letters outside the alphabet: blocks of 128 up to 4096, of 4096 beyond
            points = np.arange(len(_LETTERS[0]))
            others = np.where(points < 4096, points >> 7, 32 + np.minimum(points >> 12, 253 - ALPHABET - 32))
            chars = np.where(_LETTERS[0], ALPHABET + 1 + others, 0).astype(np.uint8)
            for i, c in enumerate(self.alphabet, 1):
                for x in {c, c.upper(), c.lower()}:
                    if len(x) == 1:
                        chars[ord(x)] = i
            grams = np.full(1 << 24, -1, np.int16)
            grams[self.grams] = np.arange(len(self.grams))
            self._table["t"] = chars, grams
        return self._table["t"]

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Features of a text and their TF-IDF, of length one; None if it has no letter."""
        chars, grams = self.tables()
        codes = coded(text, chars)
        if codes is None:
            return None
        n = np.bincount(grams[all_grams(codes)] + 1, minlength=len(self.grams) + 1)[1:]
        at = np.nonzero(n)[0]
        x = n[at] * self.idf[at]
        return at, x / max(1e-12, float(np.sqrt(x @ x)))

    def logits(self, text: str) -> np.ndarray | None:
        got = self.counts(text)
        return None if got is None else got[1] @ self.weights[got[0]] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        z = self.logits(text) if text and self.labels else None
        if z is None:
            return UNKNOWN, 0.0
        p = softmax(z / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def coded(text: str, chars: np.ndarray) -> np.ndarray | None:
    """Alphabet codes with single boundaries around words; None without a letter."""
    c = chars[code_points(text)]
    if not c.any():
        return None
    c = np.concatenate([[0], c, [0]]).astype(np.uint8)
    return c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]


def all_grams(codes: np.ndarray) -> np.ndarray:
    """Codes of the 1-, 2- and 3-grams; boundaries alone are none."""
    c = codes.astype(np.int32)
    two = c[:-1] * 256 + c[1:]
    three = two[:-1] * 256 + c[2:]
    return np.concatenate([c[c != 0], two, three[codes[1:-1] != 0]])


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model of (text, label) rows, in the given order; every fifth row fits the temperature alone."""
    seen = Counter()
    for t, _ in rows:
        seen.update(t.lower())
    alphabet = "".join(c for c, _ in sorted(((c, n) for c, n in seen.items() if c.isalpha() and len(c.upper()) == 1), key=lambda x: (-x[1], x[0]))[:ALPHABET])
    labels = sorted({y for _, y in rows})
    model = Model(labels, alphabet, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(labels))), np.zeros(len(labels)))
    if not rows:
        return model
    train = [r for i, r in enumerate(rows) if i % 5 or len(rows) < 20]
    chars, _ = model.tables()
    docs = np.zeros(1 << 24, np.int32)
    for t, _ in train:
        if (c := coded(t, chars)) is not None:
            docs[np.unique(all_grams(c))] += 1
    grams = np.nonzero(docs >= min(MIN_DOCS, max(1, len(train) // 20)))[0]
    model.grams = np.sort(grams[np.argsort(-docs[grams], kind="stable")][:FEATURES])
    model.idf = np.log((1 + len(train)) / (1 + docs[model.grams])) + 1
    model._table.clear()
    model.weights, model.bias = ftrl([(model.counts(t), labels.index(y)) for t, y in train], len(model.grams), len(labels))
    held = [(model.logits(t), labels.index(y)) for i, (t, y) in enumerate(rows) if not i % 5 or len(rows) < 20]
    held = [(z, y) for z, y in held if z is not None]
    if held:
        z, y = np.array([z for z, _ in held]), np.array([y for _, y in held])
        loss = lambda t: -float(np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean())
        model.temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
    return model


def ftrl(rows: list, features: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases after EPOCHS passes; a weight is zero until its gradients outweigh L1."""
    z, n = np.zeros((features + 1, k)), np.zeros((features + 1, k))

    def solved(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0, w)

    for _ in range(EPOCHS):
        for got, y in rows:
            if got is None:
                continue
            at, x = np.append(got[0], features), np.append(got[1], 1.0)
            w = solved(at)
            g = softmax(x @ w)
            g[y] -= 1
            g = x[:, None] * g
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = solved(slice(None))
    return w[:-1], w[-1]


def fit_on(docs: DataFrame, may_learn: Column) -> Model:
    """A model of the labelled rows of docs for which may_learn holds."""
    rows = docs.filter(may_learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    got = labelled_sample(rows, "lang", PER_LABEL, TOTAL, MAX_CHARS)
    got = sorted(got, key=lambda r: (hash((r.doc_id * 2654435761) & 0xFFFFFFFF), r.doc_id))
    return fit([(r.text, r.lang) for r in got])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: FEATURES x labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            got = [own.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of docs, with all their columns, whose text has a language with at least this score above chance.

    A score s among n languages counts as (s - 1/n) / (1 - 1/n), so that least means the same however many there are; one
    language alone is always likely. Where no language could be learned, the rows whose text has a letter stay.
    """
    chance = 1 / max(1, len(model.labels))
    bound = chance + least * (1 - chance)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            ts = b.column("text").to_pylist()
            if own.labels:
                kept = [x != UNKNOWN and s >= bound for x, s in map(own.predict, ts)]
            else:
                kept = [any(map(str.isalpha, t or "")) for t in ts]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
