"""Toxicity by multiple-instance learning: sentence scores, trained from document labels alone.

A sentence's probability is a logistic function of its distinct words and their stems of four and five letters; a document's is the noisy-or of its sentences,
1 - prod(1 - p). In scoring, that product takes every sentence with clear evidence and, of the others, the strongest
alone: thousands of faint ones would add up, and a text's score would grow with its length. The weights maximise the likelihood of document labels (Adagrad with an L1 proximal step), so the
model finds by itself which sentences offend; it is fitted on the driver from a sample bounded by PER_LABEL and
MAX_CHARS, then calibrated on rows kept out of training. Scoring reads every whole text and can return the offending
sentences with their spans.

Defined results: a null or empty text has no sentence and the score of a document without evidence; repeated rows are
scored alike and all returned; without labelled rows of both kinds the score is the smoothed share of label 1; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_sample, small_batches, texts

#: The sample's bounds: rows of a label, characters of a text.
PER_LABEL, MAX_CHARS = 2500, 20_000
#: Documents that a word must be in; passes; step; L1 strength on the mean gradient.
MIN_DOCS, STEPS, RATE, L1 = 5, 150, 0.7, 0.0001
#: Log-odds of a sentence without evidence.
BIAS = -6.0
#: Log-odds (probability 0.9) from which a sentence has clear evidence.
CLEAR = 2.2
#: Log-odds of a document beyond which calibration sees no difference, so that few far ones do not flatten the curve.
FARTHEST = 7.0
WORDS = re.compile(r"[^\W\d_]+")
SENTENCES = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences: up to an end mark or a line feed."""
    return [m.span() for m in SENTENCES.finditer(text)]


def features(word: str) -> tuple[str, ...]:
    """The word and its stems, which inflected and compounded forms share."""
    return (word, word[:4] + "*", word[:5] + "*") if len(word) > 4 else (word, word + "*") if len(word) == 4 else (word,)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self):
        self.stems = {f[:-1] for f in self.weights if f[-1] == "*"}

    def evidence(self, words: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for w in sorted(set(words)) for f in features(w))

    def logit(self, sentence: str) -> float:
        return self.bias + self.evidence(WORDS.findall(sentence.lower()))

    def clean(self, text: str) -> float:
        """Log of the probability that no clear sentence and not the strongest of the others offends.

        Sentences without a word of any weight have the bias alone.
        """
        known, stems = self.weights, self.stems
        total, faint = 0.0, None
        for s in SENTENCES.findall(text.lower()):
            found = [w for w in WORDS.findall(s) if w[:4] in stems or w[:5] in stems or w in known]
            z = self.bias + self.evidence(found) if found else self.bias
            if z >= CLEAR:
                total -= softplus(z)
            elif faint is None or z > faint:
                faint = z
        return total if faint is None else total - softplus(faint)

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * logit_of(self, text or "") + self.shift))))

    def offending(self, text: str | None, least: float = 0.5) -> list[tuple[int, int, float]]:
        """Start, end and probability of the sentences that reach least."""
        out = []
        for a, b in sentences(text or ""):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.logit(text[a:b])))))
            if p >= least:
                out.append((a, b, p))
        return out


def softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def fit(rows: list[tuple[str, int]]) -> Model:
    """A model of (text, label) rows; every fourth row calibrates."""
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    constant = Model({}, -30.0, 0.0, math.log(share / (1 - share)))
    if len({y for _, y in rows}) < 2:
        return constant
    train = [r for i, r in enumerate(rows) if i % 4 or len(rows) < 40]
    bags = [([sorted(set(WORDS.findall(t[a:b].lower()))) for a, b in sentences(t)] or [[]], y) for t, y in train]
    bags = [([[f for w in s for f in features(w)] for s in bag], y) for bag, y in bags]
    seen = Counter(f for bag, _ in bags for f in {f for s in bag for f in s})
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= min(MIN_DOCS, max(1, len(train) // 10))))}
    doc_of, row_of, col_of, k = [], [], [], 0
    for d, (bag, _) in enumerate(bags):
        for s in bag:
            doc_of.append(d)
            ids = [vocabulary[w] for w in s if w in vocabulary]
            row_of += [k] * len(ids)
            col_of += ids
            k += 1
    doc_of, row_of, col_of = (np.array(x, np.int64) for x in (doc_of, row_of, col_of))
    y = np.array([y for _, y in bags], float)
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) / len(y)
    w = np.zeros(len(vocabulary))
    sw = np.full(len(vocabulary), 1e-8)
    for _ in range(STEPS):
        z = BIAS + np.bincount(row_of, w[col_of], minlength=k)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))  # log prod(1 - p)
        any_ = np.maximum(-np.expm1(none), 1e-9)
        pull = np.where(y == 1, np.exp(none) / any_, -1.0) * balance
        g = pull[doc_of] * p
        gw = np.bincount(col_of, g[row_of], minlength=len(w))
        sw += gw * gw
        step = RATE / np.sqrt(sw)
        w += step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
    names = list(vocabulary)
    model = Model({names[i]: float(w[i]) for i in np.nonzero(np.abs(w) > 1e-3)[0]}, BIAS)
    held = [r for i, r in enumerate(rows) if not i % 4 or len(rows) < 40]
    model.slope, model.shift = platt(np.array([logit_of(model, t) for t, _ in held]), np.array([y for _, y in held], float))
    return model


def logit_of(model: Model, text: str) -> float:
    """Log-odds that a text offends, of at most FARTHEST either way."""
    p = -math.expm1(model.clean(text))
    return max(-FARTHEST, min(FARTHEST, math.log(max(p, 1e-12)) - math.log(max(1 - p, 1e-12))))


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of y over z, by damped Newton steps on smoothed labels."""
    if len(y) == 0:
        return 1.0, 0.0
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.clip(z, -30, 30)
    a, b = 0.5, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, s = t - p, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(r * z).sum() - 1e-3 * a, r.sum()])
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        d *= min(1.0, 2.0 / max(1e-12, float(np.abs(d).max())))
        a, b = a + d[0], b + d[1]
        if np.abs(d).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def fit_on(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic") -> Model:
    """A model of the labelled documents for whose doc_id may_learn holds."""
    marked = labels.filter(may_learn & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = texts(docs).join(marked, "doc_id")
    got = sorted(labelled_sample(rows, "label", PER_LABEL, 2 * PER_LABEL, MAX_CHARS), key=lambda r: (r.doc_id * 2654435761 & 0xFFFFFFFF, r.doc_id))
    return fit([(r.text, r.label) for r in got])


def predict(docs: DataFrame, model: Model, least: float = 0.7, spans: bool = False) -> DataFrame:
    """doc_id, score, predicted and, if asked for, the offending sentences, for every row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the words of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            ts = b.column("text").to_pylist()
            p = [own.score(t) for t in ts]
            cols = [b.column("doc_id"), pa.array(p, pa.float64()), pa.array([int(x >= least) for x in p], pa.int32())]
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                cols.append(pa.array([[{"start": a, "end": z, "score": s} for a, z, s in own.offending(t)] for t in ts], kind))
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, score double, predicted int" + ", offending array<struct<start:long,end:long,score:double>>" * spans
    names = ["doc_id", "score", "predicted", "offending"][: 3 + spans]
    return texts(docs).mapInArrow(run, schema)
