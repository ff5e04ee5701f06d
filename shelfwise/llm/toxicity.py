"""Toxicity by multiple-instance learning.

Labels mark whole documents; what offends is some of their sentences.  A
sentence with score p is a logistic model of its words, and a document's score
is the noisy-or of its sentences, ``1 - prod(1 - p)``.  Training maximises the
likelihood of the document labels through that noisy-or, so the weights end up
on what only the offending sentences have, and each sentence's own score then
locates it.

Features of a word are the word and its prefixes of 4, 5 and 6 bytes, so
inflected forms of a known stem are caught.  The most telling features, by the
chi-square of their document counts, make up the model; a sentence without any
of them scores 0, so length alone never makes a document toxic.

The model is fitted on at most ``sample`` labelled documents of each class,
those with the smallest hash of their id, and on at most ``max_features``
features; these bounds keep the training data that the driver holds small.
Every document is scored in full, one text at a time.

Cases: null or empty text scores 0; labels other than 0 and 1 and labels of
rows kept out of training are ignored; an id labelled twice counts as toxic if
one label says so; without labelled documents of both classes every score is
0; repeated rows get the same score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few_rows, short_batches

SAMPLE = 3000
MAX_FEATURES = 4096
MIN_CHI2 = 15.0
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
HEAD = min(PREFIXES)
# words a worker keeps the scores of
MAX_WORDS = 200_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SENTENCE = re.compile(rb"[.!?\n]+")


def features_of(word: bytes) -> list[bytes]:
    return [word + b"$", *(word[:n] for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float
    words: dict[bytes, float] = field(default_factory=dict)
    heads: frozenset[bytes] = frozenset()

    def __post_init__(self):
        # first bytes of all features: most words start with none of them
        self.heads = frozenset(f.removesuffix(b"$")[:HEAD] for f in self.weights)

    def known(self, word: bytes) -> float:
        """Sum of the weights of a word's features, 0 if it has none."""
        if word[:HEAD] not in self.heads:
            return 0.0
        s = self.words.get(word)
        if s is None:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            s = sum(self.weights.get(f, 0.0) for f in features_of(word))
            self.words[word] = s
        return s

    def sentences(self, text: bytes | None) -> list[tuple[int, float]]:
        """(sentence number, score) of the sentences that hold a feature."""
        if not text:
            return []
        text = text.lower()
        if not any(map(self.known, set(_WORD.findall(text)))):
            return []
        out = []
        for i, s in enumerate(_SENTENCE.split(text)):
            z = [x for x in map(self.known, _WORD.findall(s)) if x]
            if z:
                out.append((i, float(1 / (1 + np.exp(-np.clip(self.bias + sum(z), -30, 30))))))
        return out


def noisy_or(scores: list[float]) -> float:
    return float(-np.expm1(np.sum(np.log1p(-np.minimum(scores, 1 - 1e-12))))) if scores else 0.0


def held_out(id_: Column) -> Column:
    """Rows never trained on: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    sample: int) -> DataFrame:
    """(y, text): at most ``sample`` documents of each class, none of them held out."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    there = marks.join(texts.select("id").distinct(), "id", "left_semi")
    # a hash below the share that is wanted (and half as much again) leaves few to sort
    n = {r.y: r.n for r in there.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    chosen = [there.filter((F.col("y") == y) & (place <= (1 << 20) * 1.5 * sample / max(n.get(y, 1), 1)))
              .orderBy(place, "id").limit(sample) for y in (0, 1)]
    # at most 2 * sample rows of two numbers
    return texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").dropDuplicates(["id"]).select("y", "text")


def _telling(sample: DataFrame, max_features: int) -> list[bytes]:
    """Features whose document counts differ most between the classes, by chi-square."""
    def features(batches):
        for b in batches:
            y, found = [], []
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {f for w in set(_WORD.findall((text or b"").lower())) for f in features_of(w)}
                y.extend([label] * len(own))
                found.extend(own)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(found, pa.binary())],
                                             names=["y", "feature"])

    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return []
    a, c = F.col("a"), F.col("c")           # documents with the feature: toxic, other
    n = n0 + n1
    chi2 = (F.pow(a * n0 - c * n1, 2) * n / ((a + c) * (n - a - c + 1) * n0 * n1))
    rows = (sample.mapInArrow(features, "y int, feature binary").groupBy("feature")
            .agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("c"))
            .withColumn("chi2", chi2).filter((F.col("chi2") >= MIN_CHI2) & (a + c >= 3))
            .orderBy(F.desc("chi2"), "feature").limit(max_features).collect())
    return [bytes(r.feature) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", *, sample: int = SAMPLE, max_features: int = MAX_FEATURES) -> Model:
    """The model of the labelled documents that are not held out."""
    rows = training_sample(docs, labels, id_col, text_col, label_col, sample).cache()
    names = _telling(rows, max_features)
    number = {f: i for i, f in enumerate(names)}

    def bags(batches):
        """Per document its label and its sentences' feature numbers, each sentence ended by -1."""
        for b in batches:
            y, flat = [], []
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = []
                for s in _SENTENCE.split((text or b"").lower()):
                    hits = [number[f] for w in _WORD.findall(s) for f in features_of(w) if f in number]
                    if hits:
                        own += [*hits, -1]
                y.append(label)
                flat.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(flat, pa.list_(pa.int32()))],
                                             names=["y", "bag"])

    bags_ = rows.mapInArrow(bags, "y int, bag array<int>").collect() if names else []
    rows.unpersist()
    weights, bias = train([(r.y, r.bag) for r in sorted(bags_, key=lambda r: (r.y, r.bag))], len(names))
    return Model(dict(zip(names, weights.tolist())), bias)


def train(bags: list[tuple[int, list[int]]], n_features: int, *, steps: int = 300, rate: float = 0.2,
          decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Adam on the noisy-or likelihood, classes weighted equally.

    A bag is a document: feature numbers with -1 after each sentence.
    """
    y = np.array([label for label, _ in bags if _], float)
    flat = np.concatenate([np.array(b, np.int64) for _, b in bags if b]) if len(y) else np.zeros(0, np.int64)
    if not len(y) or not n_features:
        return np.zeros(n_features), 0.0
    end = flat < 0
    sentence = (np.cumsum(end) - end)[~end]                   # of each feature occurrence
    feature = flat[~end]
    per_doc = np.array([b.count(-1) for _, b in bags if b])
    doc = np.repeat(np.arange(len(y)), per_doc)               # of each sentence
    n_sentences, n_toxic = len(doc), max(y.sum(), 1)
    importance = np.where(y > 0, 0.5 / n_toxic, 0.5 / max(len(y) - n_toxic, 1))
    theta = np.zeros(n_features + 1)
    theta[-1] = -2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))    # prod(1 - p)
        some = np.maximum(1 - none, 1e-12)
        g = p * np.where(y > 0, importance * none / some, -importance)[doc]
        grad = np.append(np.bincount(feature, g[sentence], n_features), g.sum()) - decay * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from THRESHOLD on) and ``offending``: (sentence,
    score) of the sentences that score 0.5 or more.  Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.weights, model.bias))
    made = {"score": pa.float64(), "predicted": pa.int32(), "offending": pa.list_(
        pa.struct([("sentence", pa.int32()), ("score", pa.float64())]))}
    kept = docs.drop(*made)
    at = kept.columns.index(text_col)

    def scored(batches):
        m = shared.value
        for b in few_rows(batches):
            p, found = [], []
            for text in b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist():
                s = m.sentences(text)
                p.append(noisy_or([x for _, x in s]))
                found.append([{"sentence": i, "score": x} for i, x in s if x >= 0.5])
            new = [p, [int(x >= THRESHOLD) for x in p], found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(x, t) for x, t in zip(new, made.values()))], names=[*b.schema.names, *made])

    offending = T.StructType().add("sentence", T.IntegerType()).add("score", T.DoubleType())
    schema = T.StructType(list(kept.schema.fields)).add("score", T.DoubleType()).add("predicted", T.IntegerType()) \
        .add("offending", T.ArrayType(offending))
    return short_batches(kept).mapInArrow(scored, schema)
