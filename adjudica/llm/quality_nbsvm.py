"""Document quality by naive Bayes support vectors.

Features are indicators of n-grams, hashed to ``2**BITS`` columns: words and word pairs (ASCII case folded), and one to
three neighbouring word shapes. A shape is a word with each run of upper case, lower case, digits or one other
character written once, and a mark if the word repeats the one before. Each column is scaled by its
class log-count ratio, rows are brought to length one, and a linear hinge-loss model is fitted by dual coordinate
descent. A logistic curve, fitted on rows left out of the descent, turns margins into probabilities.

The model is fitted in one task, on a sample of labelled rows bounded by ``SAMPLE_ROWS`` whatever the input; features
of the sample are made in parallel before. Scoring reads every whole text in a narrow pass without a shuffle; the
broadcast weights have the fixed size ``2**BITS``.

Defined cases: a null text counts as empty; an empty text has the constant column alone; null or contradictory labels
aren't learnt from; without both classes in the sample all scores are the smoothed share of label 1 (0.5 without any
row); repeated rows are scored one by one; an empty table gives an empty result; other columns, ``lang``, ``source``
and ids among them, never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, sample_texts, table
from .word_hash import word_hashes

BITS = 20
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
MIX = np.uint64(0x9E3779B97F4A7C15)
SEEDS = np.arange(1, 6, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
REPEATS = np.uint64(0x94D049BB133111EB)

def _column(parts: list[np.ndarray], seed: np.uint64) -> np.ndarray:
    h = np.full(len(parts[-1]), seed)
    for p in parts:
        h = (h ^ p[: len(h)]) * MIX
        h ^= h >> np.uint64(29)
    # Column 0 is the constant's, which is put in front afterwards.
    return np.maximum((h * MIX >> np.uint64(64 - BITS)).astype(np.int32), 1)


def features(text: str | None) -> np.ndarray:
    """The columns that a text has, ascending, column 0 first."""
    word, form = word_hashes(text, shapes=True)
    if not len(word):
        return np.zeros(1, np.int32)
    form[1:] ^= np.where(word[1:] == word[:-1], REPEATS, np.uint64(0))
    found = np.concatenate([
        _column([word], SEEDS[0]), _column([word, word[1:]], SEEDS[1]),
        _column([form], SEEDS[2]), _column([form, form[1:]], SEEDS[3]), _column([form, form[1:], form[2:]], SEEDS[4]),
    ])
    found.sort()
    first = np.empty(len(found), bool)
    first[0] = True
    np.not_equal(found[1:], found[:-1], out=first[1:])
    return np.concatenate([np.zeros(1, np.int32), found[first]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Model:
    """Probability of label 1: logistic(slope * margin + offset); the margin is the row's weights over its length."""

    weights: np.ndarray  # descent weight times ratio, a column each
    ratio: np.ndarray
    slope: float
    offset: float

    def margin(self, columns: np.ndarray) -> float:
        r = self.ratio[columns]
        length = float(np.sqrt(r @ r))
        return float(self.weights[columns].sum()) / length if length else 0.0

    def score(self, text: str | None) -> float:
        return float(_sigmoid(self.slope * self.margin(features(text)) + self.offset))

    def to_bytes(self) -> tuple[bytes, bytes, float, float]:
        return self.weights.astype("<f4").tobytes(), self.ratio.astype("<f4").tobytes(), self.slope, self.offset

    @staticmethod
    def from_row(row) -> Model:
        return Model(np.frombuffer(row["weights"], "<f4"), np.frombuffer(row["ratio"], "<f4"), row["slope"], row["offset"])


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Dual coordinate descent for min |w|^2 / 2 + cost * sum of hinge losses; rows of length one, y in -1, 1.

    Classes count alike: the cost of a row is COST over its class's share.
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norm = np.array([v @ v for v in values])
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    limit = COST / (2 * share)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in order.permutation(len(rows)):
            if not norm[i]:
                continue
            c, v = rows[i], values[i]
            gradient = y[i] * (w[c] @ v) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), limit[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[c] += step * y[i] * v
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1) by Newton steps; targets are smoothed so that separable margins stay finite."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = _sigmoid(slope * margin + offset)
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        a, b, c = h @ (margin * margin) + 1e-6, h @ margin, h.sum() + 1e-6
        g1, g0 = d @ margin, d.sum()
        det = a * c - b * b
        s1, s0 = (c * g1 - b * g0) / det, (a * g0 - b * g1) / det
        slope, offset = slope - s1, offset - s0
        if abs(s1) + abs(s0) < 1e-8:
            break
    return float(slope), float(offset)


def fit(rows: list[np.ndarray], label: np.ndarray) -> Model:
    """A model of rows of columns and labels 0, 1; every fifth row is kept for the curve."""
    size = 1 << BITS
    n1 = int(label.sum())
    if n1 == 0 or n1 == len(label):
        share = (n1 + 1) / (len(label) + 2)
        return Model(np.zeros(size), np.ones(size), 1.0, float(np.log(share / (1 - share))))
    count = np.zeros((2, size))
    for columns, y in zip(rows, label):
        count[y, columns] += 1
    p, q = count[1] + SMOOTHING, count[0] + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    values = []
    for columns in rows:
        r = ratio[columns]
        length = np.sqrt(r @ r)
        values.append(r / length if length else r)
    sign = np.where(label == 1, 1.0, -1.0)
    curve = np.arange(len(rows)) % 5 == 4
    if len(set(label[curve])) < 2 or len(set(label[~curve])) < 2:
        curve = np.zeros(len(rows), bool)
    train = np.flatnonzero(~curve)
    w = descend([rows[i] for i in train], [values[i] for i in train], sign[train], size)
    held = np.flatnonzero(curve) if curve.any() else train
    margin = np.array([w[rows[i]] @ values[i] for i in held])
    slope, offset = logistic_curve(margin, label[held])
    return Model(w * ratio, ratio, slope, offset)


def train_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most ``sample_rows`` labelled rows that aren't held out."""
    texts = sample_texts(documents, labels, label, sample_rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(x).astype("<i4").tobytes() for x in b.column(2).to_pylist()]
            order = [xxhash.xxh64_intdigest(x) >> 1 for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), b.column(1), pa.array(found, pa.binary())], names=["order", "label", "columns"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((o, y, c) for b in batches for o, y, c in zip(*(x.to_pylist() for x in b.columns)))
        model = fit([np.frombuffer(c, "<i4") for _, _, c in got], np.array([y for _, y, _ in got], int))
        yield pa.RecordBatch.from_pylist([dict(zip(("weights", "ratio", "slope", "offset"), model.to_bytes()))])

    made = texts.mapInArrow(make, "order long, label int, columns binary")
    return Model.from_row(made.repartition(1).mapInArrow(learn, "weights binary, ratio binary, slope double, offset double").first())


def quality_scores(documents: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and score (probability of label 1) of each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(x) for x in b.column(1).to_pylist()], pa.float64())], names=["_key", "score"])

    d = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = T.StructType([T.StructField("_key", d.schema["_key"].dataType), T.StructField("score", T.DoubleType())])
    return d.mapInArrow(run, out).select(F.col("_key").alias(key), "score")


def keep_quality(documents: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            at = b.schema.get_field_index(text)
            yield b.filter(pa.array([m.score(x) >= threshold for x in b.column(at).to_pylist()], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op4_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, train_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
