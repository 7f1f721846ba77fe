"""Toxicity by multiple-instance learning: sentences are scored, documents labelled.

A sentence (text between ``. ! ?`` or line ends) has the logit ``bias + sum of the weights of its words``. A word is a
run of ASCII letters (A-Z folded) and bytes beyond ASCII; its weight is the sum of the weights of the word and of its
first four, five and six bytes, hashed to ``2**BITS`` columns. The document's probability is the noisy-or of its sentences', ``1 - prod(1 - p)``, and is fitted to the
document labels by gradient descent; so the sentences that explain a label are found without labels of their own.

The model is fitted in one task, on a sample of labelled rows bounded by ``SAMPLE_ROWS`` whatever the input; columns of
the sample are made in parallel before. Scoring reads every whole text in a narrow pass without a shuffle; the
broadcast weights have the fixed size ``2**BITS``.

Defined cases: a null text counts as empty; a text without a word has no sentence and the score 0; null or
contradictory labels aren't learnt from; without both classes in the sample every sentence has the probability
``BASE_RATE``; repeated rows are scored one by one; an empty table gives an empty result; other columns, ``lang``,
``source`` and ids among them, never enter a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, expm1, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, sample_texts, table
from .word_hash import run_hashes

BITS = 20
SAMPLE_ROWS = 12_000
THRESHOLD = 0.5
STEPS = 50
RATE = 0.3
SPARSITY = 5e-4
BASE_RATE = 1e-4
LEAST_ROWS = 3
STEMS = (4, 5, 6)
SEGMENT_BYTES = 1 << 22
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".!?\n\r"]] = True
_NEXT_MARK = re.compile(rb"[.!?\n\r]")


@dataclass
class Words:
    """The words of a stretch of text: their columns (-1: no such stem) and the sentence that each is in."""

    columns: np.ndarray  # a row for each word: the word, then its stems
    sentence: np.ndarray  # ascending
    marks: np.ndarray  # byte positions of the sentence ends


def _words(data: bytes) -> Words:
    raw = np.frombuffer(data.lower(), np.uint8)
    marks = np.flatnonzero(_MARK[raw])
    letter = np.zeros(len(raw) + 2, bool)
    letter[1:-1] = _LETTER[raw]
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return Words(np.empty((0, 1 + len(STEMS)), np.int64), np.empty(0, np.int64), marks)
    sizes = ends - starts
    columns = np.full((len(starts), 1 + len(STEMS)), -1)
    shift = np.uint64(64 - BITS)
    columns[:, 0] = run_hashes(raw, starts, sizes) >> shift
    for k, n in enumerate(STEMS, 1):
        long = np.flatnonzero(sizes > n)  # of a word of n bytes the stem is the word itself
        if len(long):
            columns[long, k] = run_hashes(raw, starts[long], np.full(len(long), n)) >> shift
    return Words(columns, np.searchsorted(marks, starts), marks)


def stretches(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(byte position, bytes) of a text in stretches of bounded size that end at a sentence's end."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > SEGMENT_BYTES and (m := _NEXT_MARK.search(data, at + SEGMENT_BYTES)):
            end = m.end()
        yield at, data[at:end]
        at = end


@dataclass
class Model:
    weights: np.ndarray  # one more than columns: the last, at -1, is 0
    bias: float

    def sentences(self, text: str | None, least: float) -> tuple[list[float], list[tuple[int, int, float]]]:
        """Log-odds of all sentences that have a word; start, end (code points) and log-odds of those of ``least``."""
        logits, spans, points, done = [], [], 0, 0
        whole = (text or "").encode()
        for at, data in stretches(whole):
            words = _words(data)
            if not len(words.sentence):
                continue
            weight = self.weights[words.columns].sum(axis=1, dtype=np.float64)
            number, place = np.unique(words.sentence, return_inverse=True)
            z = self.bias + np.bincount(place, weights=weight)
            logits += z.tolist()
            for k in np.flatnonzero(z >= least):
                i = number[k]
                start = words.marks[i - 1] + 1 if i else 0
                end = words.marks[i] if i < len(words.marks) else len(data)
                points += len(whole[done : at + start].decode())
                done = at + start
                spans.append((points, points + len(data[start:end].decode()), float(z[k])))
        return logits, spans

    def score(self, text: str | None) -> float:
        return noisy_or(self.sentences(text, np.inf)[0])


def noisy_or(logits: list[float]) -> float:
    """1 - prod(1 - sigmoid(z)), by the sum of log(1 - sigmoid(z)) = -log(1 + exp(z))."""
    total = sum(n * (z if z > 30 else log1p(exp(z))) for z, n in Counter(logits).items())
    return abs(expm1(-total)) if total < 700 else 1.0


def document_columns(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Columns of all sentences in a row, and the number of columns of each sentence that has some."""
    columns, sizes = [], []
    for _, data in stretches((text or "").encode()):
        words = _words(data)
        real = words.columns >= 0
        columns.append(words.columns[real].astype(np.int32))
        if len(words.sentence):
            per_sentence = np.bincount(words.sentence, weights=real.sum(axis=1)).astype(np.int32)
            sizes.append(per_sentence[per_sentence > 0])
    none = [np.empty(0, np.int32)]
    return np.concatenate(none + columns), np.concatenate(none + sizes)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Model:
    """Adam steps on the mean log loss of the noisy-or, classes weighted alike by half.

    Weights stay at 0 or above, so that no harmless word can outweigh an offending one, and a small constant pull
    towards 0 leaves the words that happen to be near offending ones without weight.
    """
    size = 1 << BITS
    used = [i for i, (_, sizes) in enumerate(docs) if len(sizes)]
    label = label[used].astype(float)
    bias = float(np.log(BASE_RATE / (1 - BASE_RATE)))
    if not used or label.min() == label.max():
        return Model(np.zeros(size + 1, np.float32), bias)
    # Only columns of several documents can tell anything of a new one; the others keep the weight 0.
    rows = np.zeros(size, np.int32)
    for i in used:
        rows[np.unique(docs[i][0])] += 1
    kept = [rows[docs[i][0]] >= LEAST_ROWS for i in used]
    columns = np.concatenate([docs[i][0][k] for i, k in zip(used, kept)])
    per_doc = np.array([len(docs[i][1]) for i in used])
    sizes = np.concatenate([np.add.reduceat(k, np.cumsum(docs[i][1]) - docs[i][1], dtype=np.int64) for i, k in zip(used, kept)])
    of_sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    doc_of = np.repeat(np.arange(len(used)), per_doc)
    cost = np.where(label == 1, 0.5 + 0.5 / (2 * label.mean()), 0.5 + 0.5 / (2 * (1 - label.mean())))
    cost /= cost.sum()
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = bias
    for step in range(1, STEPS + 1):
        z = np.clip(np.bincount(of_sentence, weights=w[columns], minlength=len(sizes)) + w[size], -30, 30)
        p = 1 / (1 + np.exp(-z))
        silent = np.add.reduceat(-np.logaddexp(0, z), first)  # log P(no sentence is toxic)
        quiet = np.exp(silent)
        # d loss / d silent: label 1 has -log(1 - quiet), label 0 has -silent
        slope = cost * np.where(label == 1, quiet / np.maximum(1 - quiet, 1e-9), -1.0)
        dz = -slope[doc_of] * p
        g = np.bincount(columns, weights=dz[of_sentence], minlength=size + 1)
        g[size] = dz.sum()
        g[:size] += SPARSITY
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        np.maximum(w[:size], 0, out=w[:size])
    bias = float(w[size])
    w[size] = 0
    return Model(w.astype(np.float32), bias)


def train_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most ``sample_rows`` labelled rows that aren't held out."""
    texts = sample_texts(documents, labels, label, sample_rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [document_columns(x) for x in b.column(2).to_pylist()]
            columns, sizes = [c.astype("<i4").tobytes() for c, _ in found], [s.astype("<i4").tobytes() for _, s in found]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(columns, pa.binary()), pa.array(sizes, pa.binary())], names=["label", "columns", "sizes"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((c, s, y) for b in batches for y, c, s in zip(*(x.to_pylist() for x in b.columns)))
        model = fit([(np.frombuffer(c, "<i4"), np.frombuffer(s, "<i4")) for c, s, _ in got], np.array([y for _, _, y in got]))
        yield pa.RecordBatch.from_pylist([{"weights": model.weights.astype("<f4").tobytes(), "bias": model.bias}])

    row = texts.mapInArrow(make, "label int, columns binary, sizes binary").repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(row["weights"], "<f4"), row["bias"])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def toxicity_scores(documents: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, score, and sentences: start, end (code points) and score of each sentence that reaches the threshold."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    least = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores, spans = [], []
            for x in b.column(1).to_pylist():
                logits, found = m.sentences(x, least)
                scores.append(noisy_or(logits))
                spans.append([{"start": s, "end": e, "score": 1 / (1 + exp(-min(z, 700)))} for s, e, z in found])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, _ARROW_SPANS)], names=["_key", "score", "sentences"])

    d = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = T.StructType([T.StructField("_key", d.schema["_key"].dataType), T.StructField("score", T.DoubleType()), T.StructField("sentences", SPANS)])
    return d.mapInArrow(run, out).select(F.col("_key").alias(key), "score", "sentences")


def op9_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.array_join(F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("sentences"),
    )
