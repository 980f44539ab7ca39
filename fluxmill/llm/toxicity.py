"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import per_batch, slices, text_column
from fluxmill.workspace import stored

LENGTHS = (4, 5)
BITS = 20
SAMPLE_ROWS = 4_000
SMOOTHING = 1.0
CONFIDENCE = 2.0  # standard errors
EPOCHS = 3
LEAST_STEPS = 100  # a small sample is gone through more often
RATE = 0.1
PENALTY = 1e-4
MINI_BATCH = 64
THRESHOLD = 0.3
UNFITTED_BIAS = -500.0  # a score of 0: nothing counts as toxic without a label that says so
FOLDS, HELD_OUT = 4, 2
SEED = 11


@dataclass(frozen=True)
class Model:
    """weights: of each n-gram bucket, its log-count ratio already multiplied in."""

    weights: np.ndarray
    bias: float


def features(text: bytes, mark: np.ndarray) -> np.ndarray:
    """Distinct n-gram buckets of a lower-cased text, in order of first use. mark: scratch of 2^BITS numbers."""
    codes = np.frombuffer(b" " .join((b"", text.lower(), b"")).decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    found = []
    for n in LENGTHS:
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        found.append((value >> np.uint64(64 - BITS)).astype(np.int32))
    if not found:
        return np.zeros(0, np.int32)
    buckets = np.concatenate(found)
    order = np.arange(len(buckets), dtype=np.int32)
    mark[buckets[::-1]] = order[::-1]
    return buckets[mark[buckets] == order]


def _featured(batch: pa.RecordBatch) -> pa.RecordBatch:
    mark = np.zeros(1 << BITS, np.int32)
    blobs = [features(text, mark).tobytes() for text in text_column(batch)]
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:3], pa.array(blobs, pa.binary())], ["doc_id", "rank", "toxic", "found"]
    )


def train(found: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Fit on feature lists and 0/1 labels, in the order given. One class only: its smoothed share as a bias."""
    n, size = len(found), 1 << BITS
    positive = float(toxic.sum())
    share = (positive + 0.5) / (n + 1.0)
    bias = float(np.log(share / (1.0 - share)))
    weights = np.zeros(size)
    if positive == 0 or positive == n:
        return Model(weights, bias)
    present = [np.zeros(size), np.zeros(size)]
    for row, label in zip(found, toxic):
        present[int(label)][row] += 1.0
    yes, no = present[1] + SMOOTHING, present[0] + SMOOTHING
    ratio = np.log(yes / (positive + 2 * SMOOTHING)) - np.log(no / (n - positive + 2 * SMOOTHING))
    # What chance alone could make of a ratio is taken off it; rare and even n-grams end at none.
    error = np.sqrt(1.0 / yes + 1.0 / no)
    ratio = np.sign(ratio) * np.maximum(0.0, np.abs(ratio) - CONFIDENCE * error)
    squares = np.full(size, 1e-8)
    bias_square = 1e-8
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-n // MINI_BATCH)))):
        for begin in range(0, n, MINI_BATCH):
            rows = found[begin : begin + MINI_BATCH]
            label = toxic[begin : begin + MINI_BATCH]
            at = np.concatenate(rows)
            owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            score = bias + np.bincount(owner, weights[at] * ratio[at], len(rows))
            wrong = 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30))) - label
            touched, where = np.unique(at, return_inverse=True)
            slope = np.bincount(where, wrong[owner]) * ratio[touched] / len(rows) + PENALTY * weights[touched]
            squares[touched] += slope * slope
            weights[touched] -= RATE * slope / np.sqrt(squares[touched])
            slope = float(wrong.mean())
            bias_square += slope * slope
            bias -= RATE * slope / bias_square**0.5
    return Model(weights * ratio, bias)


def _fit(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("rank").to_numpy(), kind="stable").tolist()
    blobs = table.column("found")
    found = [np.frombuffer(blobs[i].as_buffer(), np.int32) for i in order]
    model = train(found, table.column("toxic").to_numpy()[order].astype(np.float64))
    return pa.table({"weights": pa.array([model.weights.astype(np.float32).tobytes()]), "bias": pa.array([model.bias])})


def with_fold(rows: DataFrame) -> DataFrame:
    """Adds held_out: crc32 of the id as text leaves HELD_OUT modulo FOLDS. A null id is not held out."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return rows.withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(False)))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from labelled rows that are not held out: about sample_rows of them at most, drawn by a seeded hash.

    A label over 0 says toxic, any other not. A document with several labels counts as toxic if one
    of them says so; null labels and ids are left out, and of several texts of one id all but one.
    Without any labelled text every score is 0, so no text counts as toxic. The model has a fixed size.
    """
    known = (
        with_fold(labels.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")))
        .where("not held_out and doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)).alias("rank"))
    )
    known = stored(known, "labelled")
    rows = known.count()
    drawn = known.where(F.col("rank") < int((1 << 30) * min(1.0, sample_rows / max(rows, 1))))
    texts = docs.select(F.col("doc_id").alias("text_id"), "text")
    # The sample is bounded by its parameter, so it may be sent to all tasks; no text is shuffled.
    joined = texts.join(F.broadcast(drawn), F.col("text_id") == F.col("doc_id"))
    ranked = joined.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("rank", "doc_id", "text").alias("rank"), "toxic", "text"
    )
    found = ranked.mapInArrow(per_batch(_featured), "doc_id string, rank long, toxic int, found binary")
    # A labelled id may have any number of copies in docs; one of them is fitted on.
    each = found.groupBy("doc_id").agg(F.min(F.struct("rank", "toxic", "found")).alias("row")).select("row.*")
    models = each.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit, "weights binary, bias double").collect()
    if not models:
        return Model(np.zeros(1 << BITS), UNFITTED_BIAS)
    return Model(np.frombuffer(models[0].weights, np.float32).astype(np.float64), models[0].bias)


def _score(weights, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << BITS, np.int32)
        table = weights.value
        for batch in slices(batches):
            sums = [bias + float(table[features(text, mark)].sum(dtype=np.float64)) for text in text_column(batch)]
            scores = 1.0 / (1.0 + np.exp(-np.clip(np.array(sums), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "score"]
            )

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Scores see the text alone.

    Null and empty texts get the score of a text without n-grams; null and repeated ids keep
    their rows. One pass over the documents without a shuffle, after the fit.
    """
    rows = with_fold(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return _scored(rows.select("doc_id", "held_out", "text"), fit(docs, labels), threshold)


def _scored(rows: DataFrame, model: Model, threshold: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model.weights.astype(np.float32))  # 4 MB, whatever the input
    scored = rows.mapInArrow(_score(shared, model.bias), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs scored under the threshold, all columns kept, in one pass over docs.

    Without any labelled text to fit on (no labels, null ones, or none outside the held-out fold) all rows stay.
    """
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights.astype(np.float32))
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << BITS, np.int32)
        for batch in slices(batches):
            sums = [bias + float(shared.value[features(t, mark)].sum(dtype=np.float64)) for t in text_column(batch)]
            yield batch.filter(pa.array(1.0 / (1.0 + np.exp(-np.clip(np.array(sums), -500, 500))) < threshold))

    return docs.mapInArrow(run, docs.schema)
