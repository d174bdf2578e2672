"""Bounded samples of labelled documents, and small helpers to fit on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import encoded, mapped, pieces


def fold(doc_id: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


@dataclass
class Sample:
    """Labelled texts and their weights; a weight tells how many labelled documents one of the
    sample stands for."""

    texts: list[bytes]
    label: np.ndarray
    weight: np.ndarray

    @property
    def rate(self) -> float:
        """The share of label 1, pulled a little towards a half."""
        ones = float((self.weight * self.label).sum())
        return (ones + 1) / (float(self.weight.sum()) + 2)

    @property
    def one_sided(self) -> bool:
        """Whether there is nothing to tell apart."""
        return len(set(self.label.tolist())) < 2


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
           per_class: int) -> Sample:
    """At most `per_class` documents of each label, none of the fold `held`, with their whole texts.

    Of more labelled documents those with the least hash of their id are taken, so reruns
    agree. Labels other than 0 and 1 and null ids are left out; of several labels of one id
    the largest counts, of several texts of one id the last in order.
    """
    told = (labels.filter(F.col(label).isin(0, 1) & (fold("doc_id", folds) != held))
            .groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("label")))
    counts = {r.label: r["count"] for r in told.groupBy("label").count().collect()}
    order = F.xxhash64("id")
    chosen = None
    for value in sorted(counts):
        part = told.filter(F.col("label") == value).orderBy(order, "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return Sample([], np.empty(0), np.empty(0))
    # The sample has a fixed bound, so it may be broadcast.
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id")).groupBy("id").agg(
            F.max("label").alias("label"), F.max("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = encoded(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"), pa.array(texts, pa.binary())],
                names=["id", "label", "text"])

    found = sorted(mapped(texts, run, "id string, label int, text binary").collect(), key=lambda r: r.id)
    label = np.array([r.label for r in found], dtype=float)
    known = {value: max(1, int((label == value).sum())) for value in counts}
    return Sample([bytes(r.text) for r in found], label,
                  np.array([counts[int(x)] / known[int(x)] for x in label]))


class Adam:
    """Adam steps for some arrays, in place."""

    def __init__(self, arrays: list[np.ndarray], steps: int, rate: float) -> None:
        self.arrays, self.steps, self.rate, self.step = arrays, steps, rate, 0
        self.mean = [np.zeros_like(a) for a in arrays]
        self.square = [np.zeros_like(a) for a in arrays]

    def __call__(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        rate = self.rate * max(0.02, 1 - self.step / self.steps)
        for a, slope, m, s in zip(self.arrays, slopes, self.mean, self.square):
            m += 0.1 * (slope - m)
            s += 0.01 * (slope * slope - s)
            a -= rate * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-7)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrated(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients, the constant last, of a logistic regression by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    c = np.zeros(x.shape[1])
    weight = weight / weight.mean()
    for _ in range(30):
        p = sigmoid(x @ c)
        slope = x.T @ (weight * (p - label)) + ridge * c
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(c))
        step = np.linalg.solve(curve, slope)
        c -= step
        if np.abs(step).max() < 1e-8:
            break
    return c


def scored(docs: DataFrame, model, folds: int, held: int, threshold: float) -> DataFrame:
    """doc (a row of `docs`), held_out, score, predicted. `model` has score(text as bytes).

    A null text counts as empty; a null doc_id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.score
        for batch in pieces(batches):
            scores = [score(text) for text in encoded(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("held_out"),
                 pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc", "held_out", "score", "predicted"])

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"))
    schema = rows.drop("text").withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    return mapped(rows, run, schema)
