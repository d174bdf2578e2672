"""Quality by a convolutional network over bytes, in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover it wholly. Bytes become
short learned vectors; learned filters slide over them, and each filter's largest response in
a chunk, where positive, counts for the chunk's value. The mean and the least value of a
document's chunks go through a logistic calibration, fitted on documents that the network
has not seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm import learning
from learnertrace.llm.common import table

CHUNK, STEP = 512, 448
VECTOR, WIDTH, FILTERS = 8, 7, 24

#: The bound of the sample: documents of each label, with their whole texts.
PER_CLASS = 4_000
#: Rounds over all chunks, and the least number of steps; steps of so many chunks.
EPOCHS, LEAST_STEPS, BATCH = 2, 1200, 48

#: Chunks that are scored at once, so that memory does not depend on a text's length.
AT_ONCE = 32


def chunks(text: bytes) -> np.ndarray:
    """Rows of CHUNK bytes, zero after the end of a text that is shorter; the last row ends
    with the text. An empty text has one row of zeros."""
    letters = np.frombuffer(text, np.uint8)
    if len(letters) < CHUNK:
        letters = np.concatenate((letters, np.zeros(CHUNK - len(letters), np.uint8)))
    count = -(-(len(letters) - CHUNK) // STEP) + 1
    starts = np.minimum(np.arange(count) * STEP, len(letters) - CHUNK)
    return letters[starts[:, None] + np.arange(CHUNK)]


class Network:
    """Byte vectors, filters, and the weight of each filter in a chunk's value."""

    def __init__(self, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        self.vectors = draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.vectors[0] = 0  # what fills up a short chunk
        self.filters = draw.normal(0, (WIDTH * VECTOR) ** -0.5, (WIDTH * VECTOR, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.weights = draw.normal(0, 0.3, FILTERS).astype(np.float32)
        self.bias = np.ones(1, np.float32)

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.shift, self.weights, self.bias]

    def responses(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretches of bytes as vectors, and each filter's response to each."""
        spread = np.lib.stride_tricks.sliding_window_view(self.vectors[rows], WIDTH, axis=1)
        stretches = np.ascontiguousarray(spread.transpose(0, 1, 3, 2)).reshape(len(rows), -1, WIDTH * VECTOR)
        return stretches, (stretches.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(
            len(rows), -1, FILTERS)

    def values(self, rows: np.ndarray) -> np.ndarray:
        """The value of each chunk."""
        found = []
        for start in range(0, len(rows), AT_ONCE):
            largest = self.responses(rows[start:start + AT_ONCE])[1].max(1) + self.shift
            found.append(np.maximum(largest, 0) @ self.weights + self.bias[0])
        return np.concatenate(found)

    def slopes(self, rows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Derivatives of the weighted log loss by each of the arrays."""
        stretches, responses = self.responses(rows)
        at = responses.argmax(1)
        largest = np.take_along_axis(responses, at[:, None], 1)[:, 0] + self.shift
        pooled = np.maximum(largest, 0)
        error = ((learning.sigmoid(pooled @ self.weights + self.bias[0]) - label)
                 * weight / len(rows)).astype(np.float32)
        back = error[:, None] * self.weights * (largest > 0)
        # Only the stretch with a filter's largest response has a part in it.
        picked = np.take_along_axis(stretches, at[:, :, None], 1)
        letters = rows[np.arange(len(rows))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
        vectors = np.zeros_like(self.vectors)
        np.add.at(vectors, letters.reshape(-1),
                  (back[:, :, None] * self.filters.T[None]).reshape(-1, VECTOR))
        vectors[0] = 0
        return [vectors, np.einsum("nfk,nf->kf", picked, back), back.sum(0), pooled.T @ error,
                error.sum(keepdims=True)]


class Quality:
    """Scores of whole texts. Without labels of both kinds every score is the labels' rate."""

    def __init__(self, rate: float, network: Network | None = None,
                 coefficients: np.ndarray | None = None) -> None:
        self.rate, self.network, self.coefficients = rate, network, coefficients

    def score(self, text: bytes) -> float:
        if self.network is None or not text:
            return self.rate
        values = self.network.values(chunks(text))
        return float(learning.sigmoid(self.coefficients @ [values.mean(), values.min(), 1.0]))


def fit(told: learning.Sample) -> Quality:
    """Fit the network on three quarters of the sampled documents, calibrate on the others."""
    if told.one_sided:
        return Quality(told.rate)
    apart = np.arange(len(told.label)) % 4 == 3
    if len(set(told.label[apart].tolist())) < 2 or len(set(told.label[~apart].tolist())) < 2:
        apart = np.zeros(len(told.label), dtype=bool)  # too few to hold any apart
    draw = np.random.default_rng(0)
    shown = [k for k in np.flatnonzero(~apart) if told.texts[k]]
    counts = {k: len(chunks(told.texts[k])) for k in shown}
    n = sum(counts.values())
    if not n:
        return Quality(told.rate)
    weight = told.weight / told.weight[shown].mean()

    network = Network()
    rounds = max(EPOCHS, -(-LEAST_STEPS * BATCH // n))
    adam = learning.Adam(network.arrays, rounds * (n // BATCH + 1), 0.01)
    # Chunks of so many documents are mixed, so that memory does not grow with the texts.
    for _ in range(rounds):
        for some in np.array_split(draw.permutation(shown), -(-n // (200 * BATCH))):
            if not len(some):
                continue
            rows = np.concatenate([chunks(told.texts[k]) for k in some])
            owner = np.repeat(some, [counts[k] for k in some])
            # Some chunks are cut short, so that short texts are known as well.
            for k in np.flatnonzero(draw.random(len(rows)) < 0.15):
                rows[k, draw.integers(8, CHUNK):] = 0
            order = draw.permutation(len(rows))
            for start in range(0, len(order), BATCH):
                chosen = order[start:start + BATCH]
                mine = owner[chosen]
                adam(network.slopes(rows[chosen], told.label[mine].astype(np.float32),
                                    weight[mine].astype(np.float32)))
    judges = apart if apart.any() else ~apart
    known, values = [], []
    for document, text in enumerate(told.texts):
        if judges[document] and text:
            found = network.values(chunks(text))
            values.append((found.mean(), found.min()))
            known.append(document)
    coefficients = learning.calibrated(np.array(values), told.label[known], told.weight[known])
    return Quality(told.rate, network, coefficients)


def trained(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
            per_class: int = PER_CLASS) -> Quality:
    """A model of the labels outside the fold `held`, from at most `per_class` texts of each."""
    return fit(learning.sample(docs, labels, "quality", folds, held, per_class))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 3,
            held: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """doc (each row of `docs`), held_out, score, predicted; see learning.scored.

    The score depends on the text alone. An empty or null text scores the labels' rate of good
    documents. Repeated rows are scored each; an empty table gives an empty result.
    """
    return learning.scored(docs, trained(docs, labels, folds, held, per_class), folds, held, threshold)


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that are predicted good, with the columns of `docs`."""
    return quality(docs, labels, **settings).filter("predicted = 1").select("doc.*")


def op10_quality(spark, folder: str) -> DataFrame:
    """Every document with its quality."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality(docs, table(spark, folder, "labels")).select(
        F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")
