"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes ratios.

The n-grams of a window of text, hashed, are present or not. Each is scaled by the log ratio of
its smoothed shares in toxic and other windows; a logistic regression over the scaled
features, each window's divided by the root of their number, gives the window's value. A
document is cut into windows that cover it wholly; the mean and the largest of their values
go through a logistic calibration fitted on documents that the weights have not seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm import learning
from learnertrace.llm.common import table

ORDERS = (4, 5, 6)
BITS = 18
WINDOW = 1000

#: The bound of the sample: documents of each label, with their whole texts.
PER_CLASS = 4_000
#: Rounds over all windows, and the least number of steps; steps of so many windows.
EPOCHS, LEAST_STEPS, STEP = 8, 300, 256
#: Bytes of windows that are kept from round to round; those of further documents are made anew.
KEPT = 128 << 20
#: Rounds after which a toxic document's windows count by how toxic they look.
ALIKE = 2

#: Weights are pulled to 0, so that n-grams which say nothing fade out.
PULL = np.float32(1e-5)

FACTOR, LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def grams(text: bytes) -> tuple[int, list[np.ndarray]]:
    """Characters of the lower-cased text, and for each order the features of its n-grams."""
    lower = text.decode(errors="replace").lower()
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, h = [], np.full(len(codes), 1, np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = h[:max(0, len(codes) - n + 1)] * FACTOR + codes[n - 1:]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint64(29))) * LAST
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return len(codes), found


def windows(text: bytes) -> list[np.ndarray]:
    """The distinct features of each window; together the windows hold every n-gram."""
    size, found = grams(text)
    count = max(1, size // WINDOW)
    seen, cuts = np.zeros(1 << BITS, dtype=bool), []
    for k in range(count):
        start, end = size * k // count, size * (k + 1) // count
        for order in found:
            seen[order[start:end]] = True
        here = np.flatnonzero(seen)
        seen[here] = False
        cuts.append(here)
    return [c for c in cuts if len(c)]


class Toxicity:
    """Scores of whole texts. Without labels of both kinds every score is the labels' rate."""

    def __init__(self, rate: float, weights: np.ndarray | None = None, bias: float = 0.0,
                 coefficients: np.ndarray | None = None) -> None:
        self.rate, self.weights, self.bias, self.coefficients = rate, weights, bias, coefficients

    def values(self, text: bytes) -> np.ndarray:
        """The value of each window; a text too short for any n-gram has none."""
        return np.array([self.weights[c].sum() / np.sqrt(len(c)) + self.bias for c in windows(text)])

    def score(self, text: bytes) -> float:
        if self.weights is None:
            return self.rate
        values = self.values(text)
        if not len(values):
            return self.rate
        return float(learning.sigmoid(self.coefficients @ [values.mean(), values.max(), 1.0]))


def fit(told: learning.Sample) -> Toxicity:
    """Fit weights on three quarters of the sampled documents, calibrate on the others."""
    if told.one_sided:
        return Toxicity(told.rate)
    apart = np.arange(len(told.label)) % 4 == 3
    if len(set(told.label[apart].tolist())) < 2 or len(set(told.label[~apart].tolist())) < 2:
        apart = np.zeros(len(told.label), dtype=bool)  # too few to hold any apart
    shown = np.flatnonzero(~apart)
    kept: dict[int, list[np.ndarray]] = {}
    room = KEPT

    def cut(document: int) -> list[np.ndarray]:
        nonlocal room
        if document in kept:
            return kept[document]
        cuts = [window.astype(np.int32) for window in windows(told.texts[document])]
        size = sum(window.nbytes for window in cuts)
        if size <= room:
            kept[document], room = cuts, room - size
        return cuts

    toxic, other, n = np.ones(1 << BITS), np.ones(1 << BITS), 0
    for document in shown:
        cuts = cut(document)
        for window in cuts:
            (toxic if told.label[document] else other)[window] += 1 / len(cuts)
        n += len(cuts)
    if not n:
        return Toxicity(told.rate)
    ratio = np.log((toxic / toxic.sum()) / (other / other.sum())).astype(np.float32)

    weight = told.weight / told.weight[shown].mean()
    scale, bias = np.ones(1 << BITS, np.float32), np.zeros(1, np.float32)
    draw = np.random.default_rng(0)
    rounds = max(EPOCHS, -(-LEAST_STEPS * STEP // n))
    adam = learning.Adam([scale, bias], rounds * (n // STEP + 1), 0.2)

    def step(held: list[tuple[np.ndarray, float, float]]) -> None:
        sizes = np.array([len(window) for window, _, _ in held])
        here = np.concatenate([window for window, _, _ in held])
        label, part = np.array([y for _, y, _ in held]), np.array([w for _, _, w in held])
        value = ratio[here] / np.sqrt(np.repeat(sizes, sizes))
        z = np.add.reduceat(value * scale[here], np.cumsum(sizes) - sizes) + bias[0]
        slope = (learning.sigmoid(z) - label) * part / len(held)
        adam([np.bincount(here, value * np.repeat(slope, sizes), 1 << BITS).astype(np.float32)
              + PULL * scale, np.array([slope.sum()], np.float32)])

    for turn in range(rounds):
        held: list[tuple[np.ndarray, float, float]] = []
        for document in draw.permutation(shown):
            cuts, label = cut(document), told.label[document]
            parts = np.ones(len(cuts))
            if label and turn >= ALIKE and len(cuts) > 1:
                # What makes a document toxic may stand in one of its windows only.
                seen = np.array([(scale[c] * ratio[c]).sum() / np.sqrt(len(c)) for c in cuts])
                parts = np.exp(2 * (seen - seen.max()))
                parts /= parts.max()
            for window, part in zip(cuts, parts):
                held.append((window, label, weight[document] * part))
                if len(held) == STEP:
                    step(held)
                    held = []
        if held:
            step(held)
    model = Toxicity(told.rate, scale * ratio, float(bias[0]))
    judges = apart if apart.any() else ~apart
    values = [model.values(text) for document, text in enumerate(told.texts) if judges[document]]
    rows = np.array([(v.mean(), v.max()) if len(v) else (model.bias, model.bias) for v in values])
    model.coefficients = learning.calibrated(rows, told.label[judges], told.weight[judges])
    return model


def trained(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2,
            per_class: int = PER_CLASS) -> Toxicity:
    """A model of the labels outside the fold `held`, from at most `per_class` texts of each."""
    return fit(learning.sample(docs, labels, "toxic", folds, held, per_class))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4,
             held: int = 2, per_class: int = PER_CLASS) -> DataFrame:
    """doc (each row of `docs`), held_out, score, predicted; see learning.scored.

    The score depends on the text alone. An empty or null text, and one too short for any
    n-gram, scores the labels' rate of toxic documents. Repeated rows are scored each; an empty
    table gives an empty result.
    """
    return learning.scored(docs, trained(docs, labels, folds, held, per_class), folds, held, threshold)


def op1_toxicity(spark, folder: str) -> DataFrame:
    """Every document with its toxicity."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, folder, "labels")).select(
        F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")
