"""Hard negatives: for anchors and their nearest rows of the same label, near rows of other labels.

Method: coordinate pruning as in LEMP. A shard's vectors lie in buckets of one label and similar
length; a bucket has, per coordinate, the list of its vectors in the order of that coordinate of the
vector divided by its length. An anchor's threshold divided by both lengths is a least cosine. If it
is over 1 the bucket is skipped; else it bounds, for each of the anchor's focus coordinates (its
largest), the range of a candidate's coordinate; the ranges are looked up in the sorted lists and
their vectors intersected, and inner products of what remains are computed in whole numbers. The
threshold rises as rows are found: it is the score of the last of a full list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.llm.common import table, written
from learnertrace.llm.vectors import (
    Vectors,
    as_long,
    best,
    exact_in_doubles,
    packed,
    searched,
    shards,
    usable,
)

#: Vectors of a bucket, the least share of the longest that its shortest has, and focus coordinates.
BUCKET, SHORTEST, FOCUS = 1024, 0.8, 4

#: Slack of bounds that are computed with rounding.
SLACK = 1e-7


class Bucket:
    """Vectors of one label, of similar lengths and numbers of components."""

    def __init__(self, rows: Vectors, chosen: np.ndarray, lengths: np.ndarray) -> None:
        self.ids, self.longest, self.shortest = rows.ids[chosen], lengths.max(), lengths.min()
        self.whole = np.zeros((len(chosen), int(rows.sizes[chosen].max())))
        for place, row in enumerate(chosen):
            self.whole[place, :rows.sizes[row]] = rows[row]
        with np.errstate(all="ignore"):
            unit = self.whole / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.lists, axis=0)

    def within(self, focus: list[tuple[int, float]], length: float, threshold: float) -> np.ndarray | None:
        """Positions of vectors that may reach the threshold, or None for all.

        `focus` has coordinates of the anchor, each with its angle to the anchor; `length` is the anchor's.
        """
        if length <= 0 or self.longest <= 0 or threshold <= 0 and self.shortest <= 0:
            return None if threshold <= 0 else np.empty(0, np.int64)
        reach = threshold / length / (self.longest if threshold > 0 else self.shortest)
        if reach > 1 + SLACK:
            return np.empty(0, np.int64)
        if not reach > -1:
            return None
        angle = np.arccos(min(reach - SLACK, 1.0)) if reach - SLACK > -1 else np.pi
        marks, lists = None, 0
        for coordinate, apart in focus:
            if coordinate >= self.whole.shape[1]:
                continue
            low, high = np.cos(min(np.pi, apart + angle)) - SLACK, np.cos(max(0.0, apart - angle)) + SLACK
            values = self.sorted[:, coordinate]
            start, end = np.searchsorted(values, low), np.searchsorted(values, high, "right")
            if start == 0 and end == len(values):
                continue
            if marks is None:
                marks = np.zeros(len(values), np.int8)
            marks[self.lists[start:end, coordinate]] += 1
            lists += 1
        return None if marks is None else np.flatnonzero(marks == lists)

    def scores(self, anchor: np.ndarray, exact: bool, chosen: np.ndarray | None) -> np.ndarray:
        size = min(len(anchor), self.whole.shape[1])
        whole = self.whole[:, :size] if chosen is None else self.whole[chosen, :size]
        if exact:
            return whole @ anchor[:size]
        # Whole numbers of any length.
        return np.array([sum(int(a) * int(b) for a, b in zip(row, anchor)) for row in whole], object)


class Index:
    """A shard's buckets by label, longest vectors first."""

    def __init__(self, rows: Vectors) -> None:
        labels, self.largest = np.array(rows.others["label"], np.int64), rows.largest
        with np.errstate(over="ignore"):
            squares = rows.values * rows.values
        row_of = np.repeat(np.arange(len(rows)), rows.sizes)
        lengths = np.sqrt(np.bincount(row_of, squares, len(rows)))
        width = np.ceil(np.log2(np.maximum(rows.sizes, 1)))  # at most twice as many components as any other
        order = np.lexsort((rows.ids, -lengths, width, labels))
        self.of: dict[int, list[Bucket]] = {}
        start = 0
        for end in range(1, len(order) + 1):
            first, last = order[start], order[end] if end < len(order) else None
            if last is None or end - start == BUCKET or labels[last] != labels[first] \
                    or width[last] != width[first] or lengths[last] < SHORTEST * lengths[first]:
                chosen = order[start:end]
                self.of.setdefault(int(labels[first]), []).append(Bucket(rows, chosen, lengths[chosen]))
                start = end

    def found(self, key: int, anchor: np.ndarray, labels: Iterable[int],
              lists: list[Nearest]) -> None:
        """Show the vectors of these labels to the lists, but those that no list can take."""
        with np.errstate(over="ignore"):
            length = float(np.sqrt((anchor * anchor).sum()))
        exact = exact_in_doubles(anchor, self.largest)
        focus = [] if not exact or not length else [
            (int(c), float(np.arccos(np.clip(anchor[c] / length, -1, 1))))
            for c in np.argsort(-np.abs(anchor), kind="stable")[:FOCUS]]
        for bucket in sorted((b for label in labels for b in self.of[label]), key=lambda b: -b.longest):
            threshold = min(one.least for one in lists)
            chosen = bucket.within(focus, length, threshold) if exact and threshold > -np.inf else None
            if chosen is not None and not len(chosen):
                continue
            scores = bucket.scores(anchor, exact, chosen)
            ids = bucket.ids if chosen is None else bucket.ids[chosen]
            others = ids != key
            for one in lists:
                one.show(ids[others], scores[others])


class Nearest:
    """The first of the ids shown, by falling score and then by id, with a score within bounds."""

    def __init__(self, most: int, low: float = -np.inf, high: float = np.inf) -> None:
        self.most, self.least, self.high = most, low, high
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0)

    def show(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if not len(fits):
            return
        ids, scores = np.concatenate((self.ids, ids[fits])), np.concatenate((self.scores, scores[fits]))
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])) if scores.dtype == object \
            else np.lexsort((ids, -scores))
        order = np.array(order[:self.most])
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.most:
            self.least = self.scores[-1]


def _columns(parts: list[tuple], kinds: list[str]) -> pa.RecordBatch:
    """One batch of (values to repeat .., ids, scores) per list."""
    fixed = len(kinds) - 2
    repeats = [len(part[-2]) for part in parts]
    columns = [pa.array(np.repeat(np.array([part[k] for part in parts], np.int64), repeats))
               for k in range(fixed)]
    ids = np.concatenate([part[-2] for part in parts]) if parts else np.empty(0, np.int64)
    scores = np.concatenate([as_long(part[-1]) for part in parts]) if parts else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([*columns, pa.array(ids), pa.array(scores)], kinds)


def _positives(most: int, candidates: Vectors):
    index = Index(candidates)

    def answer(anchors: Vectors) -> pa.RecordBatch:
        parts = []
        for k, key in enumerate(anchors.ids):
            label, one = anchors.others["label"][k], Nearest(most)
            index.found(key, anchors[k], [label] if label in index.of else [], [one])
            parts.append((key, one.ids, one.scores))
        return _columns(parts, ["anchor_id", "positive_id", "positive_score"])
    return answer


def _bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores n with low * score <= 100 * n <= high * score: the least and the greatest."""
    return -(-low * score // 100), high * score // 100


def _negatives(most: int, low: int, high: int, candidates: Vectors):
    index = Index(candidates)

    def lists(positives: list[dict]) -> Iterator[tuple[dict, Nearest]]:
        for positive in positives:
            least, greatest = _bounds(positive["score"], low, high)
            if least <= greatest:
                yield positive, Nearest(most, least, greatest)

    def answer(anchors: Vectors) -> pa.RecordBatch:
        parts = []
        for k, key in enumerate(anchors.ids):
            wanted = list(lists(anchors.others["positives"][k]))
            if not wanted:
                continue
            labels = [x for x in index.of if x != anchors.others["label"][k]]
            index.found(key, anchors[k], labels, [one for _, one in wanted])
            parts += [(key, p["place"], p["id"], p["score"], one.ids, one.scores) for p, one in wanted]
        return _columns(parts, ["anchor_id", "place", "positive_id", "positive_score", "negative_id",
                                "negative_score"])
    return answer


def hard_negatives(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding",
                   label: Column | str = "label", positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """For each anchor and each of its positives, the first negatives: anchor_id, positive_id, rank
    (from 1), negative_id, positive_score, negative_score.

    Scores are inner products with the anchor, each component x counting as floor(scale * x); higher ones
    come first, then smaller ids. An anchor (a row for which `is_anchor`, on the column `id`,
    holds) has as positives its first `positives` other rows of its label; negatives are rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score. With a negative
    score of the positive no row can be one; with 0 those of score 0 are.

    Rows without id or label, or with a vector that is null or holds a null or non-finite component, take
    no part. Vectors of different lengths are filled up with zeros. A repeated id: each of its rows is a
    candidate of other ids, none of its own, and the greatest (label, vector) of them is the
    anchor. Scores beyond 64 bits become the nearest 64-bit integer. Other columns are not read. An
    empty table, and an anchor alone with its label, give no rows.
    """
    named = rows.withColumn("label", F.expr(label) if isinstance(label, str) else label) \
        .filter(F.col("label").isNotNull())
    known = usable(named, key, vector, F.col("label").cast("long").alias("label"))
    anchors = known.filter(is_anchor).groupBy("id").agg(F.max(F.struct("label", "vec")).alias("row")).select(
        "id", "row.label", "row.vec")
    n_shards, candidates = shards(known), packed(known, scale)
    near = best(
        searched(candidates, packed(anchors, scale), n_shards, partial(_positives, positives),
                 "anchor_id long, positive_id long, positive_score long"),
        ["anchor_id"], "positive_score", "positive_id", positives)
    # At most `positives` per anchor.
    listed = near.groupBy("anchor_id").agg(F.collect_list(F.struct(
        F.col("rank").alias("place"), F.col("positive_id").alias("id"),
        F.col("positive_score").alias("score"))).alias("positives"))
    asking = written(anchors.join(listed, F.col("id") == F.col("anchor_id")).drop("anchor_id"))
    found = searched(candidates, packed(asking, scale), n_shards, partial(_negatives, negatives, low, high),
                     "anchor_id long, place long, positive_id long, positive_score long, negative_id long, "
                     "negative_score long")
    return best(found, ["anchor_id", "place"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: Labels with some wrong ones.
SHIFTED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the embeddings whose id is divisible by 100; every seventh label is shifted."""
    return hard_negatives(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label=SHIFTED)


SQL = f"""
WITH vectors AS (
    SELECT vec_id, {SHIFTED} AS label, [floor(256 * x::DOUBLE) for x in embedding] AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(a.whole, c.whole) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
               row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE same) WHERE place <= 5
), negatives AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS place
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 10
"""
