"""Exact search: the highest inner products of some rows among all rows.

Method: exhaustive, a term (component) at a time. A shard's candidates are turned into a posting list
per term: positions and weights of the candidates that are not zero there. A query's non-zero terms
scatter their weighted postings into a dense array of scores, one for each candidate of the shard, and
a partition of that array selects the shard's best, which are merged over the shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.llm.common import table
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


class Postings:
    """Posting lists of a shard. Positions follow the ids, so of equal scores the first has the smaller id."""

    def __init__(self, rows: Vectors) -> None:
        order = np.argsort(rows.ids, kind="stable")
        self.ids, self.largest = rows.ids[order], rows.largest
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        position = np.repeat(place, rows.sizes)
        term = np.arange(len(rows.values)) - np.repeat(rows.starts, rows.sizes)
        held = np.flatnonzero(rows.values)
        held = held[np.lexsort((position[held], term[held]))]
        self.position, self.weight = position[held], rows.values[held]
        terms = int(rows.sizes.max(initial=0))
        self.start = np.searchsorted(term[held], np.arange(terms + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner products with every candidate; components that one of both lacks count as zero."""
        kind = np.float64 if exact_in_doubles(query, self.largest) else object
        scores = np.zeros(len(self.ids), kind)
        for term in np.flatnonzero(query[:len(self.start) - 1]):
            part = slice(self.start[term], self.start[term + 1])
            position, weight = self.position[part], self.weight[part]
            if kind is object:
                # Whole numbers of any length.
                scores[position] += np.array([int(x) for x in weight], object) * int(query[term])
            elif len(position) == len(scores):
                scores += weight * query[term]
            else:
                scores[position] += weight * query[term]
        return scores

    def best(self, key: int, query: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best candidates with another id than the query's."""
        ids, scores = self.ids, self.scores(query)
        own = slice(np.searchsorted(ids, key), np.searchsorted(ids, key, "right"))
        if own.start < own.stop:
            ids, scores = np.delete(ids, own), np.delete(scores, own)
        if len(ids) > most:
            if scores.dtype == object:
                chosen = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], i))[:most])
            else:
                least = np.partition(scores, len(scores) - most)[len(scores) - most]
                above = np.flatnonzero(scores > least)
                chosen = np.concatenate((above, np.flatnonzero(scores == least)[:most - len(above)]))
            ids, scores = ids[chosen], scores[chosen]
        return ids, as_long(scores)


def top_k(rows: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding",
          most: int = 10, scale: int = 1024) -> DataFrame:
    """The `most` rows with the highest inner product for each row that `asks` (a condition on its id,
    the column `id`): query_id, rank (from 1), vec_id, score.

    Each component x counts as floor(scale * x). Ties go to the smaller id. Rows without an id, or with
    a vector that is null or holds a null or non-finite component, take no part. Vectors of
    different lengths are filled up with zeros; an empty one has the score 0 with all. A repeated id:
    each of its rows is a candidate of other ids, none of its own, and the greatest of its
    vectors asks. Scores beyond 64 bits are exact while ranked in a shard and then become the nearest
    64-bit integer. Other columns are not read. An empty table gives no rows.
    """
    known = usable(rows, key, vector)
    asking = known.filter(asks).groupBy("id").agg(F.max("vec").alias("vec"))

    def index(candidates: Vectors):
        postings = Postings(candidates)

        def answer(queries: Vectors) -> pa.RecordBatch:
            found = [postings.best(int(i), queries[k], most) for k, i in enumerate(queries.ids)]
            return pa.RecordBatch.from_arrays([
                pa.array(np.repeat(queries.ids, [len(ids) for ids, _ in found])),
                pa.array(np.concatenate([ids for ids, _ in found])),
                pa.array(np.concatenate([scores for _, scores in found]))], ["query_id", "vec_id", "score"])
        return answer

    found = searched(packed(known, scale), packed(asking, scale), shards(known), index,
                     "query_id long, vec_id long, score long")
    return best(found, ["query_id"], "score", "vec_id", most).select("query_id", "rank", "vec_id", "score")


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all embeddings for each whose id is divisible by 100."""
    return top_k(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.whole, c.whole) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""
