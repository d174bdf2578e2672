"""Exact duplicates: frequent texts by broadcast, the others by an ordinary shuffle.

A Misra-Gries summary finds the digests that may make up more than 1/counters of all
rows. Their true counts are then taken; those that are indeed so frequent (fewer than
`counters`) are broadcast with the row that stays, and their rows are settled where they
lie. No remaining digest has more than 1/counters of the rows; these are grouped by a
shuffle of digests, never of texts. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import SPACE, table, written


def digest(text: Column) -> Column:
    """SHA-256 in lowercase hex of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256)


def mark_duplicates(docs: DataFrame, counters: int = 256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of `docs`.

    Columns other than doc_id and text are ignored. A null text counts as empty; empty
    texts are equal to each other. In a group the row with the smallest doc_id stays, a
    null doc_id last; among rows that repeat the same doc_id exactly one stays. An empty
    table gives an empty result. Texts of any length: only their digests are shuffled.
    """
    rows = written(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), digest(F.col("text")).alias("digest")))
    total = rows.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    size = F.count(F.lit(1)).alias("group_size")

    # At most `counters` candidates come out of the summary, so both broadcasts are bounded.
    hashed = rows.withColumn("h", F.xxhash64("digest"))
    summary = hashed.stat.freqItems(["h"], 1 / counters)
    candidates = summary.select(F.explode("h_freqItems").alias("h"))
    frequent = (hashed.join(F.broadcast(candidates), "h", "left_semi").groupBy("digest")
                .agg(size, first).filter(F.col("group_size") * counters > total))
    marked = rows.join(F.broadcast(frequent), "digest", "left")

    rest = marked.filter(F.col("first").isNull()).select("doc_id", "row", "digest")
    grouped = rest.join(rest.groupBy("digest").agg(size, first), "digest")
    settled = marked.filter(F.col("first").isNotNull()).unionByName(grouped)
    return settled.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"), F.col("digest").alias("text_sha256"))


def op2_exact_dedup(spark, folder: str) -> DataFrame:
    """Every document with the one that stays of its equals."""
    return mark_duplicates(table(spark, folder, "documents"))


SQL = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
        AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
"""
