"""Mixing sources to target weights by systematic sampling.

Each source gets a target, a share of the whole by weight that stops at `most` times the
source's size. A document is then expected target / size times. Within a source the
documents stand in order of size and doc_id; the running sum of expected copies, shifted by one
random offset, is cut at the whole numbers: a document is taken once for each whole number
that its step crosses. Neighbours in that order have about the same size, so the words
taken stay near the target.

The running sum never needs a whole source in one task: the order is cut into blocks (size,
and a range of doc_id of fixed width), blocks are counted by a map-side aggregate, the counts
are summed up within classes of sizes, and only the classes per source. How wide the blocks
are changes nothing in the order. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.llm.common import NOT_SPACE, table

WEIGHTS = (5, 2, 1)


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """source, source_size, target of each row (source, source_size).

    Targets are min(most * size, level * weight), with the one level that makes them
    share * the sum of all sizes: what is left when the excess over a limit is shared again
    by weight until none is above. Sources are taken by the ratio of limit to weight; the
    level follows from the sums over those whose limit lies below it. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = (sources.withColumn("weight", weight)
              .withColumn("limit", F.col("source_size") * F.lit(most))
              .withColumn("ratio", F.col("limit") / F.col("weight")))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * F.lit(share)
              - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levelled = ranked.withColumn("level", level)
    # The first source whose limit is not below the level ends the limited ones.
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    return levelled.withColumn("level", F.first(fits, ignorenulls=True).over(everything)).select(
        "source", "source_size",
        F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on seed and source alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(sizes: DataFrame, seed: int = 7, rows_per_block: int = 100_000, **settings) -> DataFrame:
    """`sizes` (doc_id, source, size, other columns) with source_size, target and copies.

    Reruns agree: the offset is a hash, and the order is by size and doc_id, nulls last. Rows
    that agree in both are interchangeable. A document's copies lie between 0 and `most`;
    documents without words are sampled like others. A block has rows of one size whose
    doc_id, a number, is in the same range of `rows_per_block` numbers. An empty table gives none.
    """
    # Sixteen classes for each doubling of the size; they grow with the size, as blocks do with doc_id.
    step = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * 16)).otherwise(-1)
    placed = sizes.withColumn("class", step.cast("int")).withColumn(
        "block", F.floor(F.col("doc_id") / F.lit(rows_per_block)))
    counted = placed.groupBy("source", "class", "size", "block").agg(F.count(F.lit(1)).alias("rows"))
    classes = counted.groupBy("source", "class").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("size")).alias("class_size"))
    shares = targets(classes.groupBy("source").agg(F.sum("class_size").alias("source_size")),
                     **settings)

    def before(window):
        rows = F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(rows, F.lit(0))

    smaller = classes.withColumn("smaller", before(Window.partitionBy("source").orderBy("class"))).join(
        shares.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).select(
            "name", F.col("class").alias("of_class"), "smaller", "source_size", "target")
    ahead = before(Window.partitionBy("source", "class").orderBy("size", F.col("block").asc_nulls_last()))
    starts = counted.withColumn("ahead", ahead).join(
        smaller, F.col("source").eqNullSafe(F.col("name")) & (F.col("class") == F.col("of_class"))).select(
            "name", F.col("size").alias("at_size"), F.col("block").alias("at_block"),
            (F.col("ahead") + F.col("smaller")).alias("ahead"), "source_size", "target")
    within = Window.partitionBy("source", "size", "block").orderBy(F.col("doc_id").asc_nulls_last())
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor(offset(F.col("source"), seed) + F.col("nth") * F.col("expected")) - F.floor(
        offset(F.col("source"), seed) + (F.col("nth") - 1) * F.col("expected"))
    return (placed.withColumn("nth", F.row_number().over(within))
            .join(starts, F.col("source").eqNullSafe(F.col("name"))
                  & (F.col("size") == F.col("at_size")) & F.col("block").eqNullSafe(F.col("at_block")))
            .withColumn("nth", F.col("nth") + F.col("ahead")).withColumn("expected", expected)
            .withColumn("copies", F.least(crossed, F.ceil("expected")).cast("long"))
            .select(*sizes.columns, "source_size", "target", "copies"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; the columns of `docs`.

    A null text has size 0, a null source is a source of its own, last in order. Repeated
    rows are documents of their own. An empty table gives an empty mix. doc_id is a number; texts of
    any length count as their words, and go along as they are.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "doc_id", "source",
        words(F.col("text")).alias("size"))
    taken = plan(sized, **settings).filter(F.col("copies") > 0)
    repeated = taken.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("whole.*")


def op9_mixing(spark, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = table(spark, folder, "documents")
    return plan(docs.select("doc_id", "source", words(F.col("text")).alias("size"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
        AS weight, source_size * 2.0::DOUBLE AS most
    FROM sources),
level AS (
    -- Sources in order of limit to weight: the first that stays below its limit when the
    -- sources before it stand at theirs gives the level.
    SELECT level FROM (
        SELECT ratio, ((SELECT sum(source_size) * 1.5::DOUBLE FROM weighed)
                       - coalesce((SELECT sum(b.most) FROM weighed b WHERE b.most / b.weight < ratio), 0))
                      / (SELECT sum(b.weight) FROM weighed b WHERE b.most / b.weight >= ratio) AS level
        FROM (SELECT DISTINCT most / weight AS ratio FROM weighed))
    WHERE level <= ratio ORDER BY ratio LIMIT 1),
goals AS (
    SELECT source, source_size, least(most, weight * (SELECT level FROM level)) AS target
    FROM weighed),
placed AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected,
           ('0x' || md5(concat('7:', coalesce('=' || s.source, '')))[:8])::BIGINT / 4294967296.0::DOUBLE AS shift,
           row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS nth
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * least(floor(shift + nth * expected) - floor(shift + (nth - 1) * expected),
                     ceil(expected)))::BIGINT AS taken
FROM placed
"""
