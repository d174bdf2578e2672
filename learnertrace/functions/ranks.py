"""Running totals over an ordered group that may be too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.sources.store import written


def running_totals(
    histogram: DataFrame, group: str, value: str, counts: list[str], descending: bool = False,
) -> DataFrame:
    """Add, for each count, `<count>_before` (sum over earlier values) and `<count>_all`.

    `histogram` has one row per (group, value), with no NULL value. It is dealt out by ranges of
    (group, value), and written with the number of the partition each row came to: a partition
    that is computed again later must not cut otherwise. Few groups with very many values are thus
    many partitions. Totals run within a group's part of a partition; what comes before it is
    carried over from a table with a row for each group in a partition.
    """
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    dealt = written(histogram.repartitionByRange(group, by_value).withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy(group, "part").agg(*[F.sum(c).alias(c) for c in counts])
    parts = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        group, "part",
        *[F.coalesce(F.sum(c).over(parts), F.lit(0)).alias(f"{c}_carried") for c in counts],
        *[F.sum(c).over(Window.partitionBy(group)).alias(f"{c}_all") for c in counts])
    inside = (Window.partitionBy(group, "part").orderBy(by_value)
              .rowsBetween(Window.unboundedPreceding, -1))
    running = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_inside") for c in counts])
    # Partitions and groups together bound the rows of `carried`.
    return running.join(F.broadcast(carried), [group, "part"]).select(
        *histogram.columns,
        *[(F.col(f"{c}_inside") + F.col(f"{c}_carried")).alias(f"{c}_before") for c in counts],
        *[f"{c}_all" for c in counts])
