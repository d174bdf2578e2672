"""Weekly features computed from other weekly features.

Every operator takes `features`, rows of `user_long_feature`, whether read back
from the feature table or still part of the same plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.functions.ranks import running_totals
from learnertrace.functions.rows import Measure, feature_rows, stamped
from learnertrace.sources.course import Course

TABLE = "user_long_feature"

# Feature -> (numerator, denominator).
RATIOS = {10: (2, 8), 11: (6, 8), 209: (208, 7)}
# Feature -> the feature whose weeks it compares.
CHANGES = {103: 3, 104: 4, 105: 5, 109: 9, 110: 10, 111: 11, 112: 12}
# Feature -> the feature whose history it is measured against.
PROGRESS = {205: 204, 207: 206}
# Fixed value: a change of post length needs more than this many posts in the week before.
POSTS_NEEDED = 5


def side_by_side(features: DataFrame, ids: list[int]) -> DataFrame:
    """One row per learner and week; `v<id>` and `has<id>` for each feature."""
    same = [F.col("feature_id") == i for i in ids]
    return (
        features.filter(F.col("feature_id").isin(*ids))
        .groupBy("user_id", "feature_week")
        .agg(*[F.max(F.when(is_it, F.col("feature_value"))).alias(f"v{i}")
               for i, is_it in zip(ids, same)],
             *[(F.count_if(is_it) > 0).alias(f"has{i}") for i, is_it in zip(ids, same)])
    )


#: What `together` gives.
TOGETHER = {*RATIOS, *CHANGES, *PROGRESS, 203}


def together(
    course: Course, features: DataFrame, ids: Iterable[int], last_week: int | None = None,
) -> DataFrame:
    """Any of features 10, 11, 103-105, 109-112, 203, 205, 207 and 209, from one row per learner and week.

    * 10, 11, 209: one feature over another of the same week, 0 over a divisor of 0.
    * 103-105, 109-112: a week's value over the week before's; 0 if that fails. Only directly
      consecutive weeks give a row. Post length (105) also asks for more than five posts in the
      earlier week.
    * 203: a learner's average attempts over the greatest of the week.
    * 205, 207: a grade minus the mean of all earlier grades, NULL without any; from week 1 on, up to
      `last_week` if given.

    The windows hold one learner's weeks, and all features share one aggregate and one window.
    """
    ids = sorted(set(ids))
    ratios = sorted({i for i in ids if i in RATIOS} | {CHANGES[i] for i in ids if CHANGES.get(i) in RATIOS})
    sources = {x for i in ratios for x in RATIOS[i]} | {PROGRESS[i] for i in ids if i in PROGRESS}
    sources |= {CHANGES[i] for i in ids if i in CHANGES and CHANGES[i] not in RATIOS}
    sources |= ({3} if 105 in ids else set()) | ({9} if 203 in ids else set())
    rows = side_by_side(features, sorted(sources))
    for i in ratios:
        above, below = RATIOS[i]
        rows = rows.withColumns({
            f"v{i}": F.expr(f"CASE WHEN v{below} = 0 THEN 0 ELSE try_divide(v{above}, v{below}) END"),
            f"has{i}": F.expr(f"has{above} AND has{below}")})
    weeks = Window.partitionBy("user_id").orderBy("feature_week")
    earlier: dict[str, Column] = {}
    if any(i in CHANGES for i in ids):
        earlier["week_before"] = F.lag("feature_week").over(weeks)
    for i in ids:
        if i in CHANGES:
            source = CHANGES[i]
            earlier[f"before{source}"] = F.lag(f"v{source}").over(weeks)
            earlier[f"had{source}"] = F.lag(f"has{source}").over(weeks)
        if i in PROGRESS:
            earlier[f"history{PROGRESS[i]}"] = F.avg(f"v{PROGRESS[i]}").over(
                weeks.rangeBetween(Window.unboundedPreceding, -1))
    if 105 in ids:
        earlier["posts_before"] = F.lag("v3").over(weeks)
    rows = rows.withColumns(earlier) if earlier else rows
    if 203 in ids:
        # One row per course week.
        rows = rows.join(F.broadcast(rows.groupBy("feature_week").agg(F.max("v9").alias("greatest"))), "feature_week")
    measures = []
    for i in ids:
        if i in RATIOS:
            value, found = f"v{i}", f"has{i}"
        elif i in CHANGES:
            source = CHANGES[i]
            value = f"coalesce(try_divide(v{source}, before{source}), 0)"
            found = f"has{source} AND had{source} AND week_before = feature_week - 1"
            found += f" AND posts_before > {POSTS_NEEDED}" if i == 105 else ""
        elif i in PROGRESS:
            value, found = f"v{PROGRESS[i]} - history{PROGRESS[i]}", f"has{PROGRESS[i]} AND feature_week >= 1"
            found += f" AND feature_week <= {last_week}" if last_week is not None else ""
        else:
            value, found = "try_divide(v9, greatest)", "has9"
        measures.append(Measure(i, value, f"CAST({found} AS INT)"))
    return feature_rows(course, TABLE, rows, measures)


#: Tasks over which the learners with one value of a week are spread.
SALTS = 16


def _attempts(features: DataFrame) -> DataFrame:
    return features.filter("feature_id = 9").select("user_id", "feature_week", "feature_value")


def percentile(course: Course, features: DataFrame) -> DataFrame:
    """Feature 202: percentile of a learner's average attempts among all of the week.

    Learners with equal values share the mean of their ranks.
    """
    rows = _attempts(features)
    histogram = rows.groupBy("feature_week", "feature_value").agg(
        F.count(F.lit(1)).alias("n"))
    ranked = running_totals(histogram, "feature_week", "feature_value", ["n"])
    below, upto = F.col("n_before"), F.col("n_before") + F.col("n")
    # Very many learners may share a value: its percentile goes to several tasks, its learners to any of them.
    scores = ranked.select(
        "feature_week", "feature_value",
        (F.lit(50.0) * (below + upto + 1) / F.col("n_all")).alias("percentile"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("user_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(scores, ["feature_week", "feature_value", "salt"])
    return stamped(course, TABLE, 202, joined, "percentile")
