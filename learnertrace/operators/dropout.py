"""When learners stopped, and the stop-out label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.rows import stamped
from learnertrace.functions.weeks import week
from learnertrace.sources.course import Course


def user_dropout(course: Course) -> DataFrame:
    """One row per submitter: last submission and the 1-based week after it.

    Equal last timestamps are settled by the greatest submission id. A learner
    whose submissions all lack a time keeps a row with a NULL week.
    """
    moment = F.col("submission_timestamp")
    order = F.when(moment.isNotNull(), F.struct(moment, F.col("submission_id")))
    # Two aggregates rather than one maximum of a struct: readers that need only
    # the week then prune the id and keep a plain hash aggregate.
    return (
        course.submissions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max_by("submission_id", order).alias("last_submission_id"),
             F.max(moment).alias("dropout_timestamp"))
        .select(
            "user_id", "last_submission_id",
            (week(course, F.col("dropout_timestamp")) + 1).alias("dropout_week"),
            "dropout_timestamp",
        )
    )


def dropout(course: Course, dropout: DataFrame) -> DataFrame:
    """Feature 1: for each learner and week, 1 while still active, else 0."""
    grid = dropout.filter(F.col("dropout_week").isNotNull()).select(
        "user_id", "dropout_week",
        F.explode(F.sequence(F.lit(0), F.lit(course.weeks - 1))).alias("feature_week"),
    )
    return stamped(course, "user_long_feature", 1, grid,
                   "CASE WHEN dropout_week > feature_week THEN 1 ELSE 0 END")
