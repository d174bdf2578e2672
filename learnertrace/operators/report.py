"""The report of a weekly model run: a row per week and one of totals.

`scores` are those of the test rows, `wide` the rows with support that were scored from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.operators import cohort, evaluation
from learnertrace.sources.store import written


def weekly_report(
    scores: DataFrame, wide: DataFrame, ids: Sequence[int], weeks_ahead: int = 1, missing: float = -1.0,
) -> DataFrame:
    """Per scored week: the week predicted, accuracy, AUC, learners with support and in the
    test, right and wrong predictions, the confusion matrix (c<label><prediction>), learners
    with each feature and the mean number of features."""
    right = F.count_if(F.col("prediction") == F.col("label"))
    cells = [F.count_if((F.col("label") == a) & (F.col("prediction") == b)).cast("long").alias(f"c{a}{b}")
             for a in (0, 1) for b in (0, 1)]
    judged = scores.groupBy("feature_week").agg(
        F.count(F.lit(1)).alias("test_users"), right.alias("correct"), *cells)
    held = wide.groupBy("feature_week").agg(
        F.count(F.lit(1)).alias("users"),
        *[F.count_if(F.col(c) != missing).alias(f"users_{c}") for c in cohort.names(ids)],
        F.avg(cohort.present(ids, missing)).alias("mean_present"))
    # Each side has one row per course week.
    rows = judged.join(evaluation.auc(scores), "feature_week").join(held, "feature_week")
    return rows.select(
        "feature_week", (F.col("feature_week") + weeks_ahead).alias("predicted_week"),
        (F.col("correct") / F.col("test_users")).alias("accuracy"), "auc", "users", "test_users", "correct",
        (F.col("test_users") - F.col("correct")).alias("incorrect"), "c00", "c01", "c10", "c11",
        *[f"users_{c}" for c in cohort.names(ids)], "mean_present")


def total_report(weekly: DataFrame, ids: Sequence[int]) -> DataFrame:
    """`weekly_report` rows as one row: sums, the share right, the mean AUC of the weeks that
    have one, and the mean number of features of a learner-week."""
    return weekly.agg(
        F.sum("users").alias("users"), F.sum("test_users").alias("test_users"),
        F.sum("correct").alias("correct"), F.sum("incorrect").alias("incorrect"),
        (F.sum("correct") / F.sum("test_users")).alias("accuracy"),
        F.avg(F.when(F.col("auc") != -1, F.col("auc"))).alias("mean_auc"),
        *[F.sum(f"users_{c}").alias(f"users_{c}") for c in cohort.names(ids)],
        (F.sum(F.col("mean_present") * F.col("users")) / F.sum("users")).alias("mean_present"))


def report(scores: DataFrame, wide: DataFrame, ids: Sequence[int], **settings) -> tuple[DataFrame, DataFrame]:
    """The weekly rows, stored as a table, and their total."""
    weekly = written(weekly_report(scores, wide, ids, **settings))
    return weekly, total_report(weekly, ids)
