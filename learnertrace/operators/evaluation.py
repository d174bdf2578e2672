"""How good predictions are. `scores` has user_id, feature_week, label, score, prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.ranks import running_totals

WEEK = "feature_week"


def accuracy(scores: DataFrame) -> DataFrame:
    """Per week, rows and share of right predictions."""
    return scores.groupBy(WEEK).agg(*_accuracy())


def overall_accuracy(scores: DataFrame) -> DataFrame:
    """The same over all weeks, which weighs each week by its rows."""
    return scores.agg(*_accuracy())


def _accuracy() -> list:
    right = F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)
    return [F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy")]


def confusion(scores: DataFrame) -> DataFrame:
    """Per week, rows for each label and prediction, also where there are none."""
    cells = [(label, guess) for label in (0, 1) for guess in (0, 1)]
    weekly = scores.groupBy(WEEK).agg(*[
        F.count_if((F.col("label") == a) & (F.col("prediction") == b)).alias(f"c{a}{b}")
        for a, b in cells])
    return weekly.select(WEEK, F.inline(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                 F.col(f"c{a}{b}").alias("n")) for a, b in cells])))


def _ranked(scores: DataFrame) -> DataFrame:
    """Distinct scores per week, with the positives and negatives at and above each."""
    histogram = scores.groupBy(WEEK, "score").agg(
        F.sum("label").cast("long").alias("positives"),
        F.sum(1 - F.col("label")).cast("long").alias("negatives"))
    return running_totals(histogram, WEEK, "score", ["positives", "negatives"], descending=True)


def roc(scores: DataFrame) -> DataFrame:
    """Per week, one point per distinct score taken as threshold; a missing class gives NULL."""
    return _ranked(scores).select(
        WEEK, F.col("score").alias("threshold"),
        F.try_divide(F.col("negatives_before") + F.col("negatives"), "negatives_all").alias("fpr"),
        F.try_divide(F.col("positives_before") + F.col("positives"), "positives_all").alias("tpr"),
    )


def auc(scores: DataFrame) -> DataFrame:
    """Per week, area under the ROC curve by trapezoids; -1 if only one class occurs."""
    area = F.col("negatives") * (F.col("positives_before") + F.col("positives") / 2)
    whole = F.max("negatives_all").cast("double") * F.max("positives_all")
    return _ranked(scores).groupBy(WEEK).agg(
        F.coalesce(F.try_divide(F.sum(area), whole), F.lit(-1.0)).alias("auc"))


def mean_auc(weekly: DataFrame) -> DataFrame:
    """Mean over the weeks that have both classes."""
    return weekly.filter(F.col("auc") != -1).agg(F.avg("auc").alias("mean_auc"))
