"""How far fitted weekly classifiers are from what they should be, measured on their training rows.

A residual of 0 is the optimum; what a model that has not learned would have is far from it:

* logistic regression: the largest entry of the penalised slope of the mean log loss;
* support vector machine: by how much the penalised mean hinge loss is at most above the least
  possible one. The bound is the loss of a solution of the dual problem, made of the rows' pulls at
  a corner rounded by CORNER: the pulls of both classes are brought into balance, all of them scaled;
* decision tree: by how much the best first split of any feature at any of its values lowers the
  impurity more than the tree's own.

All sums over rows are taken by Spark; the driver sees some vectors of features per week and class.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.ranks import running_totals

CORNER = 0.01


def residuals(models: Mapping[int, PipelineModel], training: DataFrame) -> DataFrame:
    """feature_week and residual of each model; `training` are the rows it was fitted on
    (`cohort.training_rows`)."""
    found: list[tuple[int, float]] = []
    sums, trees = {}, {}
    for week, pipeline in models.items():
        stage = next(s for s in pipeline.stages if isinstance(
            s, (LogisticRegressionModel, LinearSVCModel, DecisionTreeClassificationModel)))
        rows = training.filter(F.col("model_week") == week)
        if isinstance(stage, DecisionTreeClassificationModel):
            trees[week] = stage, pipeline.stages[0].getInputCols(), rows
        else:
            sums[week] = stage, _summed(week, stage, pipeline.transform(rows))
    if sums:
        parts = [part for _, part in sums.values()]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        classes: dict[int, dict[int, object]] = {}
        for row in whole.collect():
            classes.setdefault(row["week"], {})[row["label"]] = row
        for week, (stage, _) in sums.items():
            measure = _gap if isinstance(stage, LinearSVCModel) else _slope
            found.append((week, measure(stage, classes[week])))
    for week, (stage, columns, rows) in trees.items():
        found.append((week, _shortfall(stage, columns, rows)))
    return training.sparkSession.createDataFrame(found, "feature_week int, residual double")


def _summed(week: int, stage, scored: DataFrame) -> DataFrame:
    """Per class: rows, losses, pulls, and the pulled sums of the features the model sees."""
    sign = F.col("label") * 2 - 1
    if isinstance(stage, LinearSVCModel):
        short = 1 - sign * vector_to_array(stage.getRawPredictionCol())[1]
        loss: Column = F.greatest(short, F.lit(0.0))
        pull = F.least(loss / CORNER, F.lit(1.0))
    else:
        right = F.abs(1 - F.col("label") - vector_to_array(stage.getProbabilityCol())[1])
        loss, pull = -F.log(right), 1 - right
    return scored.select("label", F.col(stage.getFeaturesCol()).alias("seen"), loss.alias("loss"), pull.alias("pull")) \
        .groupBy("label").agg(
            F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss"), F.sum("pull").alias("pull"),
            Summarizer.sum(F.col("seen"), F.col("pull")).alias("pulled")) \
        .select(F.lit(week).alias("week"), "*")


def _pulled(row, size: int) -> np.ndarray:
    """A class's pulled sum; rows of weight 0 alone have none."""
    return row["pulled"].toArray() if row["pull"] > 0 else np.zeros(size)


def _slope(stage: LogisticRegressionModel, classes: Mapping) -> float:
    weights = stage.coefficients.toArray()
    n = sum(row["n"] for row in classes.values())
    slope, constant = n * stage.getRegParam() * weights, 0.0
    for label, row in classes.items():
        slope = slope - (2 * label - 1) * _pulled(row, len(weights))
        constant -= (2 * label - 1) * row["pull"]
    return float(max(np.abs(slope).max(initial=0), abs(constant) if stage.getFitIntercept() else 0)) / n


def _gap(stage: LinearSVCModel, classes: Mapping) -> float:
    weights, strength = stage.coefficients.toArray(), stage.getRegParam()
    n = sum(row["n"] for row in classes.values())
    primal = sum(row["loss"] for row in classes.values()) / n + strength / 2 * float(weights @ weights)
    balance = min(classes[k]["pull"] if k in classes else 0.0 for k in (0, 1))
    if not balance:
        return primal
    total = sum((2 * k - 1) * balance / row["pull"] * _pulled(row, len(weights)) for k, row in classes.items()) / n
    mean, square = 2 * balance / n, float(total @ total) / strength
    # Of all shares of these pulls, the one with the largest dual loss; no pull may exceed 1.
    share = min(1.0, mean / square) if square else 1.0
    return primal - (share * mean - share * share * square / 2)


def _impurity(kind: str, ones: Column, n: Column) -> Column:
    share = F.try_divide(ones, n)
    if kind == "gini":
        return 2 * share * (1 - share)
    return -F.coalesce(share * F.log2(F.when(share > 0, share)), F.lit(0.0)) \
        - F.coalesce((1 - share) * F.log2(F.when(share < 1, 1 - share)), F.lit(0.0))


def _gains(rows: DataFrame, kind: str) -> DataFrame:
    """How much splitting the rows (feature, value, label) of each feature behind each of its values
    lowers the impurity."""
    histogram = rows.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("ones"))
    ranked = running_totals(histogram, "feature", "value", ["n", "ones"])
    low, low_ones = F.col("n_before") + F.col("n"), F.col("ones_before") + F.col("ones")
    high, high_ones = F.col("n_all") - low, F.col("ones_all") - low_ones
    gain = _impurity(kind, F.col("ones_all"), F.col("n_all")) \
        - low / F.col("n_all") * _impurity(kind, low_ones, low) \
        - high / F.col("n_all") * _impurity(kind, high_ones, high)
    return ranked.filter(low < F.col("n_all")).select("feature", "value", gain.alias("gain"))


def _shortfall(stage: DecisionTreeClassificationModel, columns: list[str], rows: DataFrame) -> float:
    cells = F.inline(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(c).cast("double").alias("value"), F.col("label"))
                               for k, c in enumerate(columns)]))
    gains = _gains(rows.select(cells), stage.getImpurity())
    own = F.lit(False)
    root = stage._java_obj.rootNode()
    if stage.depth:
        split = root.split()
        own = (F.col("feature") == split.featureIndex()) & (F.col("value") <= split.threshold())
    # The tree's own split is behind the last value that is not above its threshold.
    best = gains.agg(F.max("gain").alias("best"), F.max(F.when(own, F.struct("value", "gain"))).alias("own")).first()
    if best["best"] is None:
        return 0.0
    return best["best"] - (best["own"]["gain"] if best["own"] else 0.0)
