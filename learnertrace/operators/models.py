"""Weekly stop-out classifiers on prepared wide rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.operators import cohort, evaluation, hinge
from learnertrace.sources.manifest import Manifest
from learnertrace.sources.store import dropped, written

# The features the weekly models use.
MODEL_FEATURES = (2, 3, 6, 7, 8, 15, 16, 208, 209, 210)

COLUMNS = {"featuresCol": "features", "labelCol": "label"}

# The values tried for each model. `penalty` is the inverse weight
# of the regularisation, as opposed to Spark's regParam; `degree` that of a polynomial kernel,
# 1 for a linear one.
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"penalty": [1, 10, 100, 1000, 10000], "fitIntercept": [True, False]},
    "svm": {"penalty": [1, 10, 100, 1000], "degree": [1, 3, 4, 5]},
    "decision_tree": {"impurity": ["gini", "entropy"],
                      "featureSubsetStrategy": ["sqrt", "log2", "all"]},
    "random_forest": {
        "numTrees": [10, 20, 30], "impurity": ["gini", "entropy"],
        "featureSubsetStrategy": ["sqrt", "log2", "all"], "bootstrap": [True, False],
    },
    "neural_network": {"solver": ["l-bfgs", "gd"]},
}

#: Rows of a week that one partition holds while its models are fitted.
ROWS_PER_PART = 50_000

#: Values of a feature between which trees may split; with more values, so many quantiles.
BINS = 1024


def estimator(model: str, n_features: int, seed: int = 19, **settings) -> Estimator:
    """A classifier; support vector machines come from `hinge` instead. A tree that looks at some features per split is a forest of one tree."""
    if model == "logistic_regression":
        stage = LogisticRegression(standardization=False, **COLUMNS)
    elif model == "decision_tree" and settings.get("featureSubsetStrategy", "all") != "all":
        stage = RandomForestClassifier(numTrees=1, bootstrap=False, seed=seed, maxBins=BINS, **COLUMNS)
    elif model == "decision_tree":
        settings.pop("featureSubsetStrategy", None)
        stage = DecisionTreeClassifier(seed=seed, maxBins=BINS, **COLUMNS)
    elif model == "random_forest":
        stage = RandomForestClassifier(seed=seed, maxBins=BINS, **COLUMNS)
    elif model == "neural_network":
        stage = MultilayerPerceptronClassifier(layers=[n_features, 100, 2], seed=seed, **COLUMNS)
    else:
        raise ValueError(f"no estimator for model {model!r}; known are {sorted(GRIDS)}")
    return stage.copy({stage.getParam(name): value for name, value in settings.items()})


def choices(grid: Mapping[str, list]) -> list[dict]:
    """Every combination of a grid's values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def same_fit(model: str, choice: Mapping, n_features: int) -> tuple:
    """What a choice's fit depends on: choices that agree in it give the same model on the same rows.

    Trees look at a number of features per split, whatever rule gives it. Trees of a forest that see all rows
    and all features are copies of one tree, so their number changes no prediction.
    """
    found = dict(choice)
    if "featureSubsetStrategy" in found:
        per_split = {"all": n_features, "sqrt": math.ceil(math.sqrt(n_features)),
                     "log2": max(1, math.ceil(math.log(n_features) / math.log(2)))}
        rule = found["featureSubsetStrategy"]
        found["featureSubsetStrategy"] = rule if rule == "all" else per_split.get(rule, rule)
    if model == "random_forest" and found.get("bootstrap") is False and (
            found.get("featureSubsetStrategy") == "all" and found.get("subsamplingRate", 1.0) == 1.0):
        found.pop("numTrees", None)
    return tuple(sorted((name, repr(value)) for name, value in found.items()))


def _fit(rows: DataFrame, n: int, n_features: int, model: str, choice: Mapping, seed: int) -> Transformer:
    """A model fitted on `rows` (features, label), of which there are `n`.

    Spark divides the loss by the number of rows and multiplies the penalty, so
    an inverse weight of c becomes 1 / (c * n).
    """
    settings = dict(choice)
    if "penalty" in settings:
        settings["regParam"] = 1.0 / (settings.pop("penalty") * max(n, 1))
    return estimator(model, n_features, seed, **settings).fit(rows)


def _margin_to_probability(rows: DataFrame) -> list[Transformer]:
    """Stages that turn the margin of a support vector machine into the probability of class
    1, a sigmoid fitted on the scored rows."""
    slicer = VectorSlicer(inputCol="rawPrediction", outputCol="margin", indices=[1])
    curve = LogisticRegression(featuresCol="margin", labelCol="label", rawPredictionCol="margin_raw",
                               predictionCol="margin_prediction")
    return [slicer, curve.fit(slicer.transform(rows))]


@dataclass(frozen=True)
class Week:
    """Rows that train the model of a week: all, those of label 1, and those in each fold."""

    week: int
    rows: int
    ones: int
    sizes: tuple[int, ...]


def _fold(folds: int, seed: int) -> Column:
    """A learner's fold, a hash of the learner, so a rerun has the same folds."""
    return F.pmod(F.xxhash64("user_id", F.lit(seed)), F.lit(folds)).cast("int")


def _counts(fold: Column, folds: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"),
            *[F.count_if(fold == k).alias(f"n{k}") for k in range(folds)]]


def fit_weekly(
    training: DataFrame, ids: Sequence[int], model: str = "logistic_regression",
    grid: Mapping[str, list] | None = None, folds: int = 3, parallelism: int = 8, seed: int = 19,
) -> dict[int, PipelineModel]:
    """One classifier per `model_week`, chosen by cross-validated accuracy over `grid`.

    `training` is what `cohort.training_rows` gives. It is written out once,
    split by model week, and removed when done; each week then reads its own part once and
    keeps it for all its fits. A choice's accuracy is the mean over folds that have rows to fit and to
    judge; choices that fit the same model are fitted once. Weeks with one class only have nothing to learn and are left out. A grid with a single
    choice is fitted directly.
    """
    used: list[str] = []
    training = written(training, "model_week", used=used)
    fold = _fold(folds, seed)
    try:
        # One row per course week.
        weeks = [Week(r["model_week"], r["n"], r["ones"], tuple(r[f"n{k}"] for k in range(folds)))
                 for r in training.groupBy("model_week").agg(*_counts(fold, folds)).orderBy("model_week").collect()]
        return _fitted(lambda week: training.filter(F.col("model_week") == week), weeks, training.sparkSession,
                       ids, model, grid, fold, parallelism, seed)
    finally:
        dropped(training.sparkSession, *used)


def fit_prepared(
    prepared: DataFrame, ids: Sequence[int], model: str = "logistic_regression",
    grid: Mapping[str, list] | None = None, mode: str = "week", folds: int = 3, parallelism: int = 8,
    seed: int = 19,
) -> dict[int, PipelineModel]:
    """`fit_weekly` of what `cohort.training_rows(prepared, mode)` gives, without making that table.

    `prepared` is a stored table, best with a folder per week. The model of a week reads the weeks
    it learns from out of that one table, in mode "cumulative" all up to its own, less the rows
    that test it; so no row is written once for each model that uses it.
    """
    if mode not in ("week", "all", "cumulative"):
        raise ValueError(f"unknown mode {mode!r}")
    fold = _fold(folds, seed)
    # At most two rows per course week.
    parts = prepared.groupBy("feature_week", "is_test").agg(*_counts(fold, folds)).collect()

    def rows_of(week: int) -> DataFrame:
        own = F.col("feature_week") == week
        if mode == "all":
            return prepared.filter(own)
        own = own & ~F.col("is_test")
        return prepared.filter(own | (F.col("feature_week") < week) if mode == "cumulative" else own)

    def counted(week: int) -> Week:
        mine = [p for p in parts if p["feature_week"] == week and (mode == "all" or not p["is_test"])
                or mode == "cumulative" and p["feature_week"] < week]
        return Week(week, sum(p["n"] for p in mine), sum(p["ones"] for p in mine),
                    tuple(sum(p[f"n{k}"] for p in mine) for k in range(folds)))

    weeks = [counted(week) for week in sorted({p["feature_week"] for p in parts})]
    return _fitted(rows_of, weeks, prepared.sparkSession, ids, model, grid, fold, parallelism, seed)


def _fitted(
    rows_of: Callable[[int], DataFrame], weeks: Sequence[Week], spark: SparkSession, ids: Sequence[int],
    model: str, grid: Mapping[str, list] | None, fold: Column, parallelism: int, seed: int,
) -> dict[int, PipelineModel]:
    """The classifiers of the weeks that have both classes."""
    tried = choices(GRIDS[model] if grid is None else grid)
    weeks = [week for week in weeks if 0 < week.ones < week.rows]
    assembler = VectorAssembler(inputCols=cohort.names(ids), outputCol="features")
    if model == "svm":
        return _fit_machines(rows_of, weeks, spark, ids, tried, fold, assembler) if weeks else {}
    threaded = inheritable_thread_target(spark)

    def fit_week(week: Week) -> PipelineModel:
        n, sizes = week.rows, week.sizes
        rows = assembler.transform(rows_of(week.week)).select(
            "features", "label", fold.alias("fold")).coalesce(-(-n // ROWS_PER_PART)).persist()

        def judged(choice: Mapping, k: int) -> float | None:
            if not 0 < sizes[k] < n:
                return None
            fitted = _fit(rows.filter(F.col("fold") != k), n - sizes[k], len(ids), model, choice, seed)
            right = (F.col("prediction") == F.col("label")).cast("double")
            return fitted.transform(rows.filter(F.col("fold") == k)).agg(F.avg(right)).first()[0]

        def accuracy(shares: Sequence[float | None]) -> float:
            found = [x for x in shares if x is not None]
            return sum(found) / max(len(found), 1)

        try:
            best = 0
            if len(tried) > 1:
                fits = [same_fit(model, choice, len(ids)) for choice in tried]
                tasks = [(fit, k) for fit in dict.fromkeys(fits) for k in range(len(sizes))]
                shares = dict(zip(tasks, inner.map(threaded(lambda task: judged(tried[fits.index(task[0])], task[1])), tasks)))
                scores = [accuracy([shares[fit, k] for k in range(len(sizes))]) for fit in fits]
                best = scores.index(max(scores))
            return PipelineModel([assembler, _fit(rows, n, len(ids), model, tried[best], seed)])
        finally:
            rows.unpersist()

    # Most fits are one task at a time: fewer of them than cores would leave cores idle.
    parallelism = max(parallelism, spark.sparkContext.defaultParallelism)
    with ThreadPoolExecutor(parallelism) as inner, ThreadPoolExecutor(max(1, parallelism // 2)) as outer:
        fitted = list(outer.map(threaded(fit_week), weeks))
    return {week.week: pipeline for week, pipeline in zip(weeks, fitted)}


def _fit_machines(
    rows_of: Callable[[int], DataFrame], weeks: Sequence[Week], spark: SparkSession, ids: Sequence[int],
    tried: Sequence[Mapping], fold: Column, assembler: VectorAssembler,
) -> dict[int, PipelineModel]:
    """The best support vector machine per week, with probabilities; see `hinge`."""
    training = reduce(DataFrame.unionByName, [
        rows_of(week.week).withColumn("model_week", F.lit(week.week)) for week in weeks])
    best = hinge.fitted_grid(training, cohort.names(ids), fold, {week.week: week.sizes for week in weeks}, tried)
    models = {}
    for week in weeks:
        choice, weights, constant = best[week.week]
        stages = [assembler, *hinge.as_stages(spark, len(ids), choice.get("degree", 1), choice["penalty"],
                                              week.rows, weights, constant)]
        rows = PipelineModel(stages).transform(rows_of(week.week))
        models[week.week] = PipelineModel([*stages, *_margin_to_probability(rows)])
    return models


def save_models(models: Mapping[int, PipelineModel], folder: str, about: Mapping | None = None) -> None:
    """Store the weekly models of a run as the folder's newest version.

    They come into a folder of their own, which is then listed with the run's weeks, the names of the
    features and `about` (what else tells how rows have to be prepared, such as the scaling). Readers
    see the models of one run whole; those of earlier runs stay until `Manifest.clean`.
    """
    if not models:
        raise ValueError("there are no models to store")
    spark = SparkSession.getActiveSession()
    manifest = Manifest(spark, folder)
    before, place = manifest.read()[0], manifest.new_folder()
    for week, model in models.items():
        model.write().save(f"{manifest.folder}/{place}/week={week}")
    columns = {week: model.stages[0].getInputCols() for week, model in models.items()}
    if len({tuple(c) for c in columns.values()}) > 1:
        raise ValueError(f"the weeks do not use the same features: {columns}")
    manifest.commit({"folder": place, "weeks": sorted(models), "features": next(iter(columns.values())),
                     "about": dict(about or {})}, before)


def load_models(
    spark: SparkSession, folder: str, ids: Sequence[int] | None = None, about: Mapping | None = None,
) -> dict[int, PipelineModel]:
    """The weekly models of the run stored last in a folder.

    `ids` and `about` may tell the features, and how the rows that are to be scored were prepared;
    models of other features or another preparation are refused.
    """
    listed = Manifest(spark, folder).read()[1]
    if not listed:
        raise LookupError(f"no models in {folder}")
    if ids is not None and cohort.names(ids) != listed["features"]:
        raise ValueError(f"the models use {listed['features']}, not {cohort.names(ids)}")
    for name, value in (about or {}).items():
        if listed["about"].get(name) != value:
            raise ValueError(f"the models were made with {name} {listed['about'].get(name)!r}, not {value!r}")
    return {w: PipelineModel.load(f"{folder.rstrip('/')}/{listed['folder']}/week={w}") for w in listed["weeks"]}


def score(models: Mapping[int, PipelineModel], rows: DataFrame) -> DataFrame:
    """Apply each week's model to the rows of that week. The score is the probability of class 1."""
    parts = []
    for week, model in models.items():
        out = model.transform(rows.filter(F.col("feature_week") == week))
        parts.append(out.select(
            "user_id", "feature_week", "label",
            vector_to_array("probability")[1].alias("score"),
            F.col("prediction").cast("int").alias("prediction")))
    if not parts:
        raise ValueError("no week had enough learners of both classes")
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return scores


def prepare(
    features: DataFrame, ids: Sequence[int], labels: DataFrame | None = None,
    weeks_ahead: int = 1, last_week: int | None = None, min_support: int = 3, min_users: int = 25,
    scaled: bool = True, test_fraction: float = 0.25, seed: int = 19,
) -> DataFrame:
    """Labelled, supported, scaled and split rows of all weeks that can be analysed.

    `labels` may give the rows of feature 1 on their own, which saves looking
    for them among all features.
    """
    wide = cohort.wide_features(features, ids, labels=labels)
    rows = cohort.with_future_label(
        cohort.with_support(wide, ids, min_support), features if labels is None else labels,
        weeks_ahead, last_week)
    if scaled:
        rows = cohort.scaled_valid_weeks(rows, ids, min_users)
    else:
        rows = cohort.in_valid_weeks(rows, min_users)
    return cohort.with_split(rows, test_fraction, seed)


def save_prepared(prepared: DataFrame, path: str) -> None:
    """Store prepared rows, one folder per week, for `open_prepared`."""
    prepared.hint("rebalance", "feature_week").write.mode("overwrite").partitionBy("feature_week").parquet(path)


def open_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def train_and_score(
    prepared: DataFrame, ids: Sequence[int], model: str = "logistic_regression",
    grid: Mapping[str, list] | None = None, mode: str = "week",
) -> DataFrame:
    """Fit per week and score the test rows; in mode "all" no row is left to test with."""
    if mode == "all":
        raise ValueError('mode "all" trains on the test rows; use fit_weekly and transfer')
    prepared = written(prepared, "feature_week")
    return score(fit_prepared(prepared, ids, model, grid, mode), prepared.filter("is_test"))


def transfer(models: Mapping[int, PipelineModel], other: DataFrame) -> DataFrame:
    """Scores of another course's rows under this course's models, for the weeks both have."""
    return score(models, other)


def ensemble(scores_a: DataFrame, scores_b: DataFrame,
             weeks: tuple[int, int] | None = None) -> DataFrame:
    """Mean score of two models for the same rows, and the class it stands for.

    `weeks` may give the first and last week to take; both scores are probabilities.
    """
    keys = ["user_id", "feature_week"]
    if weeks is not None:
        scores_a = scores_a.filter(F.col("feature_week").between(*weeks))
    second = scores_b.select(*keys, F.col("score").alias("other"))
    mean = (F.col("score") + F.col("other")) / 2
    return (
        scores_a.join(second, keys)
        .select(*keys, "label", mean.alias("score"),
                F.when(mean > 0.5, 1).otherwise(0).alias("prediction"))
    )


def compare_models(
    prepared: DataFrame, ids: Sequence[int], models: Iterable[str] = tuple(GRIDS),
    grids: Mapping[str, Mapping[str, list]] | None = None,
) -> DataFrame:
    """Accuracy and AUC per model and week on the same test rows."""
    prepared = written(prepared, "feature_week")
    held_out = prepared.filter("is_test")
    tables = []
    for model in models:
        fitted = fit_prepared(prepared, ids, model, (grids or GRIDS)[model])
        scores = written(score(fitted, held_out))
        tables.append(
            evaluation.accuracy(scores).join(evaluation.auc(scores), "feature_week")
            .select(F.lit(model).alias("model"), "feature_week", "n", "accuracy", "auc"))
    metrics = tables[0]
    for table in tables[1:]:
        metrics = metrics.unionByName(table)
    return metrics


def model_totals(metrics: DataFrame) -> DataFrame:
    """`compare_models` rows over all weeks: rows, share right, mean AUC where there is one."""
    return metrics.groupBy("model").agg(
        F.sum("n").alias("n"), (F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")).alias("accuracy"),
        F.avg(F.when(F.col("auc") != -1, F.col("auc"))).alias("mean_auc"))
