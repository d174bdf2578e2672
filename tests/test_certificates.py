"""Fits of whole grids at once, and what the certificates say of good and bad models."""

import pickle
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from learnertrace.functions import arrow
from learnertrace.operators import certificates, cohort, hinge, models

IDS = [2, 3, 6]


def fold():
    return F.pmod(F.xxhash64("user_id"), F.lit(3)).cast("int")


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(4)
    rows = []
    for week in (1, 2):
        for i in range(160):
            a, b, c = rng.random(), rng.random(), rng.random()
            rows.append((f"u{i}", week, a, b, c, int((a - 0.5) * (b - 0.5) + 0.05 * rng.gauss(0, 1) > 0)))
    frame = spark.createDataFrame(
        rows, "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE, f6 DOUBLE, label INT")
    return cohort.training_rows(frame.withColumn("is_test", F.lit(False)), "all").repartition(5)


def sizes(training):
    counts = training.groupBy("model_week", fold().alias("k")).count().collect()
    return {week: [next((r["count"] for r in counts if (r.model_week, r.k) == (week, k)), 0) for k in range(3)]
            for week in (1, 2)}


def test_expansion_is_that_of_spark(spark):
    rows = np.random.default_rng(1).random((7, 4))
    for degree in (2, 3, 5):
        frame = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "k INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
        powers = PolynomialExpansion(degree=degree, inputCol="x", outputCol="p").transform(
            VectorAssembler(inputCols=list("abcd"), outputCol="x").transform(frame))
        want = np.array([r[0] for r in powers.orderBy("k").select(vector_to_array("p")).collect()])
        got = hinge.expanded(rows, degree)[hinge.spark_order(spark, 4, degree)].T
        assert np.allclose(got, want)


def test_directions_leave_out_little():
    rng = np.random.default_rng(2)
    for size, rank in ((5, 5), (60, 12), (400, 30), (400, 390)):
        lines = rng.normal(size=(size, rank)) * 10.0 ** -rng.integers(0, 6, rank)
        moments = lines @ lines.T / rank
        basis = hinge.directions(moments, 1e-4)
        assert np.allclose(basis @ moments @ basis.T, np.eye(len(basis)), atol=1e-5)
        projection = np.linalg.qr(basis.T)[0]
        rest = np.trace(moments) - np.trace(projection.T @ moments @ projection)
        assert rest <= 2 * 1e-4 * hinge.LEFT_OUT * 1.01 + 1e-12 * np.trace(moments)


@pytest.mark.parametrize("cells", [hinge.CELLS, 2500])
def test_fits_of_a_grid_are_optimal(training, monkeypatch, cells):
    monkeypatch.setattr(hinge, "CELLS", cells)
    choices = models.choices({"penalty": [100], "degree": [1, 3]})
    found = hinge.fitted_grid(training, cohort.names(IDS), fold(), sizes(training), choices)
    for week, (choice, weights, constant) in found.items():
        assert choice["degree"] == 3  # the rule is a product
        rows = training.filter(F.col("model_week") == week).collect()
        x = np.array([[r.f2, r.f3, r.f6] for r in rows])
        y = np.array([2.0 * r.label - 1 for r in rows])
        lines = hinge.expanded(x, choice["degree"])

        def loss(w, b):
            return np.maximum(0, 1 - y * (w @ lines + b)).mean() + w @ w / (2 * choice["penalty"] * len(y))

        least = loss(weights, constant)
        # No neighbour is better by more than the rounding of the corner may cost.
        rng = np.random.default_rng(week)
        for size in (1e-3, 1e-1, 1):
            for _ in range(200):
                step = rng.normal(size=len(weights)) * size * (1 + np.abs(weights))
                assert loss(weights + step, constant + size * rng.normal()) > least - hinge.CORNERS[-1] / 2


def test_no_matrix_comes_to_the_driver(training, monkeypatch):
    """Moments and curvatures are added up and solved by tasks; the driver gets directions and steps."""
    got, loads = [], pickle.loads
    monkeypatch.setattr(arrow.pickle, "loads", lambda data: got.append(len(data)) or loads(data))
    choices = models.choices({"penalty": [1, 100], "degree": [4]})
    found = hinge.fitted_grid(training, cohort.names(IDS), fold(), sizes(training), choices)
    monomials = len(hinge.exponents(len(IDS), 4))
    assert sorted(found) == [1, 2] and len(found[1][1]) == monomials
    # A week's directions are fewer than its monomials; of a model come some vectors along them.
    matrix = 8 * monomials * monomials
    assert len(got) > 50 and max(got) < matrix + 1000 and sum(sorted(got)[-3:]) < 3 * matrix
    assert sorted(got)[-3] < 6 * 8 * (monomials + 1) + 1000


@pytest.mark.parametrize("cells", [hinge.CELLS, 2500])
def test_tasks_that_hold_a_week_take_the_same_steps(training, monkeypatch, cells):
    """A week's rows that fit a task take no pass per step, and give what passes give."""
    passes, measure = [], hinge.finished
    monkeypatch.setattr(hinge, "finished", lambda *a: passes.append(1) or measure(*a))
    monkeypatch.setattr(hinge, "CELLS", cells)
    choices = models.choices({"penalty": [1, 100], "degree": [1, 3]})
    rest = training.filter("model_week = 1 OR f2 > 0.3")
    alone = hinge.fitted_grid(rest, cohort.names(IDS), fold(), sizes(rest), choices)
    assert len(passes) == 1  # the directions
    # Both weeks in passes, then only the larger one.
    for most in (0, 2300):
        monkeypatch.setattr(hinge, "ALONE", most)
        found = hinge.fitted_grid(rest, cohort.names(IDS), fold(), sizes(rest), choices)
        for week, (choice, weights, constant) in found.items():
            assert choice == alone[week][0]
            assert np.allclose(weights, alone[week][1], atol=1e-3) and abs(constant - alone[week][2]) < 1e-3
    assert len(passes) > 20


def fitted(training, model, grid):
    return models.fit_weekly(training, IDS, model, grid)


def residuals(found, training):
    return {r.feature_week: r.residual for r in certificates.residuals(found, training).collect()}


@pytest.mark.parametrize("model, grid", [
    ("logistic_regression", {"penalty": [10], "fitIntercept": [True]}),
    ("logistic_regression", {"penalty": [1000], "fitIntercept": [False]}),
    ("svm", {"penalty": [1, 100], "degree": [3]}),
    ("decision_tree", {"impurity": ["gini"], "featureSubsetStrategy": ["all"]}),
    ("decision_tree", {"impurity": ["entropy"], "featureSubsetStrategy": ["all"]})])
def test_residuals_of_fits_vanish(training, model, grid):
    found = fitted(training, model, grid)
    assert sorted(found) == [1, 2]
    for residual in residuals(found, training).values():
        assert -1e-9 < residual < 0.004


def test_residuals_of_bad_models_do_not(spark, training):
    learned = training.withColumn("label", (F.col("f2") > 0.5).cast("int"))
    turned = learned.withColumn("label", 1 - F.col("label"))
    logistic = fitted(learned, "logistic_regression", {"penalty": [1000], "fitIntercept": [True]})
    assert min(residuals(logistic, turned).values()) > 0.03
    assembler = VectorAssembler(inputCols=cohort.names(IDS), outputCol="features")
    nothing = PipelineModel([assembler, *hinge.as_stages(spark, 3, 3, 100.0, 160, np.zeros(19), 0.0)])
    assert min(residuals({1: nothing, 2: nothing}, training).values()) > 0.2
    tree = fitted(training.withColumns({"f2": F.rand(1), "f3": F.rand(2), "f6": F.rand(3)}),
                  "decision_tree", {"impurity": ["gini"]})
    assert max(residuals(tree, training).values()) > 0.004


def test_machines_are_stored(spark, training, tmp_path):
    found = fitted(training, "svm", {"penalty": [10], "degree": [2]})
    models.save_models(found, str(tmp_path))
    again = models.load_models(spark, str(tmp_path))
    rows = training.filter("model_week = 1")
    scores = [sorted(m[1].transform(rows).select(vector_to_array("probability")[1]).collect()) for m in (found, again)]
    assert np.allclose(*scores)
    assert max(residuals(again, training).values()) < 0.004


def test_one_class_and_few_rows(spark, training):
    few = training.filter("user_id IN ('u1', 'u2', 'u3', 'u4', 'u5')")
    assert set(fitted(few, "svm", {"penalty": [1, 10], "degree": [1, 3]})) <= {1, 2}
    assert fitted(training.withColumn("label", F.lit(1)), "svm", {"penalty": [1]}) == {}
