"""Weekly classifiers on a rule that can be learned."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from learnertrace.operators import cohort, evaluation, models, report
from learnertrace.sources.store import shared_folder

IDS = [2, 3]


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(9)
    rows = []
    for week in (3, 4):
        for i in range(300):
            a, b = rng.random(), rng.random()
            rows.append((f"u{i}", week, a, b, int(a + 0.2 * rng.random() > 0.6)))
    frame = spark.createDataFrame(
        rows, "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE, label INT")
    return cohort.with_split(frame)


GRIDS = {"logistic_regression": {"penalty": [1, 100], "fitIntercept": [True, False]},
         "svm": {"penalty": [10], "degree": [1, 3]}, "decision_tree": {"impurity": ["gini"], "featureSubsetStrategy": ["all", "sqrt"]},
         "random_forest": {"numTrees": [10], "bootstrap": [True]},
         "neural_network": {"solver": ["l-bfgs"]}}


@pytest.mark.parametrize("model", sorted(models.GRIDS))
def test_models_learn(prepared, model):
    scores = models.train_and_score(prepared, IDS, model, GRIDS[model])
    assert scores.columns == ["user_id", "feature_week", "label", "score", "prediction"]
    assert scores.count() == prepared.filter("is_test").count()
    assert scores.filter("score NOT BETWEEN 0 AND 1").count() == 0
    assert evaluation.overall_accuracy(scores).first()["accuracy"] > 0.85
    assert evaluation.mean_auc(evaluation.auc(scores)).first()[0] > 0.9


def test_transfer_and_ensemble(prepared):
    fitted = models.fit_weekly(cohort.training_rows(prepared, "cumulative"), IDS,
                               "logistic_regression", {"penalty": [1]})
    assert sorted(fitted) == [3, 4]
    scores = models.transfer(fitted, prepared)
    assert scores.count() == prepared.count()
    both = models.ensemble(scores, scores)
    assert both.count() == scores.count()
    assert both.filter("abs(score) > 1").count() == 0
    assert models.ensemble(scores, scores, weeks=(4, 10)).count() == 300
    assert evaluation.overall_accuracy(both).first()["accuracy"] > 0.85


def test_grids_cover_every_setting(spark):
    sizes = {model: len(models.choices(grid)) for model, grid in models.GRIDS.items()}
    assert sizes == {"logistic_regression": 10, "svm": 16, "decision_tree": 6, "random_forest": 36,
                     "neural_network": 2}
    for model, grid in models.GRIDS.items():
        for choice in models.choices(grid):
            settings = {k: v for k, v in choice.items() if k not in ("penalty", "degree")}
            if model != "svm":
                models.estimator(model, 2, **settings)


def test_choices_that_fit_the_same_forest_are_fitted_once(spark, monkeypatch):
    rng = random.Random(4)
    rows = spark.createDataFrame(
        [(f"u{i}", 3, *(x := [rng.random() for _ in range(3)]), int(x[0] + x[1] * rng.random() > 0.7)) for i in range(120)],
        "user_id STRING, model_week INT, f2 DOUBLE, f3 DOUBLE, f4 DOUBLE, label INT").repartition(2, "user_id").cache()
    grid = {"numTrees": [2, 5], "featureSubsetStrategy": ["sqrt", "log2", "all"], "bootstrap": [True, False]}
    groups = {}
    for choice in models.choices(grid):
        groups.setdefault(models.same_fit("random_forest", choice, 3), []).append(choice)
    assert len(groups) == 7
    data = models.VectorAssembler(inputCols=["f2", "f3", "f4"], outputCol="features").transform(rows)
    for alike in groups.values():
        # On the same rows, each choice of a group predicts the same.
        found = [models._fit(data, 120, 3, "random_forest", choice, 19).transform(data)
                 .orderBy("user_id").select("prediction").collect() for choice in alike]
        assert all(x == found[0] for x in found)
    fits, fit = [], models._fit
    monkeypatch.setattr(models, "_fit", lambda *args: fits.append(args[4]) or fit(*args))
    models.fit_weekly(rows, [2, 3, 4], "random_forest", grid)
    assert len(fits) == 7 * 3 + 1


def test_equal_fits_of_the_grid():
    choices = models.choices(models.GRIDS["random_forest"])
    assert len({models.same_fit("random_forest", c, 10) for c in choices}) == 20
    # The square root and the logarithm of 100 differ.
    assert len({models.same_fit("random_forest", c, 100) for c in choices}) == 32


def test_penalty_is_an_inverse_weight(prepared):
    """The penalised gradient vanishes at the solution."""
    rows = prepared.filter("feature_week = 3 AND NOT is_test").withColumn("model_week", F.col("feature_week"))
    stage = models.fit_weekly(rows, IDS, "logistic_regression", {"penalty": [10]})[3].stages[-1]
    weights, data = stage.coefficients.toArray(), rows.select("f2", "f3", "label").collect()
    for k, name in enumerate(("f2", "f3")):
        slope = sum((1 / (1 + math.exp(-(weights @ [r.f2, r.f3] + stage.intercept))) - r.label) * r[name]
                    for r in data)
        assert abs(slope + weights[k] / 10) < 0.05


def test_models_and_rows_are_stored(spark, prepared, tmp_path):
    fitted = models.fit_weekly(cohort.training_rows(prepared), IDS, "svm", {"penalty": [1]})
    models.save_models(fitted, str(tmp_path / "m"))
    models.save_prepared(prepared, str(tmp_path / "p"))
    again = models.load_models(spark, str(tmp_path / "m"))
    rows = models.open_prepared(spark, str(tmp_path / "p"))
    assert sorted(again) == [3, 4] and rows.count() == prepared.count()
    first = {(r.user_id, r.feature_week): r.score for r in models.transfer(fitted, prepared).collect()}
    assert first == {(r.user_id, r.feature_week): r.score for r in models.transfer(again, rows).collect()}


def test_stored_runs_do_not_mix(spark, prepared, tmp_path):
    folder = str(tmp_path / "m")
    with pytest.raises(LookupError):
        models.load_models(spark, folder)
    grid = {"impurity": ["gini"], "featureSubsetStrategy": ["all"]}
    fitted = models.fit_weekly(cohort.training_rows(prepared), IDS, "decision_tree", grid)
    models.save_models(fitted, folder, {"scaled": True})
    models.save_models({4: fitted[4]}, folder, {"scaled": False})
    assert sorted(models.load_models(spark, folder, IDS, {"scaled": False})) == [4]
    with pytest.raises(ValueError, match="f2"):
        models.load_models(spark, folder, [2, 6])
    with pytest.raises(ValueError, match="scaled"):
        models.load_models(spark, folder, about={"scaled": True})
    with pytest.raises(ValueError):
        models.save_models({}, folder)


@pytest.mark.parametrize("mode", ["week", "all", "cumulative"])
def test_prepared_rows_are_read_where_they_are(spark, prepared, monkeypatch, mode):
    """The same models as from a table of training rows, and nothing is written."""
    want = models.fit_weekly(cohort.training_rows(prepared, mode), IDS, "logistic_regression", {"penalty": [1, 100]})
    monkeypatch.setattr(models, "written", None)
    got = models.fit_prepared(prepared, IDS, "logistic_regression", {"penalty": [1, 100]}, mode)
    assert sorted(got) == sorted(want) == [3, 4]
    for week, model in got.items():
        one, other = model.stages[-1], want[week].stages[-1]
        assert one.coefficients.toArray() == pytest.approx(other.coefficients.toArray(), abs=1e-6)
    with pytest.raises(ValueError):
        models.fit_prepared(prepared, IDS, mode="none")


def test_no_table_is_left_behind(spark, prepared, tmp_path):
    before = set(os.listdir(shared_folder(spark)))
    models.fit_weekly(cohort.training_rows(prepared), IDS, "decision_tree", {"impurity": ["gini"]})
    assert set(os.listdir(shared_folder(spark))) == before


def test_training_on_all_rows_is_not_judged(prepared):
    with pytest.raises(ValueError, match="transfer"):
        models.train_and_score(prepared, IDS, mode="all")


def test_report(prepared):
    scores = models.train_and_score(prepared, IDS, "decision_tree", GRIDS["decision_tree"])
    weekly, total = report.report(scores, prepared.drop("label"), IDS)
    rows = {r.feature_week: r for r in weekly.collect()}
    assert {w: r.predicted_week for w, r in rows.items()} == {3: 4, 4: 5}
    assert all(r.c00 + r.c01 + r.c10 + r.c11 == r.test_users == r.correct + r.incorrect for r in rows.values())
    assert all(r.users == r.users_f2 == 300 for r in rows.values())
    assert total.first().test_users == scores.count() and total.first().mean_present == 2


def test_comparison(prepared):
    table = models.compare_models(prepared, IDS, ["logistic_regression", "decision_tree"], GRIDS)
    rows = table.collect()
    assert {(r.model, r.feature_week) for r in rows} == {
        (m, w) for m in ("logistic_regression", "decision_tree") for w in (3, 4)}
    totals = {r.model: r for r in models.model_totals(table).collect()}
    assert set(totals) == {r.model for r in rows}
    assert totals["decision_tree"].n == sum(r.n for r in rows if r.model == "decision_tree")


def test_one_class_week_is_left_out(spark):
    frame = cohort.with_split(spark.createDataFrame(
        [(f"u{i}", 0, 1.0, float(i), 0) for i in range(40)],
        "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE, label INT"))
    assert models.fit_weekly(cohort.training_rows(frame), IDS, "decision_tree") == {}


def test_registered_grids_are_whole(spark, monkeypatch):
    used = {}

    def noted(rows, features, model, grid):
        used[model] = grid
        return spark.createDataFrame(
            [], "user_id string, feature_week int, label int, score double, prediction double")

    monkeypatch.setattr(models, "prepare", lambda rows, *_, **settings: rows)
    monkeypatch.setattr(models, "train_and_score", noted)
    for model in models.GRIDS:
        entry.queries()[f"m12_{model}"](spark, "/root/testdata/sf0.001")
    assert used == models.GRIDS
