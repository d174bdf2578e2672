"""Cohort frames and evaluation on small tables."""

import random

import pytest

from learnertrace.operators import cohort, evaluation
from learnertrace.sources.schemas import OUTPUT
from tests.conftest import at

IDS = [2, 3]


def long(spark, *cells):
    return spark.createDataFrame([(*c, at(0)) for c in cells], OUTPUT["user_long_feature"])


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.fixture
def features(spark):
    return long(
        spark, (1, "u", 0, 1.0), (1, "u", 1, 0.0), (1, "v", 0, 1.0), (1, "v", 1, 1.0),
        (2, "u", 0, 5.0), (3, "u", 0, 0.0), (2, "v", 0, 7.0), (2, "u", 9, 1.0), (3, "v", 1, None))


def test_histogram(features):
    assert dict(cohort.dropout_histogram(features).collect()) == {0: 0, 1: 1, 2: 1}
    counts = dict(cohort.dropout_histogram(features, last_week=15).collect())
    assert len(counts) == 16 and counts[1] == 1 and counts[15] == 1 and sum(counts.values()) == 2
    assert dict(cohort.dropout_histogram(features, last_week=1).collect()) == {0: 0, 1: 2}


def test_every_learner_of_a_long_course_is_in_a_bin(spark):
    rows = long(spark, *[(1, u, w, float(w < end)) for u, end in (("u", 3), ("v", 17), ("w", 99))
                         for w in range(20)])
    counts = dict(cohort.dropout_histogram(rows).collect())
    assert len(counts) == 21 and {w for w, n in counts.items() if n} == {3, 17, 20}


def test_labels_apart_from_features(features):
    apart = features.filter("feature_id <> 1")
    labels = features.filter("feature_id = 1")
    assert as_set(cohort.wide_features(apart, IDS, labels=labels)) == as_set(cohort.wide_features(features, IDS))
    assert as_set(cohort.wide_features(features, IDS, labels=labels)) == as_set(
        cohort.wide_features(features, IDS))
    assert as_set(cohort.overall_coverage(cohort.wide_features(features, IDS), IDS)) == {(2, 2), (3, 1)}


def test_wide(features):
    assert as_set(cohort.wide_features(features, IDS)) == {
        ("u", 0, 5, 0), ("u", 1, -1, -1), ("v", 0, 7, -1), ("v", 1, -1, -1)}
    assert as_set(cohort.wide_features(features, IDS, fill=0.0, dense=False)) == {
        ("u", 0, 5, 0), ("v", 0, 7, 0), ("u", 9, 1, 0), ("v", 1, 0, 0)}
    assert as_set(cohort.wide_features(features, IDS, fill=0.0, drop_all_zero=True)) == {
        ("u", 0, 5, 0), ("v", 0, 7, 0)}


def test_summaries(features):
    wide = cohort.wide_features(features, IDS)
    zeros = cohort.wide_features(features, IDS, fill=0.0)
    assert (0, 3, 1) in as_set(cohort.feature_coverage(features, IDS))
    assert (0, 2, 2) in as_set(cohort.supported_coverage(wide, IDS))
    assert (1, 2, 0) in as_set(cohort.supported_coverage(wide, IDS))
    assert as_set(cohort.feature_count_distribution(zeros, IDS)) == {
        (0, 0, 0), (0, 1, 2), (0, 2, 0), (1, 0, 2), (1, 1, 0), (1, 2, 0)}
    assert (0, 2, 1) in as_set(cohort.feature_count_distribution(wide, IDS, missing=-1.0))
    assert as_set(cohort.class_balance(features)) == {(0, 0, 2), (1, 1, 1)}
    assert as_set(cohort.mean_features_by_class(features, IDS)) == {
        (0, 1, 1.0), (1, 0, 0.0), (1, 1, 0.0)}
    assert as_set(cohort.feature_cardinality(wide, IDS)) == {(0, 1.5), (1, 0.0)}
    assert cohort.overall_cardinality(wide, IDS).first()[0] == 0.75
    assert as_set(cohort.any_present(wide, [3])) == {(0, 1), (1, 0)}
    assert as_set(cohort.with_support(wide, IDS, min_support=1)) == {("u", 0, 5, 0)}


def test_later_runs_only(features):
    assert cohort.extracted_after(features, "2023-12-31 23:59:59").count() == features.count()
    assert cohort.extracted_after(features, "2024-01-01 00:00:00").count() == 0


def test_future_label(features):
    wide = cohort.wide_features(features, IDS)
    rows = cohort.with_future_label(wide, features).select("user_id", "feature_week", "label")
    assert as_set(rows) == {("u", 0, 0), ("v", 0, 1)}
    assert cohort.with_future_label(wide, features, weeks_ahead=2).count() == 0
    assert cohort.with_future_label(wide, features, last_week=-1).count() == 0


def test_scaling(spark):
    wide = spark.createDataFrame(
        [("a", 0, 2.0, 5.0), ("b", 0, 4.0, 5.0), ("c", 0, -1.0, 5.0), ("a", 1, 9.0, 1.0)],
        "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE")
    assert as_set(cohort.scale_min_max(wide, IDS)) == {
        ("a", 0, 0.6, 0), ("b", 0, 1, 0), ("c", 0, 0, 0), ("a", 1, 0, 0)}


def test_week_guards(spark):
    rows = ([(f"u{i}", 0, 1.0, 1.0, i % 2) for i in range(24)]
            + [(f"u{i}", 1, 1.0, 1.0, i % 2) for i in range(25)]
            + [(f"u{i}", 2, 1.0, 1.0, 1) for i in range(30)]
            + [(f"u{i}", 3, 1.0, 1.0, 0) for i in range(30)])
    frame = spark.createDataFrame(
        rows, "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE, label INT")
    assert as_set(cohort.valid_weeks(frame)) == {(1, 25), (3, 30)}
    assert cohort.in_valid_weeks(frame).count() == 55
    assert as_set(cohort.scaled_valid_weeks(frame, IDS)) == as_set(
        cohort.scale_min_max(cohort.in_valid_weeks(frame), IDS))


def test_split_and_training_rows(spark):
    frame = spark.createDataFrame(
        [(f"u{i}", w, 1.0, 1.0, i % 2) for i in range(2000) for w in range(3)],
        "user_id STRING, feature_week INT, f2 DOUBLE, f3 DOUBLE, label INT")
    split = cohort.with_split(frame)
    assert split.filter("is_test").count() == pytest.approx(1500, abs=120)
    assert as_set(split) == as_set(cohort.with_split(frame.repartition(7)))
    assert as_set(split) != as_set(cohort.with_split(frame, seed=20))
    kept = split.filter("NOT is_test").count()
    assert cohort.training_rows(split, "week").count() == kept
    assert cohort.training_rows(split, "all").count() == 6000
    cumulative = cohort.training_rows(split, "cumulative")
    assert set(cumulative.columns) == set(split.columns) | {"model_week"}
    assert cumulative.count() == kept + 2000 + 4000
    assert cumulative.filter("model_week = feature_week AND is_test").count() == 0
    with pytest.raises(ValueError):
        cohort.training_rows(split, "other")


def scores(spark, rows):
    return spark.createDataFrame(
        [(f"u{i}", w, label, s, int(s > 0.5)) for i, (w, label, s) in enumerate(rows)],
        "user_id STRING, feature_week INT, label INT, score DOUBLE, prediction INT")


def test_accuracy_and_confusion(spark):
    frame = scores(spark, [(0, 1, 0.9), (0, 0, 0.1), (0, 0, 0.8), (1, 1, 0.2)])
    assert {(w, n, round(a, 6)) for w, n, a in evaluation.accuracy(frame).collect()} == {
        (0, 3, 0.666667), (1, 1, 0)}
    assert evaluation.overall_accuracy(frame).first()["accuracy"] == 0.5
    assert as_set(evaluation.confusion(frame)) == {
        (0, 0, 0, 1), (0, 0, 1, 1), (0, 1, 0, 0), (0, 1, 1, 1),
        (1, 0, 0, 0), (1, 0, 1, 0), (1, 1, 0, 1), (1, 1, 1, 0)}


def test_roc_merges_ties_and_auc_counts_pairs(spark):
    frame = scores(spark, [(0, 1, 0.9), (0, 1, 0.5), (0, 0, 0.5), (0, 0, 0.1), (1, 1, 0.3)])
    assert as_set(evaluation.roc(frame)) == {
        (0, 0.9, 0, 0.5), (0, 0.5, 0.5, 1), (0, 0.1, 1, 1), (1, 0.3, None, 1)}
    weekly = evaluation.auc(frame)
    assert as_set(weekly) == {(0, 0.875), (1, -1)}
    assert evaluation.mean_auc(weekly).first()[0] == 0.875


def test_auc_equals_the_rank_sum(spark):
    rng = random.Random(4)
    rows = [(w, rng.randint(0, 1), rng.choice([rng.random(), 0.5, 0.25]))
            for w in range(3) for _ in range(400)]
    got = dict(evaluation.auc(scores(spark, rows)).collect())
    for week in range(3):
        ones = [s for w, label, s in rows if w == week and label == 1]
        zeros = [s for w, label, s in rows if w == week and label == 0]
        pairs = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
        assert got[week] == pytest.approx(pairs / len(ones) / len(zeros))
