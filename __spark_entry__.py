"""What the driver runs: a flagship query, all queries, and their DuckDB twins."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from learnertrace.operators import (  # noqa: E402
    certificates,
    cohort,
    evaluation,
    models,
    observed,
    report,
    submissions,
    video,
)
from learnertrace.operators.dropout import user_dropout  # noqa: E402
from learnertrace.plans.catalog import CATALOG  # noqa: E402
from learnertrace.plans.features import feature, features, populate, stored_states  # noqa: E402
from learnertrace.plans.increments import StateStore  # noqa: E402
from learnertrace.sources.bucketed import open_by_learner, save_by_learner  # noqa: E402
from learnertrace.sources.course import from_files  # noqa: E402
from learnertrace.sources.driver_tables import WEEKS, course  # noqa: E402
from learnertrace.sources.store import FeatureStore, dropped, shared_folder, written  # noqa: E402

try:
    import corpus_pipeline
    from learnertrace.llm import queries as training_data
except ModuleNotFoundError as missing:
    # Without the operators of training data, the others still work.
    if (missing.name or "").split(".")[:2] not in (["corpus_pipeline"], ["learnertrace", "llm"]):
        raise
    corpus_pipeline = training_data = None

Query = Callable[[SparkSession, str], DataFrame]
IDS = models.MODEL_FEATURES
LONG, LATER = 20, "2024-03-01 00:00:00"


def entry(spark: SparkSession) -> DataFrame:
    """Submissions per learner and week."""
    return queries()["f007_number_of_attempts"](spark, "/root/testdata/sf0.001")


def comparable(frame: DataFrame) -> DataFrame:
    """Round fractions to six places, without negative zero; write times as text."""
    columns = []
    for name, kind in frame.dtypes:
        column = F.col(name)
        if kind == "double":
            column = F.round(column, 6) + F.lit(0.0)
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(name))
    return frame.select(*columns)


def queries() -> dict[str, Query]:
    """One query per operator, by its number in the survey."""
    found: dict[str, Query] = {}

    def add(name: str, build: Callable[..., DataFrame], weeks: int = WEEKS) -> None:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables' own
            return comparable(build(course(spark, folder, weeks)))
        found[name] = run

    def with_dropout(name: str, build: Callable[..., DataFrame]) -> None:
        add(name, lambda c: build(c, user_dropout(c)))

    add("p01_user_dropout", user_dropout)
    for number, about in CATALOG.items():
        with_dropout(f"f{number:03d}_{about.name}",
                     lambda c, d, number=number: feature(c, d, number))
    with_dropout("f012t_solving_time", submissions.solving_time)
    with_dropout("f206l_lab_grade_per_lab_problem",
                 lambda c, d: submissions.grades(c, d, [206], submissions.LAB))
    with_dropout("f302d_time_to_react_days", lambda c, d: observed.reaction_time(c, d, "days"))
    with_dropout("f702s_session_engagement", video.session_engagement)
    with_dropout("f706f_rewatched_share_per_video",
                 lambda c, d: video.video_features(c, d, [706], at_least_once=True))
    with_dropout("f707f_rewatched_share_per_user",
                 lambda c, d: video.user_features(c, d, [707], at_least_once=True))

    add("s01_partitioned_files", _by_day)
    add("s03_stored_features", _stored)
    add("s07_extracted_after", lambda c: cohort.extracted_after(
        features(c, only=[2, 15]).unionByName(features(replace(c, stamp=LATER), only=[3, 4, 5, 14, 201])),
        "2024-02-15 00:00:00"))
    add("s10_populate", _populated)
    add("s11_incremental", _incremental)
    add("t01_user_long_feature", lambda c: features(c, known_states=stored_states(c)))
    add("t01p_one_plan", features)
    for name, table in [("t02", "user_feature"), ("t03", "video_feature"), ("t04", "user_video_feature")]:
        add(f"{name}_{table}", lambda c, table=table: features(c, table=table))

    def weekly(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
        add(name, lambda c: build(features(c, only=(1, *IDS))))

    def cohorts(name: str, build: Callable[[DataFrame, DataFrame], DataFrame],
                weeks: int = WEEKS) -> None:
        """Queries that also need the label of a later week."""
        def run(c) -> DataFrame:
            dropout = user_dropout(c)
            return build(features(c, dropout, only=(1, *IDS)), features(c, dropout, only=[1]))
        add(name, run, weeks)

    def supported(rows: DataFrame) -> DataFrame:
        return cohort.with_support(cohort.wide_features(rows, IDS), IDS)

    def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
        return cohort.with_future_label(supported(rows), labels)

    def prepared(rows: DataFrame, labels: DataFrame, **settings) -> DataFrame:
        return models.prepare(rows, IDS, labels, **settings)

    def rule_scores(rows: DataFrame, labels: DataFrame, one: str = "f6", two: str = "f7") -> DataFrame:
        """A score that is a rule instead of a fitted model."""
        return cohort.scaled_valid_weeks(labelled(rows, labels), IDS).selectExpr(
            "user_id", "feature_week", "label", f"({one} + {two}) / 2 AS score",
            f"CASE WHEN ({one} + {two}) / 2 > 0.5 THEN 1 ELSE 0 END AS prediction")

    def judged(name: str, measure: Callable[[DataFrame], DataFrame]) -> None:
        cohorts(name, lambda rows, labels: measure(rule_scores(rows, labels)))

    weekly("m01_dropout_histogram", cohort.dropout_histogram)
    weekly("m02_wide_features", lambda rows: cohort.wide_features(rows, IDS))
    weekly("m02z_wide_features_zero_fill",
           lambda rows: cohort.wide_features(rows, IDS, fill=0.0, drop_all_zero=True))
    weekly("m03_feature_coverage", lambda rows: cohort.feature_coverage(rows, IDS))
    weekly("m03o_overall_coverage", lambda rows: cohort.overall_coverage(supported(rows), IDS))
    weekly("m03s_supported_coverage", lambda rows: cohort.supported_coverage(supported(rows), IDS))
    weekly("m04_feature_count_distribution", lambda rows: cohort.feature_count_distribution(
        cohort.wide_features(rows, IDS, fill=0.0), IDS))
    add("m05_class_balance", lambda c: cohort.class_balance(features(c, only=[1])))
    weekly("m06_mean_features_by_class", lambda rows: cohort.mean_features_by_class(rows, IDS))
    weekly("m07_with_support", supported)
    cohorts("m08_with_future_label", labelled)
    cohorts("m09_scale_min_max", lambda rows, labels: cohort.scale_min_max(
        cohort.in_valid_weeks(labelled(rows, labels)), IDS))
    cohorts("m10_valid_weeks", lambda rows, labels: cohort.valid_weeks(labelled(rows, labels)))
    cohorts("m11_with_split", lambda rows, labels: cohort.with_split(labelled(rows, labels)).select(
        "user_id", "feature_week", "label", "is_test"))
    for name, mode in [("m13_training_rows_week", "week"), ("m13a_training_rows_all", "all"),
                       ("m13c_training_rows_cumulative", "cumulative")]:
        cohorts(name, lambda rows, labels, mode=mode: cohort.training_rows(
            prepared(rows, labels), mode).select(
                "model_week", "feature_week", "user_id", "label"))
    judged("m14_accuracy", evaluation.accuracy)
    judged("m14o_overall_accuracy", evaluation.overall_accuracy)
    judged("m15_confusion", evaluation.confusion)
    judged("m16_roc", evaluation.roc)
    judged("m17_auc", evaluation.auc)
    judged("m17m_mean_auc", lambda scores: evaluation.mean_auc(evaluation.auc(scores)))
    weekly("m18_feature_cardinality",
           lambda rows: cohort.feature_cardinality(supported(rows), IDS))
    weekly("m18o_overall_cardinality",
           lambda rows: cohort.overall_cardinality(supported(rows), IDS))
    weekly("m19_any_present", lambda rows: cohort.any_present(supported(rows), [208, 209, 210]))

    def determined(scores: DataFrame) -> DataFrame:
        """What of fitted scores does not hang on the fit: which rows have one, and its range."""
        return scores.selectExpr("user_id", "feature_week", "label", "score BETWEEN 0 AND 1 AS in_range",
                                 "prediction IN (0, 1) AS is_class")

    def reopened(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Prepared wide rows, stored and opened again."""
        path = f"{shared_folder(rows.sparkSession)}/prepared-{os.urandom(8).hex()}"
        models.save_prepared(prepared(rows, labels), path)
        return models.open_prepared(rows.sparkSession, path).select(
            "user_id", "feature_week", "label", "is_test", *cohort.names(IDS))

    def by_learner(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Wide rows and labels stored by learner, opened again and joined where they lie."""
        spark, root = rows.sparkSession, f"{shared_folder(rows.sparkSession)}/learners-{os.urandom(8).hex()}"
        save_by_learner(supported(rows), f"{root}/wide", 8)
        save_by_learner(labels.selectExpr("user_id", "feature_week", "CAST(feature_value AS INT) AS label"),
                        f"{root}/labels", 8)
        return cohort.with_future_label_by_learner(
            open_by_learner(spark, f"{root}/wide"), open_by_learner(spark, f"{root}/labels"))

    cohorts("s08_reopened_frame", reopened)
    cohorts("s08_by_learner", by_learner)
    for model, grid in models.GRIDS.items():
        cohorts(f"m12_{model}", lambda rows, labels, model=model, grid=grid: determined(
            models.train_and_score(prepared(rows, labels), IDS, model, grid)))
    cohorts("m13f_cumulative_model", lambda rows, labels: determined(models.train_and_score(
        prepared(rows, labels), IDS, "logistic_regression", mode="cumulative")))

    def certified(model: str, grid: dict, mode: str = "week") -> Callable[[DataFrame, DataFrame], DataFrame]:
        """How far the chosen model of each week is from the optimum."""
        def measure(rows: DataFrame, labels: DataFrame) -> DataFrame:
            used: list[str] = []
            table = written(prepared(rows, labels), "feature_week", used=used)
            fitted = models.fit_prepared(table, IDS, model, grid, mode)
            found = certificates.residuals(fitted, cohort.training_rows(table, mode))
            dropped(rows.sparkSession, *used)
            return found.select("feature_week", F.round("residual", 2).alias("residual"))
        return measure

    for model in ("logistic_regression", "svm"):
        cohorts(f"m12c_{model}", certified(model, models.GRIDS[model]))
    # A first split that looks at some features only need not be the best.
    cohorts("m12c_decision_tree", certified(
        "decision_tree", models.GRIDS["decision_tree"] | {"featureSubsetStrategy": ["all"]}))
    cohorts("m13fc_cumulative_model", certified(
        "logistic_regression", models.GRIDS["logistic_regression"], "cumulative"))

    def transferred(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Models of the learners with even numbers, stored and read back, for the odd ones."""
        def half(frame: DataFrame, odd: int) -> DataFrame:
            return frame.filter(F.col("user_id").cast("long") % 2 == odd)

        even, odd = (prepared(half(rows, k), half(labels, k), min_users=10) for k in (0, 1))
        spark = rows.sparkSession
        folder, about = f"{shared_folder(spark)}/models-{os.urandom(8).hex()}", {"scaled": True}
        fitted = models.fit_weekly(cohort.training_rows(even, "all"), IDS, "logistic_regression")
        # Two stored runs, the first of which lacks a week; the second counts.
        models.save_models(dict(list(fitted.items())[:1]), folder, about)
        models.save_models(fitted, folder, about)
        return determined(models.transfer(models.load_models(spark, folder, IDS, about), odd))

    cohorts("m20_transfer", transferred)
    cohorts("m21_ensemble", lambda rows, labels: models.ensemble(
        rule_scores(rows, labels), rule_scores(rows, labels, "f2", "f15")))
    cohorts("m22_compare_models", lambda rows, labels: models.compare_models(
        prepared(rows, labels), IDS, ["logistic_regression", "decision_tree"]).selectExpr(
            "model", "feature_week", "n", "accuracy BETWEEN 0 AND 1 AS is_share",
            "auc = -1 OR auc BETWEEN 0 AND 1 AS is_auc"))

    def reported(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        return report.report(rule_scores(rows, labels), supported(rows), IDS)

    cohorts("s09_report_weekly", lambda rows, labels: reported(rows, labels)[0])
    cohorts("s09_report_total", lambda rows, labels: reported(rows, labels)[1])

    # The same activity drawn out to 20 weeks: no week may be left out.
    def long_feature(number: int) -> None:
        add(f"f{number:03d}l_20_weeks", lambda c: feature(c, user_dropout(c), number), LONG)

    long_feature(205)
    long_feature(207)
    cohorts("m01l_20_weeks", lambda rows, labels: cohort.dropout_histogram(rows), LONG)
    cohorts("m08l_20_weeks", labelled, LONG)
    cohorts("m13cl_20_weeks", lambda rows, labels: cohort.training_rows(
        prepared(rows, labels), "cumulative").select(
            "model_week", "feature_week", "user_id", "label"), LONG)
    if training_data:
        found.update(training_data.QUERIES)
        found["pipeline"] = corpus_pipeline.run
    return found


def _by_day(c) -> DataFrame:
    """Features from activity that is stored in folders by date."""
    spark = c.observed_events.sparkSession
    root = f"{shared_folder(spark)}/days-{os.urandom(8).hex()}"
    for name, moment in (("observed_events", "observed_event_timestamp"), ("submissions", "submission_timestamp")):
        rows = getattr(c, name).withColumn("day", F.to_date(moment))
        rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{root}/{name}")
    days = from_files(spark, root, c.start, c.weeks, c.stamp, day="day")
    return features(days, only=[2, 6, 7, 13, 15])


def _stored(c) -> DataFrame:
    """Features 2 and 15 written twice for the same run, and read back."""
    spark = c.observed_events.sparkSession
    store = FeatureStore(spark, f"{shared_folder(spark)}/stored-{os.urandom(8).hex()}")
    store.create("user_long_feature")
    for _ in range(2):
        store.append("user_long_feature", features(c, only=[2, 15]))
    return store.read("user_long_feature", [2, 15], c.stamp)


def _populated(c) -> DataFrame:
    """A whole run into an empty store, and its weekly features read back."""
    spark = c.observed_events.sparkSession
    store = FeatureStore(spark, f"{shared_folder(spark)}/run-{os.urandom(8).hex()}")
    populate(c, store)
    return store.read("user_long_feature", stamp=c.stamp)


def _incremental(c) -> DataFrame:
    """Four weeks taken in, then the fifth, which alone is read for that."""
    spark = c.observed_events.sparkSession
    store = StateStore(spark, f"{shared_folder(spark)}/states-{os.urandom(8).hex()}")
    store.add(c, until="2024-01-29 00:00:00")
    store.add(c)
    return store.features(c)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express."""
    bodies = {f"f{number:03d}_{about.name}": oracle_queries.feature_select(number)
              for number, about in CATALOG.items()}
    bodies.update(oracle_queries.FINAL_SQL)
    found = {name: oracle_queries.with_views(body) for name, body in bodies.items()}
    found.update({name: oracle_queries.drawn_out(oracle_queries.with_views(body))
                  for name, body in oracle_queries.LONG_SQL.items()})
    if training_data:
        found.update(training_data.SQL)
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
