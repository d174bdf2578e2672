"""The catalogue, the stored tables and a whole run."""

import threading
import warnings
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from learnertrace.functions.weeks import by_week
from learnertrace.plans.catalog import CATALOG, feature_info, select
from learnertrace.plans.features import BASE, derive, features, needed, populate
from learnertrace.sources.course import Course, from_catalog, from_files
from learnertrace.sources.driver_tables import course as driver_course
from learnertrace.sources.schemas import ACTIVITY, OUTPUT
from learnertrace.sources.store import FeatureStore, shared_folder, written
from tests.conftest import at

FOLDER = "/root/testdata/sf0.001"


def test_catalogue(spark):
    assert len(CATALOG) == 50 and list(CATALOG) == sorted(CATALOG)
    assert feature_info(spark).count() == 50
    assert all(max(f.requires, default=0) < f.id for f in CATALOG.values())
    assert all(f.table in OUTPUT for f in CATALOG.values())


def test_selection():
    assert select(only=[9, 2, 999]) == [2, 9]
    assert select(only=[]) == []
    with pytest.warns(UserWarning, match="number_of_forum_posts"):
        chosen = select(skip=[3])
    assert 3 not in chosen and 103 in chosen and len(chosen) == 49
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert 3 not in select(skip=[3, 103, 105])
    assert needed([110]) == [2, 8, 10, 110]
    assert needed([706]) == [706]


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def rounded(frame):
    return {tuple(round(x, 6) if isinstance(x, float) else x for x in r)
            for r in frame.collect()}


def test_run_equals_the_plans(spark, tmp_path):
    """Staged through stored tables or as one plan: the same rows."""
    course = driver_course(spark, FOLDER)
    store = FeatureStore(spark, str(tmp_path))
    assert populate(course, store) == list(CATALOG)
    for table in ("user_long_feature", "user_feature", "video_feature", "user_video_feature"):
        stored, planned = store.read(table), features(course, table=table)
        assert rounded(stored) == rounded(planned) and stored.count() == planned.count()
    assert store.read("feature_info").count() == 50
    before = store.read("user_long_feature").count()
    populate(course, store, only=[2, 10], fresh=False)
    assert store.read("user_long_feature").count() == before
    later = Course(course.tables, course.start, course.weeks, "2024-03-01 00:00:00")
    populate(later, store, only=[2, 8, 10], fresh=False)
    second = store.read("user_long_feature", stamp=later.stamp)
    assert {r.feature_id for r in second.select("feature_id").distinct().collect()} == {2, 8, 10}
    assert store.read("user_long_feature").count() == before + second.count()


def test_selection_brings_in_what_it_needs(spark, tmp_path):
    course = driver_course(spark, FOLDER)
    store = FeatureStore(spark, str(tmp_path))
    assert populate(course, store, only=[10, 110, 712]) == [10, 110, 712]
    for table in ("user_long_feature", "user_feature"):
        planned = features(course, table=table, only=[10, 110, 712])
        assert rounded(store.read(table)) == rounded(planned) and planned.count()


def test_a_stage_is_written_at_the_same_time(spark, tmp_path, monkeypatch):
    """The parts of a stage do not wait for each other, and a table's are listed together."""
    running, most, lock, files = [0], [0], threading.Lock(), FeatureStore._files

    def counted(self, *args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            files(self, *args)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(FeatureStore, "_files", counted)
    store = FeatureStore(spark, str(tmp_path))
    populate(driver_course(spark, FOLDER), store, only=[2, 7, 9, 10, 14])
    assert most[0] > 1
    created, families, derived = 1, 1, 1
    assert store.manifest("user_long_feature").read()[0] == created + families + derived


def test_a_part_that_breaks_off_leaves_its_table(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(i, "u", 0, 1.0, at(0)) for i in (2, 3)], OUTPUT["user_long_feature"])
    store.append("user_long_feature", rows)
    broken = rows.withColumn("feature_value", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        store.append_all({"user_long_feature": [(rows.filter("feature_id = 9"), [2]), (broken, [3])]},
                         "2024-01-01 00:00:00")
    assert as_set(store.read("user_long_feature")) == as_set(rows)


def test_an_empty_rewrite_leaves_no_stale_rows(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(i, "u", 0, 1.0, at(0)) for i in (2, 3)], OUTPUT["user_long_feature"])
    store.append("user_long_feature", rows, [2, 3], "2024-01-01 00:00:00")
    store.append("user_long_feature", rows.filter("feature_id = 9"), [2], "2024-01-01 00:00:00")
    assert as_set(store.read("user_long_feature")) == as_set(rows.filter("feature_id = 3"))
    store.append("user_long_feature", rows.filter("feature_id = 9"), [3], "2024-02-01 00:00:00")
    assert store.read("user_long_feature").count() == 1


@pytest.mark.parametrize("start", ["2024-01-01 00:00:00", "2024-09-02 00:00:00"])
def test_a_course_ends_by_elapsed_weeks(spark, start):
    """Across a change of clocks the last week is whole, and no week follows it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        course = Course({}, start, 15, "2025-01-01 00:00:00")
        ticks = spark.range(15 * 7 * 24 * 2 + 96).select(F.timestamp_seconds(
            F.unix_timestamp(course.start_time) + (F.col("id") - 48) * 1800).alias("t"))
        weeks = by_week(course, ticks, "t").groupBy("feature_week").count().collect()
        assert {r.feature_week: r["count"] for r in weeks} == {w: 336 for w in range(15)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_files_of_other_types_are_cast(spark, tmp_path):
    frame = spark.createDataFrame([(1, 7, at(5), 2, 1, 9)], "observed_event_id INT, user_id LONG, "
                                  "observed_event_timestamp TIMESTAMP, observed_event_duration INT, "
                                  "validity LONG, url_id INT")
    frame.write.parquet(f"{tmp_path}/observed_events")
    course = from_files(spark, str(tmp_path), "2024-01-01 00:00:00", 5, "2024-02-01 00:00:00")
    assert course.observed_events.first().user_id == "7"
    assert course.observed_events.schema == spark.createDataFrame([], ACTIVITY["observed_events"]).schema


def test_the_test_course_uses_its_tables(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        course = driver_course(spark, folder)
        documents = spark.read.parquet(f"{folder}/documents.parquet")
        assert course.collaborations.select("collaboration_content").distinct().count() == documents.select(
            "text").distinct().count()
        parts = course.problems.count()
        reached = course.submissions.join(course.problems, "problem_id").select("problem_id").distinct().count()
        assert reached >= 0.9 * parts


def test_reading_one_feature_opens_only_its_files(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [(i, "u", 0, 1.0, at(0)) for i in (2, 3, 4)], OUTPUT["user_long_feature"])
    store.create("user_long_feature")
    assert store.read("user_long_feature").count() == 0
    store.append("user_long_feature", rows)
    store.append("user_long_feature", rows.filter("feature_id = 3"))
    assert as_set(store.read("user_long_feature")) == as_set(rows)
    plan = store.read("user_long_feature", [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "feature_id" in plan.split("PartitionFilters")[1]
    assert len(store.read("user_long_feature", [3]).inputFiles()) >= 1


def test_written_tables_go_to_the_shared_folder(spark):
    frame = spark.range(10).selectExpr("id % 2 AS half", "id")
    table = written(frame, "half")
    assert as_set(table) == as_set(frame) and table.columns == frame.columns
    assert all(shared_folder(spark) in f for f in table.inputFiles())


def test_the_shared_folder_is_never_local_on_a_cluster():
    def session(master, setting=None):
        context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context,
                               conf=SimpleNamespace(get=lambda name, default: setting))
    assert shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))


def test_course_from_files_and_catalogue(spark, tmp_path):
    source = driver_course(spark, FOLDER)
    for name in ACTIVITY:
        getattr(source, name).write.parquet(f"{tmp_path}/{name}")
    settings = (source.start, source.weeks, source.stamp)
    course = from_files(spark, str(tmp_path), *settings)
    wanted = rounded(features(source, only=[2, 6, 16]))
    assert rounded(features(course, only=[2, 6, 16])) == wanted
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    try:
        for name in ("observed_events", "submissions"):
            spark.sql(f"CREATE TABLE shelf.{name} USING parquet LOCATION '{tmp_path}/{name}'")
        listed = from_catalog(spark, "shelf", *settings, names=["observed_events", "submissions"])
        assert rounded(features(listed, only=[2])) == {r for r in wanted if r[0] == 2}
        with pytest.raises(LookupError):
            listed.urls
    finally:
        spark.sql("DROP DATABASE shelf CASCADE")


def test_unknown_tables_and_derivations(spark, make_course):
    with pytest.raises(ValueError):
        Course({"other": spark.range(1)}, "2024-01-01 00:00:00", 5, "2024-02-01 00:00:00")
    with pytest.raises(ValueError):
        Course({}, "2024-01-01 00:00:00", 0, "2024-02-01 00:00:00")
    derived = set(CATALOG) - BASE
    empty = spark.createDataFrame([], OUTPUT["user_long_feature"])
    pairs = spark.createDataFrame([], OUTPUT["user_video_feature"])
    for number in derived:
        inputs = pairs if CATALOG[number].requires[0] > 700 else empty
        assert derive(make_course(), inputs, [number]).count() == 0
