"""Lists of files that replace each other at once, and weeks that are taken in one after the other."""

import re

import pytest
from pyspark.sql import functions as F

from learnertrace.operators import states
from learnertrace.plans.features import features
from learnertrace.plans.increments import StateStore
from learnertrace.sources.driver_tables import course as driver_course
from learnertrace.sources.manifest import END, Manifest, hadoop_path
from learnertrace.sources.schemas import ACTIVITY, OUTPUT
from learnertrace.sources.store import FeatureStore
from tests.conftest import at
from tests.test_states import odd_course, rounded  # noqa: F401

RUN = "2024-01-01 00:00:00"


def rows(spark, *cells):
    return spark.createDataFrame([(i, "u", 0, float(v), at(0)) for i, v in cells], OUTPUT["user_long_feature"])


def held(frame):
    return sorted((r.feature_id, r.feature_value) for r in frame.collect())


def broken(frame):
    """Rows whose last task fails."""
    return frame.unionByName(frame.withColumn("feature_value", F.raise_error(F.lit("lost")).cast("double")))


def test_a_broken_write_changes_nothing(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.append("user_long_feature", rows(spark, (2, 1), (3, 1)), [2, 3], RUN)
    before = store.read("user_long_feature")
    for write in (lambda: store.append("user_long_feature", broken(rows(spark, (2, 9))), [2], RUN),
                  lambda: store.replace("user_long_feature", broken(rows(spark, (7, 9))))):
        with pytest.raises(Exception, match="lost"):
            write()
        assert held(store.read("user_long_feature")) == held(before) == [(2, 1), (3, 1)]
    store.append("user_long_feature", rows(spark, (2, 5)), [2, 3], RUN)
    assert held(store.read("user_long_feature")) == [(2, 5)]
    # A reader that began before still sees its own state.
    assert held(before) == [(2, 1), (3, 1)]
    store.manifest("user_long_feature").clean()
    assert held(store.read("user_long_feature")) == [(2, 5)]
    store.create("user_long_feature")
    assert store.read("user_long_feature").count() == 0


def test_reads_open_the_files_of_what_they_want(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.append("user_long_feature", rows(spark, (2, 1), (3, 1), (4, 1)))
    assert all("feature=3/" in f for f in store.read("user_long_feature", [3]).inputFiles())
    assert store.read("user_long_feature", [3], "2030-01-01 00:00:00").count() == 0
    assert held(store.read("user_long_feature", [3, 4], RUN)) == [(3, 1), (4, 1)]


def test_lists(spark, tmp_path):
    one, two = Manifest(spark, str(tmp_path / "t")), Manifest(spark, str(tmp_path / "t"))
    assert one.read() == (0, {})
    assert one.commit({"a": "x"}, 0) == 1 and two.read() == (1, {"a": "x"})
    two.commit({"a": "y"}, 1)
    with pytest.raises(RuntimeError):  # it knows the state before only
        one.commit({"a": "z"}, 1)
    # A list that its writer did not finish does not count, and the next one goes past it.
    (tmp_path / "t" / "list-00000003.json").write_text('{"a": "half')
    assert one.read() == (2, {"a": "y"})
    assert one.commit({"a": "w"}, 2) == 4 and two.read() == (4, {"a": "w"})
    assert (tmp_path / "t" / "list-00000004.json").read_text().endswith(END)
    files, where = hadoop_path(spark, str(tmp_path / "t" / "data-1"))
    files.mkdirs(where)
    one.clean()
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["list-00000004.json"]


def test_weeks_one_after_the_other(spark, odd_course, tmp_path):  # noqa: F811
    store = StateStore(spark, str(tmp_path))
    for until in ("2024-01-08 00:00:00", "2024-01-10 12:00:00", "2024-01-22 00:00:00", None):
        store.add(odd_course, until)
    assert rounded(store.features(odd_course)) == rounded(features(odd_course))
    assert store.ranges()[0] == (None, "2024-01-08 00:00:00") and store.ranges()[-1][1] is None
    with pytest.raises(ValueError):
        store.add(odd_course, "2024-02-01 00:00:00")


def test_ranges_do_not_overlap(spark, make_course, tmp_path):
    store = StateStore(spark, str(tmp_path))
    course = make_course()
    store.add(course, "2024-01-08 00:00:00")
    with pytest.raises(ValueError):
        store.add(course, "2024-01-08 00:00:00")
    assert len(store.ranges()) == 1


def test_states_of_another_form_are_not_mixed_in(spark, make_course, tmp_path):
    store, course = StateStore(spark, str(tmp_path)), make_course()
    store.manifest.commit({"parts": [{"range": [None, "2024-01-08 00:00:00"], "folder": "data-old", "kinds": ["events"]}]}, 0)
    for use in (lambda: store.add(course), lambda: store.features(course)):
        with pytest.raises(ValueError, match="earlier form"):
            use()


def test_only_the_new_week_is_scanned(spark, tmp_path):
    from learnertrace.sources.course import from_files
    source = driver_course(spark, "/root/testdata/sf0.001")
    for name in ACTIVITY:
        getattr(source, name).write.parquet(f"{tmp_path}/{name}")
    course = from_files(spark, str(tmp_path), source.start, source.weeks, source.stamp)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        week = states.states(course, "2024-01-29 00:00:00", "2024-02-05 00:00:00")
        for kind, column in (("events", "observed_event_timestamp"), ("submissions", "submission_timestamp"),
                             ("contributions", "collaboration_timestamp")):
            plan = week.tables()[kind]._jdf.queryExecution().executedPlan().toString()
            scan = next(line for line in plan.splitlines() if "FileScan" in line and column in line)
            pushed = scan[scan.index("PushedFilters"):]
            assert re.search(rf"GreaterThanOrEqual\({column},", pushed) and re.search(rf"LessThan\({column},", pushed)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
