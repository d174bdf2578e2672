"""What Spark does with the plans: the shapes that have to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from learnertrace.operators import cohort, observed, video
from learnertrace.operators.dropout import user_dropout
from learnertrace.plans.catalog import CATALOG
from learnertrace.plans.features import FAMILIES, feature, features
from learnertrace.sources.bucketed import open_by_learner, save_by_learner
from learnertrace.sources.course import from_files
from learnertrace.sources.driver_tables import course as driver_course
from learnertrace.sources.schemas import ACTIVITY

FOLDER = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_lines(spark):
    """Print filters in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def course(spark, tmp_path_factory):
    """The test course as plain parquet tables with the declared types."""
    root = str(tmp_path_factory.mktemp("course"))
    source = driver_course(spark, FOLDER)
    for name in ACTIVITY:
        getattr(source, name).write.parquet(f"{root}/{name}")
    return from_files(spark, root, source.start, source.weeks, source.stamp)


@pytest.fixture
def no_small_tables(spark):
    """Plan as if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("number", sorted(CATALOG))
def test_stays_in_the_engine(course, number):
    plan = physical(feature(course, user_dropout(course), number))
    assert not re.search("Python|CartesianProduct|NestedLoop|CollectLimit", plan)


def test_cohorts_stay_in_the_engine(spark):
    for name, query in entry.queries().items():
        if re.match("m09|m13c|m17_", name):
            plan = physical(query(spark, FOLDER))
            assert not re.search("Python|CartesianProduct|NestedLoop", plan), name


def test_the_course_range_reaches_the_scan(course):
    plan = physical(observed.time_spent(course, user_dropout(course), [2]))
    scan = next(line for line in plan.splitlines() if "observed_event_duration" in line
                and "FileScan" in line)
    assert "GreaterThanOrEqual(observed_event_timestamp" in scan
    assert "LessThan(observed_event_timestamp" in scan and "EqualTo(validity,1)" in scan
    assert "url_id" not in scan and "observed_event_id" not in scan


def test_activity_is_combined_before_it_is_shuffled(course, no_small_tables):
    """Beyond the broadcast limit the learners are joined to the weekly sums, not to events."""
    for number in (2, 3, 7, 15):
        plan = physical(feature(course, user_dropout(course), number))
        first = plan.index("Exchange hashpartitioning(user_id")
        join = plan.index("Join")
        assert join < first and "LeftSemi" in plan
        assert re.search(r"Exchange hashpartitioning\(user_id#\d+, (feature_week|_grouping)", plan)


@pytest.mark.parametrize("number, key", [(16, "url_id"), (302, "url_id"), (204, "problem_id"),
                                         (210, "problem_id")])
def test_activity_is_combined_before_it_meets_urls_and_problems(course, no_small_tables, number, key):
    """What is shuffled to the join is already summed per learner and url or problem."""
    lines = physical(feature(course, user_dropout(course), number)).splitlines()
    dealt = [k for k, line in enumerate(lines) if re.search(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)", line)]
    table = "observed_events" if key == "url_id" else "submissions"
    below = [lines[k:next(j for j in range(k, len(lines)) if "FileScan" in lines[j]) + 1] for k in dealt]
    own = [part for part in below if f"/{table}]" in part[-1] or f"{table}" in part[-1]]
    assert own and all(any("partial_" in line for line in part) for part in own)


def test_no_hint_without_a_bound(course, no_small_tables):
    """With automatic broadcasts off, just the bounded tables are still broadcast."""
    bounded = {16: 1, 17: 1, 18: 1, 202: 2, 203: 1, 204: 1, 205: 1, 206: 1, 207: 1}
    for number in CATALOG:
        plan = physical(feature(course, user_dropout(course), number))
        assert plan.count("BroadcastExchange") <= bounded.get(number, 0) * 2, number


def test_families_have_tasks_of_their_own(course, no_small_tables):
    """A task of a union may hold the parts of all its members, so none of these sorts for a join there."""
    plan = features(course)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")
    members = re.findall(r"^[:+]- (\w+)", plan, re.M)
    assert members.count("RebalancePartitions") == len(FAMILIES)


def test_clicks_are_windowed_by_time_slot(course):
    plan = physical(feature(course, user_dropout(course), 701))
    clicks = [line for line in plan.splitlines() if "Window" in line and "event_id" in line]
    assert clicks and all("slot" in line for line in clicks)


def test_both_ways_of_watching_share_their_windows(course):
    """Three windows cut the clicks into pieces, one links these, three chain them, for 701 and 702 at once."""
    plan = physical(video.pairs(course))
    assert len(re.findall(r"[+:]- (?:\*\(\d+\) )?Window \[", plan)) <= 7


def test_attempts_are_windowed_after_two_aggregates(course):
    plan = physical(feature(course, user_dropout(course), 9))
    below = plan[plan.index("Window"):]
    assert below.count("partial_") >= 2


def test_tables_by_learner_join_where_they_lie(spark, no_small_tables, tmp_path):
    wide = spark.createDataFrame([(f"u{k % 40}", k // 40, float(k)) for k in range(200)],
                                 "user_id STRING, feature_week INT, f2 DOUBLE")
    labels = wide.selectExpr("user_id", "feature_week", "CAST(f2 % 2 AS INT) AS label")
    for rows, name in ((wide, "wide"), (labels, "labels")):
        for _ in range(2):  # a second version replaces the first
            save_by_learner(rows, f"{tmp_path}/{name}", 4)
    got = cohort.with_future_label_by_learner(*[open_by_learner(spark, f"{tmp_path}/{n}") for n in ("wide", "labels")])
    plan = physical(got)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = cohort.with_future_label(wide, wide.selectExpr(
        "user_id", "feature_week", "1 AS feature_id", "f2 % 2 AS feature_value"))
    assert sorted(map(tuple, got.select("user_id", "feature_week", "f2", "label").collect())) \
        == sorted(map(tuple, want.select("user_id", "feature_week", "f2", "label").collect()))
    with pytest.raises(LookupError):
        open_by_learner(spark, f"{tmp_path}/none")


def test_the_course_range_opens_the_folders_of_its_days(spark, course, tmp_path):
    rows = course.observed_events.withColumn("day", F.to_date("observed_event_timestamp"))
    rows.repartition("day").write.partitionBy("day").parquet(f"{tmp_path}/observed_events")
    course.submissions.write.parquet(f"{tmp_path}/submissions")
    days = from_files(spark, str(tmp_path), course.start, 1, course.stamp, day="day")
    frame = feature(days, user_dropout(days), 2)
    scan = next(line for line in physical(frame).splitlines() if "FileScan" in line and "observed_event_duration" in line)
    dates = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "2023-12-31" in dates and "2024-01-09" in dates
    kept = days.on_days(days.observed_events, days.start_time, days.end_time)
    assert 0 < kept.select("day").distinct().count() <= 10 < days.observed_events.select("day").distinct().count()
    short = from_files(spark, str(tmp_path), course.start, 1, course.stamp)
    found, want = ({(r.user_id, r.feature_week): round(r.feature_value, 6) for r in f.collect()}
                   for f in (frame, feature(short, user_dropout(short), 2)))
    assert found == want and found
