"""Partial states: roll-ups against the plans from activity, merging, and scans."""

import random
import re
from datetime import timedelta

import pytest

from learnertrace.operators import states
from learnertrace.operators.dropout import user_dropout
from learnertrace.plans.features import features, stored_states
from learnertrace.sources.course import Course
from learnertrace.sources.driver_tables import course as driver_course
from learnertrace.sources.schemas import ACTIVITY
from tests.conftest import START, at

FOLDER = "/root/testdata/sf0.001"


def rounded(frame):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in frame.collect())


@pytest.fixture
def odd_course(spark):
    """Activity before, in and after the course, without time, learner, url or problem, and repeated."""
    rng = random.Random(8)

    def moment():
        return rng.choice([None, at(rng.randrange(-700_000, 5 * 604800 + 700_000)), at(rng.randrange(0, 4000)),
                           at(weeks=rng.randrange(6))])

    users = ["u", "v", "w", "x", None]
    events = [(k, rng.choice(users), moment(), rng.choice([None, rng.random() * 9]), rng.choice([0, 1, 1, None]),
               rng.choice([None, 1, 2, 3])) for k in range(400)]
    tries = [(f"s{k % 280}", rng.choice(users), rng.choice([None, "p", "q", "r"]), moment(), rng.choice([None, 1, 2, 3]),
              rng.choice([0, 1, 1, None])) for k in range(300)]
    posts = [(rng.choice(users), rng.choice([1, 2, 3, 4, 5, None]), moment(), rng.choice([None, "", "abc", "é"]))
             for _ in range(120)]
    tables = {
        "observed_events": events + events[:30], "submissions": tries,
        "assessments": [(f"s{k}", rng.choice([0.0, 1.0, 1.0, None])) for k in range(280) for _ in range(1 + k % 2)],
        "collaborations": posts, "urls": [(1, "/a"), (2, "/b"), (2, "/c")],
        "problems": [("p", 1, 0, at(50)), ("q", 3, 1, None), ("q", 3, 1, at(9)), ("z", 1, 2, at(5))],
        "resources": [(1, "/a", 4, at(0)), (2, "/a", 3, at(7)), (3, "/b", 7, None), (4, "/c", 4, at(99))],
        "resources_urls": [(1, 1), (2, 1), (3, 2), (4, 3), (4, 3)], "resource_types": [(3,), (7,), (7,)],
    }
    return Course({name: spark.createDataFrame(rows, ACTIVITY[name]) for name, rows in tables.items()},
                  "2024-01-01 00:00:00", 5, "2024-02-01 00:00:00")


def test_rolled_up_equals_the_plans(odd_course):
    known = states.states(odd_course)
    assert rounded(states.user_dropout(odd_course, known.submissions)) == rounded(user_dropout(odd_course))
    for number in (i for ids in states.ROLLUPS for i in ids):
        assert rounded(features(odd_course, only=[number], known_states=known)) \
            == rounded(features(odd_course, only=[number])), number
    assert rounded(features(odd_course, known_states=known)) == rounded(features(odd_course))


def test_states_of_parts_merge_into_those_of_all(odd_course):
    cuts = [None, "2024-01-04 10:00:00", "2024-01-08 00:00:00", "2024-01-29 00:00:00", None]
    parts = [states.states(odd_course, a, b) for a, b in zip(cuts, cuts[1:])]
    whole = states.states(odd_course)
    for kind in states.KEYS:
        rows = getattr(parts[0], kind)
        for part in parts[1:]:
            rows = rows.unionByName(getattr(part, kind))

        def ordered(frame):
            return sorted(str([sorted(x) if isinstance(x, list) else round(x, 6) if isinstance(x, float) else x
                               for x in row]) for row in frame.collect())
        assert ordered(states.merged(kind, rows)) == ordered(getattr(whole, kind))


def test_moments_count_once_a_second(spark, make_course):
    events = [(k, "u", START + timedelta(seconds=s, microseconds=m), 1.0, 1, 1)
              for k, (s, m) in enumerate([(0, 0), (0, 5), (10, 0), (10, 0)])]
    course = make_course(observed_events=events)
    for known in (None, states.states(course)):
        [row] = features(course, only=[13], known_states=known).collect()
        assert row.feature_value == 5


@pytest.mark.parametrize("zone, start", [("America/New_York", "2024-03-04 00:00:30"), ("Asia/Kolkata", "2024-01-01 23:59:59"),
                                         ("UTC", "1969-12-29 00:00:00")])
def test_seconds_of_minutes_are_those_of_the_moments(spark, zone, start):
    """In zones with half hours, across a change of clocks and in a course that starts within a minute."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ticks = spark.range(3000).selectExpr(
            "id AS observed_event_id", "concat('u', id % 7) AS user_id", f"timestamp_seconds(unix_timestamp(TIMESTAMP '{start}')"
            " + CASE id % 3 WHEN 0 THEN id WHEN 1 THEN id * id % 1209600 ELSE 518400 + id * 61 END - 50) AS observed_event_timestamp",
            "1D AS observed_event_duration", "1 AS validity", "id % 2 AS url_id")
        tried = spark.range(7).selectExpr(
            "concat('s', id) AS submission_id", "concat('u', id) AS user_id", "'p' AS problem_id",
            f"TIMESTAMP '{start}' AS submission_timestamp", "1 AS submission_attempt_number", "1 AS validity")
        course = Course({"observed_events": ticks, "submissions": tried}, start, 2, "2024-06-01 00:00:00")
        known = states.states(course, kinds=["events", "submissions"])
        got, want = (features(course, only=[13], known_states=k) for k in (known, None))
        assert rounded(got) == rounded(want) and want.count() == 14
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_states_of_events_hold_numbers_and_are_rolled_up_once(spark):
    """No sets to sort for, and one pass over the states for all that is summed by week."""
    course = driver_course(spark, FOLDER)
    ids = [2, 15, 16, 17, 18, 301, 302]
    known = stored_states(course, [*ids, 13])
    assert not any(kind.startswith("array") for _, kind in known.events.dtypes)
    plan = states.states(course).events._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    folder = known.events.inputFiles()[0].split("/")[-2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = features(course, only=ids, known_states=known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sum(folder in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_one_scan_of_each_activity_table(spark, tmp_path):
    source = driver_course(spark, FOLDER)
    for name in ACTIVITY:
        getattr(source, name).write.parquet(f"{tmp_path}/{name}")
    from learnertrace.sources.course import from_files
    course = from_files(spark, str(tmp_path), source.start, source.weeks, source.stamp)

    def scans(frame):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        files = "".join(line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines()
                        if "FileScan" in line)
        return {name: len(re.findall(rf"/{name}\]", files)) for name in ACTIVITY}, plan

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        found = {}
        for kind in states.KEYS:
            for name, count in scans(getattr(states.states(course), kind))[0].items():
                found[name] = found.get(name, 0) + count
        assert found["observed_events"] == found["submissions"] == found["assessments"] == found["collaborations"] == 1
        rest, plan = scans(features(course, known_states=stored_states(course)))
        assert not any(rest[name] for name in ("observed_events", "submissions", "assessments", "collaborations"))
        assert not re.search("lambda", plan)
        known = stored_states(course)
        text = features(course, only=[13], known_states=known)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in text and not re.search(r"hashpartitioning\([^)]*second", text)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert rounded(features(course, known_states=known)) == rounded(features(source))


def test_missing_tables(spark, make_course):
    course = make_course(submissions=[(f"s-{u}", u, "p", at(10), 1, 1) for u in ("u", "v", "w")])
    bare = Course({"submissions": course.submissions}, course.start, course.weeks, course.stamp)
    known = stored_states(bare, [7, 9])
    assert known.events is None and known.contributions is None
    assert features(bare, only=[7, 9], known_states=known).count() == 6
