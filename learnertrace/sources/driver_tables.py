"""A course read out of general-purpose test tables (events, documents, part).

Every document and nearly every other row takes part. The same view for the SQL twins is
`COURSE_SQL` in `oracle_queries.py`.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.sources.course import Course, conform
from learnertrace.sources.schemas import ACTIVITY

START, WEEKS, STAMP = "2024-01-01 00:00:00", 5, "2024-02-01 00:00:00"

# Columns read from each test table.
READ = {
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
    "documents": "doc_id BIGINT, text STRING",
    "part": "p_partkey BIGINT, p_size INT",
}

START_SECONDS = f"unix_timestamp(TIMESTAMP '{START}')"
EVENT = [
    "event_id", "user_id", "event_type", "value",
    "date_trunc('second', CAST(ts AS TIMESTAMP)) AS second",
    f"unix_timestamp(CAST(ts AS TIMESTAMP)) - {START_SECONDS} AS sec",
    "CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k",
]
VALID = "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS validity"
SUBMITTED = "event_type IN ('purchase', 'signup', 'error')"
EVEN = "p_partkey - p_partkey % 2"

# Table -> (where its rows come from, which of them, its columns).
VIEWS = {
    "observed_events": ("events", None, [
        "event_id AS observed_event_id", "user_id", "second AS observed_event_timestamp",
        "value AS observed_event_duration", VALID, "event_id DIV 5 AS url_id"]),
    # Learners submit at one of five paces, so they stop in different weeks; the
    # submissions of a sixth group have no times.
    "submissions": ("events", SUBMITTED, [
        "event_id AS submission_id", "user_id", "user_id * 14 + k % 20 AS problem_id",
        f"timestamp_seconds({START_SECONDS} + sec * nullif(user_id % 6, 0) DIV 5) "
        "AS submission_timestamp",
        "1 + floor(value / 20) AS submission_attempt_number", VALID]),
    "assessments": ("events", SUBMITTED, [
        "event_id AS submission_id",
        "CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS assessment_grade"]),
    "problems": ("part", None, [
        "p_partkey AS problem_id",
        "CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END AS problem_type_id",
        "p_partkey % 5 AS problem_week",
        f"timestamp_seconds({START_SECONDS} + (p_partkey % 5 + 1) * 604800) "
        "AS problem_hard_deadline"]),
    "collaborations": ("contributions", None, [
        "user_id", "1 + k % 4 AS collaboration_type_id", "second AS collaboration_timestamp",
        "text AS collaboration_content"]),
    "click_events": ("events", "event_type IN ('view', 'click', 'purchase')", [
        "event_id", "user_id", "concat('v', k % 10) AS video_id",
        "CASE event_type WHEN 'view' THEN 'play_video' WHEN 'click' THEN 'pause_video' "
        "ELSE 'seek_video' END AS observed_event_type",
        "CASE WHEN value >= 1 THEN value END AS video_current_time",
        f"timestamp_seconds({START_SECONDS} + sec DIV 200) AS observed_event_timestamp"]),
    "urls": ("part", None, ["p_partkey AS url_id", "concat('/u/', p_partkey) AS url"]),
    "resources": ("part", None, [
        "1000000 + p_partkey AS resource_id", f"concat('/u/', {EVEN}) AS resource_uri",
        "1 + p_size % 8 AS resource_type_id",
        f"timestamp_seconds({START_SECONDS} + p_size * 3600) AS resource_release_timestamp"]),
    "resources_urls": ("part", None, [
        "1000000 + p_partkey AS resource_id", f"{EVEN} AS url_id"]),
    "resource_types": ("types", None, ["resource_type_id"]),
}


def course(spark: SparkSession, folder: str, weeks: int = WEEKS) -> Course:
    """The course, or with other `weeks` the same activity drawn out to that many.

    The session's zone has to be UTC, as the tables' times are.
    """
    stretch = weeks // WEEKS
    event_columns = [e.replace(f"- {START_SECONDS} AS sec", f"- {START_SECONDS}) * {stretch} AS sec")
              .replace("unix_timestamp(CAST(ts", "(unix_timestamp(CAST(ts")
              if e.endswith("AS sec") else
              f"timestamp_seconds((unix_timestamp(CAST(ts AS TIMESTAMP)) - {START_SECONDS}) * {stretch} "
              f"+ {START_SECONDS}) AS second" if e.endswith("AS second") else e for e in EVENT]

    def read(name: str) -> DataFrame:
        return spark.read.schema(READ[name]).parquet(f"{folder}/{name}.parquet")

    def source(name: str) -> DataFrame:
        if name == "events":
            return read("events").selectExpr(*event_columns)
        if name == "contributions":
            # A signup contributes the document of its ten events; besides, every document is
            # contributed once by one of five events.
            chosen = ("filter(array(CASE WHEN event_type = 'signup' THEN event_id DIV 10 END, "
                      "CASE WHEN event_id % 5 = event_id DIV 5 % 5 THEN event_id DIV 5 END), "
                      "d -> d IS NOT NULL)")
            events = source("events").withColumn("doc_id", F.explode(F.expr(chosen)))
            return events.join(read("documents"), "doc_id")
        if name == "types":
            return read("part").selectExpr("1 + p_size % 8 AS resource_type_id").distinct()
        return read(name)

    def view(name: str) -> DataFrame:
        origin, chosen, columns = VIEWS[name]
        rows = source(origin)
        rows = rows.filter(chosen) if chosen else rows
        columns = [c.replace(f"p_partkey % {WEEKS}", f"p_partkey % {weeks}") for c in columns]
        return conform(rows.selectExpr(*columns), ACTIVITY[name])

    return Course({name: partial(view, name) for name in VIEWS}, START, weeks, STAMP)
