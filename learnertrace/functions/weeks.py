"""Course weeks and other time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnertrace.sources.course import Course

WEEK_SECONDS, MINUTE = 7 * 24 * 3600, 60


def seconds_since_start(course: Course, moment: Column) -> Column:
    """Whole seconds from the start of the course; negative before it."""
    return F.unix_timestamp(moment) - F.unix_timestamp(course.start_time)


def week(course: Course, moment: Column) -> Column:
    """0-based course week of `moment`."""
    return F.floor(seconds_since_start(course, moment) / WEEK_SECONDS).cast("int")


def during(course: Course, moment: Column) -> Column:
    """True for moments inside the course.

    Written as a range on the raw column, not on the week number, so that it
    reaches the file scan and skips row groups by their statistics.
    """
    return (moment >= course.start_time) & (moment < course.end_time)


def by_week(course: Course, frame: DataFrame, moment: str) -> DataFrame:
    """Rows inside the course with their `feature_week`."""
    return course.on_days(frame, course.start_time, course.end_time).filter(during(course, F.col(moment))).withColumn(
        "feature_week", week(course, F.col(moment))
    )


def seconds_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
