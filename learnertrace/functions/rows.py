"""Turning aggregates into feature rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from learnertrace.sources.course import Course
from learnertrace.sources.schemas import ENTITY


@dataclass(frozen=True)
class Measure:
    """One feature of an aggregate: its value, and whether the row exists at all.

    A feature has no row where nothing qualified for it, which is different
    from a row holding 0 or NULL; `rows` counts what qualified. Both are SQL
    expressions over the aggregate.
    """

    feature_id: int
    value: str
    rows: str


def feature_rows(
    course: Course, table: str, frame: DataFrame, measures: list[Measure],
) -> DataFrame:
    """Rows of `table` for the measures that have any qualifying input."""
    keys = ENTITY[table]
    if len(measures) == 1:
        only = measures[0]
        tall = frame.filter(f"{only.rows} > 0").selectExpr(
            f"{only.feature_id} AS feature_id", *keys,
            f"CAST({only.value} AS DOUBLE) AS feature_value", course.extracted)
    else:
        cells = ", ".join(
            f"struct({m.feature_id} AS feature_id, CAST({m.value} AS DOUBLE) AS feature_value, "
            f"{m.rows} > 0 AS found)" for m in measures)
        tall = frame.selectExpr(*keys, f"inline(array({cells}))").filter("found").selectExpr(
            "feature_id", *keys, "feature_value", course.extracted)
    return tall


def stamped(course: Course, table: str, feature_id: int, frame: DataFrame,
            value: str) -> DataFrame:
    """One feature row per row of `frame`; `value` is an SQL expression."""
    return frame.selectExpr(f"{feature_id} AS feature_id", *ENTITY[table],
                            f"CAST({value} AS DOUBLE) AS feature_value", course.extracted)


def eligible(dropout: DataFrame) -> DataFrame:
    """Learners whose last submission falls in a known week."""
    return dropout.filter("dropout_week IS NOT NULL").select("user_id")


def keep_eligible(frame: DataFrame, dropout: DataFrame) -> DataFrame:
    """Drop the rows of learners who get no features.

    Operators call this on their *aggregate*, not on the raw activity. There is
    then at most one row per learner and week, so a learner with a huge share of
    the activity is only ever one key among many in the join, and the raw rows
    are combined map-side before they cross the network.
    """
    return frame.join(eligible(dropout), "user_id", "left_semi")
