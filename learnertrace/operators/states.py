"""Partial states of activity: one scan of each activity table, and all weekly features rolled up from them.

* `events`: valid observed events per learner, week, url and minute
* `submissions`: submissions per learner, problem, week and attempt number, with their grades
* `contributions`: forum and wiki contributions per learner and week

Weeks count from the course's start and also hold what lies before and after it; NULL holds what has no
time. States of two sets of activity merge into those of both (`merged`): counts and sums add up, extremes
and sets of seconds unite. The seconds of a minute are the bits of one number, so all that a state of events
holds is numbers, and a learner, week and url has at most 10,080 of them (one more if the course starts within a minute).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.functions.rows import Measure, feature_rows, keep_eligible
from learnertrace.functions.weeks import MINUTE, seconds_of_day, seconds_since_start, week
from learnertrace.operators.collaboration import FORUM, RESPONSE, WIKI_EDIT
from learnertrace.operators.observed import (
    RESOURCE_FEATURES,
    TABLE,
    releases_per_url,
    resources_per_url,
    valid_events,
)
from learnertrace.operators.submissions import correct_assessments, first_and_last, per_problem_grades
from learnertrace.sources.course import Course

#: Keys of each kind of state.
KEYS = {
    "events": ["user_id", "feature_week", "url_id", "minute"],
    "submissions": ["user_id", "problem_id", "feature_week", "number"],
    "contributions": ["user_id", "feature_week"],
}
#: What merges otherwise than by adding up.
EXTREMES, SETS = {"longest", "last"}, {"seconds"}
#: Changes with the columns of states: stored ones of another form do not merge with these.
FORM = 2


@dataclass(frozen=True)
class States:
    """Tables of states of a course, those that are wanted."""

    events: DataFrame | None = None
    submissions: DataFrame | None = None
    contributions: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        found = {kind: getattr(self, kind) for kind in KEYS}
        return {kind: rows for kind, rows in found.items() if rows is not None}


def _within(course: Course, frame: DataFrame, moment: Column, since: str | None, until: str | None) -> DataFrame:
    """Rows with a moment in a range, by a filter on the raw column that reaches the scan.

    What has no time belongs to the range without a beginning.
    """
    start, end = (None if x is None else F.lit(x).cast("timestamp") for x in (since, until))
    inside = F.lit(True)
    if start is not None:
        inside = moment >= start
    if end is not None:
        inside = inside & (moment < end) if start is not None else (moment < end) | moment.isNull()
    return course.on_days(frame, start, end).filter(inside)


def states(course: Course, since: str | None = None, until: str | None = None,
           kinds: Iterable[str] = tuple(KEYS)) -> States:
    """States of the activity from `since` (if given) to before `until` (if given)."""
    makers = {"events": _events, "submissions": _submissions, "contributions": _contributions}
    return States(**{kind: makers[kind](course, since, until) for kind in kinds})


def kinds_for(ids: Iterable[int]) -> list[str]:
    """The kinds of states from which some weekly features, and who dropped out when, are rolled up."""
    ids = set(ids)
    found = {"submissions"}
    found |= {"events"} if ids & {2, 13, 15, 16, 17, 18, 301, 302} else set()
    found |= {"contributions"} if ids & {3, 4, 5, 14, 201, 301} else set()
    return [kind for kind in KEYS if kind in found]


def _hours(moment: Column) -> list[Column]:
    hour = F.hour(moment).cast("long")
    return [F.count(moment).alias("timed"), F.sum(hour).alias("hours"), F.sum(hour * hour).alias("squares")]


def _events(course: Course, since: str | None, until: str | None) -> DataFrame:
    moment = F.col("observed_event_timestamp")
    passed = seconds_since_start(course, moment)
    second = F.unix_timestamp(moment)
    of_minute = F.pmod(second, F.lit(MINUTE))
    duration = F.col("observed_event_duration")
    return (
        _within(course, valid_events(course), moment, since, until)
        .withColumn("second", F.call_function("shiftleft", F.lit(1).cast("long"), of_minute.cast("int")))
        .groupBy("user_id", week(course, moment).alias("feature_week"), "url_id", (second - of_minute).alias("minute"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(duration).alias("total"), F.max(duration).alias("longest"),
             F.sum(passed.cast("double")).alias("moments"), *_hours(moment), F.bit_or("second").alias("seconds"))
    )


def _submissions(course: Course, since: str | None, until: str | None) -> DataFrame:
    moment = F.col("submission_timestamp")
    valid = F.col("validity") == 1
    graded = _within(course, course.submissions, moment, since, until)
    if "assessments" in course.tables:
        graded = graded.join(correct_assessments(course), "submission_id", "left")
    else:
        graded = graded.withColumn("correct", F.lit(0).cast("long"))
    return (
        graded.groupBy("user_id", "problem_id", week(course, moment).alias("feature_week"),
                       F.col("submission_attempt_number").cast("long").alias("number"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid"),
             F.sum(F.when(valid, F.coalesce("correct", F.lit(0)))).alias("correct"),
             F.sum(F.when(valid, F.unix_timestamp(moment))).alias("times"),
             F.max(F.when(moment.isNotNull(), F.struct(moment.alias("at"), F.col("submission_id").alias("id"))))
             .alias("last"))
    )


def _contributions(course: Course, since: str | None, until: str | None) -> DataFrame:
    kind, moment = F.col("collaboration_type_id"), F.col("collaboration_timestamp")
    post = kind.isin(*FORUM)
    length = F.when(post, F.octet_length("collaboration_content"))
    return (
        _within(course, course.collaborations, moment, since, until)
        .groupBy("user_id", week(course, moment).alias("feature_week"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(post).alias("posts"),
             F.count_if(kind == WIKI_EDIT).alias("edits"), F.count_if(kind == RESPONSE).alias("responses"),
             F.sum(length).alias("lengths"), F.count(length).alias("measured"), *_hours(moment))
    )


def merged(kind: str, rows: DataFrame) -> DataFrame:
    """One state per key from rows that may hold several."""
    keys = KEYS[kind]
    parts = []
    for name in rows.columns:
        if name not in keys:
            merge = F.bit_or if name in SETS else F.max if name in EXTREMES else F.sum
            parts.append(merge(name).alias(name))
    return rows.groupBy(*keys).agg(*parts).select(*rows.columns)


def user_dropout(course: Course, submissions: DataFrame) -> DataFrame:
    """`dropout.user_dropout` from the states of submissions."""
    last = submissions.filter("user_id IS NOT NULL").groupBy("user_id").agg(F.max("last").alias("last"))
    return last.select(
        "user_id", F.col("last.id").alias("last_submission_id"),
        (week(course, F.col("last.at")) + 1).alias("dropout_week"), F.col("last.at").alias("dropout_timestamp"))


def _in_course(course: Course, rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("feature_week").between(0, course.weeks - 1))


def _rows(course: Course, weekly: DataFrame, dropout: DataFrame, measures: list[Measure],
          ids: Iterable[int]) -> DataFrame:
    wanted = set(ids)
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in wanted])


def observed_weeks(course: Course, known: States, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 2, 15, 16, 17, 18, 301 and 302, from one roll-up of the events to weeks.

    All that is known of a url meets them in one join, and what learners wrote joins their rows for 301.
    """
    wanted = set(ids)
    by_kind = {i: column for i, column in RESOURCE_FEATURES.items() if i in wanted}
    urls = [resources_per_url(course).select("url_id", *by_kind.values())] if by_kind else []
    urls += [releases_per_url(course)] if 302 in wanted else []
    rows = known.events.withColumns({"worked": F.col("n"), "clocked": F.col("timed")})
    if urls:
        rows = rows.join(reduce(lambda one, two: one.join(two, "url_id", "full"), urls), "url_id", "left")
    sums = [F.sum("n").alias("events"), F.sum("total").alias("total"), F.max("longest").alias("longest")]
    inside = f"CAST(feature_week BETWEEN 0 AND {course.weeks - 1} AND {{}} > 0 AS INT)".format
    measures = [Measure(2, "total", inside("events")), Measure(15, "longest", inside("events"))]
    for i, column in by_kind.items():
        shown = F.col(column)
        sums += [F.sum(F.col("total") * shown).alias(f"total_{column}"),
                 F.sum(F.col("n") * shown).alias(f"events_{column}")]
        measures.append(Measure(i, f"total_{column}", inside(f"events_{column}")))
    if 301 in wanted:
        wrote = known.contributions.select(
            "user_id", "feature_week", F.col("n").alias("worked"), F.col("timed").alias("clocked"), "hours", "squares")
        rows = rows.unionByName(wrote, allowMissingColumns=True)
        sums += [F.sum(c).alias(c) for c in ("worked", "clocked", "hours", "squares")]
        square = "CAST(clocked AS DOUBLE) * squares - CAST(hours AS DOUBLE) * hours"
        measures.append(Measure(301, f"try_divide(sqrt(greatest({square}, 0D)), clocked)", "worked"))
    if 302 in wanted:
        sums += [F.sum(F.col("moments") * F.col("dated") - F.col("timed") * F.col("releases")).alias("waited"),
                 F.sum(F.col("timed") * F.col("dated")).alias("uses"),
                 F.sum(F.col("n") * F.col("resources")).alias("pairs")]
        measures.append(Measure(302, "try_divide(waited, uses)", "pairs"))
    return _rows(course, rows.groupBy("user_id", "feature_week").agg(*sums), dropout, measures, wanted)


#: Seconds of a minute whose number has a bit k, as bits.
WITH_BIT = [sum(1 << second for second in range(MINUTE) if second >> k & 1) for k in range(6)]


def _members(bits: str, weight: Callable[[int, int], int]) -> str:
    """Sum of weights over pairs of bits k <= l of the numbers of the seconds in a set."""
    return " + ".join(f"{weight(k, m)}L * bit_count({bits} & {WITH_BIT[k] & WITH_BIT[m]}L)"
                      for k in range(6) for m in range(k, 6) if weight(k, m))


def timestamp_deviation(course: Course, known: States, dropout: DataFrame, ids: Iterable[int] = (13,)) -> DataFrame:
    """Feature 13. Sets of seconds unite per learner, week and minute, at most 10,081 of a week; no second is
    an exchange's key. Moments of a minute follow each other in time of day as well, since clocks
    change by whole minutes, so sums and squares come from the minute's time and the bits of its set. They are whole
    numbers, and their difference is taken exactly."""
    start = seconds_of_day(F.timestamp_seconds("minute")).cast("long")
    minutes = (
        _in_course(course, known.events).groupBy("user_id", "feature_week", "minute")
        .agg(F.bit_or("seconds").alias("seconds"))
        .select("user_id", "feature_week", start.alias("start"), F.expr("CAST(bit_count(seconds) AS BIGINT) AS n"),
                F.expr(_members("seconds", lambda k, m: 1 << k if k == m else 0)).alias("sum"),
                F.expr(_members("seconds", lambda k, m: (1 if k == m else 2) << k + m)).alias("squares"))
    )
    weekly = minutes.groupBy("user_id", "feature_week").agg(
        F.sum("n").alias("moments"), F.expr("sum(n * start + sum) AS total"),
        F.expr("sum(n * start * start + 2 * start * sum + squares) AS squares"))
    # At most 604,800 moments of less than 86,400 seconds.
    square = ("CAST(moments AS DECIMAL(10, 0)) * CAST(squares AS DECIMAL(18, 0)) "
              "- CAST(total AS DECIMAL(14, 0)) * CAST(total AS DECIMAL(14, 0))")
    return _rows(course, weekly, dropout, [Measure(13, f"sqrt(CAST({square} AS DOUBLE)) / moments", "moments")], ids)


def contributions(course: Course, known: States, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 3, 4, 5, 14, 201."""
    return _rows(course, _in_course(course, known.contributions), dropout, [
        Measure(3, "posts", "posts"), Measure(4, "edits", "edits"),
        Measure(5, "try_divide(lengths, measured)", "posts"), Measure(14, "n", "n"),
        Measure(201, "responses", "responses")], ids)


def attempts(course: Course, known: States, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 6, 7, 8, 208, 210, from one roll-up to problems; deadlines meet its rows."""
    wanted = set(ids)
    solved = F.col("problem_id").isNotNull()
    tried = (
        _in_course(course, known.submissions).filter("valid > 0")
        .groupBy("user_id", "feature_week", "problem_id")
        .agg(F.sum("valid").alias("n"), F.sum("correct").alias("correct"), F.sum("times").alias("times"))
    )
    sums = [F.count_if(solved).alias("problems"), F.sum("n").alias("submissions"),
            F.count_if(solved & (F.col("correct") > 0)).alias("solved"), F.sum("correct").alias("correct")]
    if 210 in wanted:
        # One row per problem, so that no submission is multiplied.
        due = F.unix_timestamp("problem_hard_deadline")
        deadlines = course.problems.groupBy("problem_id").agg(
            F.count(F.lit(1)).alias("copies"), F.count(due).alias("dates"), F.sum(due).alias("dues"))
        tried = tried.join(deadlines, "problem_id", "left")
        sums += [F.sum(F.col("times") * F.col("dates") - F.col("n") * F.col("dues")).alias("seconds"),
                 F.sum(F.col("n") * F.col("dates")).alias("dated"), F.sum(F.col("n") * F.col("copies")).alias("listed")]
    weekly = tried.groupBy("user_id", "feature_week").agg(*sums)
    return _rows(course, weekly, dropout, [
        Measure(6, "problems", "submissions"), Measure(7, "submissions", "submissions"),
        Measure(8, "solved", "correct"), Measure(208, "correct", "correct"),
        Measure(210, "try_divide(seconds, dated)", "listed")], ids)


def attempt_spans(course: Course, known: States, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 9 and 12."""
    in_course = F.when(F.col("feature_week").between(0, course.weeks - 1), F.col("feature_week"))
    per_number = (
        known.submissions.filter("problem_id IS NOT NULL AND number IS NOT NULL")
        .groupBy("user_id", "problem_id", in_course.alias("feature_week"), "number")
        .agg(F.sum("valid").alias("valid"), F.sum("rows").alias("rows"))
    )
    return first_and_last(course, per_number, dropout, ids)


def grades(course: Course, known: States, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 204 and 206."""
    solved = known.submissions.filter("correct > 0").groupBy("user_id", "problem_id").agg(
        F.sum("correct").alias("correct"))
    return per_problem_grades(course, solved, dropout, ids)


#: Weekly features by the roll-up that gives them.
ROLLUPS: Mapping[tuple[int, ...], Callable[..., DataFrame]] = {
    (2, 15, 16, 17, 18, 301, 302): observed_weeks,
    (3, 4, 5, 14, 201): contributions,
    (6, 7, 8, 208, 210): attempts,
    (9, 12): attempt_spans,
    (13,): timestamp_deviation,
    (204, 206): grades,
}
