"""Weekly features of problem submissions and their grades."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.functions.rows import Measure, feature_rows, keep_eligible
from learnertrace.functions.weeks import by_week, during, seconds_since_start, week
from learnertrace.sources.course import Course

TABLE = "user_long_feature"

# Problem types by code, and the grade of a correct answer.
HOMEWORK, LAB, CORRECT = 1, 3, 1


def valid_submissions(course: Course) -> DataFrame:
    return course.submissions.filter("validity = 1")


def correct_assessments(course: Course) -> DataFrame:
    """One row per submission that was ever graded correct, with how many times."""
    return (
        course.assessments.filter(F.col("assessment_grade") == CORRECT)
        .groupBy("submission_id").agg(F.count(F.lit(1)).alias("correct"))
    )


def attempts(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (6, 7, 8, 208),
) -> DataFrame:
    """Features 6, 7, 8, 208: problems tried, submissions, problems solved, correct submissions.

    Counting per (learner, week, problem) first makes both kinds of count fall
    out of one pass, and spreads a busy learner over the problems.
    """
    ids = set(ids)
    graded = bool(ids & {8, 208})
    every = bool(ids & {6, 7})
    tried = by_week(course, valid_submissions(course), "submission_timestamp")
    correct = F.lit(0)
    if graded:
        how = "left" if every else "inner"
        tried = tried.join(correct_assessments(course), "submission_id", how)
        correct = F.coalesce(F.sum("correct"), F.lit(0))
    known = F.col("problem_id").isNotNull()
    weekly = (
        tried.groupBy("user_id", "feature_week", "problem_id")
        .agg(F.count(F.lit(1)).alias("tries"), correct.alias("correct"))
        .groupBy("user_id", "feature_week")
        .agg(
            F.count_if(known).alias("problems"),
            F.sum("tries").alias("submissions"),
            F.count_if(known & (F.col("correct") > 0)).alias("solved"),
            F.sum("correct").alias("correct"),
        )
    )
    measures = [
        Measure(6, "problems", "submissions"),
        Measure(7, "submissions", "submissions"),
        Measure(8, "solved", "correct"),
        Measure(208, "correct", "correct"),
    ]
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in ids])


def attempt_spans(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (9, 12),
) -> DataFrame:
    """Features 9 and 12: last attempt number, and last minus first, averaged over problems.

    A submission takes part if its attempt number is the greatest the learner
    ever reached on the problem, counting invalid submissions and other weeks
    too, and the submission itself is valid and in the course. For feature 12
    it counts once for every submission holding the smallest attempt number.

    The submissions are reduced in two aggregates, so nothing ever holds all
    rows of one (learner, problem): first to counts per attempt number, then to
    the extremes of each week. The window sees at most one row per course week
    and one more for everything outside the course.
    """
    number = F.col("submission_attempt_number")
    moment = F.col("submission_timestamp")
    in_week = F.when(during(course, moment), week(course, moment))
    per_number = (
        course.submissions.filter(F.col("problem_id").isNotNull() & number.isNotNull())
        .groupBy("user_id", "problem_id", in_week.alias("feature_week"),
                 number.cast("long").alias("number"))
        .agg(F.count_if(F.col("validity") == 1).alias("valid"), F.count(F.lit(1)).alias("rows"))
    )
    return first_and_last(course, per_number, dropout, ids)


def first_and_last(course: Course, per_number: DataFrame, dropout: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features 9 and 12 from counts (valid, rows) per learner, problem, week of the course or
    NULL, and attempt number."""
    keys = ["user_id", "problem_id", "feature_week"]
    per_week = per_number.groupBy(*keys).agg(
        F.max("number").alias("top"), F.max_by("valid", "number").alias("valid_at_top"),
        F.min("number").alias("low"), F.min_by("rows", "number").alias("rows_at_low"),
    )
    problem = Window.partitionBy("user_id", "problem_id")
    ranged = (
        per_week
        .withColumn("last", F.max("top").over(problem))
        .withColumn("first", F.min("low").over(problem))
        .withColumn("firsts", F.sum(F.when(F.col("low") == F.col("first"), F.col("rows_at_low")))
                    .over(problem))
    )
    used = ranged.filter(
        F.col("feature_week").isNotNull() & (F.col("top") == F.col("last"))
        & (F.col("valid_at_top") > 0))
    pairs = F.col("valid_at_top") * F.col("firsts")
    weekly = used.groupBy("user_id", "feature_week").agg(
        F.sum("valid_at_top").alias("n"),
        F.sum(F.col("last") * F.col("valid_at_top")).alias("numbers"),
        F.sum(pairs).alias("pairs"),
        F.sum((F.col("last") - F.col("first")) * pairs).alias("spans"),
    )
    measures = [
        Measure(9, "try_divide(numbers, n)", "n"),
        Measure(12, "try_divide(spans, pairs)", "n"),
    ]
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in set(ids)])


def solving_time(course: Course, dropout: DataFrame) -> DataFrame:
    """Feature 12 as documented: seconds from first to last attempt, averaged over problems."""
    moment = seconds_since_start(course, F.col("submission_timestamp"))
    weekly = (
        by_week(course, valid_submissions(course), "submission_timestamp")
        .filter(F.col("problem_id").isNotNull())
        .groupBy("user_id", "feature_week", "problem_id")
        .agg((F.max(moment) - F.min(moment)).alias("took"))
        .groupBy("user_id", "feature_week")
        .agg(F.avg("took").alias("took"), F.count(F.lit(1)).alias("problems"))
    )
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [Measure(12, "took", "problems")])


def grades(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (204, 206),
    lab_denominator: int = HOMEWORK,
) -> DataFrame:
    """Features 204 and 206: correct homework and lab submissions per problem of their week.

    Counted in the week the problem belongs to, not the week of the submission.
    Lab grades are divided by the number of homework problems unless
    `lab_denominator` says otherwise. Submissions are counted per learner and problem before
    they meet the problems.
    """
    solved = (
        valid_submissions(course).select("submission_id", "user_id", "problem_id")
        .join(correct_assessments(course), "submission_id")
        .groupBy("user_id", "problem_id").agg(F.sum("correct").alias("correct"))
    )
    return per_problem_grades(course, solved, dropout, ids, lab_denominator)


def per_problem_grades(
    course: Course, solved: DataFrame, dropout: DataFrame, ids: Iterable[int], lab_denominator: int = HOMEWORK,
) -> DataFrame:
    """Features 204 and 206 from correct submissions per learner and problem."""
    ids = set(ids)
    wanted = [kind for feature, kind in ((204, HOMEWORK), (206, LAB)) if feature in ids]
    in_course = (F.col("problem_week") >= 0) & (F.col("problem_week") < course.weeks)
    kind = F.col("problem_type_id")
    problems = course.problems.filter(in_course)
    # One row per course week, hence at most `course.weeks` rows to broadcast.
    sizes = problems.groupBy("problem_week").agg(
        *[F.count_if(kind == k).alias(f"size_{k}") for k in {HOMEWORK, lab_denominator}])
    weekly = (
        solved.join(problems.filter(kind.isin(*wanted)).select("problem_id", "problem_week", kind),
              "problem_id")
        .groupBy("user_id", "problem_week")
        .agg(F.sum(F.when(kind == HOMEWORK, F.col("correct"))).alias("homework"),
             F.sum(F.when(kind == LAB, F.col("correct"))).alias("lab"))
        .join(F.broadcast(sizes), "problem_week", "left")
        .withColumnRenamed("problem_week", "feature_week")
    )
    measures = [
        Measure(204, f"try_divide(homework, size_{HOMEWORK})", "homework"),
        Measure(206, f"try_divide(lab, size_{lab_denominator})", "lab"),
    ]
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in ids])


def time_before_deadline(course: Course, dropout: DataFrame) -> DataFrame:
    """Feature 210: average seconds from deadline to submission, negative when early.

    Submissions are summed per learner, week and problem before they meet the deadlines.
    """
    tried = (
        by_week(course, valid_submissions(course), "submission_timestamp")
        .groupBy("user_id", "feature_week", "problem_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.unix_timestamp("submission_timestamp")).alias("times"))
    )
    due = F.unix_timestamp("problem_hard_deadline")
    weekly = (
        tried.join(course.problems.select("problem_id", due.alias("due")), "problem_id")
        .groupBy("user_id", "feature_week")
        .agg(F.sum(F.col("times") - F.col("n") * F.col("due")).alias("seconds"),
             F.sum(F.when(F.col("due").isNotNull(), F.col("n"))).alias("dated"),
             F.sum("n").alias("submissions"))
        .withColumn("late", F.try_divide("seconds", "dated"))
    )
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [Measure(210, "late", "submissions")])
