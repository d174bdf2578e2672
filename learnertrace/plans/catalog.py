"""The catalogue of features: number, table, name, meaning and needs."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from learnertrace.sources.schemas import OUTPUT


@dataclass(frozen=True)
class Feature:
    id: int
    table: str
    name: str
    description: str
    requires: tuple[int, ...] = ()


WEEKLY = "user_long_feature"
USER = "user_feature"
VIDEO = "video_feature"
PAIR = "user_video_feature"

# Feature numbers, tables and names. The descriptions are our own.
CATALOG = {f.id: f for f in [
    Feature(1, WEEKLY, "dropout", "1 while the learner is still active in the week, else 0"),
    Feature(2, WEEKLY, "sum_observed_events_duration", "Total duration of observed events"),
    Feature(3, WEEKLY, "number_of_forum_posts", "Contributions to the forum"),
    Feature(4, WEEKLY, "number_of_wiki_edits", "Edits of the wiki"),
    Feature(5, WEEKLY, "average_length_of_forum_posts", "Mean bytes per forum contribution"),
    Feature(6, WEEKLY, "distinct_attempts", "Different problems submitted to"),
    Feature(7, WEEKLY, "number_of_attempts", "Submissions"),
    Feature(8, WEEKLY, "distinct_problems_correct", "Different problems answered correctly"),
    Feature(9, WEEKLY, "average_number_of_attempts", "Mean final attempt number per problem"),
    Feature(10, WEEKLY, "sum_observed_events_duration_per_correct_problem",
            "Total duration over problems answered correctly", (2, 8)),
    Feature(11, WEEKLY, "number_problem_attempted_per_correct_problem",
            "Problems submitted to over problems answered correctly", (6, 8)),
    Feature(12, WEEKLY, "average_time_to_solve_problem",
            "Mean difference of last and first attempt number per problem"),
    Feature(13, WEEKLY, "observed_event_timestamp_variance",
            "Standard deviation of the time of day of observed events, in seconds"),
    Feature(14, WEEKLY, "number_of_collaborations", "Contributions of any kind"),
    Feature(15, WEEKLY, "max_duration_resources", "Longest duration of an observed event"),
    Feature(16, WEEKLY, "sum_observed_events_lecture", "Total duration on lectures"),
    Feature(17, WEEKLY, "sum_observed_events_book", "Total duration on books"),
    Feature(18, WEEKLY, "sum_observed_events_wiki", "Total duration on wiki pages"),
    Feature(103, WEEKLY, "difference_feature_3", "Feature 3 over that of the week before", (3,)),
    Feature(104, WEEKLY, "difference_feature_4", "Feature 4 over that of the week before", (4,)),
    Feature(105, WEEKLY, "difference_feature_5",
            "Feature 5 over that of the week before, if it had more than five posts", (3, 5)),
    Feature(109, WEEKLY, "difference_feature_9", "Feature 9 over that of the week before", (9,)),
    Feature(110, WEEKLY, "difference_feature_10",
            "Feature 10 over that of the week before", (10,)),
    Feature(111, WEEKLY, "difference_feature_11",
            "Feature 11 over that of the week before", (11,)),
    Feature(112, WEEKLY, "difference_feature_12",
            "Feature 12 over that of the week before", (12,)),
    Feature(201, WEEKLY, "number_of_forum_responses", "Responses in the forum"),
    Feature(202, WEEKLY, "percentile_of_average_number_of_attempts",
            "Percentile of feature 9 within the week", (9,)),
    Feature(203, WEEKLY, "percent_of_average_number_of_attempts",
            "Feature 9 as a share of the week's greatest", (9,)),
    Feature(204, WEEKLY, "pset_grade", "Correct homework submissions per homework problem"),
    Feature(205, WEEKLY, "pset_grade_over_time",
            "Feature 204 minus its mean over earlier weeks", (204,)),
    Feature(206, WEEKLY, "lab_grade", "Correct lab submissions per problem"),
    Feature(207, WEEKLY, "lab_grade_over_time",
            "Feature 206 minus its mean over earlier weeks", (206,)),
    Feature(208, WEEKLY, "attempts_correct", "Correct submissions"),
    Feature(209, WEEKLY, "percent_correct_submissions",
            "Correct submissions over all submissions", (7, 208)),
    Feature(210, WEEKLY, "average_predeadline_submission_time",
            "Mean seconds from deadline to submission"),
    Feature(301, WEEKLY, "std_hours_working",
            "Standard deviation of the hour of events and contributions"),
    Feature(302, WEEKLY, "time_to_react", "Mean seconds from a resource's release to its use"),
    Feature(701, PAIR, "total_engagement_time", "Seconds watched"),
    Feature(702, PAIR, "session_engagement_time", "Seconds watched in the last session"),
    Feature(703, PAIR, "scroll_back_times", "Jumps back to an earlier position"),
    Feature(704, VIDEO, "frequency_per_video", "Learners who clicked on the video"),
    Feature(705, USER, "frequency_per_user", "Videos the learner clicked on"),
    Feature(706, VIDEO, "rewatching_rate_per_video", "Returns to the video per learner", (704,)),
    Feature(707, USER, "rewatching_rate_per_user", "Returns to videos per video", (704, 705)),
    Feature(710, USER, "total_engagement_time_per_user", "Feature 701 summed", (701,)),
    Feature(711, VIDEO, "total_engagement_time_per_video", "Feature 701 summed", (701,)),
    Feature(712, USER, "session_engagement_time_per_user", "Feature 702 summed", (702,)),
    Feature(713, VIDEO, "session_engagement_time_per_video", "Feature 702 summed", (702,)),
    Feature(714, USER, "scroll_back_times_per_user", "Feature 703 summed", (703,)),
    Feature(715, VIDEO, "scroll_back_times_per_video", "Feature 703 summed", (703,)),
]}


def feature_info(spark: SparkSession) -> DataFrame:
    """The catalogue as a table."""
    return spark.createDataFrame(
        [(f.id, f.table, f.name, f.description) for f in CATALOG.values()],
        OUTPUT["feature_info"])


def select(only: Iterable[int] | None = None, skip: Iterable[int] = ()) -> list[int]:
    """Feature numbers to compute, ascending: those asked for, or all but the skipped.

    Unknown numbers are ignored. Skipping what a remaining feature needs gives a
    warning, for that feature then has nothing to read.
    """
    if only is not None:
        return sorted(set(only) & set(CATALOG))
    chosen = sorted(set(CATALOG) - set(skip))
    lacking = sorted({need for i in chosen for need in CATALOG[i].requires} - set(chosen))
    if lacking:
        warnings.warn(
            "skipped, but needed by others: " + ", ".join(CATALOG[i].name for i in lacking),
            stacklevel=2)
    return chosen
