"""Weekly features of observed events: time spent, regularity, reaction."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.rows import Measure, feature_rows, keep_eligible
from learnertrace.functions.weeks import by_week, seconds_of_day, seconds_since_start, week
from learnertrace.sources.course import Course

TABLE = "user_long_feature"

# Resource types by code.
LECTURE, BOOK, WIKI = 4, 3, 7
RESOURCE_FEATURES = {16: "lectures", 17: "books", 18: "wikis"}


def valid_events(course: Course) -> DataFrame:
    return course.observed_events.filter("validity = 1")


def time_spent(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (2, 15, 16, 17, 18),
) -> DataFrame:
    """Features 2, 15, 16, 17, 18: total and longest time, and time by kind of resource.

    All of them come out of one scan. A url shown by several resources counts once per
    resource, as a join to the resources would; here that number is a multiplier on a table
    with one row per url, so events are never duplicated. Events are summed per learner, week
    and url before they meet that table, so a url with a third of all events (or events without
    url) is a row per learner and week in the join.
    """
    ids = set(ids)
    duration = F.col("observed_event_duration")
    events = by_week(course, valid_events(course), "observed_event_timestamp")
    keys = ["user_id", "feature_week"]
    parts = [F.count(F.lit(1)).alias("events"), F.sum(duration).alias("total"),
             F.max(duration).alias("longest")]
    sums, measures = [], []
    if 2 in ids or 15 in ids:
        measures += [Measure(2, "total", "events"),
                     Measure(15, "longest", "events")]
        sums = parts
    by_kind = {i: column for i, column in RESOURCE_FEATURES.items() if i in ids}
    if by_kind:
        wanted = resources_per_url(course).select("url_id", *by_kind.values())
        how = "left" if sums else "inner"
        events = events.groupBy(*keys, "url_id").agg(*parts).join(wanted, "url_id", how)
        if sums:
            sums = [F.sum("events").alias("events"), F.sum("total").alias("total"),
                    F.max("longest").alias("longest")]
        for feature_id, column in by_kind.items():
            shown = F.col(column)
            sums += [F.sum(F.col("total") * shown).alias(f"total_{column}"),
                     F.sum(F.col("events") * shown).alias(f"events_{column}")]
            measures.append(Measure(feature_id, f"total_{column}", f"events_{column}"))
    weekly = events.groupBy(*keys).agg(*sums)
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in ids])


def resources_per_url(course: Course) -> DataFrame:
    """url_id -> number of lecture, book and wiki resources it shows, NULL for none.

    Books and wikis also have to be of a declared resource type. Resources are
    counted per uri before the join, so a uri shared by many of them is one row.
    """
    declared = (
        course.resource_types.filter(F.col("resource_type_id").isin(BOOK, WIKI))
        .groupBy("resource_type_id").agg(F.count(F.lit(1)).alias("declared"))
    )
    per_uri = (
        course.resources.filter(F.col("resource_type_id").isin(LECTURE, BOOK, WIKI))
        .groupBy("resource_uri", "resource_type_id").agg(F.count(F.lit(1)).alias("n"))
        # At most two rows: the filter above leaves two possible keys.
        .join(F.broadcast(declared), "resource_type_id", "left")
    )
    kind = F.col("resource_type_id")
    counts = per_uri.groupBy("resource_uri").agg(
        F.sum(F.when(kind == LECTURE, F.col("n"))).alias("lectures"),
        F.sum(F.when(kind == BOOK, F.col("n") * F.col("declared"))).alias("books"),
        F.sum(F.when(kind == WIKI, F.col("n") * F.col("declared"))).alias("wikis"),
    )
    return (
        course.urls.join(counts, F.col("url") == F.col("resource_uri"))
        .groupBy("url_id")
        .agg(*[F.sum(c).alias(c) for c in RESOURCE_FEATURES.values()])
    )


def timestamp_deviation(course: Course, dropout: DataFrame) -> DataFrame:
    """Feature 13: spread of the times of day at which a learner was seen in a week.

    Each distinct second counts once, the resolution of the source's times.
    """
    moment = F.col("moment")
    moments = by_week(course, valid_events(course), "observed_event_timestamp")
    weekly = (
        moments.select("user_id", "feature_week", F.date_trunc("second", "observed_event_timestamp").alias("moment"))
        .distinct()
        .groupBy("user_id", "feature_week")
        .agg(F.stddev_pop(seconds_of_day(moment)).alias("spread"),
             F.count(F.lit(1)).alias("moments"))
    )
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [Measure(13, "spread", "moments")])


def hours_deviation(course: Course, dropout: DataFrame) -> DataFrame:
    """Feature 301: spread of the hours at which a learner works, in any week."""
    seen = valid_events(course).select("user_id", F.col("observed_event_timestamp").alias("moment"))
    wrote = course.collaborations.select(
        "user_id", F.col("collaboration_timestamp").alias("moment"))
    moment = F.col("moment")
    weekly = (
        seen.unionByName(wrote)
        .groupBy("user_id", week(course, moment).alias("feature_week"))
        .agg(F.stddev_pop(F.hour(moment)).alias("spread"), F.count(F.lit(1)).alias("moments"))
    )
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [Measure(301, "spread", "moments")])


# Seconds in one unit of reaction time.
REACTION_UNITS = {"seconds": 1, "days": 86400}


def releases_per_url(course: Course) -> DataFrame:
    """url_id -> number of its resources, of those with a release, and the sum of the releases.

    A url with many resources is one row, so an event that meets it is never multiplied.
    """
    release = seconds_since_start(course, F.col("resource_release_timestamp")).cast("double")
    return (
        course.resources_urls.join(
            course.resources.select("resource_id", release.alias("release")), "resource_id")
        .groupBy("url_id")
        .agg(F.count(F.lit(1)).alias("resources"), F.count("release").alias("dated"),
             F.coalesce(F.sum("release"), F.lit(0.0)).alias("releases"))
    )


def reaction_time(course: Course, dropout: DataFrame, unit: str = "seconds") -> DataFrame:
    """Feature 302: average time from the release of a resource to its use, in any week.

    Events are summed per learner, week and url before they meet the releases.
    """
    moment = seconds_since_start(course, F.col("observed_event_timestamp")).cast("double")
    seen = (
        valid_events(course)
        .groupBy("user_id", week(course, F.col("observed_event_timestamp")).alias("feature_week"), "url_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count("observed_event_timestamp").alias("timed"),
             F.sum(moment).alias("moments"))
    )
    weekly = (
        seen.join(releases_per_url(course), "url_id").groupBy("user_id", "feature_week")
        .agg(F.sum(F.col("moments") * F.col("dated") - F.col("timed") * F.col("releases")).alias("waited"),
             F.sum(F.col("timed") * F.col("dated")).alias("uses"),
             F.sum(F.col("n") * F.col("resources")).alias("pairs"))
    )
    average = f"try_divide(waited, uses * {REACTION_UNITS[unit]})"
    return feature_rows(course, TABLE, keep_eligible(weekly, dropout),
                        [Measure(302, average, "pairs")])
