"""Weekly features of forum and wiki contributions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.rows import Measure, feature_rows, keep_eligible
from learnertrace.functions.weeks import by_week
from learnertrace.sources.course import Course

# Contribution types by code.
FORUM, RESPONSE, WIKI_EDIT = (1, 2, 3), 2, 4


def contributions(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (3, 4, 5, 14, 201),
) -> DataFrame:
    """Features 3, 4, 5, 14, 201 from one scan: posts, edits, post length, all, responses.

    The length of a post is in bytes.
    """
    kind = F.col("collaboration_type_id")
    post = kind.isin(*FORUM)
    weekly = (
        by_week(course, course.collaborations, "collaboration_timestamp")
        .groupBy("user_id", "feature_week")
        .agg(
            F.count_if(post).alias("posts"),
            F.count_if(kind == WIKI_EDIT).alias("edits"),
            F.avg(F.when(post, F.octet_length("collaboration_content"))).alias("length"),
            F.count(F.lit(1)).alias("contributions"),
            F.count_if(kind == RESPONSE).alias("responses"),
        )
    )
    measures = [
        Measure(3, "posts", "posts"),
        Measure(4, "edits", "edits"),
        Measure(5, "length", "posts"),
        Measure(14, "contributions", "contributions"),
        Measure(201, "responses", "responses"),
    ]
    return feature_rows(course, "user_long_feature", keep_eligible(weekly, dropout),
                        [m for m in measures if m.feature_id in set(ids)])
