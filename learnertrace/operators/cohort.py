"""Weekly cohorts of learners: wide feature rows, labels, summaries and preparation for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = 1
KEYS = ["user_id", "feature_week"]


def extracted_after(features: DataFrame, moment: str) -> DataFrame:
    """Feature rows of runs stamped later than `moment`."""
    return features.filter(F.col("date_of_extraction") > F.lit(moment).cast("timestamp"))


def names(ids: Sequence[int]) -> list[str]:
    """Columns that hold the features in a wide row."""
    return [f"f{i}" for i in ids]


def _counted(ids: Sequence[int], counts: Column) -> Column:
    """How many features of a wide row satisfy `counts`, a function of the column."""
    terms = [F.when(counts(F.col(c)), 1).otherwise(0) for c in names(ids)]
    return sum(terms[1:], terms[0])


def dropout_histogram(features: DataFrame, last_week: int | None = None) -> DataFrame:
    """Learners by the first week with label 0; those without one stand in the last bin.

    Bins are the weeks that have labels and one more, so every learner is in one. With
    `last_week` that bin also holds those gone in `last_week` or later.
    """
    is_label = F.col("feature_id") == LABEL
    gone = F.min(F.when(is_label & (F.col("feature_value") == 0), F.col("feature_week")))
    if last_week is not None:
        gone = F.when(gone < last_week, gone)
    first = features.groupBy("user_id").agg(gone.alias("first"))
    counts = first.groupBy("first").agg(F.count(F.lit(1)).alias("users"))
    end = F.lit(last_week) if last_week is not None else F.max(F.when(is_label, F.col("feature_week"))) + 1
    bins = features.agg(F.coalesce(end, F.lit(0)).cast("int").alias("end")).select(
        "end", F.explode(F.sequence(F.lit(0), F.col("end"))).alias("week"))
    # One row per course week on either side.
    own = F.when(F.col("week") < F.col("end"), F.col("week"))
    return bins.join(F.broadcast(counts), own.eqNullSafe(F.col("first")), "left").select(
        "week", F.coalesce("users", F.lit(0)).alias("users"))


def wide_features(
    features: DataFrame, ids: Sequence[int], fill: float = -1.0, dense: bool = True,
    drop_all_zero: bool = False, labels: DataFrame | None = None,
) -> DataFrame:
    """One row per learner and week, one column per feature, `fill` where there is none.

    `dense` keeps every labelled learner-week, also those without any feature;
    label rows exist for each learner and course week, so they are the grid and
    no join is needed. They are looked for in `labels`, if given, else in `features`;
    without any the result is empty. Without `dense` only learner-weeks with a listed
    feature stay.
    """
    kind = F.col("feature_id")
    if labels is not None:
        features = features.filter(kind.isin(*ids) & (kind != LABEL)).unionByName(
            labels.filter(kind == LABEL).select(*features.columns))
    wide = (
        features.filter(kind.isin(LABEL, *ids))
        .groupBy(*KEYS)
        .agg(*[F.max(F.when(kind == i, F.col("feature_value"))).alias(f"f{i}") for i in ids],
             F.count_if(kind == LABEL if dense else kind.isin(*ids)).alias("kept"))
        .filter("kept > 0").drop("kept")
        .na.fill(fill, names(ids))
    )
    if drop_all_zero:
        wide = wide.filter(_counted(ids, lambda c: c != 0) > 0)
    return wide


def feature_coverage(features: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Learners with each feature in each week, 0 where a week lacks the feature."""
    kind = F.col("feature_id")
    weekly = features.groupBy("feature_week").agg(
        *[F.count_if(kind == i).alias(f"f{i}") for i in ids])
    return _by_feature(weekly, ids)


def supported_coverage(wide: DataFrame, ids: Sequence[int], missing: float = -1.0) -> DataFrame:
    """The same over the rows of a wide frame, usually those left by `with_support`."""
    weekly = wide.groupBy("feature_week").agg(
        *[F.count_if(F.col(c) != missing).alias(c) for c in names(ids)])
    return _by_feature(weekly, ids)


def overall_coverage(wide: DataFrame, ids: Sequence[int], missing: float = -1.0) -> DataFrame:
    """Learner-weeks that have each feature, over all weeks."""
    total = wide.agg(*[F.count_if(F.col(c) != missing).alias(c) for c in names(ids)])
    return _by_feature(total.withColumn("feature_week", F.lit(0)), ids).drop("feature_week")


def _by_feature(weekly: DataFrame, ids: Sequence[int]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(i).alias("feature_id"), F.col(f"f{i}").alias("users"))
                      for i in ids])
    return weekly.select("feature_week", F.inline(cells))


def feature_count_distribution(
    wide: DataFrame, ids: Sequence[int], missing: float | None = None,
) -> DataFrame:
    """Per week, how many learners have k features: non-zero ones, or those not `missing`."""
    held = _counted(ids, (lambda c: c != 0) if missing is None else (lambda c: c != missing))
    sizes = range(len(ids) + 1)
    weekly = wide.withColumn("held", held).groupBy("feature_week").agg(
        *[F.count_if(F.col("held") == k).alias(f"k{k}") for k in sizes])
    cells = F.array(*[F.struct(F.lit(k).alias("n_features"), F.col(f"k{k}").alias("users"))
                      for k in sizes])
    return weekly.select("feature_week", F.inline(cells))


def class_balance(features: DataFrame) -> DataFrame:
    """Per week, learners gone and learners still active."""
    return features.filter(F.col("feature_id") == LABEL).groupBy("feature_week").agg(
        F.count_if(F.col("feature_value") == 0).alias("dropped"),
        F.count_if(F.col("feature_value") == 1).alias("active"),
    )


def mean_features_by_class(features: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Per week and label, the mean number of non-zero features of a learner."""
    kind = F.col("feature_id")
    learners = features.groupBy(*KEYS).agg(
        F.max(F.when(kind == LABEL, F.col("feature_value"))).cast("int").alias("label"),
        F.count_if(kind.isin(*ids) & (F.col("feature_value") != 0)).alias("held"),
    )
    return (
        learners.filter(F.col("label").isNotNull())
        .groupBy("feature_week", "label").agg(F.avg("held").alias("mean_features"))
    )


def present(ids: Sequence[int], missing: float = -1.0) -> Column:
    """Number of features of a wide row that are not the fill value."""
    return _counted(ids, lambda c: c != missing)


def with_support(
    wide: DataFrame, ids: Sequence[int], min_support: int = 3, missing: float = -1.0,
) -> DataFrame:
    """Learner-weeks with more than `min_support` features."""
    return wide.filter(present(ids, missing) > min_support)


def with_future_label(
    wide: DataFrame, labels: DataFrame, weeks_ahead: int = 1, last_week: int | None = None,
) -> DataFrame:
    """Add the label of `weeks_ahead` weeks later; weeks past the labels, or past `last_week`
    if given, go.

    `labels` is any set of feature rows with those of feature 1.
    """
    ahead = labels.filter(F.col("feature_id") == LABEL).select(
        "user_id", (F.col("feature_week") - weeks_ahead).alias("feature_week"),
        F.col("feature_value").cast("int").alias("label"))
    if last_week is not None:
        wide = wide.filter(F.col("feature_week") <= last_week)
    return wide.join(ahead, KEYS)


def with_future_label_by_learner(wide: DataFrame, labels: DataFrame, weeks_ahead: int = 1) -> DataFrame:
    """`with_future_label` of tables that are stored by learner (`sources.bucketed`), where they lie.

    `labels` has user_id, feature_week and label. The learner alone is the key, so that buckets
    meet without a shuffle; the week, of which a learner has few, is compared within.
    """
    ahead = labels.select("user_id", F.col("feature_week").alias("labelled_week"), F.col("label").cast("int").alias("label"))
    apart = F.col("labelled_week") - F.col("feature_week")
    return (wide.join(ahead.hint("merge"), "user_id")
            .filter((apart >= weeks_ahead) & (apart <= weeks_ahead)).drop("labelled_week"))


def scale_min_max(wide: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Scale every feature to 0..1 within its week; a constant feature becomes 0."""
    return _scaled(wide, wide.groupBy("feature_week").agg(*_bounds(ids)), ids)


def _bounds(ids: Sequence[int]) -> list[Column]:
    return [extreme(c).alias(f"{c}_{end}") for c in names(ids)
            for end, extreme in (("low", F.min), ("high", F.max))]


def _scaled(wide: DataFrame, bounds: DataFrame, ids: Sequence[int]) -> DataFrame:
    scaled = {
        c: f"CASE WHEN {c}_high > {c}_low THEN ({c} - {c}_low) / ({c}_high - {c}_low) ELSE 0D END"
        for c in names(ids)
    }
    # `bounds` has one row per week.
    return wide.join(F.broadcast(bounds), "feature_week").selectExpr(
        *[f"{scaled[c]} AS {c}" if c in scaled else c for c in wide.columns])


def valid_weeks(labelled: DataFrame, min_users: int = 25) -> DataFrame:
    """Weeks with enough learners of whom at least one will be gone."""
    return _valid(labelled.groupBy("feature_week").agg(*_guards()), min_users).select(
        "feature_week", "users")


def _guards() -> list[Column]:
    return [F.count(F.lit(1)).alias("users"), F.min("label").alias("least")]


def _valid(weeks: DataFrame, min_users: int) -> DataFrame:
    return weeks.filter((F.col("users") >= min_users) & (F.col("least") != 1))


def scaled_valid_weeks(
    labelled: DataFrame, ids: Sequence[int], min_users: int = 25,
) -> DataFrame:
    """`scale_min_max` of the rows of the valid weeks, with one aggregate for both."""
    weeks = labelled.groupBy("feature_week").agg(*_guards(), *_bounds(ids))
    return _scaled(labelled, _valid(weeks, min_users), ids)


def in_valid_weeks(labelled: DataFrame, min_users: int = 25) -> DataFrame:
    """The rows of the valid weeks."""
    weeks = valid_weeks(labelled, min_users).select("feature_week")
    kept = labelled.join(F.broadcast(weeks), "feature_week", "left_semi")
    return kept.select(*labelled.columns)


def with_split(wide: DataFrame, test_fraction: float = 0.25, seed: int = 19) -> DataFrame:
    """Mark about `test_fraction` of the rows as `is_test`, by a hash of learner, week and seed.

    A rerun, or a task repeated after a lost executor, makes the same split.
    """
    if not 0 <= test_fraction < 1:
        raise ValueError("test_fraction must be at least 0 and below 1")
    digest = F.md5(F.concat_ws(":", "user_id", F.col("feature_week").cast("string"),
                               F.lit(str(seed))))
    limit = format(int(test_fraction * 16**8), "08x")
    return wide.withColumn("is_test", F.substring(digest, 1, 8) < limit)


def training_rows(split: DataFrame, mode: str = "week", last_week: int | None = None) -> DataFrame:
    """Rows that train the model of each `model_week`, in every mode up to `last_week` if given.

    "week" takes the training part of that week, "all" every row of it, and
    "cumulative" all rows of earlier weeks too, but none of the week's own test
    rows.
    """
    if last_week is not None:
        split = split.filter(F.col("feature_week") <= last_week)
    own = split.withColumn("model_week", F.col("feature_week"))
    if mode == "all":
        return own
    if mode == "week":
        return own.filter(~F.col("is_test"))
    if mode == "cumulative":
        # One row per week that has rows of its own.
        weeks = own.select("model_week").distinct()
        last = split.agg(F.max("feature_week")).scalar()
        later = F.explode(F.sequence(F.col("feature_week"), last))
        return (
            split.withColumn("model_week", later)
            .filter((F.col("model_week") > F.col("feature_week")) | ~F.col("is_test"))
            .join(F.broadcast(weeks), "model_week", "left_semi")
            .select(*own.columns)
        )
    raise ValueError(f"unknown mode {mode!r}")


def feature_cardinality(wide: DataFrame, ids: Sequence[int], missing: float = -1.0) -> DataFrame:
    """Mean number of present features per week."""
    return (
        wide.groupBy("feature_week")
        .agg(F.avg(present(ids, missing)).alias("mean_present"))
    )


def overall_cardinality(wide: DataFrame, ids: Sequence[int], missing: float = -1.0) -> DataFrame:
    return wide.agg(F.avg(present(ids, missing)).alias("mean_present"))


def any_present(wide: DataFrame, ids: Sequence[int], missing: float = -1.0) -> DataFrame:
    """Per week, learners with at least one of the features."""
    return wide.groupBy("feature_week").agg(
        F.count_if(present(ids, missing) > 0).alias("users"))
