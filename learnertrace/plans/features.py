"""Plans that compute any set of features, and the run that stores them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.operators import collaboration, derived, observed, states, submissions, video
from learnertrace.operators.dropout import dropout as label
from learnertrace.operators.dropout import user_dropout
from learnertrace.plans.catalog import CATALOG, feature_info, select
from learnertrace.sources.course import Course
from learnertrace.sources.schemas import ENTITY
from learnertrace.sources.store import FeatureStore, at_once, dropped, written

# Features that come out of one scan together: (their numbers, their operator).
FAMILIES: list[tuple[tuple[int, ...], Callable[[Course, DataFrame, list[int]], DataFrame]]] = [
    ((1,), lambda c, d, ids: label(c, d)),
    ((2, 15, 16, 17, 18), observed.time_spent),
    ((3, 4, 5, 14, 201), collaboration.contributions),
    ((6, 7, 8, 208), submissions.attempts),
    ((9, 12), submissions.attempt_spans),
    ((13,), lambda c, d, ids: observed.timestamp_deviation(c, d)),
    ((204, 206), submissions.grades),
    ((210,), lambda c, d, ids: submissions.time_before_deadline(c, d)),
    ((301,), lambda c, d, ids: observed.hours_deviation(c, d)),
    ((302,), lambda c, d, ids: observed.reaction_time(c, d)),
]
# The same for features of (learner, video) pairs, which share one pass over the clicks.
VIDEO_FAMILIES: list[tuple[tuple[int, ...], Callable[..., DataFrame]]] = [
    ((701, 702, 703), video.pair_features),
    ((704, 706), video.video_features),
    ((705, 707), video.user_features),
]
VIDEO = {i for ids, _ in VIDEO_FAMILIES for i in ids}
BASE = VIDEO | {i for ids, _ in FAMILIES for i in ids}


def base_features(
    course: Course, dropout: DataFrame, ids: Iterable[int], known_states: states.States | None = None,
    known_pairs: DataFrame | None = None,
) -> dict[tuple[int, ...], DataFrame]:
    """Rows of each family that has wanted features, by those features.

    With `known_states` the weekly features are rolled up from these instead of the activity, with
    `known_pairs` those of videos from what is known of the (learner, video) pairs.
    """
    wanted = set(ids)
    parts = {}
    weekly = FAMILIES if known_states is None else [FAMILIES[0], *[
        (family, partial(rolled_up, operator, known_states)) for family, operator in states.ROLLUPS.items()]]
    for family, operator in weekly:
        chosen = tuple(i for i in family if i in wanted)
        if chosen:
            parts[chosen] = operator(course, dropout, chosen)
    if known_pairs is None and wanted & VIDEO:
        known_pairs = video.pairs(course, wanted & VIDEO)
    for family, operator in VIDEO_FAMILIES:
        chosen = tuple(i for i in family if i in wanted)
        if chosen:
            parts[chosen] = operator(course, dropout, chosen, known_pairs)
    return parts


def rolled_up(operator: Callable[..., DataFrame], known: states.States, course: Course, dropout: DataFrame,
              ids: Iterable[int]) -> DataFrame:
    return operator(course, known, dropout, ids)


def stored_states(course: Course, ids: Iterable[int] = tuple(CATALOG), used: list[str] | None = None) -> states.States:
    """The states that some features are rolled up from, each written out from one scan."""
    known = states.states(course, kinds=states.kinds_for(sources(ids))).tables()
    stored = at_once(next(iter(known.values())).sparkSession,
                     [partial(written, rows, used=used) for rows in known.values()])
    return states.States(**dict(zip(known, stored)))


def stored_pairs(course: Course, ids: Iterable[int], used: list[str] | None = None) -> DataFrame | None:
    """What some features need of the (learner, video) pairs, written out; None if nothing."""
    wanted = sources(ids) & VIDEO
    return written(video.pairs(course, wanted), used=used) if wanted else None


def derive(course: Course, features: DataFrame, ids: Iterable[int]) -> DataFrame:
    """Features of one table computed from `features`, rows that include what those require that are
    not computed from others themselves."""
    ids = set(ids)
    parts = []
    if ids & derived.TOGETHER:
        parts.append(derived.together(course, features, ids & derived.TOGETHER))
    if 202 in ids:
        parts.append(derived.percentile(course, features))
    parts += [video.summed(course, features, i) for i in sorted(ids) if i in video.SUMS]
    return union(parts)


def sources(ids: Iterable[int]) -> set[int]:
    """The features taken from activity that some features are derived from, directly or not."""
    return {i for i in needed(ids) if i in BASE}


def needed(ids: Iterable[int]) -> list[int]:
    """The features and everything that those derived from features require, ascending."""
    found: set[int] = set()
    waiting = list(ids)
    while waiting:
        feature_id = waiting.pop()
        if feature_id not in found:
            found.add(feature_id)
            waiting += () if feature_id in BASE else CATALOG[feature_id].requires
    return sorted(found)


def features(
    course: Course, dropout: DataFrame | None = None, table: str = "user_long_feature",
    only: Iterable[int] | None = None, skip: Iterable[int] = (), known_states: states.States | None = None,
) -> DataFrame:
    """Rows of one feature table for the selected features, as one plan.

    Each family is built once, with all its features that anything here needs.
    Derived features start from those same rows, so Spark finds the same
    exchange under each of them and shuffles the activity only once. With `known_states` weekly
    features, and who dropped out when, come from these.
    """
    if dropout is None:
        dropout = user_dropout(course) if known_states is None else states.user_dropout(
            course, known_states.submissions)
    ids = [i for i in select(only, skip) if CATALOG[i].table == table]
    if not ids:
        raise ValueError(f"no selected feature belongs to {table}")
    every = needed(ids)
    rows = base_features(course, dropout, every, known_states=known_states)
    if len(rows) > 1:
        rows = {members: apart(frame, CATALOG[members[0]].table) for members, frame in rows.items()}
    parts = []
    for members, frame in rows.items():
        wanted = [i for i in members if i in ids]
        if len(wanted) == len(members):
            parts.append(frame)
        elif wanted:
            parts.append(frame.filter(f"feature_id IN ({', '.join(map(str, wanted))})"))
    derivations = [i for i in ids if i not in BASE]
    if derivations:
        inputs = [frame for members, frame in rows.items() if sources(derivations) & set(members)]
        parts.append(derive(course, union(inputs), derivations))
    return union(parts)


def feature(course: Course, dropout: DataFrame, feature_id: int) -> DataFrame:
    """One feature as one plan, from the activity tables up."""
    return features(course, dropout, CATALOG[feature_id].table, only=[feature_id])


def apart(rows: DataFrame, table: str) -> DataFrame:
    """Feature rows of a family that gets tasks of its own.

    Families end in joins by learner, and Spark runs the parts of a union that are dealt out alike in
    the same tasks, which would then hold the sorted input of all families at once.
    """
    return rows.hint("rebalance", *ENTITY[table])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def populate(
    course: Course, store: FeatureStore, only: Iterable[int] | None = None,
    skip: Iterable[int] = (), fresh: bool = True,
) -> list[int]:
    """Prepare the tables and store the selected features; returns their numbers.

    Every stage starts from a stored table: the states of the activity and who dropped out when, then
    the features taken from these, then those derived from them, all of a table in one write. What a
    stage stores is written at the same time. What a
    derived feature requires is computed for it even if it is not selected, and then not stored. With
    `fresh` the tables are created anew, otherwise earlier runs are kept; what is stored of this
    run's selected features is replaced.
    """
    spark = store.spark
    ids = select(only, skip)
    every, used = needed(ids), []
    known_pairs, known, _ = at_once(spark, [
        lambda: stored_pairs(course, every, used), lambda: stored_states(course, every, used),
        lambda: store.replace("feature_info", feature_info(spark))])
    store.replace("user_dropout", states.user_dropout(course, known.submissions))
    if fresh:
        for table in ENTITY:
            store.create(table)
    dropout = store.read("user_dropout")
    unstored: dict[int, DataFrame] = {}
    writes: dict[str, list[tuple[DataFrame, list[int]]]] = {}
    for members, rows in base_features(course, dropout, every, known, known_pairs).items():
        kept = [i for i in members if i in ids]
        for i in members:
            if i not in ids:
                unstored[i] = rows.filter(F.col("feature_id") == i)
        if kept:
            rows = rows if len(kept) == len(members) else rows.filter(F.col("feature_id").isin(*kept))
            writes.setdefault(CATALOG[members[0]].table, []).append((rows, kept))
    store.append_all(writes, course.stamp)
    writes = {}
    for table in ENTITY:
        derivations = [i for i in ids if i not in BASE and CATALOG[i].table == table]
        if derivations:
            requires = sources(derivations)
            inputs = [unstored[i] for i in requires if i in unstored]
            stored: dict[str, list[int]] = {}
            for i in requires - set(unstored):
                stored.setdefault(CATALOG[i].table, []).append(i)
            inputs += [store.read(name, members, course.stamp) for name, members in stored.items()]
            writes[table] = [(derive(course, union(inputs), derivations), derivations)]
    store.append_all(writes, course.stamp)
    dropped(spark, *used)
    return ids
