"""How learners watch videos, from the stream of play and pause clicks.

A learner's clicks on one video are a sequence in which watching starts with a
play and ends with a pause or with a jump back. Whether a click starts, ends or
changes nothing depends on the state left by all clicks before it, so the plain
plan is a window over each (learner, video). One pair can however hold a large
part of all clicks. Here the sequence is cut at every hour and at every long
gap. Each piece is reduced to one row that says what it adds up to, and which
state it leaves, for either state it may be entered in; then the pieces of a
pair, few and small, are chained.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.functions.rows import Measure, eligible, feature_rows, keep_eligible, stamped
from learnertrace.sources.course import Course

# Event types, and the gap in whole minutes that separates two sittings.
PLAY, PAUSE = "play_video", "pause_video"
GAP_MINUTES = 30

PAIR = ["user_id", "video_id"]
IN_SLOT = "PARTITION BY user_id, video_id, slot ORDER BY observed_event_timestamp, event_id"
IN_PAIR = "PARTITION BY user_id, video_id ORDER BY slot, piece"
UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def pieces(course: Course, piece_seconds: int = 3600) -> DataFrame:
    """One row per uninterrupted piece of a (learner, video) sequence.

    `piece` numbers the pieces inside the time slot `slot`. A piece's first
    click is kept as it is (`first_*`), for what it does depends on the click
    before, which lies in another piece. The rest is summed up twice, as
    `watched_0` and `watched_1`, for a first click that leaves watching off or
    on: positions where watching ended minus positions where it started.
    `unknown_*` counts the ends and starts without a position, `open_*` is the
    position of the last start, made by click number `opened_*`. `leaves` is the
    state after the rest if `settled`, else how often, modulo 2, the rest flips
    the state.
    """
    second = "unix_timestamp(observed_event_timestamp)"
    rows = (
        course.click_events
        .filter(F.col("observed_event_type").isin(PLAY, PAUSE))
        .filter("user_id IS NOT NULL AND video_id IS NOT NULL")
        .selectExpr(
            *PAIR, "event_id", "observed_event_timestamp",
            f"CAST(observed_event_type = '{PLAY}' AS INT) AS play", "video_current_time AS spot",
            f"{second} AS sec", f"{second} DIV {piece_seconds} AS slot")
        .selectExpr("*", f"row_number() OVER ({IN_SLOT}) AS n",
                    f"lag(struct(spot, sec)) OVER ({IN_SLOT}) AS prev")
        .selectExpr(
            "*", "coalesce(prev.spot > spot, false) AS back",
            f"prev IS NULL OR coalesce((sec - prev.sec) DIV 60 > {GAP_MINUTES}, false) AS first")
        # A play that jumps back ends watching if it is on, and starts it if it is off.
        .selectExpr("*", "CAST(NOT first AND play = 1 AND back AS INT) AS flips")
        .selectExpr("*", f"sum(CAST(first AS INT)) OVER ({IN_SLOT} {UPTO}) AS piece",
                    f"sum(flips) OVER ({IN_SLOT} {UPTO}) AS flipped")
        # Any other click settles the state: on after a play, off after a pause.
        .selectExpr("*", f"""
            last(IF(flips = 1, NULL, struct(NOT first AS settled, IF(first, 0, play) AS state,
                                            flipped)), true) OVER ({IN_SLOT} {BEFORE}) AS since""")
        .selectExpr("*", "flipped - flips - since.flipped + since.state AS turns",
                    "IF(back, prev.spot, spot) AS end_spot")
        .selectExpr("*", "turns % 2 = 1 AS on_0",
                    "(turns + IF(since.settled, 0, 1)) % 2 = 1 AS on_1")
    )
    summaries = []
    for entered in (0, 1):
        on = f"on_{entered}"
        closing = f"NOT first AND {on} AND (back OR play = 0)"
        opening = f"NOT first AND NOT {on} AND play = 1"
        summaries += [
            f"coalesce(sum(IF({closing}, end_spot, NULL)), 0D) "
            f"- coalesce(sum(IF({opening}, spot, NULL)), 0D) AS watched_{entered}",
            f"count_if(({closing} AND end_spot IS NULL) OR ({opening} AND spot IS NULL)) "
            f"AS unknown_{entered}",
            f"max(IF({opening}, n, NULL)) AS opened_{entered}",
            f"max_by(spot, IF({opening}, n, NULL)) AS open_{entered}",
        ]
    return rows.groupBy(*PAIR, "slot", "piece").agg(*map(F.expr, [
        "max(IF(first, play, NULL)) AS first_play",
        "max(IF(first, spot, NULL)) AS first_spot",
        "max(IF(first, sec, NULL)) AS first_sec",
        "max_by(spot, n) AS last_spot",
        "max_by(sec, n) AS last_sec",
        "max_by(NOT first AND (flips = 0 OR since.settled), n) AS settled",
        "max_by(IF(first, 0, IF(flips = 1, (turns + 1) % 2, play)), n) AS leaves",
        "count_if(NOT first AND back AND sec IS NOT NULL AND prev.sec IS NOT NULL) AS scrolls",
        *summaries,
    ]))


def linked(pieces: DataFrame) -> DataFrame:
    """The pieces of each pair in order, with what their first click does to the one before."""
    return (
        pieces
        .selectExpr("*", f"row_number() OVER ({IN_PAIR}) AS index",
                    f"lag(struct(last_spot, last_sec)) OVER ({IN_PAIR}) AS prev")
        .selectExpr("*", "first_play = 1 AS play",
                    # Before the first click of all, the position counts as 0.
                    "IF(prev IS NULL, 0D, prev.last_spot) AS prev_spot",
                    "(first_sec - prev.last_sec) DIV 60 AS minutes")
        .selectExpr("*", "coalesce(prev_spot > first_spot, false) AS back",
                    f"coalesce(minutes > {GAP_MINUTES}, false) AS gap",
                    f"coalesce(minutes <= {GAP_MINUTES}, false) AS near")
    )


def chained(linked: DataFrame, *sessions: bool) -> DataFrame:
    """Add what really happened in each piece, for either way of `sessions`.

    With sessions, a play after a long gap while watching is on breaks the
    session: what was open is dropped, and the session number counts up, at the
    end to `sessions_s`. The added columns end in `_s` then, else in `_t`. Ways
    asked for together share their windows.
    """
    ways = [("s", "gap") if way else ("t", "false") for way in sessions]
    end_spot = "IF(back, prev_spot, first_spot)"
    steps = linked.selectExpr("*", *[f"play AND (back OR {breaks}) AS flips_{end}" for end, breaks in ways])
    numbers, found = [], []
    stages: list[list[str]] = [[], [], [], []]
    for end, breaks in ways:
        parity = f"IF(fixed_{end}, 0, to_{end})"
        reset = f"enters_{end} = 1 AND play AND NOT back AND {breaks}"
        closing = f"enters_{end} = 1 AND NOT ({reset}) AND (back OR NOT play)"
        opening = f"enters_{end} = 0 AND play"
        rest = f"IF(inner_{end} = 1, {{0}}_1, {{0}}_0)".format
        fixed, turned, since, enters = stages
        fixed += [f"settled OR NOT flips_{end} AS fixed_{end}",
                  f"IF(settled, leaves, (leaves + IF(flips_{end}, 1, first_play)) % 2) AS to_{end}"]
        turned += [f"sum({parity}) OVER ({IN_PAIR} {UPTO}) AS turned_{end}"]
        since += [f"last(IF(fixed_{end}, struct(to_{end} AS to, turned_{end} AS turned), NULL), true) "
                  f"OVER ({IN_PAIR} {BEFORE}) AS since_{end}"]
        enters += [f"(coalesce(since_{end}.to, 0) + turned_{end} - {parity} - coalesce(since_{end}.turned, 0)) % 2 "
                   f"AS enters_{end}"]
        numbers += [f"IF(flips_{end}, 1 - enters_{end}, first_play) AS inner_{end}"]
        numbers += [f"sum(CAST({reset} AS INT)) OVER ({IN_PAIR} {frame}) AS {name}_{end}"
                    for name, frame in (("session", UPTO), ("sessions", WHOLE)) if end == "s" or frame == UPTO]
        found += [f"session_{end}", *(["sessions_s"] if end == "s" else []),
            f"IF(fixed_{end}, to_{end}, (enters_{end} + to_{end}) % 2) AS exits_{end}",
            f"{rest('watched')} + IF({closing}, coalesce({end_spot}, 0D), 0D) "
            f"- IF({opening}, coalesce(first_spot, 0D), 0D) AS watched_{end}",
            f"{rest('unknown')} + CAST({closing} AND {end_spot} IS NULL AS INT) "
            f"+ CAST({opening} AND first_spot IS NULL AS INT) AS unknown_{end}",
            f"{rest('opened')} IS NOT NULL OR ({opening}) AS opened_{end}",
            f"IF({rest('opened')} IS NOT NULL, {rest('open')}, first_spot) AS open_{end}"]
    for added in [*stages, numbers]:
        steps = steps.selectExpr("*", *added)
    return steps.selectExpr(*linked.columns, *found)


def _seconds(end: str, counted: str = "true") -> str:
    """Aggregate over pieces: seconds watched in those that count.

    What was started but never ended does not count: its start, subtracted with
    all others, is added back. The total is NULL if any position it needs is.
    """
    dangling = f"max_by(exits_{end}, IF({counted}, index, NULL)) = 1"
    start = f"max_by(open_{end}, IF({counted} AND opened_{end}, index, NULL))"
    return (
        f"IF(sum(IF({counted}, unknown_{end}, 0)) = IF({dangling} AND {start} IS NULL, 1, 0), "
        f"sum(IF({counted}, watched_{end}, 0D)) + IF({dangling}, coalesce({start}, 0D), 0D), "
        f"NULL)"
    )


def session_engagement(course: Course, dropout: DataFrame) -> DataFrame:
    """Seconds watched in every session, numbered from 0; the last one is feature 702."""
    sessions = (
        chained(linked(pieces(course)), True)
        .groupBy(*PAIR, F.col("session_s").cast("int").alias("session"))
        .agg(F.expr(_seconds("s")).alias("seconds"))
    )
    return keep_eligible(sessions, dropout).select(*PAIR, "session", "seconds")


# Feature -> what has to be known of each pair; features 704 and 705 count pairs.
NEEDS = {701: "watched", 702: "last_session", 703: "scrolls", 706: "returns", 707: "returns"}
TOTALS = {
    "watched": _seconds("t"),
    "last_session": _seconds("s", "session_s = last_session"),
    "scrolls": "sum(scrolls + CAST(back AND near AS INT))",
    "returns": "count_if(gap)",
}


def pairs(course: Course, ids: Iterable[int] = tuple(NEEDS)) -> DataFrame:
    """Every (learner, video) pair with any click, and what the features need of it.

    The totals come from one pass over the play and pause clicks, the pairs from a second
    scan of all clicks; a pair without play or pause has 0 everywhere.
    """
    viewers = course.click_events.select(*PAIR).distinct()
    wanted = sorted({NEEDS[i] for i in ids if i in NEEDS})
    if not wanted:
        return viewers
    steps = linked(pieces(course))
    ways = [way for total, way in (("watched", False), ("last_session", True)) if total in wanted]
    if ways:
        steps = chained(steps, *ways)
    if "last_session" in wanted:
        steps = steps.withColumnRenamed("sessions_s", "last_session")
    totals = steps.groupBy(*PAIR).agg(*[F.expr(TOTALS[t]).alias(t) for t in wanted],
                                      F.lit(True).alias("found"))
    return viewers.join(totals, PAIR, "left").selectExpr(
        *PAIR, *[f"IF(found, {t}, 0) AS {t}" for t in wanted])


def pair_features(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (701, 702, 703),
    known: DataFrame | None = None,
) -> DataFrame:
    """Features 701, 702, 703: seconds watched, the same in the last session, jumps back.

    `known` may give the result of `pairs`, here and below.
    """
    frame = pairs(course, ids) if known is None else known
    return feature_rows(course, "user_video_feature", keep_eligible(frame, dropout),
                        [Measure(i, NEEDS[i], "1") for i in ids])


def video_features(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (704, 706),
    known: DataFrame | None = None, at_least_once: bool = False,
) -> DataFrame:
    """Features 704, learners per video, and 706, returns to a video per learner who saw it.

    Feature 706 has a row for every clicked video, with NULL if no eligible
    learner saw it. `at_least_once` gives the share of learners who returned at
    all instead.
    """
    frame = pairs(course, ids) if known is None else known
    sums = ["count(known) AS learners", "count(*) AS anyone"]
    if 706 in ids:
        sums.append(f"sum(IF(known, {_times(at_least_once)}, NULL)) AS returns")
    known_learner = eligible(dropout).withColumn("known", F.lit(True))
    videos = frame.join(known_learner, "user_id", "left").groupBy("video_id").agg(
        *map(F.expr, sums))
    rate = "IF(video_id IS NOT NULL, try_divide(returns, learners), NULL)"
    measures = [Measure(704, "learners", "learners"), Measure(706, rate, "anyone")]
    return feature_rows(course, "video_feature", videos,
                        [m for m in measures if m.feature_id in ids])


def user_features(
    course: Course, dropout: DataFrame, ids: Iterable[int] = (705, 707),
    known: DataFrame | None = None, at_least_once: bool = False,
) -> DataFrame:
    """Features 705, videos per learner, and 707, a learner's returns to videos per video seen."""
    frame = pairs(course, ids) if known is None else known
    sums = ["count(video_id) AS videos", "count(*) AS anything"]
    if 707 in ids:
        sums.append(f"sum({_times(at_least_once)}) AS returns")
    users = frame.groupBy("user_id").agg(*map(F.expr, sums))
    measures = [Measure(705, "videos", "anything"),
                Measure(707, "try_divide(returns, videos)", "anything")]
    return feature_rows(course, "user_feature", keep_eligible(users, dropout),
                        [m for m in measures if m.feature_id in ids])


def _times(at_least_once: bool) -> str:
    return "CAST(returns > 0 AS INT)" if at_least_once else "returns"


# Feature -> (table, entity, feature that is summed).
SUMS = {
    710: ("user_feature", "user_id", 701),
    711: ("video_feature", "video_id", 701),
    712: ("user_feature", "user_id", 702),
    713: ("video_feature", "video_id", 702),
    714: ("user_feature", "user_id", 703),
    715: ("video_feature", "video_id", 703),
}


def summed(course: Course, features: DataFrame, feature_id: int) -> DataFrame:
    """Features 710-715: a per-pair feature summed over videos or over learners."""
    table, entity, source = SUMS[feature_id]
    total = (
        features.filter(F.col("feature_id") == source)
        .groupBy(entity).agg(F.sum("feature_value").alias("total"))
    )
    return stamped(course, table, feature_id, total, "total")
