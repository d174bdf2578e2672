"""Video features against a click-by-click walk."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from learnertrace.operators import video
from learnertrace.operators.dropout import user_dropout
from tests.conftest import START, at, values

PLAY, PAUSE, SEEK = "play_video", "pause_video", "seek_video"


def walk(clicks, sessions):
    """(totals per session, jumps back, long gaps) of one ordered sequence."""
    on, start, previous, last = False, None, 0.0, None
    totals, scrolls, gaps = [0.0], 0, 0
    for kind, spot, moment in clicks:
        minutes = None if last is None else int((moment - last).total_seconds() // 60)
        back = previous is not None and spot is not None and previous > spot
        if minutes is not None:
            scrolls += back and minutes <= 30
            gaps += minutes > 30
        ended, where = False, None
        if on and back:
            ended, where = True, previous
        elif on and kind == PAUSE:
            ended, where = True, spot
        if ended:
            on = False
            if None in (where, start, totals[-1]):
                totals[-1] = None
            else:
                totals[-1] += where - start
        elif on and sessions and minutes is not None and minutes > 30:
            on = False
            totals.append(0.0)
        elif not on and kind == PLAY:
            on, start = True, spot
        previous, last = spot, moment
    return totals, scrolls, gaps


def course_of(make_course, sequences, learners=None):
    """sequences: {(user, video): [(kind, spot, moment), ...]} in order."""
    clicks, number = [], 0
    for (user, clip), sequence in sequences.items():
        for kind, spot, moment in sequence:
            number += 1
            clicks.append((number, user, clip, kind, spot, moment))
    random.Random(1).shuffle(clicks)
    users = learners or sorted({u for u, _ in sequences})
    return make_course(click_events=clicks, submissions=[
        (f"s{u}", u, "p", at(1), 1, 1) for u in users])


def random_sequences(seed, count, length, nulls):
    rng = random.Random(seed)
    sequences = {}
    for i in range(count):
        moment, sequence = START, []
        for _ in range(rng.randint(1, length)):
            moment += timedelta(seconds=rng.choice(
                [0, 1, 30, 600, 1799, 1800, 1859, 1860, 1861, 3599, 3600, 9000]))
            spot = None if nulls and rng.random() < 0.15 else float(rng.randint(0, 6))
            sequence.append((rng.choice([PLAY, PLAY, PAUSE]), spot, moment))
        sequences[f"u{i % 50}", f"v{i // 50}"] = sequence
    return sequences


@pytest.mark.parametrize("nulls", [False, True])
def test_features_equal_the_walk(make_course, nulls):
    sequences = random_sequences(7 + nulls, 1500, 14, nulls)
    course = course_of(make_course, sequences)
    learners = user_dropout(course)
    whole = {pair: walk(s, False) for pair, s in sequences.items()}
    split = {pair: walk(s, True)[0] for pair, s in sequences.items()}
    pair = ("user_id", "video_id")
    assert values(video.pair_features(course, learners, [701]), *pair) == {
        p: t[0] for p, (t, _, _) in whole.items()}
    assert values(video.pair_features(course, learners, [702]), *pair) == {
        p: t[-1] for p, t in split.items()}
    assert values(video.pair_features(course, learners, [703]), *pair) == {
        p: s for p, (_, s, _) in whole.items()}
    every = {(r.user_id, r.video_id, r.session): r.seconds
             for r in video.session_engagement(course, learners).collect()}
    assert every == {(*p, i): v for p, t in split.items() for i, v in enumerate(t)}
    videos = {v for _, v in sequences}
    seen = {v: [g for (_, x), (_, _, g) in whole.items() if x == v] for v in videos}
    assert values(video.video_features(course, learners, [706]), "video_id") == {
        v: round(sum(g) / len(g), 6) for v, g in seen.items()}
    assert values(video.video_features(course, learners, [706], at_least_once=True), "video_id") == {
        v: round(sum(x > 0 for x in g) / len(g), 6) for v, g in seen.items()}


@pytest.mark.parametrize("piece_seconds", [1, 60, 1000, 10**9])
def test_the_cut_does_not_matter(make_course, piece_seconds):
    sequences = random_sequences(11, 300, 30, True)
    course = course_of(make_course, sequences)
    totals = {}
    steps = video.linked(video.pieces(course, piece_seconds))
    steps = video.chained(video.chained(steps, False), True).selectExpr(
        "*", "max(session_s) OVER (PARTITION BY user_id, video_id) AS last_session")
    found = steps.groupBy(*video.PAIR).agg(
        *[F.expr(text).alias(name) for name, text in video.TOTALS.items()])
    for row in found.collect():
        totals[row.user_id, row.video_id] = (
            row.watched, row.last_session, row.scrolls, row.returns)
    assert totals == {
        p: (walk(s, False)[0][0], walk(s, True)[0][-1], *walk(s, True)[1:])
        for p, s in sequences.items()}


def test_one_pair_with_very_many_clicks(make_course):
    """A single long sequence is cut into pieces of an hour at most."""
    rng = random.Random(2)
    sequence = [(rng.choice([PLAY, PAUSE]), float(rng.randint(0, 99)), at(40 * i))
                for i in range(5000)]
    course = course_of(make_course, {("u", "v"): sequence})
    total = walk(sequence, False)[0][0]
    assert values(video.pair_features(course, user_dropout(course), [701]), "user_id") == {"u": total}
    assert video.pieces(course).count() == 5000 * 40 // 3600 + 1


def test_pairs_without_play_or_pause(make_course):
    course = course_of(make_course, {
        ("u", "a"): [(SEEK, 3.0, at(1))], ("u", "b"): [(PAUSE, 3.0, at(1)), (PLAY, 5.0, at(2))],
        ("x", "a"): [(PLAY, 0.0, at(1)), (PAUSE, 9.0, at(2))]}, learners=["u"])
    learners = user_dropout(course)
    assert values(video.pair_features(course, learners, [701]), "user_id", "video_id") == {
        ("u", "a"): 0, ("u", "b"): 0}
    assert values(video.video_features(course, learners, [704]), "video_id") == {"a": 1, "b": 1}
    assert values(video.user_features(course, learners, [705]), "user_id") == {"u": 2}


def test_a_video_no_learner_saw(make_course):
    course = course_of(make_course, {("x", "a"): [(PLAY, 0.0, at(1))],
                                     ("u", "b"): [(PLAY, 0.0, at(1))]}, learners=["u"])
    assert values(video.video_features(course, user_dropout(course), [706]), "video_id") == {
        "a": None, "b": 0}


def test_sums_agree(make_course):
    course = course_of(make_course, random_sequences(5, 400, 10, False))
    features = video.pair_features(course, user_dropout(course), [701])
    per_user = values(video.summed(course, features, 710), "user_id")
    per_video = values(video.summed(course, features, 711), "video_id")
    assert sum(per_user.values()) == pytest.approx(sum(per_video.values()))
