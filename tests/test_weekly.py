"""Weekly features on small tables that show one rule each."""

import pytest

from learnertrace.operators import collaboration, observed, submissions
from learnertrace.operators.dropout import dropout, user_dropout
from learnertrace.plans.features import feature
from tests.conftest import at, weekly


def only(course, number):
    return weekly(feature(course, user_dropout(course), number))


def event(user, moment, duration=1.0, valid=1, url=1):
    return (0, user, moment, duration, valid, url)


def submission(number, user, problem, moment, attempt=1, valid=1):
    return (str(number), user, problem, moment, attempt, valid)


def test_week_edges(make_course):
    moments = [at(-1), at(0), at(604799), at(604800), at(weeks=5) - (at(1) - at(0)), at(weeks=5)]
    course = make_course(observed_events=[event("u", m) for m in moments])
    assert only(course, 2) == {("u", 0): 2, ("u", 1): 1, ("u", 4): 1}


def test_only_valid_events_of_learners_who_submitted(make_course):
    course = make_course(observed_events=[
        event("u", at(1), 5.0), event("u", at(2), 9.0, valid=0), event("stranger", at(1))])
    assert only(course, 2) == {("u", 0): 5}
    assert only(course, 15) == {("u", 0): 5}


def test_unknown_durations(make_course):
    course = make_course(observed_events=[event("u", at(1), None), event("v", at(1), None),
                                          event("v", at(2), 3.0)])
    assert only(course, 2) == {("u", 0): None, ("v", 0): 3}


def test_last_submission(make_course):
    course = make_course(submissions=[
        submission("a", "u", "p", at(weeks=2)), submission("b", "u", "p", at(weeks=2)),
        submission("c", "u", "p", at(weeks=1)), submission("d", "v", "p", None),
        submission("e", "w", "p", at(0)), submission("f", "w", "p", None)])
    rows = {r.user_id: r for r in user_dropout(course).collect()}
    assert rows["u"].last_submission_id == "b" and rows["u"].dropout_week == 3
    assert rows["u"].dropout_timestamp == at(weeks=2)
    assert rows["v"].dropout_week is None and rows["v"].last_submission_id is None
    assert rows["w"].last_submission_id == "e" and rows["w"].dropout_week == 1


def test_label_counts_down(make_course):
    course = make_course(weeks=3, submissions=[
        submission("a", "u", "p", at(weeks=1)), submission("b", "v", "p", None)])
    labels = weekly(dropout(course, user_dropout(course)))
    assert labels == {("u", 0): 1, ("u", 1): 1, ("u", 2): 0}


def test_distinct_moments(make_course):
    course = make_course(observed_events=[
        event("u", at(0)), event("u", at(0)), event("u", at(10)), event("v", at(5))])
    assert only(course, 13) == {("u", 0): 5, ("v", 0): 0}


def test_hours_of_events_and_contributions_in_any_week(make_course):
    course = make_course(
        observed_events=[event("u", at(0)), event("u", at(days=-3))],
        collaborations=[("u", 9, at(seconds=2 * 3600), "x")])
    assert only(course, 301) == {("u", 0): 1, ("u", -1): 0}


@pytest.fixture
def shelf(make_course):
    """Url 1 shows two lectures and a book, url 2 a wiki page of no declared type."""
    return make_course(
        observed_events=[event("u", at(1), 2.0, url=1), event("u", at(2), 5.0, url=2),
                         event("v", at(3), 7.0, url=3), event("w", at(3), 7.0, url=None)],
        urls=[(1, "/a"), (2, "/b"), (3, "/c")],
        resources=[(10, "/a", 4, at(0)), (11, "/a", 4, at(1)), (12, "/a", 3, None),
                   (13, "/b", 7, at(0))],
        resources_urls=[(10, 1), (12, 1), (13, 2)],
        resource_types=[(3,), (4,)])


def test_time_by_kind_of_resource(shelf):
    assert only(shelf, 16) == {("u", 0): 4}
    assert only(shelf, 17) == {("u", 0): 2}
    assert only(shelf, 18) == {}
    together = observed.time_spent(shelf, user_dropout(shelf)).collect()
    assert {(r.feature_id, r.user_id): r.feature_value for r in together} == {
        (2, "u"): 7, (2, "v"): 7, (2, "w"): 7, (15, "u"): 5, (15, "v"): 7, (15, "w"): 7,
        (16, "u"): 4, (17, "u"): 2}


def test_reaction_time_ignores_undated_resources(shelf):
    assert only(shelf, 302) == {("u", 0): 1.5}
    days = observed.reaction_time(shelf, user_dropout(shelf), "days")
    assert weekly(days) == {("u", 0): round(1.5 / 86400, 6)}


def test_contributions(make_course):
    course = make_course(collaborations=[
        ("u", 1, at(1), "é"), ("u", 2, at(2), "abcd"), ("u", 4, at(3), "edit"),
        ("v", 4, at(4), "edit"), ("v", 9, at(5), "x"), ("w", 2, at(6), None)])
    rows = collaboration.contributions(course, user_dropout(course)).collect()
    assert {(r.feature_id, r.user_id): r.feature_value for r in rows} == {
        (3, "u"): 2, (3, "w"): 1, (4, "u"): 1, (4, "v"): 1, (5, "u"): 3, (5, "w"): None,
        (14, "u"): 3, (14, "v"): 2, (14, "w"): 1, (201, "u"): 1, (201, "w"): 1}


def test_attempts(make_course):
    course = make_course(
        submissions=[submission(1, "u", "p", at(1)), submission(2, "u", "p", at(2)),
                     submission(3, "u", "q", at(3)), submission(4, "u", "r", at(4), valid=0),
                     submission(5, "v", None, at(5))],
        assessments=[("1", 1.0), ("1", 1.0), ("2", 0.0), ("3", 0.0), ("4", 1.0), ("5", 1.0)])
    rows = submissions.attempts(course, user_dropout(course)).collect()
    assert {(r.feature_id, r.user_id): r.feature_value for r in rows} == {
        (6, "u"): 2, (7, "u"): 3, (8, "u"): 1, (208, "u"): 2,
        (6, "v"): 0, (7, "v"): 1, (8, "v"): 0, (208, "v"): 1}
    assert only(course, 8) == {("u", 0): 1, ("v", 0): 0}
    assert only(course, 209) == {("u", 0): round(2 / 3, 6), ("v", 0): 1}


def test_an_invalid_last_attempt_hides_the_problem(make_course):
    course = make_course(submissions=[
        submission(1, "u", "p", at(1), 1), submission(2, "u", "p", at(2), 2),
        submission(3, "u", "p", at(3), 3, valid=0), submission(4, "u", "q", at(4), 5),
        submission(5, "v", "p", at(weeks=1), 2), submission(6, "v", "p", at(weeks=-1), 1),
        submission(7, "w", "p", at(1), 1), submission(8, "w", "p", at(weeks=9), 2)])
    assert only(course, 9) == {("u", 0): 5, ("v", 1): 2}
    assert only(course, 12) == {("u", 0): 0, ("v", 1): 1}


def test_repeated_extreme_attempts_weigh_more(make_course):
    course = make_course(submissions=[
        submission(1, "u", "p", at(1), 1), submission(2, "u", "p", at(2), 1),
        submission(3, "u", "p", at(3), 4), submission(4, "u", "p", at(4), 4),
        submission(5, "u", "q", at(5), 7)])
    # p: two last times two first attempts, 3 apart; q: one pair, 0 apart.
    assert only(course, 12) == {("u", 0): round(4 * 3 / 5, 6)}
    assert only(course, 9) == {("u", 0): 5}


def test_solving_time(make_course):
    course = make_course(submissions=[
        submission(1, "u", "p", at(10)), submission(2, "u", "p", at(70)),
        submission(3, "u", "q", at(5))])
    assert weekly(submissions.solving_time(course, user_dropout(course))) == {("u", 0): 30}


def test_grades(make_course):
    course = make_course(
        submissions=[submission(1, "u", "h0", at(1)), submission(2, "u", "l0", at(1)),
                     submission(3, "u", "l1", at(1)), submission(4, "u", "h9", at(1))],
        assessments=[("1", 1.0), ("1", 1.0), ("2", 1.0), ("3", 1.0), ("4", 1.0)],
        problems=[("h0", 1, 0, None), ("x0", 1, 0, None), ("l0", 3, 0, None), ("l1", 3, 1, None),
                  ("h9", 1, 9, None)])
    learners = user_dropout(course)
    assert only(course, 204) == {("u", 0): 1}
    # No homework in week 1: the lab grade has nothing to be divided by.
    assert only(course, 206) == {("u", 0): 0.5, ("u", 1): None}
    labs = submissions.grades(course, learners, [206], submissions.LAB)
    assert weekly(labs) == {("u", 0): 1, ("u", 1): 1}


def test_time_before_deadline(make_course):
    course = make_course(
        submissions=[submission(1, "u", "p", at(40)), submission(2, "u", "q", at(50))],
        problems=[("p", 1, 0, at(100)), ("q", 1, 0, None)])
    assert only(course, 210) == {("u", 0): -60}


def test_missing_table(make_course):
    course = make_course()
    tables = {k: v for k, v in course.tables.items() if k != "collaborations"}
    bare = type(course)(tables, course.start, course.weeks, course.stamp)
    with pytest.raises(LookupError):
        collaboration.contributions(bare, user_dropout(bare))
    assert only(bare, 1)
