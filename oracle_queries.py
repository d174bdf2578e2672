"""The same results in DuckDB SQL, written from the meaning of each operator.

`sql(name)` puts together the views a query needs: the course, the learners,
and the features it starts from.
"""

from __future__ import annotations

import re

# The course over the test tables, as in learnertrace/sources/driver_tables.py.
COURSE_SQL = {
    "ev": """
        SELECT *, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec,
               CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
        FROM events""",
    "observed_events": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, sec, value AS duration,
               event_type <> 'error' AS valid, event_id // 5 AS url_id
        FROM ev""",
    "submissions": """
        SELECT CAST(event_id AS VARCHAR) AS submission_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(user_id * 14 + k % 20 AS VARCHAR) AS problem_id,
               sec * nullif(user_id % 6, 0) // 5 AS sec,
               CAST(1 + floor(value / 20) AS BIGINT) AS attempt, event_type <> 'error' AS valid
        FROM ev WHERE event_type IN ('purchase', 'signup', 'error')""",
    "assessments": """
        SELECT CAST(event_id AS VARCHAR) AS submission_id,
               CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS grade
        FROM ev WHERE event_type IN ('purchase', 'signup', 'error')""",
    "problems": """
        SELECT CAST(p_partkey AS VARCHAR) AS problem_id,
               CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END AS kind,
               p_partkey % 5 AS problem_week, (p_partkey % 5 + 1) * 604800 AS deadline
        FROM part""",
    "collaborations": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, 1 + k % 4 AS kind, sec, text AS content
        FROM ev JOIN documents ON doc_id = event_id // 10
        WHERE event_type = 'signup'
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), 1 + k % 4, sec, text
        FROM documents JOIN ev ON event_id = doc_id * 5 + doc_id % 5""",
    "clicks": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, 'v' || (k % 10) AS video_id,
               CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'pause' ELSE 'seek' END
                 AS kind,
               CASE WHEN value >= 1 THEN value END AS spot, sec // 200 AS sec
        FROM ev WHERE event_type IN ('view', 'click', 'purchase')""",
    "urls": "SELECT p_partkey AS url_id, '/u/' || p_partkey AS url FROM part",
    "resources": """
        SELECT 1000000 + p_partkey AS resource_id, '/u/' || (p_partkey - p_partkey % 2) AS uri,
               1 + p_size % 8 AS kind, p_size * 3600 AS release
        FROM part""",
    "resources_urls": """
        SELECT 1000000 + p_partkey AS resource_id, p_partkey - p_partkey % 2 AS url_id FROM part""",
    "resource_types": "SELECT DISTINCT 1 + p_size % 8 AS kind FROM part",
}

COHORT_SQL = {
    "user_dropout": """
        SELECT user_id, any_value(last_id) AS last_submission_id,
               CAST(floor(max(sec) / 604800.0) + 1 AS INTEGER) AS dropout_week,
               max(sec) AS last_sec
        FROM (SELECT user_id, sec, first_value(CASE WHEN sec IS NOT NULL THEN submission_id END)
                OVER (PARTITION BY user_id ORDER BY sec DESC NULLS LAST, submission_id DESC)
                AS last_id
              FROM submissions)
        GROUP BY user_id""",
    "learner": "SELECT user_id FROM user_dropout WHERE dropout_week IS NOT NULL",
    "week_events": """
        SELECT o.*, CAST(sec // 604800 AS INTEGER) AS week FROM observed_events o
        JOIN learner USING (user_id) WHERE valid AND sec >= 0 AND sec < 5 * 604800""",
    "week_submissions": """
        SELECT s.*, CAST(sec // 604800 AS INTEGER) AS week FROM submissions s
        JOIN learner USING (user_id) WHERE valid AND sec >= 0 AND sec < 5 * 604800""",
    "week_correct": """
        SELECT s.* FROM week_submissions s JOIN assessments USING (submission_id)
        WHERE grade = 1""",
    "week_contributions": """
        SELECT c.*, CAST(sec // 604800 AS INTEGER) AS week FROM collaborations c
        JOIN learner USING (user_id) WHERE sec >= 0 AND sec < 5 * 604800""",
    "kind_events": """
        SELECT e.user_id, week, duration, r.kind, t.kind AS declared
        FROM week_events e JOIN urls u USING (url_id) JOIN resources r ON r.uri = u.url
        LEFT JOIN resource_types t ON t.kind = r.kind""",
    "last_tries": """
        SELECT * FROM week_submissions s
        WHERE attempt = (SELECT max(attempt) FROM submissions a
                         WHERE a.user_id = s.user_id AND a.problem_id = s.problem_id)""",
    "first_tries": """
        SELECT * FROM submissions s
        WHERE attempt = (SELECT min(attempt) FROM submissions a
                         WHERE a.user_id = s.user_id AND a.problem_id = s.problem_id)""",
    "correct_by_problem": """
        SELECT s.user_id, p.kind, p.problem_week AS week, count(*) AS n
        FROM submissions s JOIN learner USING (user_id) JOIN assessments a USING (submission_id)
        JOIN problems p USING (problem_id)
        WHERE s.valid AND a.grade = 1 AND p.problem_week BETWEEN 0 AND 4
        GROUP BY ALL""",
    "pairs": "SELECT DISTINCT user_id, video_id FROM clicks",
    "learner_pairs": "SELECT * FROM pairs JOIN learner USING (user_id)",
    "steps": """
        SELECT user_id, video_id, spot, sec, kind = 'play' AS play,
               row_number() OVER (PARTITION BY user_id, video_id ORDER BY sec, event_id) AS n
        FROM clicks WHERE kind IN ('play', 'pause')""",
    # One click at a time: the state after each, with and without session breaks.
    "walk": """
        SELECT DISTINCT user_id, video_id, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS last_at,
               CAST(NULL AS BIGINT) AS last_sec,
               false AS on1, CAST(NULL AS DOUBLE) AS from1, CAST(0 AS DOUBLE) AS total1,
               false AS on2, CAST(NULL AS DOUBLE) AS from2, CAST(0 AS DOUBLE) AS total2,
               0 AS session
        FROM steps
        UNION ALL
        SELECT user_id, video_id, n, spot, sec,
               CASE WHEN on1 THEN play AND NOT back ELSE play END,
               CASE WHEN play AND NOT on1 THEN spot ELSE from1 END,
               CASE WHEN on1 AND back THEN total1 + last_at - from1
                    WHEN on1 AND NOT play THEN total1 + spot - from1 ELSE total1 END,
               CASE WHEN on2 THEN play AND NOT back AND NOT gap ELSE play END,
               CASE WHEN play AND NOT on2 THEN spot ELSE from2 END,
               CASE WHEN on2 AND back THEN total2 + last_at - from2
                    WHEN on2 AND NOT play THEN total2 + spot - from2
                    WHEN on2 AND gap THEN 0 ELSE total2 END,
               CASE WHEN on2 AND play AND NOT back AND gap THEN session + 1 ELSE session END
        FROM (SELECT s.*, w.last_at, w.on1, w.from1, w.total1, w.on2, w.from2, w.total2, w.session,
                     coalesce(w.last_at > s.spot, false) AS back,
                     coalesce((s.sec - w.last_sec) // 60 > 30, false) AS gap
              FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.video_id = w.video_id
                                      AND s.n = w.n + 1)""",
    "watched": """
        SELECT * FROM walk
        QUALIFY row_number() OVER (PARTITION BY user_id, video_id ORDER BY n DESC) = 1""",
    "hops": """
        SELECT b.user_id, b.video_id, (b.sec - a.sec) // 60 AS minutes, a.spot > b.spot AS back
        FROM steps a JOIN steps b ON a.user_id = b.user_id AND a.video_id = b.video_id
                                 AND b.n = a.n + 1""",
    "returns": """
        SELECT user_id, video_id, count(*) AS n FROM hops WHERE minutes > 30 GROUP BY ALL""",
}

PER = "GROUP BY user_id, week"


def _kind(kind: int, declared: bool) -> str:
    extra = " AND declared IS NOT NULL" if declared else ""
    return f"SELECT user_id, week, sum(duration) AS v FROM kind_events WHERE kind = {kind}{extra} {PER}"


def _ratio(above: int, below: int) -> str:
    return f"""
        SELECT user_id, week, CASE WHEN b.v = 0 THEN 0 ELSE a.v / b.v END AS v
        FROM f{above} a JOIN f{below} b USING (user_id, week)"""


def _change(source: int, extra: str = "") -> str:
    return f"""
        SELECT b.user_id, b.week, coalesce(b.v / nullif(a.v, 0), 0) AS v
        FROM f{source} a JOIN f{source} b ON a.user_id = b.user_id AND a.week + 1 = b.week{extra}"""


def _progress(source: int) -> str:
    return f"""
        SELECT user_id, week,
               v - (SELECT avg(v) FROM f{source} h WHERE h.user_id = f.user_id AND h.week < f.week)
                 AS v
        FROM f{source} f WHERE week >= 1"""


def _grade(kind: int) -> str:
    return f"""
        SELECT user_id, week,
               n / nullif((SELECT count(*) FROM problems WHERE kind = 1 AND problem_week = week), 0)
                 AS v
        FROM correct_by_problem WHERE kind = {kind}"""


WEEKLY_SQL = {
    1: """
        SELECT user_id, week, CASE WHEN dropout_week > week THEN 1 ELSE 0 END AS v
        FROM user_dropout, (SELECT unnest(range(5)) AS week) WHERE dropout_week IS NOT NULL""",
    2: f"SELECT user_id, week, sum(duration) AS v FROM week_events {PER}",
    3: f"SELECT user_id, week, count(*) AS v FROM week_contributions WHERE kind <= 3 {PER}",
    4: f"SELECT user_id, week, count(*) AS v FROM week_contributions WHERE kind = 4 {PER}",
    5: f"""
        SELECT user_id, week, avg(strlen(content)) AS v
        FROM week_contributions WHERE kind <= 3 {PER}""",
    6: f"SELECT user_id, week, count(DISTINCT problem_id) AS v FROM week_submissions {PER}",
    7: f"SELECT user_id, week, count(*) AS v FROM week_submissions {PER}",
    8: f"SELECT user_id, week, count(DISTINCT problem_id) AS v FROM week_correct {PER}",
    9: f"SELECT user_id, week, avg(attempt) AS v FROM last_tries {PER}",
    10: _ratio(2, 8),
    11: _ratio(6, 8),
    12: f"""
        SELECT user_id, week, avg(l.attempt - f.attempt) AS v
        FROM last_tries l JOIN (SELECT user_id, problem_id, attempt FROM first_tries) f
        USING (user_id, problem_id) {PER}""",
    13: f"""
        SELECT user_id, week, stddev_pop(sec % 86400) AS v
        FROM (SELECT DISTINCT user_id, week, sec FROM week_events) {PER}""",
    14: f"SELECT user_id, week, count(*) AS v FROM week_contributions {PER}",
    15: f"SELECT user_id, week, max(duration) AS v FROM week_events {PER}",
    16: _kind(4, False),
    17: _kind(3, True),
    18: _kind(7, True),
    103: _change(3),
    104: _change(4),
    105: _change(5, " JOIN f3 p ON p.user_id = a.user_id AND p.week = a.week WHERE p.v > 5"),
    109: _change(9),
    110: _change(10),
    111: _change(11),
    112: _change(12),
    201: f"SELECT user_id, week, count(*) AS v FROM week_contributions WHERE kind = 2 {PER}",
    202: """
        SELECT f.user_id, f.week,
               50.0 * (count(*) FILTER (o.v < f.v) + count(*) FILTER (o.v <= f.v) + 1) / count(*)
                 AS v
        FROM f9 f JOIN f9 o ON o.week = f.week GROUP BY f.user_id, f.week""",
    203: "SELECT user_id, week, v / (SELECT max(v) FROM f9 o WHERE o.week = f.week) AS v FROM f9 f",
    204: _grade(1),
    205: _progress(204),
    206: _grade(3),
    207: _progress(206),
    208: f"SELECT user_id, week, count(*) AS v FROM week_correct {PER}",
    209: _ratio(208, 7),
    210: f"""
        SELECT user_id, week, avg(sec - deadline) AS v
        FROM week_submissions JOIN problems USING (problem_id) {PER}""",
    301: f"""
        SELECT user_id, CAST(floor(sec / 604800.0) AS INTEGER) AS week,
               stddev_pop(sec // 3600 % 24) AS v
        FROM (SELECT user_id, sec FROM observed_events WHERE valid
              UNION ALL SELECT user_id, sec FROM collaborations)
        JOIN learner USING (user_id) {PER}""",
    302: f"""
        SELECT user_id, CAST(floor(sec / 604800.0) AS INTEGER) AS week, avg(sec - release) AS v
        FROM observed_events JOIN learner USING (user_id) JOIN resources_urls USING (url_id)
        JOIN resources USING (resource_id) WHERE valid {PER}""",
}


def _pair(value: str) -> str:
    return f"""
        SELECT p.user_id, p.video_id, CASE WHEN w.n IS NULL THEN 0 ELSE {value} END AS v
        FROM learner_pairs p LEFT JOIN watched w USING (user_id, video_id)"""


def _sum(source: int, entity: str) -> str:
    return f"SELECT {entity}, sum(v) AS v FROM f{source} GROUP BY {entity}"


PAIR_SQL = {
    701: _pair("total1"),
    702: _pair("total2"),
    703: """
        SELECT user_id, video_id, count(*) FILTER (minutes <= 30 AND back) AS v
        FROM learner_pairs LEFT JOIN hops USING (user_id, video_id) GROUP BY ALL""",
}
VIDEO_SQL = {
    704: "SELECT video_id, count(*) AS v FROM learner_pairs GROUP BY video_id",
    706: """
        SELECT c.video_id,
               (SELECT coalesce(sum(n), 0) FROM returns JOIN learner USING (user_id)
                WHERE video_id = c.video_id)
               / (SELECT v FROM f704 WHERE video_id = c.video_id) AS v
        FROM (SELECT DISTINCT video_id FROM clicks) c""",
    711: _sum(701, "video_id"),
    713: _sum(702, "video_id"),
    715: _sum(703, "video_id"),
}
USER_SQL = {
    705: "SELECT user_id, count(*) AS v FROM learner_pairs GROUP BY user_id",
    707: """
        SELECT user_id, coalesce((SELECT sum(n) FROM returns r WHERE r.user_id = f.user_id), 0) / v
                 AS v
        FROM f705 f""",
    710: _sum(701, "user_id"),
    712: _sum(702, "user_id"),
    714: _sum(703, "user_id"),
}

FEATURE_SQL = {**WEEKLY_SQL, **PAIR_SQL, **VIDEO_SQL, **USER_SQL}
STAMP = "'2024-02-01 00:00:00' AS date_of_extraction"
VALUE = "round(CAST(v AS DOUBLE), 6) + 0 AS feature_value"


def _keys(feature_id: int) -> str:
    if feature_id in WEEKLY_SQL:
        return "user_id, week AS feature_week"
    if feature_id in PAIR_SQL:
        return "user_id, video_id"
    return "video_id" if feature_id in VIDEO_SQL else "user_id"


def feature_select(feature_id: int, source: str | None = None) -> str:
    return (f"SELECT {feature_id} AS feature_id, {_keys(feature_id)}, {VALUE}, {STAMP} "
            f"FROM {source or f'f{feature_id}'}")


# The features of the weekly models, and the wide rows made of them.
MODEL_IDS = (2, 3, 6, 7, 8, 15, 16, 208, 209, 210)


def _terms(condition: str, join: str = " + ") -> str:
    return join.join(f"CAST(f{i} {condition} AS INTEGER)" for i in MODEL_IDS)


MODEL_SQL = {
    "long": " UNION ALL ".join(
        f"SELECT {i} AS id, user_id, week, CAST(v AS DOUBLE) AS v FROM f{i}"
        for i in (1, *MODEL_IDS)),
    "grid": "SELECT user_id, week, v AS label FROM f1",
    "wide": "SELECT user_id, week, "
            + ", ".join(f"coalesce((SELECT CAST(v AS DOUBLE) FROM f{i} x WHERE x.user_id = "
                        f"g.user_id AND x.week = g.week), -1) AS f{i}" for i in MODEL_IDS)
            + " FROM grid g",
    "zero_wide": "SELECT user_id, week, "
                 + ", ".join(f"CASE WHEN f{i} = -1 THEN 0 ELSE f{i} END AS f{i}" for i in MODEL_IDS)
                 + " FROM wide",
    "supported": f"SELECT * FROM wide WHERE {_terms('<> -1')} > 3",
    "labelled": """
        SELECT s.*, CAST(g.label AS INTEGER) AS label FROM supported s
        JOIN grid g ON g.user_id = s.user_id AND g.week = s.week + 1""",
    "weeks": """
        SELECT week, count(*) AS users FROM labelled GROUP BY week
        HAVING count(*) >= 25 AND min(label) < 1""",
    "ready": "SELECT * FROM labelled WHERE week IN (SELECT week FROM weeks)",
    "scaled": "SELECT user_id, week, label, "
              + ", ".join(f"CASE WHEN max(f{i}) OVER w > min(f{i}) OVER w THEN (f{i} - min(f{i}) "
                          f"OVER w) / (max(f{i}) OVER w - min(f{i}) OVER w) ELSE 0 END AS f{i}"
                          for i in MODEL_IDS)
              + " FROM ready WINDOW w AS (PARTITION BY week)",
    "split": """
        SELECT *, substr(md5(user_id || ':' || week || ':19'), 1, 8) < '40000000' AS is_test
        FROM scaled""",
    # Weeks whose training rows have both classes.
    "taught": """
        SELECT week FROM split WHERE NOT is_test GROUP BY week HAVING count(DISTINCT label) > 1""",
    "taught_so_far": """
        SELECT m.week FROM split s JOIN (SELECT DISTINCT week FROM split) m ON s.week <= m.week
        WHERE s.week < m.week OR NOT s.is_test GROUP BY m.week HAVING count(DISTINCT s.label) > 1""",
    "halves": "SELECT user_id, week, label, CAST(user_id AS BIGINT) % 2 AS odd FROM labelled",
    # A score that is a rule instead of a fitted model.
    "scores": """
        SELECT user_id, week, label, (f6 + f7) / 2 AS score,
               CASE WHEN (f6 + f7) / 2 > 0.5 THEN 1 ELSE 0 END AS prediction
        FROM scaled""",
    "roc": """
        SELECT s.week, t.score AS threshold,
               count(*) FILTER (label = 0 AND s.score >= t.score)
                 / nullif(count(*) FILTER (label = 0), 0) AS fpr,
               count(*) FILTER (label = 1 AND s.score >= t.score)
                 / nullif(count(*) FILTER (label = 1), 0) AS tpr
        FROM scores s JOIN (SELECT DISTINCT week, score FROM scores) t ON t.week = s.week
        GROUP BY s.week, t.score""",
    # Share of (active, gone) pairs that the score puts in the right order, ties half.
    "auc": """
        SELECT w.week, coalesce(a.auc, -1) AS auc
        FROM (SELECT DISTINCT week FROM scores) w LEFT JOIN (
            SELECT p.week, avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5
                               ELSE 0 END) AS auc
            FROM scores p JOIN scores n ON p.week = n.week AND p.label = 1 AND n.label = 0
            GROUP BY p.week) a USING (week)""",
    "weekly_report": f"""
        SELECT * FROM (
            SELECT week, count(*) AS test_users, count(*) FILTER (label = prediction) AS correct,
                   count(*) FILTER (label = 0 AND prediction = 0) AS c00,
                   count(*) FILTER (label = 0 AND prediction = 1) AS c01,
                   count(*) FILTER (label = 1 AND prediction = 0) AS c10,
                   count(*) FILTER (label = 1 AND prediction = 1) AS c11
            FROM scores GROUP BY week)
        JOIN auc USING (week) JOIN (
            SELECT week, count(*) AS users, avg({_terms('<> -1')}) AS mean_present, {
                ", ".join(f"count(*) FILTER (f{i} <> -1) AS users_f{i}" for i in MODEL_IDS)}
            FROM supported GROUP BY week) USING (week)""",
}

USERS = ", ".join(f"users_f{i}" for i in MODEL_IDS)
DETERMINED = "user_id, week AS feature_week, label, true AS in_range, true AS is_class"
IDS_VALUES = ", ".join(f"({i})" for i in MODEL_IDS)
WIDE_COLUMNS = ", ".join(f"round(f{i}, 6) + 0 AS f{i}" for i in MODEL_IDS)
COUNTS = ", ".join(f"({k})" for k in range(len(MODEL_IDS) + 1))

FINAL_SQL = {
    "p01_user_dropout": """
        SELECT user_id, last_submission_id, dropout_week,
               strftime(TIMESTAMP '2024-01-01' + to_seconds(last_sec), '%Y-%m-%d %H:%M:%S')
                 AS dropout_timestamp
        FROM user_dropout""",
    "f012t_solving_time": feature_select(12, f"""
        (SELECT user_id, week, avg(took) AS v
         FROM (SELECT user_id, week, problem_id, max(sec) - min(sec) AS took
               FROM week_submissions GROUP BY ALL) {PER})"""),
    "f206l_lab_grade_per_lab_problem": feature_select(206, """
        (SELECT user_id, week, n / nullif((SELECT count(*) FROM problems
                WHERE kind = 3 AND problem_week = week), 0) AS v
         FROM correct_by_problem WHERE kind = 3)"""),
    "f302d_time_to_react_days": feature_select(
        302, "(SELECT user_id, week, v / 86400 AS v FROM f302)"),
    "f702s_session_engagement": """
        SELECT user_id, video_id, session, round(total2, 6) + 0 AS seconds
        FROM (SELECT * FROM walk QUALIFY row_number() OVER
                (PARTITION BY user_id, video_id, session ORDER BY n DESC) = 1)
        JOIN learner USING (user_id)""",
    "f706f_rewatched_share_per_video": feature_select(706, """
        (SELECT video_id, count(n) / count(*) AS v
         FROM learner_pairs LEFT JOIN returns USING (user_id, video_id) GROUP BY video_id)"""),
    "f707f_rewatched_share_per_user": feature_select(707, """
        (SELECT user_id, count(n) / count(*) AS v
         FROM learner_pairs LEFT JOIN returns USING (user_id, video_id) GROUP BY user_id)"""),
    "s01_partitioned_files": " UNION ALL ".join(feature_select(i) for i in (2, 6, 7, 13, 15)),
    "s03_stored_features": " UNION ALL ".join(feature_select(i) for i in (2, 15)),
    "s07_extracted_after": " UNION ALL ".join(feature_select(i) for i in (3, 4, 5, 14, 201)).replace(
        STAMP, "'2024-03-01 00:00:00' AS date_of_extraction"),
    "s10_populate": " UNION ALL ".join(feature_select(i) for i in WEEKLY_SQL),
    **{name: " UNION ALL ".join(feature_select(i) for i in WEEKLY_SQL)
       for name in ("t01_user_long_feature", "t01p_one_plan", "s11_incremental")},
    "t02_user_feature": " UNION ALL ".join(feature_select(i) for i in USER_SQL),
    "t03_video_feature": " UNION ALL ".join(feature_select(i) for i in VIDEO_SQL),
    "t04_user_video_feature": " UNION ALL ".join(feature_select(i) for i in PAIR_SQL),
    "m01_dropout_histogram": """
        SELECT CAST(b.week AS INTEGER) AS week, count(first) AS users
        FROM (SELECT unnest(range((SELECT max(week) + 2 FROM grid))) AS week) b
        LEFT JOIN (SELECT coalesce(min(week) FILTER (id = 1 AND v = 0),
                                   (SELECT max(week) + 1 FROM grid)) AS first
                   FROM long GROUP BY user_id) ON first = b.week
        GROUP BY b.week""",
    "m03o_overall_coverage": " UNION ALL ".join(
        f"SELECT {i} AS feature_id, count(*) FILTER (f{i} <> -1) AS users FROM supported"
        for i in MODEL_IDS),
    "m02_wide_features": f"SELECT user_id, week AS feature_week, {WIDE_COLUMNS} FROM wide",
    "m02z_wide_features_zero_fill": f"""
        SELECT user_id, week AS feature_week, {WIDE_COLUMNS} FROM zero_wide
        WHERE {_terms('<> 0')} > 0""",
    "m03_feature_coverage": f"""
        SELECT w.week AS feature_week, i.id AS feature_id, count(l.id) AS users
        FROM (SELECT DISTINCT week FROM long) w
        CROSS JOIN (SELECT * FROM (VALUES {IDS_VALUES}) t(id)) i
        LEFT JOIN long l ON l.week = w.week AND l.id = i.id GROUP BY ALL""",
    "m03s_supported_coverage": " UNION ALL ".join(
        f"SELECT week AS feature_week, {i} AS feature_id, count(*) FILTER (f{i} <> -1) AS users "
        f"FROM supported GROUP BY week" for i in MODEL_IDS),
    "m04_feature_count_distribution": f"""
        SELECT w.week AS feature_week, k AS n_features, count(h.week) AS users
        FROM (SELECT DISTINCT week FROM zero_wide) w
        CROSS JOIN (SELECT * FROM (VALUES {COUNTS}) t(k))
        LEFT JOIN (SELECT week, {_terms('<> 0')} AS held FROM zero_wide) h
          ON h.week = w.week AND held = k
        GROUP BY ALL""",
    "m05_class_balance": """
        SELECT week AS feature_week, count(*) FILTER (label = 0) AS dropped,
               count(*) FILTER (label = 1) AS active FROM grid GROUP BY week""",
    "m06_mean_features_by_class": f"""
        SELECT z.week AS feature_week, CAST(label AS INTEGER) AS label,
               round(avg({_terms('<> 0')}), 6) AS mean_features
        FROM zero_wide z JOIN grid USING (user_id, week) GROUP BY z.week, label""",
    "m07_with_support": f"SELECT user_id, week AS feature_week, {WIDE_COLUMNS} FROM supported",
    "m08_with_future_label": f"""
        SELECT user_id, week AS feature_week, label, {WIDE_COLUMNS} FROM labelled""",
    "s08_by_learner": f"""
        SELECT user_id, week AS feature_week, label, {WIDE_COLUMNS} FROM labelled""",
    "m09_scale_min_max": f"""
        SELECT user_id, week AS feature_week, label, {WIDE_COLUMNS} FROM scaled""",
    "s08_reopened_frame": f"""
        SELECT user_id, week AS feature_week, label, is_test, {WIDE_COLUMNS} FROM split""",
    "m10_valid_weeks": "SELECT week AS feature_week, users FROM weeks",
    "m11_with_split": """
        SELECT user_id, week AS feature_week, label,
               substr(md5(user_id || ':' || week || ':19'), 1, 8) < '40000000' AS is_test
        FROM labelled""",
    "m13_training_rows_week": """
        SELECT week AS model_week, week AS feature_week, user_id, label FROM split
        WHERE NOT is_test""",
    "m13a_training_rows_all": """
        SELECT week AS model_week, week AS feature_week, user_id, label FROM split""",
    "m13c_training_rows_cumulative": """
        SELECT m.week AS model_week, s.week AS feature_week, s.user_id, s.label
        FROM split s JOIN (SELECT DISTINCT week FROM split) m ON s.week <= m.week
        WHERE s.week < m.week OR NOT s.is_test""",
    **{f"m12_{model}": f"SELECT {DETERMINED} FROM split JOIN taught USING (week) WHERE is_test"
       for model in ("logistic_regression", "svm", "decision_tree", "random_forest", "neural_network")},
    **{f"m12c_{model}": "SELECT week AS feature_week, CAST(0 AS DOUBLE) AS residual FROM taught"
       for model in ("logistic_regression", "svm", "decision_tree")},
    "m13f_cumulative_model": f"""
        SELECT {DETERMINED} FROM split WHERE is_test AND week IN (SELECT week FROM taught_so_far)""",
    "m13fc_cumulative_model": "SELECT week AS feature_week, CAST(0 AS DOUBLE) AS residual FROM taught_so_far",
    "m20_transfer": f"""
        SELECT {DETERMINED} FROM halves h JOIN (
            SELECT week FROM halves GROUP BY week
            HAVING count(*) FILTER (odd = 0) >= 10 AND count(DISTINCT label) FILTER (odd = 0) = 2
               AND count(*) FILTER (odd = 1) >= 10 AND min(label) FILTER (odd = 1) < 1)
          USING (week) WHERE odd = 1""",
    "m21_ensemble": """
        SELECT user_id, week AS feature_week, label, round((f6 + f7 + f2 + f15) / 4, 6) + 0 AS score,
               CASE WHEN ((f6 + f7) / 2 + (f2 + f15) / 2) / 2 > 0.5 THEN 1 ELSE 0 END AS prediction
        FROM scaled""",
    "m22_compare_models": """
        SELECT model, week AS feature_week, count(*) AS n, true AS is_share, true AS is_auc
        FROM split JOIN taught USING (week)
        CROSS JOIN (VALUES ('logistic_regression'), ('decision_tree')) t(model)
        WHERE is_test GROUP BY model, week""",
    "s09_report_weekly": f"""
        SELECT week AS feature_week, week + 1 AS predicted_week, round(correct / test_users, 6) AS accuracy,
               round(auc, 6) AS auc, users, test_users, correct, test_users - correct AS incorrect,
               c00, c01, c10, c11, {USERS}, round(mean_present, 6) AS mean_present
        FROM weekly_report""",
    "s09_report_total": f"""
        SELECT sum(users) AS users, sum(test_users) AS test_users, sum(correct) AS correct,
               sum(test_users - correct) AS incorrect,
               round(sum(correct) / sum(test_users), 6) AS accuracy,
               round(avg(auc) FILTER (auc <> -1), 6) AS mean_auc,
               {", ".join(f"sum(users_f{i}) AS users_f{i}" for i in MODEL_IDS)},
               round(sum(mean_present * users) / sum(users), 6) AS mean_present
        FROM weekly_report""",
    "m14_accuracy": """
        SELECT week AS feature_week, count(*) AS n,
               round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy
        FROM scores GROUP BY week""",
    "m14o_overall_accuracy": """
        SELECT count(*) AS n, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy
        FROM scores""",
    "m15_confusion": """
        SELECT w.week AS feature_week, a.x AS label, b.x AS prediction, count(s.week) AS n
        FROM (SELECT DISTINCT week FROM scores) w
        CROSS JOIN (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) b(x)
        LEFT JOIN scores s ON s.week = w.week AND s.label = a.x AND s.prediction = b.x
        GROUP BY ALL""",
    "m16_roc": """
        SELECT week AS feature_week, round(threshold, 6) + 0 AS threshold, round(fpr, 6) AS fpr,
               round(tpr, 6) AS tpr
        FROM roc""",
    "m17_auc": "SELECT week AS feature_week, round(auc, 6) AS auc FROM auc",
    "m17m_mean_auc": "SELECT round(avg(auc), 6) AS mean_auc FROM auc WHERE auc <> -1",
    "m18_feature_cardinality": f"""
        SELECT week AS feature_week, round(avg({_terms('<> -1')}), 6) AS mean_present
        FROM supported GROUP BY week""",
    "m18o_overall_cardinality": f"""
        SELECT round(avg({_terms('<> -1')}), 6) AS mean_present FROM supported""",
    "m19_any_present": """
        SELECT week AS feature_week, count(*) FILTER (f208 <> -1 OR f209 <> -1 OR f210 <> -1)
                 AS users
        FROM supported GROUP BY week""",
}

# In an order in which each view comes after those it uses.
VIEWS = {**COURSE_SQL, **COHORT_SQL, **{f"f{i}": text for i, text in FEATURE_SQL.items()},
         **MODEL_SQL}


def with_views(body: str) -> str:
    """`body` preceded by the views whose names occur in it, directly or through others."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        found = set(re.findall(r"\w+", texts.pop())) & set(VIEWS) - needed
        needed |= found
        texts += [VIEWS[name] for name in found]
    views = ",\n".join(f"{name} AS ({text.strip()})" for name, text in VIEWS.items()
                       if name in needed)
    return f"WITH RECURSIVE {views}\n{body.strip()}"


# Queries over the same activity drawn out to 20 weeks.
LONG_SQL = {
    "f205l_20_weeks": feature_select(205),
    "f207l_20_weeks": feature_select(207),
    "m01l_20_weeks": FINAL_SQL["m01_dropout_histogram"],
    "m08l_20_weeks": FINAL_SQL["m08_with_future_label"],
    "m13cl_20_weeks": FINAL_SQL["m13c_training_rows_cumulative"],
}


def drawn_out(query: str) -> str:
    """`query` over a course of 20 weeks, as `course(..., weeks=20)` gives it."""
    for short, long in [
        ("CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec",
         "(CAST(floor(epoch(ts)) AS BIGINT) - 1704067200) * 4 AS sec"),
        ("5 * 604800", "20 * 604800"), ("range(5)", "range(20)"), ("p_partkey % 5", "p_partkey % 20"),
        ("BETWEEN 0 AND 4", "BETWEEN 0 AND 19"),
    ]:
        query = query.replace(short, long)
    return query
