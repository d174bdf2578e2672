"""Schemas of the activity tables that are read and the feature tables that are written."""

ACTIVITY = {
    "observed_events": (
        "observed_event_id BIGINT, user_id STRING, observed_event_timestamp TIMESTAMP, "
        "observed_event_duration DOUBLE, validity INT, url_id BIGINT"
    ),
    "submissions": (
        "submission_id STRING, user_id STRING, problem_id STRING, submission_timestamp TIMESTAMP, "
        "submission_attempt_number INT, validity INT"
    ),
    "assessments": "submission_id STRING, assessment_grade DOUBLE",
    "problems": (
        "problem_id STRING, problem_type_id INT, problem_week INT, problem_hard_deadline TIMESTAMP"
    ),
    "collaborations": (
        "user_id STRING, collaboration_type_id INT, collaboration_timestamp TIMESTAMP, "
        "collaboration_content STRING"
    ),
    "click_events": (
        "event_id BIGINT, user_id STRING, video_id STRING, observed_event_type STRING, "
        "video_current_time DOUBLE, observed_event_timestamp TIMESTAMP"
    ),
    "urls": "url_id BIGINT, url STRING",
    "resources": (
        "resource_id BIGINT, resource_uri STRING, resource_type_id INT, "
        "resource_release_timestamp TIMESTAMP"
    ),
    "resources_urls": "resource_id BIGINT, url_id BIGINT",
    "resource_types": "resource_type_id INT",
}

# Names and columns of the output tables.
OUTPUT = {
    "user_dropout": (
        "user_id STRING, last_submission_id STRING, dropout_week INT, dropout_timestamp TIMESTAMP"
    ),
    "feature_info": (
        "feature_id INT, feature_table STRING, feature_name STRING, feature_description STRING"
    ),
    "user_feature": (
        "feature_id INT, user_id STRING, feature_value DOUBLE, date_of_extraction TIMESTAMP"
    ),
    "user_long_feature": (
        "feature_id INT, user_id STRING, feature_week INT, feature_value DOUBLE, "
        "date_of_extraction TIMESTAMP"
    ),
    "video_feature": (
        "feature_id INT, video_id STRING, feature_value DOUBLE, date_of_extraction TIMESTAMP"
    ),
    "user_video_feature": (
        "feature_id INT, user_id STRING, video_id STRING, feature_value DOUBLE, "
        "date_of_extraction TIMESTAMP"
    ),
}

# Which entity a row of each feature table describes.
ENTITY = {
    "user_feature": ["user_id"],
    "user_long_feature": ["user_id", "feature_week"],
    "video_feature": ["video_id"],
    "user_video_feature": ["user_id", "video_id"],
}
