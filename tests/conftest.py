import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from learnertrace.sources.course import Course
from learnertrace.sources.schemas import ACTIVITY

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds=0, days=0, weeks=0):
    """A moment that long after the start of the course."""
    return START + timedelta(seconds=seconds, days=days, weeks=weeks)


@pytest.fixture
def make_course(spark):
    """A course from lists of rows; tables not given are empty.

    Unless given, one submission in the first week makes learners u, v, w eligible.
    """
    def make(weeks=5, **tables):
        tables.setdefault("submissions", [
            (f"s-{u}", u, "p0", at(10), 1, 0) for u in ("u", "v", "w")])
        return Course(
            {name: spark.createDataFrame(tables.get(name, []), ddl)
             for name, ddl in ACTIVITY.items()},
            "2024-01-01 00:00:00", weeks, "2024-02-01 00:00:00")
    return make


def values(frame, *keys):
    """{key: rounded feature value}; a single key is not wrapped."""
    found = {}
    for row in frame.collect():
        key = tuple(row[k] for k in keys)
        value = row["feature_value"]
        assert key not in found, f"two rows for {key}"
        found[key[0] if len(key) == 1 else key] = None if value is None else round(value, 6)
    return found


def weekly(frame):
    return values(frame, "user_id", "feature_week")
