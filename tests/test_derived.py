"""Features computed from features."""

import random
import re

from pyspark.sql import functions as F

from learnertrace.functions.ranks import running_totals
from learnertrace.operators import derived
from learnertrace.sources.schemas import OUTPUT
from tests.conftest import at, weekly


def rows(spark, *cells):
    return spark.createDataFrame([(*c, at(0)) for c in cells], OUTPUT["user_long_feature"])


def test_ratio_needs_both_and_guards_zero(spark, make_course):
    features = rows(spark, (2, "u", 0, 6.0), (8, "u", 0, 4.0), (2, "u", 1, 6.0), (8, "u", 1, 0.0),
                    (2, "u", 2, 6.0), (8, "u", 3, 1.0), (2, "u", 4, None), (8, "u", 4, 2.0))
    assert weekly(derived.together(make_course(), features, [10])) == {
        ("u", 0): 1.5, ("u", 1): 0, ("u", 4): None}


def test_change_needs_consecutive_weeks(spark, make_course):
    features = rows(spark, (3, "u", 0, 2.0), (3, "u", 2, 4.0), (3, "u", 3, 0.0), (3, "u", 4, 5.0),
                    (3, "v", 1, 1.0))
    assert weekly(derived.together(make_course(), features, [103])) == {("u", 3): 0, ("u", 4): 0}


def test_change_of_length_needs_more_than_five_posts(spark, make_course):
    features = rows(
        spark, (5, "u", 0, 10.0), (5, "u", 1, 20.0), (3, "u", 0, 5.0), (3, "u", 1, 6.0),
        (5, "u", 2, 30.0), (3, "u", 2, 9.0), (5, "v", 0, 4.0), (5, "v", 1, 8.0))
    assert weekly(derived.together(make_course(), features, [105])) == {("u", 2): 1.5}


def test_progress_over_earlier_weeks(spark, make_course):
    features = rows(spark, (204, "u", 0, 1.0), (204, "u", 1, 0.5), (204, "u", 3, 0.0),
                    (204, "v", 2, 1.0), (204, "u", 14, 1.0), (206, "u", 0, 9.0))
    every = {("u", 1): -0.5, ("u", 3): -0.75, ("v", 2): None, ("u", 14): 0.5}
    assert weekly(derived.together(make_course(weeks=20), features, [205])) == every
    del every["u", 14]
    assert weekly(derived.together(make_course(weeks=20), features, [205], last_week=13)) == every


def test_percentile_of_ties(spark, make_course):
    features = rows(spark, *[(9, f"u{i}", 0, v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0])])
    assert weekly(derived.percentile(make_course(), features)) == {
        ("u0", 0): 25, ("u1", 0): 62.5, ("u2", 0): 62.5, ("u3", 0): 100}


def test_percentile_by_counting(spark, make_course):
    rng = random.Random(3)
    cells = [(9, f"u{i}", i % 3, rng.choice([1.0, rng.randint(1, 400) / 7]))
             for i in range(900)]
    expected = {}
    for _, user, week, value in cells:
        same = [c[3] for c in cells if c[2] == week]
        ranks = sum(v < value for v in same) + sum(v <= value for v in same) + 1
        expected[user, week] = round(50 * ranks / len(same), 6)
    assert weekly(derived.percentile(make_course(), rows(spark, *cells))) == expected


def test_share_of_maximum(spark, make_course):
    features = rows(spark, (9, "u", 0, 1.0), (9, "v", 0, 4.0), (9, "u", 1, 3.0))
    assert weekly(derived.together(make_course(), features, [203])) == {
        ("u", 0): 0.25, ("v", 0): 1, ("u", 1): 1}


def test_running_totals_do_not_depend_on_the_cuts(spark):
    rng = random.Random(5)
    histogram = [(g, v / 13 - 20, rng.randint(1, 9)) for g in (1, 2)
                 for v in rng.sample(range(1000), 300)]
    frame = spark.createDataFrame(histogram, "g INT, v DOUBLE, n LONG")
    for descending in (False, True):
        expected = set()
        for g, v, n in histogram:
            mine = [(x, m) for h, x, m in histogram if h == g]
            before = sum(m for x, m in mine if (x > v if descending else x < v))
            expected.add((g, v, n, before, sum(m for _, m in mine)))
        for partitions in (2, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
            try:
                got = {tuple(r) for r in running_totals(frame, "g", "v", ["n"], descending).collect()}
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", "8")
                spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            assert got == expected


def test_running_totals_spread_one_group(spark):
    """The windows of a large group see a share of its values each, and no higher-order function looks for ranges."""
    frame = spark.range(20000).select(
        F.lit(0).alias("g"), (F.col("id") / 7).alias("v"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = running_totals(frame, "g", "v", ["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert not re.search("lambda|Python", got._jdf.queryExecution().executedPlan().toString())
    [path] = {re.sub("part-[^/]*$", "", f) for f in got.inputFiles()}
    sizes = spark.read.parquet(path).groupBy("part").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 3 * 20000 / 8 and sizes[1] == 8
    assert got.filter("n_before != round(v * 7) OR n_all != 20000").count() == 0
