"""Exact searches against all pairs, in whole numbers of any length."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from learnertrace.llm import vectors
from learnertrace.llm.hard_negatives import SHIFTED, Bucket, Index, Nearest, hard_negatives
from learnertrace.llm.queries import QUERIES, SQL
from learnertrace.llm.top_k import Postings, top_k
from tests.compare import connect, difference

COLUMNS = "vec_id long, embedding array<double>, label int, score string, `a.b` int, shard int, pack int"


@pytest.fixture(autouse=True)
def many_shards(monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_SHARD", 100)


@pytest.mark.parametrize("name", ["op12_top_k", "op13_hard_negatives"])
@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_same_as_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    assert difference(spark, connect(folder), folder, QUERIES[name], SQL[name]) is None


def frame(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], COLUMNS).repartition(partitions)


def plain(rows, scale):
    """Rows that take part, with whole components."""
    good = [(i, v, label) for i, v, label in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, [math.floor(scale * x) for x in v], label) for i, v, label in good]


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def askers(rows, every):
    """The greatest row of each id that asks."""
    found = {}
    for i, vec, label in rows:
        if i % every == 0:
            found[i] = max(found.get(i, (label, vec)), (label, vec))
    return found


def random_rows(count, seed, dims=6, labels=4):
    chance = random.Random(seed)
    rows = []
    for k in range(count):
        size = chance.choice([dims] * 6 + [0, 1, 3, dims + 5])
        scale = chance.choice([1, 1, .1, 5])
        rows.append((k, [scale * chance.gauss(0, 1) if chance.random() > .3 else 0. for _ in range(size)],
                     chance.randrange(labels)))
    return rows


ODD = [(None, [1., 2.], 1), (1000, None, 1), (1001, [1., None], 1), (1002, [float("nan")], 2),
       (1003, [1., float("inf")], 0), (1004, [], 1), (1005, [0.] * 6, 2), (0, [1., 1.], None),
       (1010, [2., 1., .5], 1), (1010, [2., 1., .5], 1), (1010, [1., 1., 7.], 2), (-10, [1.] * 6, 3),
       (-20, [-1.] * 6, 1), (1011, [1e5] * 6, 1), (1012, [.5] * 300, 3), (1020, [0., 0.], 0)]


def test_top_k_of_odd_rows(spark):
    rows = random_rows(120, 1) + ODD
    for more in ([], [(2000, [1e30, -3.], 1), (2001, [1e30, 1e30], 2)]):
        known = plain([(i, v, 0) for i, v, _ in rows + more], 1024)
        want = Counter()
        for key, (_, vec) in askers(known, 10).items():
            near = sorted((-product(vec, other), i) for i, other, _ in known if i != key)[:10]
            for rank, (score, i) in enumerate(near, 1):
                want[key, rank, i, min(max(-score, -2**63), 2**63 - 1)] += 1
        got = Counter(map(tuple, top_k(frame(spark, rows + more), F.col("id") % 10 == 0).collect()))
        if more:
            # Beyond 64 bits only the order within a shard is exact.
            assert {(q, i) for q, _, i, s in want if abs(s) < 2**62 and abs(q) < 1000} <= {(q, i) for q, _, i, _ in got}
        else:
            assert got == want


def mined(rows, positives=5, negatives=10, every=10):
    found = []
    for key, (label, vec) in askers(rows, every).items():
        scored = sorted((-product(vec, other), i, mark) for i, other, mark in rows if i != key)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            near = [(n, i) for n, i, mark in scored if mark != label and 30 * -p <= 100 * -n <= 90 * -p]
            found += [(key, positive, rank, i, -p, -n) for rank, (n, i) in enumerate(near[:negatives], 1)]
    return Counter(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_of_odd_rows(spark, seed):
    rows = random_rows(150, seed) + ODD
    known = [r for r in plain(rows, 256) if r[2] is not None]
    got = Counter(map(tuple, hard_negatives(frame(spark, rows), F.col("id") % 10 == 0).collect()))
    assert got == mined(known) and got


def test_equal_vectors_and_one_label(spark):
    rows = [(k, [.5, .25], k % 3 == 0) for k in range(60)]
    rows = [(i, v, int(x)) for i, v, x in rows]
    assert Counter(map(tuple, hard_negatives(frame(spark, rows), F.col("id") % 10 == 0).collect())) \
        == mined(plain(rows, 256))
    top = top_k(frame(spark, rows), F.col("id") % 10 == 0).collect()
    assert {(r.query_id, r.rank): r.vec_id for r in top} == {
        (q, k): (k - 1 if k - 1 < q else k) for q in range(0, 60, 10) for k in range(1, 11)}
    alone = [(i, v, 1) for i, v, _ in rows]
    assert hard_negatives(frame(spark, alone), F.col("id") % 10 == 0).count() == 0


def test_empty_table(spark):
    assert top_k(frame(spark, [], 1), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives(frame(spark, [], 1), F.col("id") % 10 == 0, label=SHIFTED).count() == 0


def shard(rows):
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict({
        "id": pa.array([r[0] for r in rows], pa.int64()), "vec": pa.array([r[1] for r in rows], pa.list_(pa.float64())),
        "label": pa.array([r[2] for r in rows], pa.int64())})
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return vectors.Vectors([sink.getvalue().to_pybytes()])


def test_pruning_loses_nothing_and_prunes():
    import numpy as np

    rows = [(i, [float(x) for x in v], label) for i, v, label in plain(random_rows(400, 7, dims=3, labels=1), 256)]
    index, kept, all_rows = Index(shard(rows)), 0, 0
    for key, vec, _ in rows[:60]:
        anchor = np.array(vec)
        length = float(np.sqrt((anchor * anchor).sum()))
        for threshold in (-1e5, 0.0, 1e4, 1e5, 1e6):
            for bucket in index.of[0]:
                focus = [(int(c), float(np.arccos(anchor[c] / length))) for c in range(len(vec))] if length else []
                chosen = bucket.within(focus, length, threshold)
                chosen = np.arange(len(bucket.ids)) if chosen is None else chosen
                wanted = np.flatnonzero(bucket.scores(anchor, True, None) >= threshold)
                assert set(wanted) <= set(chosen)
                kept, all_rows = kept + len(chosen), all_rows + len(bucket.ids)
    assert kept < 0.8 * all_rows
    assert all(isinstance(b, Bucket) for b in index.of[0])


def test_scores_by_term_are_products():
    import numpy as np

    rows = [(i, [float(x) for x in v], label) for i, v, label in plain(random_rows(200, 9), 1024)]
    postings = Postings(shard(rows[::-1]))
    for _, vec, _ in rows[:40]:
        assert postings.scores(np.array(vec)).tolist() == [product(vec, other) for _, other, _ in rows]


def test_lists_keep_the_first():
    import numpy as np

    one = Nearest(2, 1, 5)
    one.show(np.array([4, 3, 9]), np.array([2., 2., 6.]))
    one.show(np.array([1, 2, 8]), np.array([2., 1., 0.]))
    assert one.ids.tolist() == [1, 3] and one.least == 2
