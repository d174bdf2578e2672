"""Near duplicates against all pairs compared one by one."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from learnertrace.llm import common
from learnertrace.llm import jaccard_join as jj

DOCS = "doc_id long, text string, first string, node int, `a b` int"


def shingled(text, words):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[k:k + words]) for k in range(len(found) - words + 1)}


def is_link(a, b, percent):
    both = len(a & b)
    return both and 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows, words, percent):
    """doc_id: (size of the set, least reachable doc_id)."""
    sets = [shingled(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if is_link(sets[a], sets[b], percent):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return {doc_id: (len(sets[k]), least[find(k)]) for k, (doc_id, _) in enumerate(rows)}


def near_copies(seed, sizes=(1, 3, 6, 9, 14, 25, 60, 200), families=12, copies=8):
    """Texts of families in which members differ by some words."""
    draw = random.Random(seed)
    rows = []
    for family in range(families):
        base = [f"w{draw.randrange(40 if family % 3 else 3000)}" for _ in range(sizes[family % len(sizes)])]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4, len(words) // 6])):
                at = draw.randrange(len(words) + 1)
                words[at:at + draw.choice([0, 1])] = [f"n{draw.randrange(50)}"] * draw.choice([0, 1, 1])
            rows.append(draw.choice([" ", "\n", "  "]).join(words))
    draw.shuffle(rows)
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", 0, 1) for i, t in rows], DOCS)


@pytest.mark.parametrize("seed, words, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 50)])
def test_equal_to_all_pairs(spark, seed, words, percent):
    rows = near_copies(seed)
    want = brute(rows, words, percent)
    for tiles in (jj.BLOCK_SHINGLES, 150):
        got = jj.near_duplicates(frame(spark, rows).repartition(4), words, percent, tiles).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    kept = {r.doc_id for r in jj.deduplicate(frame(spark, rows), words=words, percent=percent).collect()}
    assert kept == {k for k, (_, root) in want.items() if k == root}


def test_odd_rows(spark):
    rows = [(5, "a b c d e"), (2, "A B c\td e"), (2, "A B c\td e"), (7, None), (8, ""), (8, ""), (9, " \n"),
            (None, "x y"), (3, "x  Y"), (None, "only null"), (11, "w " * 20_000), (12, "W " * 20_001)]
    got = sorted(map(tuple, jj.near_duplicates(frame(spark, rows)).select(
        "doc_id", "n_shingles", "component_id", "first").collect()), key=str)
    assert got == sorted([
        (5, 1, 2, False), (2, 1, 2, True), (2, 1, 2, False), (7, 0, 7, True), (8, 0, 8, True), (8, 0, 8, True),
        (9, 0, 9, True), (None, 1, 3, False), (3, 1, 3, True), (None, 1, None, True), (11, 1, 11, True),
        (12, 1, 11, False)], key=str)
    kept = jj.deduplicate(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [11, 2, 3, 7, 8, 8, 9, None]
    assert jj.near_duplicates(frame(spark, [])).count() == jj.deduplicate(frame(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abAB \t\né ") | st.characters(codec="utf-8"), max_size=80), st.integers(1, 5))
def test_sets_have_the_right_size(text, words):
    found = jj.shingles(text.encode(), words)
    assert len(found) == len(shingled(text, words))
    assert (np.diff(found.astype(object)) > 0).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 400), st.sampled_from([50, 80, 85, 95]))
def test_linked_sets_always_meet(seed, size, percent):
    """Sets that just pass the threshold share a key."""
    draw = np.random.default_rng(seed)
    pool = draw.integers(0, 2**64, 2 * size, dtype=np.uint64)
    a, added = pool[:size], 0
    b = a
    while True:  # take away and add as much as the threshold bears
        less = draw.integers(0, 2)
        other = b[1:] if less else np.append(b, pool[size + added])
        added += not less
        both = len(np.intersect1d(a, other))
        if not len(other) or added >= size or 100 * both < percent * (len(a) + len(other) - both):
            break
        b = other
    a, b = np.unique(a), np.unique(b)
    bands = jj.Bands(percent)
    assert np.intersect1d(jj.keys(a, bands), jj.keys(b, bands)).size


def test_tree_search_equals_all_pairs():
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = draw.integers(0, 2**64, draw.integers(1, 300), dtype=np.uint64)
        for _ in range(draw.integers(1, 9)):
            more = draw.integers(0, 2**64, draw.integers(0, 1 + len(base) // 6), dtype=np.uint64)
            sets.append(np.unique(np.append(base[draw.random(len(base)) > 0.04], more)))
    sets = [s for s in sets if len(s)]
    root, plain = jj.linked(sets, 80), [set(s.tolist()) for s in sets]
    for a in range(len(sets)):
        for b in range(a):
            if is_link(plain[a], plain[b], 80):
                assert root[a] == root[b]
    assert all(any(is_link(plain[a], plain[b], 80) for b in range(len(sets)) if b != a and root[b] == root[a])
               for a in range(len(sets)) if (root == root[a]).sum() > 1)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(7, 3), (3, 7), (9, 9)]
    got = {r.node: r.root for r in jj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 500 for k in range(500, 540)}, 3: 3, 7: 3}


def test_filter_lets_all_wanted_pass(spark):
    texts = spark.range(5000).selectExpr("xxhash64(id) AS text_hash", "id")
    wanted = texts.filter("id % 7 = 0").select("text_hash")
    for bits, most in ((1 << 26, 720), (1 << 12, 5000)):
        rows = jj.with_likely(texts, wanted, bits).collect()
        got = {r.id for r in rows if r.likely}
        assert len(rows) == 5000
        assert {k for k in range(5000) if k % 7 == 0} <= got and len(got) <= most
    assert jj.with_likely(texts, wanted.limit(0)).filter('likely').count() == 0


def test_texts_that_share_a_passage_only_are_no_block(spark, monkeypatch):
    """Many unrelated texts with the same passage meet, but none of them travels to be compared as a whole."""
    draw = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(k, " ".join(f"w{draw.randrange(10**6)}" for _ in range(70)) + " " + passage) for k in range(300)]
    rows += [(1000 + k, text + " end") for k, (_, text) in enumerate(rows[:3])]
    rows += [(2000 + k, text) for k, (_, text) in enumerate(rows[:3])]
    dealt, write = [], jj.written

    def seen(frame):
        found = write(frame)
        if "block" in found.columns:
            dealt.append(found.select("node", "block").distinct().count())
        return found

    monkeypatch.setattr(jj, "written", seen)
    got = {r.doc_id: r.component_id for r in jj.near_duplicates(frame(spark, rows)).collect()}
    assert got == {k: root[1] for k, root in brute(rows, 5, 80).items()}
    assert dealt == [6]


@pytest.mark.parametrize("seed, words, percent", [(4, 5, 80), (5, 2, 50)])
def test_companies_in_tiles(spark, seed, words, percent):
    rows = near_copies(seed, families=9)
    got = jj.near_duplicates(frame(spark, rows).repartition(3), words, percent, company_sets=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, words, percent)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 300), st.integers(0, 60), st.sampled_from([50, 80, 85]))
def test_linked_sets_are_possible(seed, size, added, percent):
    """Counts never part sets that are linked, also where one has many elements in one range."""
    draw = np.random.default_rng(seed)
    pool = np.unique(draw.integers(0, 2**64 - 1, size + added, dtype=np.uint64) >> np.uint64(draw.choice([0, 0, 9])))
    a, b = pool[:size], pool[min(added // 2, size - 1):]
    assert (jj.unpacked(jj.packed(jj.counts(a))) == jj.counts(a)).all()
    shared = len(np.intersect1d(a, b))
    if 100 * shared >= percent * (len(a) + len(b) - shared):
        one, other = jj.counts(a), jj.counts(b)
        least = min(len(one), len(other))
        assert jj.possible(jj.folded(one, least), len(a), jj.folded(other, least)[None], np.array([len(b)]), percent)[0]
        assert jj.close([one, other], np.array([len(a), len(b)]), np.array([1, 2]), percent).tolist() == [0, 0]


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), max_size=30), st.integers(1, 7))
def test_companies_are_the_nodes_under_a_key(rows, size):
    rows = sorted(rows)
    cut = [rows[k:k + size] for k in range(0, len(rows), size)]
    found = {}
    for batch in jj._companies(pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*part)], names=["key", "node"]) for part in cut):
        for company, first, node in zip(*(c.to_pylist() for c in batch.columns)):
            found.setdefault(company, (first, set()))[1].add(node)
    nodes = {}
    for key, node in rows:
        nodes.setdefault(key, set()).add(node)
    want = {(min(x), frozenset(x)) for x in nodes.values() if len(x) > 1}
    assert {(first, frozenset(x)) for first, x in found.values()} == want


def test_written_tables_leave_no_shuffle_files(spark):
    def held():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return set(re.findall(r"shuffle_\d+", blocks.mkString(",")))

    before = held()
    again = spark.conf.get(common.TIDY, None)
    common.written(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before and spark.conf.get(common.TIDY, None) == again
