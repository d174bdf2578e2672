"""Classifiers, and the pipeline against each stage's brute-force version."""

import os
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from learnertrace.llm import jaccard_join, learning, mixing, quality, toxicity
from tests.llm.test_jaccard import brute
from tests.llm.test_simple import brute_hits

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, held_out string, `a.b` int"


def texts(spark, rows):
    return spark.createDataFrame([(i, t, 0.0, "x", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def told(spark):
    """Texts of which some say "nasty", some are noise."""
    draw = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(400):
        words = [f"{'aeiou'[draw.integers(5)]}{'bcdfg'[draw.integers(5)]}{'xyz'[draw.integers(3)]}ow"
                 for _ in range(draw.integers(20, 80))]
        toxic, good = int(k % 5 == 0), int(k % 3 != 0)
        if toxic:
            for at in range(0, len(words), 12):
                words[at] = "nasty"
        rows.append((k, (" " if good else "%$ ").join(words)))
        labels.append((k, good, toxic))
    return texts(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("score, name", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_held_out_accuracy(told, score, name):
    docs, labels = told
    got = score(docs, labels).select(F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")
    rows = got.join(labels, "doc_id").collect()
    assert len(rows) == 400
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[name] for r in held]) > 0.95
    folds, fold = (4, 2) if name == "toxic" else (3, 1)
    assert {r.doc_id for r in held} == {
        r.doc_id for r in labels.filter(learning.fold("doc_id", folds) == fold).collect()}


@pytest.mark.parametrize("score, name", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_odd_rows_and_reruns(spark, told, score, name):
    docs, labels = told
    odd = texts(spark, [(1, None), (1, ""), (None, "x"), (2, "nasty " * 40_000), (3, "\x00é🙂"), (3, "\x00é🙂")])
    got = score(docs.unionByName(odd).repartition(3), labels).filter("doc.held_out = 'x'").collect()
    again = score(docs.unionByName(odd), labels).collect()
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 406
    assert sorted((str(r.doc.doc_id), r.doc.text or "", r.score) for r in got) == sorted(
        (str(r.doc.doc_id), r.doc.text or "", r.score) for r in again)
    empty = {r.score for r in got if not r.doc.text}
    assert len(empty) == 1
    assert score(docs.limit(0), labels).count() == 0
    assert {r.score for r in score(odd, labels.limit(0)).collect()} == {0.5}
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias(name))
    assert {r.score for r in score(odd, nulls).collect()} == {0.5}


def test_slopes_are_derivatives():
    draw = np.random.default_rng(0)
    network, rows = quality.Network(), draw.integers(0, 256, (3, quality.CHUNK)).astype(np.uint8)
    label, weight = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)
    for a in network.arrays:
        a[...] = a.astype(np.float32)

    def loss():
        p = learning.sigmoid(network.values(rows).astype(float))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    for array, slope in zip(network.arrays[1:], network.slopes(rows, label, weight)[1:]):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before, step = array[at], 1e-2
        array[at] = before + step
        high = loss()
        array[at] = before - step
        low = loss()
        array[at] = before
        assert abs((high - low) / (2 * step) - slope[at]) < 0.05 * abs(slope[at]) + 1e-3


def test_chunks_cover_the_text():
    for size in (0, 1, 511, 512, 513, 959, 960, 961, 5000):
        text = bytes(k % 251 + 1 for k in range(size))
        rows = quality.chunks(text)
        assert rows.shape[1] == quality.CHUNK
        spots = {(r.tobytes().rstrip(b"\x00")) for r in rows}
        assert all(any(text[k:k + 7] in s for s in spots) for k in range(max(1, size - 7)))


def test_stages_on_given_tables(spark):
    """Every stage on what the one before kept, against a plain version of it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "good", "apart", "without_benchmark", "mixed", "records"]
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        kept.append(docs.collect())
    assert all(list(stage[0].asDict()) == columns for stage in kept[:4])

    model = quality.trained(spark.read.parquet(f"{SMALL}/documents.parquet"),
                            spark.read.parquet(f"{SMALL}/labels.parquet"))
    every = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert sorted(r.doc_id for r in kept[0]) == sorted(
        r.doc_id for r in every if model.score(r.text.encode()) >= 0.5)
    components = brute([(r.doc_id, r.text) for r in kept[0]], 5, 80)
    assert sorted(r.doc_id for r in kept[1]) == sorted(d for d, (n, c) in components.items() if c == d or not n)

    import re
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    items = [(str(r.item_id), words(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[k:k + 13]) for _, w in items for k in range(max(1, len(w) - 12))}
    clean = []
    for r in kept[1]:
        own = words(r.text)
        near = [x for x in items if any(tuple(own[k:k + 13]) in windows for k in range(len(own)))]
        hit = brute_hits(own, near, 13)[0]
        if not (hit and 20 * hit >= len(own)):
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in kept[2]) == sorted(clean)

    taken = mixing.plan(spark.createDataFrame(kept[2]).select(
        "doc_id", "source", mixing.words(F.col("text")).alias("size"))).collect()
    assert sorted(r.doc_id for r in kept[3]) == sorted(r.doc_id for r in taken for _ in range(r.copies))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept[3]}
    assert sorted((r.doc_id, r.n_tokens) for r in kept[4]) == sorted((r.doc_id, sizes[r.doc_id]) for r in kept[3])
    assert sum(r.n_tokens for r in kept[4]) == max(r.start + r.n_tokens for r in kept[4])
