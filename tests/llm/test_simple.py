"""Exact duplicates, token records, token counts, decontamination and mixing."""

import itertools
import math
import struct
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from learnertrace.llm import common, decontaminate, exact_dedup, mixing, token_records
from learnertrace.llm.token_counts import Merges, token_counts

DOCS = "doc_id long, text string, source string, digest string, `a b.c` int"


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, s, "x", 1) for i, t, s in rows], DOCS)


ODD = [(3, "a  b", "s"), (1, "a b", "s"), (1, "a b", "s"), (2, None, None), (5, "", "é"),
       (None, "a\tb", "s"), (7, "b " * 30_000, "t"), (8, "<|endoftext|> it's\n\n x", "t")]


def test_duplicates_of_odd_rows(spark):
    for counters in (2, 256):
        got = exact_dedup.mark_duplicates(docs(spark, ODD), counters).collect()
        same = [r for r in got if r.keep_id == 1]
        assert len(got) == 8 and sorted(r.group_size for r in got) == [1, 1, 2, 2, 4, 4, 4, 4]
        assert len(same) == 4 and [r.doc_id for r in same if r.kept] == [1]
        assert {r.keep_id for r in got if r.doc_id in (2, 5)} == {2}
    assert exact_dedup.mark_duplicates(docs(spark, [])).count() == 0


def test_frequent_and_rare_duplicates(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"t{k % 50}", None) for k in range(900)]
    got = exact_dedup.mark_duplicates(docs(spark, rows).repartition(5), counters=8).collect()
    first = {}
    for k, text, _ in rows:
        first.setdefault(text, k)
    assert {r.doc_id: r.keep_id for r in got} == {k: first[text] for k, text, _ in rows}
    assert sum(r.kept for r in got) == len(first)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


TRICKY = ["", " ", "  a  b", "a\n b \n\tc  ", "it's we'll  I'd", "x<|endoftext|>y <|startoftext|>",
          "éÉ ñ 123 45 $$$ %%% a", "日本 語　x y \u0085z", "a\x1c b\x1fc", "İstanbul ΑΣ Σ",
          "é ́e", "a" * 3000, "ab" * 999 + "<|endoftext|>" * 3, "🙂🙂 👩‍👩‍👧 x", "a \n", "\r\n\r\n a"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab 'stélL1.<|>\n\t　 é🙂%") | st.characters(codec="utf-8"), max_size=60))
def test_counts_equal_the_library(text):
    assert MERGES.count(text) == len(BYTE.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab 'stélL1.<|>\n\t　 é🙂%́") | st.characters(codec="utf-8"), max_size=60))
def test_word_ids_equal_the_library(text):
    got = next(WORDS.of([text.encode()]))
    assert list(struct.unpack(f"<{len(got) // 2}H", got)) == WORD.encode(text, add_special_tokens=False).ids


MERGES, BYTE = Merges(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
WORDS, WORD = token_records.WordIds(public_tokenizers.path("word_bpe_49k.json")), library("word_bpe_49k.json")


def test_counts_of_tricky_texts(spark):
    rows = [(k, text, None) for k, text in enumerate(TRICKY)] + [(None, None, None)]
    got = token_counts(docs(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), limit=4).collect()
    want = [len(BYTE.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    assert [r.n_tokens for r in got] == want
    assert [r.n_bytes for r in got] == [len((t or "").encode()) for _, t, _ in rows]
    assert [r.over_limit for r in got] == [n > 4 for n in want]


def test_tasks_give_memory_back(monkeypatch):
    class Library:
        asked = []

        def malloc_trim(self, pad):
            self.asked.append(pad)

    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: Library())
    given_back = common._giving_back(iter([1, 2]), lambda batches: (2 * b for b in batches))
    assert next(given_back) == 2 and not Library.asked
    assert list(given_back) == [4] and Library.asked == [0]


def test_known_words_stay_within_their_bound():
    words = token_records.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(0, 900_000, 1000):
        list(words.of([b" ".join(b"%d" % n for n in range(k, k + 1000))]))
    entries = len(words.known) + len(words.before)
    assert entries * token_records.OVERHEAD < 2 * 65 << 20


def test_known_words_are_encoded_once():
    words = token_records.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    encode, asked = words.encoded, []
    words.encoded = lambda new: asked.extend(new) or encode(new)
    texts = [b" ".join(b"%d" % n for n in range(k, k + 20_000)) for k in range(0, 700_000, 20_000)]
    for text in [*texts, texts[0]]:
        list(words.of([text]))
    assert len(asked) == 700_000


def test_ids_of_a_batch_equal_the_library():
    odd = ["", " ", "\u3000", "\u0301", "\u2028a", "\ufeffx", "a\u3000b", "\x1c", "\x85b", "<|endoftext|>", "\u0958", "x" * 200]
    texts = [" ".join(p) for p in itertools.product(odd, repeat=2)] + ["\t".join(odd * 20), None]
    column = pa.array(texts, pa.string())
    words = token_records.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    for batch in (column, column.slice(7), column.cast(pa.large_string()), column.slice(0, 0)):
        got = [list(struct.unpack(f"<{len(ids) // 2}H", ids)) for ids in words.of(batch)]
        assert got == [WORD.encode(t or "", add_special_tokens=False).ids for t in batch.to_pylist()]


def test_records_round_trip(spark, tmp_path):
    rows = [(k, text, None) for k, text in reversed(list(enumerate(TRICKY)))] + [
        (3, TRICKY[3], None), (None, None, None), (99, None, None)]
    path = public_tokenizers.path("word_bpe_49k.json")
    index = token_records.write_records(docs(spark, rows), str(tmp_path / "r"), path)
    got = token_records.read_records(index).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [WORD.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _ in want]
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, len(x)) for (i, _, _), x in zip(want, ids)]
    assert [r.start for r in got] == [sum(map(len, ids[:k])) for k in range(len(ids))]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for x in ids]
    single = {r.doc_id: r.ids for r in token_records.shuffled(index, 1).collect()}
    assert single == {i: x for (i, _, _), x in zip(want, ids)}
    assert token_records.encode_and_read(docs(spark, [])).count() == 0


def test_damaged_records_are_refused(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    index = token_records.write_records(docs(spark, [(1, "a b c", None)]), str(tmp_path / "r"), path)
    file = index.first().path
    with open(file, "r+b") as f:
        f.seek(25)
        f.write(b"\xff")
    with pytest.raises(Exception, match="damaged"):
        token_records.read_records(index).collect()


def brute_hits(words, items, window):
    hit, found = set(), set()
    for item, other in items:
        length = min(window, len(other))
        for at in range(len(other) - length + 1 if length else 0):
            for start in range(len(words) - length + 1):
                if words[start:start + length] == other[at:at + length]:
                    hit |= set(range(start, start + length))
                    found.add(item)
    return len(hit), found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4),
       st.integers(1, 6))
def test_search_equals_brute_force(words, others, window):
    items = [(str(k), x) for k, x in enumerate(others)]
    built = decontaminate.tables([(k, " ".join(x).encode()) for k, x in items], window)
    starts, ends, found = decontaminate.spans([w.encode() for w in words], built)
    assert (sum(ends) - sum(starts), found) == brute_hits(words, items, window)


def test_contamination_in_groups_and_odd_rows(spark):
    item = " ".join(f"w{k}" for k in range(20))
    bench = spark.createDataFrame(
        [(1, item), (2, "short one"), (10, "w3 W4, w5"), (3, None), (4, "--"), (None, "null item")],
        "item_id long, text string")
    rows = [(1, item.upper() + " and more", None), (2, f"x {'y ' * 60} short-one", None), (3, None, None),
            (4, "", None), (5, "w0 w1 w2", None), (6, "null item", None), (6, "null item", None)]
    for size in (4 << 20, 30):
        found = decontaminate.contamination(docs(spark, rows), bench, group_bytes=size)
        got = decontaminate.judged(found).orderBy("doc.doc_id").collect()
        assert [(r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got] == [
            (22, 20, ["1", "10"], True), (63, 2, ["2"], False), (0, 0, [], False), (0, 0, [], False),
            (3, 0, [], False), (2, 2, ["null"], True), (2, 2, ["null"], True)]
        assert got[0].doc["a b.c"] == 1
    left = decontaminate.clean(docs(spark, rows), bench)
    assert left.columns == docs(spark, []).columns and {r.doc_id for r in left.collect()} == {2, 3, 4, 5}
    assert decontaminate.clean(docs(spark, rows), bench.limit(0)).count() == 7
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    goal, open_, spare = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while spare > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            goal[s] += spare * weight[s] / total
        spare = 0.0
        for s in list(open_):
            if goal[s] >= most * sizes[s]:
                spare += goal[s] - most * sizes[s]
                goal[s] = most * sizes[s]
                open_.discard(s)
    return goal


def test_mix_reaches_targets(spark):
    rows = [(k, "w " * (k * 37 % 101), ["a", "b", "c", None, "é", "z"][k % 6 if k % 2 else 0]) for k in range(3000)]
    sized = docs(spark, rows).select("doc_id", "source", mixing.words(F.col('text')).alias("size"))
    for block in (100_000, 50):
        got = mixing.plan(sized, rows_per_block=block).collect()
        again = mixing.plan(sized.repartition(7), rows_per_block=block).collect()
        assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == 3000
        sizes = {}
        for r in got:
            sizes[r.source] = sizes.get(r.source, 0) + r.size
        goal = brute_targets(sizes)
        for source in sizes:
            own = [r for r in got if r.source == source]
            assert math.isclose(own[0].target, goal[source], rel_tol=1e-9)
            assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 250
            assert all(0 <= r.copies <= 2 for r in own)


def test_mix_equals_the_sql_at_every_block_size(spark):
    rows = [(k * 7919 % 1000 - 20 if k % 90 else None, "w " * (k * 37 % 23 if k % 4 else 5),
             ["a", "b", "c", None][k * k % 11 % 4]) for k in range(1000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = Counter(con.execute(f"SELECT doc_id, size, source_size, target::DOUBLE, taken FROM ({mixing.SQL})").fetchall())
    sized = docs(spark, rows).repartition(5).select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    for width in (100_000, 100, 3):
        got = mixing.plan(sized, rows_per_block=width).collect()
        assert Counter((r.doc_id, r.size, r.source_size, r.target, r.copies * r.size) for r in got) == want


def test_mix_of_odd_rows(spark):
    frame = docs(spark, ODD + [(9, "x y z", "u")] * 3)
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert {r.doc_id for r in mixed.collect()} <= {r[0] for r in ODD} | {9}
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None, None)])).count() in (0, 1)
