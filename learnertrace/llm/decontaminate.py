"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of the benchmark items: `window` consecutive words, or a
whole item that has fewer. For patterns of one length a shift table over blocks of two
words tells how far the search may move on: a block in no pattern skips all positions that
it would cover, a block in some pattern moves its last place there to the window's end.
Where the shift is 0, the patterns that end in this block are looked up by their first
block, and the words are compared directly.

Items are dealt into groups of a bounded size (by bytes of text), each group's tables are
broadcast by themselves, and each group is searched in all documents. With the usual
benchmark there is one group and one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import WORD_BYTES, encoded, mapped, pieces, table, written

#: Words in a block, as the method's authors advise for many patterns.
BLOCK = 2


class Patterns:
    """Tables for patterns (tuples of words) of one length, each with the items that hold it."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]) -> None:
        self.length = length
        self.block = min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.default), length - end)
            by_first = self.buckets.setdefault(words[length - self.block:], {})
            by_first.setdefault(words[:self.block], []).append((words, items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of each place where a pattern stands in `words`."""
        size, length, get, default = self.block, self.length, self.shift.get, self.default
        end, last = length, len(words)
        if size == 2:
            while end <= last:
                step = get((words[end - 2], words[end - 1]), default)
                if step:
                    end += step
                    continue
                yield from self._confirmed(words, end)
                end += 1
        else:
            for end in range(length, last + 1):
                if (words[end - 1],) in self.buckets:
                    yield from self._confirmed(words, end)

    def _confirmed(self, words: list[bytes], end: int) -> Iterator[tuple[int, set[str]]]:
        start, size = end - self.length, self.block
        for pattern, items in self.buckets[tuple(words[end - size:end])].get(
                tuple(words[start:start + size]), ()):
            if pattern == tuple(words[start:end]):
                yield start, items


def tables(items: list[tuple[str, bytes]], window: int) -> list[Patterns]:
    """Search tables for the windows of (item id, text), one for each pattern length."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = text.translate(WORD_BYTES).split()
        length = min(window, len(words))
        for start in range(len(words) - length + 1 if length else 0):
            found = by_length.setdefault(length, {})
            found.setdefault(tuple(words[start:start + length]), set()).add(item)
    return [Patterns(length, found) for length, found in sorted(by_length.items())]


def spans(words: list[bytes], searches: list[Patterns]) -> tuple[list[int], list[int], set[str]]:
    """Starts and ends of the runs of words that lie in occurrences, and the items found."""
    places, items = [], set()
    for search in searches:
        for start, found in search.occurrences(words):
            places.append((start, start + search.length))
            items |= found
    starts, ends = [], []
    for start, end in sorted(places):
        if starts and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends, items


def merged(known: tuple, more: tuple) -> tuple[list[int], list[int], list[str]]:
    """The spans of two searches of the same words as one."""
    if not known[0]:
        return more[0], more[1], sorted(more[2])
    starts, ends = [], []
    for start, end in sorted([*zip(known[0], known[1]), *zip(more[0], more[1])]):
        if starts and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends, sorted({*known[2], *more[2]})


def _search(items, window: int):
    """A mapInArrow function that adds one group's spans to the columns starts, ends and items."""
    built: list[list[Patterns]] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(tables(items.value, window))
        for batch in pieces(batches):
            counts, found = [], []
            before = zip(*(batch.column(c).to_pylist() for c in ("starts", "ends", "items")))
            for text, known in zip(encoded(batch.column("text")), before):
                words = text.translate(WORD_BYTES).split()
                counts.append(len(words))
                found.append(merged(known, spans(words, built[0])))
            kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text"), pa.array(counts, pa.int64()),
                 *(pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds))],
                names=["doc", "text", "n_words", "starts", "ends", "items"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                  group_bytes: int = 4 << 20) -> DataFrame:
    """doc (a row of `docs`, all its columns), n_words, starts, ends, items.

    starts and ends are the runs of words (from 0, end excluded) that lie in occurrences of
    any window; items are the ids of the items with such windows, as sorted strings (a null
    id is "null"). Null and empty texts have no words and no runs; an item without words has
    no windows; repeated items and rows count as they stand. Without a benchmark nothing is
    hit. Columns of other names, whatever they are, are kept within doc.
    """
    spark = docs.sparkSession
    asked = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("binary").alias("text")).filter(F.col("text").isNotNull())
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_bytes))
    none = F.array()
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"),
        F.lit(0).cast("long").alias("n_words"), none.cast("array<int>").alias("starts"),
        none.cast("array<int>").alias("ends"), none.cast("array<string>").alias("items"))
    for group in range(groups):
        part = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group)
        items = spark.sparkContext.broadcast([(x.item, bytes(x.text)) for x in part.collect()])
        found = mapped(found, _search(items, window), found.schema)
        if groups > 1:  # so that only one group's tables are in memory at a time
            found = written(found)
    return found.drop("text")


def judged(found: DataFrame, one_in: int = 20) -> DataFrame:
    """`contamination` rows with n_hit, n_items, items_sha256 and contaminated.

    n_hit are the words in occurrences. A document is contaminated when it has any, and at
    least one in `one_in` of its words.
    """
    hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"),
                      lambda total, run: total + run.ends - run.starts)
    return found.withColumn("n_hit", hit).withColumns({
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", "items"), 256),
        "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))})


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that are not contaminated, with the columns of `docs`."""
    return judged(contamination(docs, benchmark, **settings)).filter(
        ~F.col("contaminated")).select("doc.*")


def op8_decontamination(spark, folder: str) -> DataFrame:
    """Every document with what it shares with the benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judged(contamination(docs, table(spark, folder, "benchmark"))).select(
        "doc.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(words)) AS length,
           array_to_string(words[place:place + least(13, len(words)) - 1], ' ') AS phrase
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS place
          FROM item WHERE len(words) > 0)),
places AS (
    SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS place
    FROM doc CROSS JOIN (SELECT DISTINCT length FROM windows) WHERE len(words) >= length),
occurrences AS (
    SELECT p.doc_id, p.place, p.length, w.item_id
    FROM places p JOIN windows w
      ON w.length = p.length AND w.phrase = array_to_string(p.words[p.place:p.place + p.length - 1], ' ')),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + length)) AS place FROM occurrences) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM occurrences) GROUP BY doc_id)
SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(words), 0) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
