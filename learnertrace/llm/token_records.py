"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is framed as in common record files: the payload's length as 8 bytes, a masked
checksum of these, the payload, a masked checksum of it (all little-endian). The payload is a
flag, the document's id and the width of a token id, then the token ids: 2 bytes each where
the vocabulary allows it, else 4. The checksum is CRC-32,
rotated and shifted by a constant so that a checksum of data that holds checksums is sound.

Documents are range-partitioned by id; each partition writes one shard, in order of id. A
task writes to a name of its own, and only the index, committed by Spark, says which shards
count: a lost or repeated task leaves at most a file that nothing refers to. The index has a
row for each record (shard, place in it, offset, length), so any record can be read alone.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache, partial
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from learnertrace.llm.common import mapped, pieces, shared_folder, table

INDEX = "shard int, path string, record long, doc_id long, offset long, length long, n_tokens long"
READ = "shard int, record long, doc_id long, start long, n_tokens long, ids_crc32 long"

#: Fixed value of the masking rule.
MASK = 0xA282EAD8
HEAD, FOOT, NAME = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<?qB")

#: Bytes of memory that a Python worker's known words take, in each of two generations; what one takes,
#: with its share of the table by which words are found; the longest word that is kept.
KEPT, OVERHEAD, KEPT_BYTES = 64 << 20, 128, 48
KNOWN = pa.schema([("word", pa.binary()), ("ids", pa.binary())])

#: Words that are encoded as one line.
LINE = 64


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, FOOT.pack(masked(length)), payload, FOOT.pack(masked(payload))))


def unframed(file) -> Iterator[bytes]:
    """The payload of each record from where `file` stands; raises on any damage."""
    offset = 0
    while True:
        head = file.read(HEAD.size)
        if not head:
            return
        if len(head) < HEAD.size:
            raise ValueError(f"record {offset} bytes on: cut short")
        length, check = HEAD.unpack(head)
        if masked(head[:8]) != check:
            raise ValueError(f"record {offset} bytes on: length damaged")
        rest = file.read(length + FOOT.size)
        if len(rest) < length + FOOT.size:
            raise ValueError(f"record {offset} bytes on: cut short")
        payload = rest[:length]
        if masked(payload) != FOOT.unpack(rest[length:])[0]:
            raise ValueError(f"record {offset} bytes on: payload damaged")
        yield payload
        offset += HEAD.size + length + FOOT.size


def contents(payload: bytes) -> tuple[int | None, np.ndarray]:
    """The document's id and the token ids of a record."""
    known, doc_id, width = NAME.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=NAME.size)


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return (fs.FileSystem.from_uri(path) if ":/" in path
            else (fs.LocalFileSystem(), path))


class WordIds:
    """Ids of texts, by the tokenizers library, little-endian in `width` bytes each.

    The tokenizer drops white space and never joins across it, so a text's ids are those of
    its words in turn. Each distinct word is looked up once per batch and encoded once per
    worker, and words are kept up to a bound: where it is reached, those met since the time
    before stay, the older ones go. Only ASCII white space is cut at; the library sees to all
    other. Words and ids are Arrow columns: a dict of them takes several times the memory.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        ids = self.library.get_vocab(with_added_tokens=True).values()
        self.width = 2 if max(ids, default=0) < 1 << 16 else 4
        self.code = {2: "H", 4: "I"}[self.width]
        self.known = self.before = KNOWN.empty_table()

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def encoded(self, words: list[bytes]) -> list[bytes]:
        """The ids of some words: lines of words are encoded, and cut where a word starts."""
        found = []
        for k in range(0, len(words), LINE):
            line = [w.decode(errors="replace") for w in words[k:k + LINE]]
            encoding = self.library.encode(" ".join(line), add_special_tokens=False)
            starts = list(accumulate(len(word) + 1 for word in line[:-1]))
            cuts = list(map(encoding.char_to_token, starts))
            if None in cuts:  # a word whose first character gives no token
                cuts = np.searchsorted([start for start, _ in encoding.offsets], starts).tolist()
            ids, cuts = self.packed(encoding.ids), [self.width * cut for cut in cuts]
            found += [ids[a:b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]
        return found

    def of_words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        if len(self.known) * OVERHEAD > KEPT:
            self.before, self.known = self.known, KNOWN.empty_table()
        at, older = (pa.compute.index_in(words, value_set=rows["word"]).fill_null(-1).to_numpy()
                     for rows in (self.known, self.before))
        new = (at < 0) & (older < 0)
        ids = pa.array(self.encoded(words.filter(pa.array(new)).to_pylist()), pa.binary())
        ends = len(self.known), len(self.known) + len(self.before)
        ids = pa.chunked_array([*self.known["ids"].chunks, *self.before["ids"].chunks, ids]).take(pa.array(
            np.where(at >= 0, at, np.where(older >= 0, ends[0] + older, ends[1] + np.cumsum(new) - 1))))
        kept = (at < 0) & (pa.compute.binary_length(words).to_numpy() <= KEPT_BYTES)
        met = pa.table([words, ids], schema=KNOWN).filter(pa.array(kept))
        self.known = pa.concat_tables([self.known, met]).combine_chunks()
        return ids.combine_chunks()

    def of(self, texts: list[bytes] | pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null is empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).view(pa.string())
        parts = pa.compute.ascii_split_whitespace(column.fill_null(""))
        words = parts.flatten().dictionary_encode()
        ids = self.of_words(words.dictionary.cast(pa.binary())).cast(pa.large_binary()).take(words.indices)
        yield from pa.compute.binary_join(
            pa.ListArray.from_arrays(parts.offsets, ids), pa.scalar(b"", pa.large_binary())).to_pylist()


@cache
def word_ids(path: str) -> WordIds:
    """One encoder per file and Python worker."""
    return WordIds(path)


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str,
           end_id: int) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.rec"
    system, where = place(name)
    words = word_ids(path)
    end, width, offset, record, out = words.packed([end_id]), words.width, 0, 0, None
    try:
        for batch in pieces(batches):
            rows = []
            names = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(names, words.of(batch.column("text"))):
                if out is None:
                    system.create_dir(os.path.dirname(where), recursive=True)
                    out = system.open_output_stream(where)
                framed = frame(NAME.pack(doc_id is not None, doc_id or 0, width) + ids + end)
                out.write(framed)
                rows.append((shard, name, record, doc_id, offset, len(framed), len(ids) // width + 1))
                offset, record = offset + len(framed), record + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int32(), pa.string(), *[pa.int64()] * 5))],
                    names=["shard", "path", "record", "doc_id", "offset", "length", "n_tokens"])
    finally:
        if out is not None:
            out.close()


def write_records(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> DataFrame:
    """Write the ids of every row's whole text, `end_id` after each, and return the index.

    `folder` is a shared folder that pyarrow can write to from every machine, `path` a
    tokenizer file there on every machine; the index is stored as Parquet in folder/index.
    Shards follow doc_id in ascending order, a null doc_id first; rows of one doc_id stand by
    a hash of their text, equal rows side by side. A null or empty text has the end id alone.
    An empty table gives an empty index and no shard. doc_id is a whole number.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("order"))
    ordered = rows.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order")
    index = mapped(ordered.select("doc_id", "text"),
                   partial(_write, folder=folder, path=path, end_id=end_id), INDEX)
    index.write.parquet(f"{folder}/index")
    return read_index(docs.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch], shards: list[tuple]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for number in batch.column("id").to_pylist():
                shard, path, records, start = shards[number]
                system, where = place(path)
                seen = 0
                with system.open_input_stream(where, buffer_size=1 << 20) as file:
                    for record, payload in enumerate(unframed(file)):
                        doc_id, ids = contents(payload)
                        count, seen = len(ids), record + 1
                        yield shard, record, doc_id, start, count, zlib.crc32(ids.astype("<u4"))
                        start += count
                if seen != records:
                    raise ValueError(f"{path}: {seen} records instead of {records}")

    held = []
    for row in rows():
        held.append(row)
        if len(held) == 10_000:
            yield _read_batch(held)
            held = []
    if held:
        yield _read_batch(held)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.int64()] * 5))],
        names=["shard", "record", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_records(index: DataFrame) -> DataFrame:
    """One row per record, from the shards that `index` names: shard, record, doc_id, start
    (ids of all records before it), n_tokens and the CRC-32 of its ids.

    The list of shards, one entry per file as in any table's listing, passes through the
    driver; each shard is read whole by one task, and every checksum and count is checked.
    """
    spark = index.sparkSession
    by_shard = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = [tuple(x) for x in index.groupBy("shard", "path").agg(
        F.count(F.lit(1)).alias("records"), F.sum("n_tokens").alias("tokens")).select(
            "shard", "path", "records",
            F.coalesce(F.sum("tokens").over(by_shard), F.lit(0))).orderBy("shard").collect()]
    return mapped(spark.range(0, len(shards), 1, max(1, len(shards))),
                  partial(_read, shards=shards), READ)


def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A mapInArrow function: index rows, in any order, to (doc_id, ids) read one by one."""
    for batch in batches:
        rows = batch.to_pylist()
        ids = []
        for row in rows:
            system, where = place(row["path"])
            with system.open_input_file(where) as file:
                file.seek(row["offset"])
                payload = next(unframed(file))
            ids.append(contents(payload)[1].tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
            names=["doc_id", "ids"])


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """(doc_id, ids) in an order that depends on seed, each record fetched by its offset."""
    order = F.xxhash64(F.lit(seed), "shard", "record")
    return mapped(index.repartitionByRange(order).sortWithinPartitions(order), fetch,
                  "doc_id long, ids array<long>")


def encode_and_read(docs: DataFrame) -> DataFrame:
    """Write `docs` into a new shared folder and read the files back."""
    folder = shared_folder(docs.sparkSession)
    index = write_records(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_records(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_token_records(spark, folder: str) -> DataFrame:
    """Every document as found in the record files."""
    return encode_and_read(table(spark, folder, "documents"))
