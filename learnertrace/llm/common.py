"""What several operators share: white space, words, the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache, partial

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, and what lies between two pieces of it.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: For bytes.translate: A-Z in lower case, other bytes as they are.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: For bytes.translate: ASCII letters in lower case, digits and all bytes of other
#: characters as they are, every other ASCII character a space. bytes.split() then
#: gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
WORD_BYTES = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256))

#: Characters of text handled at once within a task.
BATCH_CHARS = 8 << 20

#: Applications whose workers have the package.
_sent: set[str] = set()

#: Whether what a query has shuffled goes when it ends, and not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below spark.checkpoint.dir, which all executors reach.

    Where the setting is missing a local session gets a temporary folder; any other
    master is refused, since its executors would not see that folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _temporary(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


@cache
def _temporary(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"llm-{application}-")


def written(frame: DataFrame) -> DataFrame:
    """`frame` as a table in the shared folder, read back: what follows neither repeats
    the work before nor depends on the executors that did it. What it took to shuffle leaves their disks."""
    spark, path = frame.sparkSession, shared_folder(frame.sparkSession)
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)
    return spark.read.schema(frame.schema).parquet(path)


def _giving_back(batches: Iterator[pa.RecordBatch], function) -> Iterator[pa.RecordBatch]:
    """What `function` makes of a task's batches. What the task has freed goes back to the machine at its end:
    the worker lives on, idle, beside later stages, and would keep all it ever needed."""
    try:
        yield from function(batches)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def mapped(frame: DataFrame, function, schema) -> DataFrame:
    """mapInArrow, with this package sent along to Python workers that lack it."""
    context = frame.sparkSession.sparkContext
    if context.applicationId not in _sent:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.realpath(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(), "learnertrace"), "zip", root, "learnertrace"))
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return frame.mapInArrow(partial(_giving_back, function=function), schema)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `most` bytes of `column`, one row at least."""
    for batch in batches:
        sizes = batch.column(column)
        start, held = 0, 0
        for row, value in enumerate(pa.compute.binary_length(sizes).fill_null(0).to_pylist()):
            if held and held + value > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += value
        if start < batch.num_rows:
            yield batch.slice(start)


def encoded(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8; a null is empty."""
    return [x or b"" for x in column.cast(
        pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
