"""Numpy within tasks: functions over Arrow batches, and sums of arrays by group."""

from __future__ import annotations

import os
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Applications whose workers have the package.
_sent: set[str] = set()

#: Partial sums that may go to the driver at once; of more, each group's are added up by tasks first.
PARTS = 16


def mapped(frame: DataFrame, function, schema) -> DataFrame:
    """mapInArrow, with this package sent along to Python workers that lack it."""
    context = frame.sparkSession.sparkContext
    if context.applicationId not in _sent:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.realpath(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(), "learnertrace"), "zip", root, "learnertrace"))
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return frame.mapInArrow(function, schema)


def finished(
    blocks: DataFrame, measure: Callable[[int, dict], Iterator[tuple[int, np.ndarray]]],
    finish: Callable[[int, int, np.ndarray], object],
) -> dict[tuple[int, int], object]:
    """Per group and piece, `finish(group, piece, total)` of the sum over the group's blocks of what
    `measure(group, block)` yields for the piece, an array of any fixed size.

    `blocks` has the group (int) and `block`, as for `totals`. The sums are added up and finished
    by tasks that share the pieces, so the driver only sees what `finish` makes of them.
    """
    def added(rows: Iterator[tuple[tuple[int, int], np.ndarray]]) -> dict[tuple[int, int], np.ndarray]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for key, part in rows:
            if key in sums:
                sums[key] += part
            else:
                sums[key] = np.array(part)
        return sums

    def rows_of(cells: Iterator[tuple[int, int, object]]) -> Iterator[pa.RecordBatch]:
        for key, piece, value in cells:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()), pa.array([piece], pa.int32()),
                 pa.array([pickle.dumps(value)], pa.binary())], ["key", "piece", "total"])

    def loaded(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield *(batch.column(j)[k].as_py() for j in range(column)), pickle.loads(batch.column(column)[k].as_buffer())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (((key, piece), part) for key, block in loaded(batches, 1) for piece, part in measure(key, block))
        yield from rows_of((*key, total) for key, total in added(parts).items())

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = added(((key, piece), part) for key, piece, part in loaded(batches, 2))
        yield from rows_of((*key, finish(*key, total)) for key, total in sums.items())

    schema = "key int, piece int, total binary"
    group = blocks.columns[0]
    parts = mapped(blocks.select(group, "block"), measured, schema)
    return {(row["key"], row["piece"]): pickle.loads(row["total"])
            for row in mapped(parts.repartition("key", "piece"), ended, schema).collect()}


def totals(blocks: DataFrame, group: str, measure: Callable[[int, dict], np.ndarray]) -> dict[int, np.ndarray]:
    """Per group, the sum over its blocks of `measure(group, block)`, an array of any fixed size.

    `blocks` has the group (int) and `block`, a pickled dictionary of arrays. Tasks add up
    their own blocks, so what leaves them does not grow with their rows.
    """
    def added(rows: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for key, part in rows:
            sums[key] = sums[key] + part if key in sums else part
        for key, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()), pa.array([pickle.dumps(total)], pa.binary())], [group, "total"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                yield row[0], pickle.loads(row[1])

    schema = f"{group} int, total binary"
    parts = mapped(blocks.select(group, "block"), lambda batches: added(
        (key, measure(key, block)) for key, block in cells(batches)), schema)
    if parts.rdd.getNumPartitions() > PARTS:
        parts = mapped(parts.repartition(group), lambda batches: added(cells(batches)), schema)
    found: dict[int, np.ndarray] = {}
    for row in parts.collect():
        part = pickle.loads(row["total"])
        found[row[group]] = found[row[group]] + part if row[group] in found else part
    return found
