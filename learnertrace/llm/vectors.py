"""Vectors dealt out in blocks: what the exact searches of some rows among all share.

Candidates are packed (some hundred rows in one Arrow message) and each pack goes to one of many
shards; packs of queries go to every shard. A task builds an index of one shard at a time, whose size
is bounded, and answers the queries as a stream, so neither side ever is whole in a task, and
only packs are copied, not rows. What a shard gives is bounded by queries and ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnertrace.llm.common import mapped

#: Rows and components of a pack; components of a shard, as small as makes work for all cores
#: and no larger than a task holds with its index.
PACK_ROWS, PACK_COMPONENTS = 256, 1 << 15
LEAST_SHARD, LARGEST_SHARD = 1 << 17, 4 << 20
LONG = np.iinfo(np.int64)


def usable(rows: DataFrame, key: str, vector: str, *others: Column | str) -> DataFrame:
    """Columns `id`, `vec` (array of doubles) and others, of rows with an id and all of a vector.

    Rows whose vector is null or holds a null or a non-finite component go; so do rows without
    an id, which no result could name. An empty vector stays.
    """
    vec = F.col(vector).cast("array<double>")
    wanting = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~wanting).select(
        F.col(key).cast("long").alias("id"), vec.alias("vec"), *others)


def packed(rows: DataFrame, scale: int) -> DataFrame:
    """One column `pack`: Arrow messages of rows whose components x have become floor(scale * x)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            messages = [message(batch.slice(start, end - start)) for start, end in cuts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(messages, pa.binary())], ["pack"])

    def cuts(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        start, held = 0, 0
        for row, size in enumerate(pa.compute.list_value_length(batch.column("vec")).to_pylist()):
            if row > start and (row - start == PACK_ROWS or held + size > PACK_COMPONENTS):
                yield start, row
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield start, batch.num_rows

    def message(batch: pa.RecordBatch) -> bytes:
        vec = batch.column("vec")
        whole = np.floor(vec.flatten().to_numpy(zero_copy_only=False) * float(scale))
        if not len(whole) or np.abs(whole).max() < 1 << 15:
            whole = whole.astype(np.int16)
        ends = np.cumsum(pa.compute.list_value_length(vec).to_numpy(zero_copy_only=False))
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        batch = batch.set_column(batch.schema.get_field_index("vec"), "vec",
                                 pa.ListArray.from_arrays(offsets, pa.array(whole)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    return mapped(rows, pack, "pack binary")


class Vectors:
    """Rows of packs: ids, sizes, components one after another (whole numbers as doubles), and
    the other columns as lists."""

    def __init__(self, packs: list[bytes]) -> None:
        tables = [pa.ipc.open_stream(pack).read_all() for pack in packs]
        columns = {name: pa.chunked_array([c for t in tables for c in t.column(name).chunks])
                   for name in tables[0].column_names if name != "vec"}
        lists = [c for t in tables for c in t.column("vec").chunks]
        self.ids = columns.pop("id").to_numpy()
        self.sizes = np.concatenate([pa.compute.list_value_length(c).to_numpy() for c in lists]).astype(np.int64)
        self.values = np.concatenate([c.flatten().to_numpy().astype(np.float64) for c in lists])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.others = {name: column.to_pylist() for name, column in columns.items()}
        self.largest = float(np.abs(self.values).max(initial=0))

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, row: int) -> np.ndarray:
        return self.values[self.starts[row]:self.starts[row] + self.sizes[row]]


def exact_in_doubles(query: np.ndarray, largest: float) -> bool:
    """Whether sums of products with components up to `largest` are exact in doubles."""
    return float(np.abs(query).sum()) * largest < 2.0**53


def as_long(scores: list | np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; those beyond become the nearest."""
    if isinstance(scores, np.ndarray) and scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in scores], np.int64)


def shards(rows: DataFrame) -> int:
    """How many shards the vectors of `rows` (as `usable` gives them) make."""
    total = rows.agg(F.sum(F.size("vec") + 1)).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = min(max(total // (4 * cores), LEAST_SHARD), LARGEST_SHARD)
    return max(1, -(-total // size))


def searched(candidates: DataFrame, queries: DataFrame, n_shards: int,
             index: Callable[[Vectors], Callable[[Vectors], pa.RecordBatch]], schema: str) -> DataFrame:
    """What `index(candidates of a shard)(queries of a pack)` gives, over all shards and packs.

    Both sides are as `packed` gives them. A pack's shard is a hash of its place in the scan, so no
    value of the data, however frequent, can gather packs in one shard.
    """
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_shards)).cast("int")
    dealt = candidates.select(place.alias("shard"), F.lit(0).alias("kind"), "pack")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), F.lit(1).alias("kind"), "pack")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches
                for row in zip(*(batch.column(name).to_pylist() for name in ("shard", "kind", "pack"))))
        for _, shard in groupby(rows, itemgetter(0)):
            packs, first = [], None
            for row in shard:
                if row[1]:
                    first = row
                    break
                packs.append(row[2])
            if not packs or first is None:
                continue
            answer = index(Vectors(packs))
            del packs
            for _, _, pack in chain([first], shard):
                yield answer(Vectors([pack]))

    tiles = dealt.unionByName(asked).repartition(n_shards, "shard").sortWithinPartitions("shard", "kind")
    return mapped(tiles, search, schema)


def best(found: DataFrame, of: list[str], score: str, key: str, most: int) -> DataFrame:
    """The `most` rows with the highest scores of each group, ties to the smaller key, with their rank."""
    order: list[Column] = [F.col(score).desc(), F.col(key).asc()]
    rank = F.row_number().over(Window.partitionBy(*of).orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)
