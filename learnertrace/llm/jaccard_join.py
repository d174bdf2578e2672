"""N-gram Jaccard join by count vectors in an R-tree.

Each document is the set of its word shingles, as 64-bit hashes. Shingles are hashed into
groups; how many fall into each group makes a point. Two sets share at most the sum of the
smaller count of each group, and that bound, taken with the largest counts of a node of an
R-tree, tells which parts of the tree can hold a partner. What passes is compared exactly.

No machine can hold one tree, and in many dimensions a tree over unrelated texts prunes
little, so the sets are first dealt out by an exact criterion on the same kind of groups.
Linked sets differ in at most d shingles, where d follows from their sizes. With more than
d groups, some group holds the very same shingles in both. So sets of about the same size
meet under a key per group (band of sizes, group, hash of the group's content). Texts that
share some passage meet as well, more of them the more texts there are, so those who
meet are first compared by the counts of their sets in ranges of the hashes, which bound what two
share; sets that are joined by what passes, directly or through others, form a block. No link leaves a
block. Of equal sets one text does all this; texts that are near copies of nothing travel no further.

Within a block a search goes from set to set: each finds, in the block's tree, its partners
among those not yet reached. A group of near copies costs about one search for each member
rather than each pair, and gives one row for each member. A block too large for a task is parted
by size, and a part that still is too large cut into tiles, each pair of which is one task; the
components found there are joined at the end.

Sets and texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import LOWER_BYTES, NOT_SPACE, encoded, mapped, pieces, table, written

MEETING = "key long, node long"
COMPANY = "company long, first long, node long"

#: Shingles that one task holds of a block, and the seeds for dealing shingles into groups.
BLOCK_SHINGLES = 3_000_000
SEEDS = 4

#: Parts in which keys are shuffled one after the other, so that not all are on the disks at once; each reads the texts.
TURNS = 2

#: Sets of a company that one task compares with each other, and the largest count of a range that is told.
COMPANY_SETS = 4096
MANY = 15

LEAF = 32

#: Shingles that are compared at once.
AT_ONCE = 500_000

#: Size of the filter that keeps texts outside blocks from being shuffled: 8 MB.
FILTER_BITS = 1 << 26


# --- sets of shingles -------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


@cache
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** k and its inverse ** k, modulo 2 ** 64, for k below 2 ** bits."""
    found = []
    for factor in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(1 << bits, np.uint64(factor))
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    return found[0], found[1]


def shingles(text: bytes, words: int) -> np.ndarray:
    """The set of hashes of `words` consecutive words, ascending; A-Z count as a-z.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    letters = np.frombuffer(text.translate(LOWER_BYTES), dtype=np.uint8)
    if not len(letters):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(max(16, int(len(letters)).bit_length()))
    solid = np.empty(len(letters) + 2, dtype=np.int8)
    solid[0] = solid[-1] = 0
    solid[1:-1] = ~BLANK[letters]
    edges = np.flatnonzero(np.diff(solid))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    # A word's hash is a difference of running sums, shifted back to the word's start.
    sums = np.empty(len(letters) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(SPREAD[letters] * up[:len(letters)], out=sums[1:])
    word = mix((sums[ends] - sums[starts]) * down[starts])
    taken = min(words, len(word))
    count = len(word) - taken + 1
    found = word[:count]
    for k in range(1, taken):
        found = found * np.uint64(BASE) + word[k:k + count]
    return np.unique(mix(found + np.uint64(taken)))


def signature(found: np.ndarray) -> int:
    """A hash of the set, as a signed number."""
    if not len(found):
        return 0
    return int(mix(mix(found ^ np.uint64(BASE)).sum(keepdims=True) + np.uint64(len(found))).view(np.int64)[0])


# --- meetings ---------------------------------------------------------------------------

class Bands:
    """Bands of set sizes, so that linked sets lie in the same band or in neighbours."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.edges = [1]

    def of(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def groups(self, band: int) -> tuple[int, int]:
        """How many groups sets are dealt into that meet in `band`, and how many of the groups
        with equal content may be empty in a set before it counts as thinly spread."""
        self.of(1)
        while len(self.edges) < band + 2:
            self.of(self.edges[-1])
        largest = self.edges[band + 1] - 1
        differ = 2 * largest * (100 - self.percent) // (100 + self.percent)
        # Groups that come out empty in the smallest sets that meet here, with a margin.
        smallest, spare = self.edges[max(band - 1, 0)], 0
        while True:
            count = differ + 1 + spare
            empty = count * math.exp(-smallest / count)
            more = min(int(empty + 2 * empty ** 0.5), differ * 15 // 100)
            if more <= spare:
                return count, spare
            spare = more


def keys(found: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set meets others."""
    band, every = bands.of(len(found)), []
    for meet in (band, band + 1):
        count, spare = bands.groups(meet)
        for seed in range(SEEDS):
            dealt = found if seed == 0 else np.sort(mix(found + np.uint64(seed)))
            # Groups are equal ranges of the hashes, which the set holds in order.
            step = np.uint64(min((1 << 64) // count + 1, (1 << 64) - 1))
            limits = np.searchsorted(dealt, np.arange(1, count, dtype=np.uint64) * step)
            limits = np.concatenate(([0], limits, [len(dealt)]))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(dealt + np.uint64(BASE)))))
            content = sums[limits[1:]] - sums[limits[:-1]]
            full = np.flatnonzero(limits[1:] > limits[:-1])
            tag = np.uint64(((meet * SEEDS + seed) * BASE) & 0xFFFFFFFFFFFFFFFF)
            every.append(mix(mix(content[full] + tag) + full.astype(np.uint64)))
            if count - len(full) <= spare:
                break
            # Sets that agree in empty groups only are both thinly spread: they meet under
            # another dealing, and if thin under all, under one key.
        else:
            every.append(mix(np.array([tag], dtype=np.uint64)))
    return np.concatenate(every)


def _meetings(batches: Iterator[pa.RecordBatch], words: int, percent: int, turn: int) -> Iterator[pa.RecordBatch]:
    """(key, node) for every key of a text's set that has its turn."""
    bands = Bands(percent)
    for batch in pieces(batches):
        seen, many, nodes = set(), [], []
        for text in encoded(batch.column("text")):
            found = shingles(text, words)
            node = signature(found)
            if len(found) and node not in seen:
                seen.add(node)
                every = keys(found, bands)
                many.append(every[every % np.uint64(TURNS) == turn].view(np.int64))
                nodes.append(node)
        if many:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(many), pa.int64()),
                 pa.array(np.repeat(np.array(nodes, np.int64), [len(x) for x in many]), pa.int64())],
                names=["key", "node"])


def _gathered(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """(company, first, node) for the keys, sorted with their nodes, under which several nodes meet.

    A company is known by a hash of its nodes, so keys under which the same nodes meet count once.
    """
    own = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
    key, node = key[own], node[own]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(starts, append=len(key))
    company = mix(np.add.reduceat(mix(node.view(np.uint64) ^ np.uint64(BASE)), starts)
                  + sizes.astype(np.uint64)).view(np.int64)
    taken = np.zeros(len(starts), dtype=bool)
    taken[np.unique(company, return_index=True)[1]] = True
    taken &= sizes > 1
    row = np.repeat(taken, sizes)
    sizes = sizes[taken]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(company[taken], sizes), pa.int64()),
         pa.array(np.repeat(node[starts[taken]], sizes), pa.int64()), pa.array(node[row], pa.int64())],
        names=["company", "first", "node"])


def _companies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meetings sorted by key and node to companies; the rows of a last key wait for the next batch."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key, node = (batch.column(c).to_numpy() for c in ("key", "node"))
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if waiting and (cut or waiting[0][0][0] != key[0]):
            waiting.append((key[:cut], node[:cut]))
            yield _gathered(*map(np.concatenate, zip(*waiting)))
            waiting = []
        elif cut:
            yield _gathered(key[:cut], node[:cut])
        waiting.append((key[cut:], node[cut:]))
    if waiting:
        yield _gathered(*map(np.concatenate, zip(*waiting)))


# --- who of a company may be linked ---------------------------------------------------------

def counts(found: np.ndarray) -> np.ndarray:
    """How many elements of a set lie in each of so many equal ranges that one or two do on average;
    MANY stands for as many or more."""
    bits = max(1, len(found).bit_length() - 1)
    cells = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(cells, MANY).astype(np.uint8)


def packed(cells: np.ndarray) -> bytes:
    """Counts as half bytes."""
    return (cells[::2] | cells[1::2] << 4).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    both = np.frombuffer(data, dtype=np.uint8)
    return np.stack((both & 15, both >> 4), axis=1).ravel()


def folded(cells: np.ndarray, size: int) -> np.ndarray:
    """Counts over `size` ranges, out of those over more."""
    if len(cells) == size:
        return cells
    return np.minimum(cells.reshape(size, -1).sum(1), MANY).astype(np.uint8)


def possible(own: np.ndarray, size: int, cells: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets with these counts (a line each) may be linked with the set of counts `own`: they share
    at most the sum of the lesser counts."""
    least = np.minimum(cells, own)
    full = (least == MANY).any(1) if (own == MANY).any() else False
    return full | (least.sum(1, dtype=np.int64) * (100 + percent) >= percent * (sizes + size))


def close(every: list[np.ndarray], sizes: np.ndarray, roots: np.ndarray, percent: int) -> np.ndarray:
    """For each set the number of the first set that possible links and common roots join it with."""
    least = min(map(len, every))
    cells = np.stack([folded(x, least) for x in every])
    kin = np.unique(roots, return_inverse=True)[1]
    left, first = np.ones(len(every), dtype=bool), np.full(len(every), -1)
    for start in range(len(every)):
        if not left[start]:
            continue
        open_ = np.flatnonzero(kin == kin[start]).tolist()
        left[open_], first[open_] = False, start
        while open_ and left.any():
            k = open_.pop()
            among = np.flatnonzero(left)
            found = among[possible(cells[k], sizes[k], cells[among], sizes[among], percent)]
            if len(found):
                found = np.flatnonzero(left & np.isin(kin, kin[found]))
                left[found], first[found] = False, start
                open_.extend(found.tolist())
    return first


def _counted(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = [shingles(text, words) for text in encoded(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(signature, found), pa.int64()), pa.array(map(len, found), pa.int64()),
             pa.array([packed(counts(x)) for x in found], pa.binary())], names=["node", "size", "counts"])


def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that may be linked, of pairs with their sizes and counts."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("a_counts", "a_size", "b_counts", "b_size")))
        passed = []
        for a, a_size, b, b_size in rows:
            one, other = unpacked(a), unpacked(b)
            least = min(len(one), len(other))
            passed.append(bool(possible(folded(one, least), a_size, folded(other, least)[None],
                                        np.array([b_size]), percent)[0]))
        yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))


def _close(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Companies, sorted by company and tiles, to (a, b): a node and the first that it may be joined with there."""
    def solved(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        node, root, size, data = zip(*rows)
        own = np.array(node, np.int64)
        return own[close([unpacked(x) for x in data], np.array(size), np.array(root, np.int64), percent)], own

    at, rows, done = None, [], []
    for batch in batches:
        for *here, node, root, size, data in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            if here != at:
                if rows:
                    done.append(solved(rows))
                at, rows = here, []
            rows.append((node, root, size, data))
        if done:
            yield _roots(done)
            done = []
    if rows:
        yield _roots([solved(rows)])


def joined(companies: DataFrame, texts: DataFrame, words: int, percent: int, most: int) -> DataFrame:
    """Pairs (a, b) of nodes that connect, directly or through others, all linked nodes of a company.

    Nodes that met by chance, or under what many texts say, are told apart by the counts of their sets, some hundredths of
    a text in size. First each company's first node is compared with the others; then all nodes of those that
    this leaves in several parts. `texts` has the node's texts, perhaps among others. Of a company of more
    than `most` nodes each pair of tiles is one task.
    """
    sets = written(mapped(texts.select("text"), partial(_counted, words=words), "node long, size long, counts binary")
                   .dropDuplicates(["node"]))

    def seen(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("size").alias(f"{name}_size"),
                           F.col("counts").alias(f"{name}_counts"))

    stars = companies.filter("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    stars = written(mapped(stars.join(seen("a"), "a").join(seen("b"), "b"), partial(_possible, percent=percent),
                           "a long, b long"))
    known = companies.join(components(stars), "node", "left").select(
        "company", "node", F.coalesce("root", "node").alias("root"))
    # Of two nodes the first was compared with the other.
    parted = written(known.groupBy("company").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("last"))
        .filter("n > 2 AND least <> last").select("company", F.ceil(F.col("n") / F.lit(most)).cast("int").alias("tiles")))
    tile, other = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"), F.col("beside")
    dealt = (known.join(parted, "company").join(sets, "node")
             .withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("company", F.least(tile, other).alias("tile"), F.greatest(tile, other).alias("other"),
                     "node", "root", "size", "counts"))
    at = ["company", "tile", "other"]
    found = mapped(dealt.repartition(*at).sortWithinPartitions(*at, "node"), partial(_close, percent=percent),
                   "a long, b long")
    return stars.unionByName(written(found.filter("a <> b").distinct()))


# --- components -------------------------------------------------------------------------

def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node in `pairs` (a, b); root is the least node of its component.

    Each round hangs every node's larger neighbours, then itself and its smaller ones, onto the
    least of them; rounds grow with the logarithm of a component's diameter. Least neighbours
    are taken by a map-side aggregate, so a node with very many neighbours is no hot group.
    """
    edges = written(pairs.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("m"))
                    .filter(F.col("x") != F.col("m")).distinct())
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "m").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        # Neighbours above u go to the least of u and all its neighbours.
        both = edges.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(
            edges.select(F.col("m").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        below = (both.filter(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # u and its neighbours below go to the least of these.
        least = below.groupBy("u").agg(F.min("v").alias("m"))
        moved = below.join(least, "u").select(F.col("v").alias("x"), "m").unionByName(
            least.select(F.col("u").alias("x"), "m"))
        edges = written(moved.filter(F.col("x") != F.col("m")).distinct())
    return edges.select(F.col("x").alias("node"), F.col("m").alias("root")).unionByName(
        edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())


# --- search within blocks ---------------------------------------------------------------

class Tree:
    """An R-tree over the group counts of sets.

    Points are sorted by size and counts and packed; a node keeps the largest count of each
    group and the least and largest size below it.
    """

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets])
        groups = 16
        while groups < 256 and groups * 8 < self.sizes.max():
            groups *= 2
        step = np.uint64((1 << 64) // groups)
        limits = np.arange(1, groups, dtype=np.uint64) * step
        self.points = np.empty((len(sets), groups), dtype=np.int32)
        for k, found in enumerate(sets):
            self.points[k] = np.diff(np.searchsorted(found, limits), prepend=0, append=len(found))
        self.order = np.lexsort((*self.points.T[:3], self.sizes))
        self.levels = []
        high, low, top = self.points[self.order], self.sizes[self.order], self.sizes[self.order]
        while True:
            cuts = np.arange(0, len(high), LEAF)
            high = np.maximum.reduceat(high, cuts)
            low, top = np.minimum.reduceat(low, cuts), np.maximum.reduceat(top, cuts)
            self.levels.append((high, low, top))
            if len(high) == 1:
                break
        self.levels.reverse()

    def search(self, k: int, left: np.ndarray) -> np.ndarray:
        """Sets of `left` (a flag per set) that may be partners of set k."""
        point, size, t = self.points[k], self.sizes[k], self.percent

        def passes(high, low, top):
            # Partners have t% to 1/t% of the size and share t / (100 + t) of both sizes.
            return ((top * 100 >= size * t) & (low * t <= size * 100)
                    & (np.minimum(high, point).sum(1) * (100 + t) >= t * (size + low)))

        nodes = np.zeros(1, dtype=np.int64)
        for high, low, top in self.levels:
            nodes = nodes[nodes < len(high)]
            nodes = nodes[passes(high[nodes], low[nodes], top[nodes])]
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
        found = self.order[nodes[nodes < len(self.order)]]
        found = found[left[found]]
        return found[passes(self.points[found], self.sizes[found], self.sizes[found])]


def overlaps(own: np.ndarray, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """How many elements each of the other sets shares with `own`, some sets at a time."""
    found, start = [], 0
    ends = np.cumsum(sizes)
    while start < len(others):
        held = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, held + AT_ONCE, side="right")))
        every, part = np.concatenate(others[start:stop]), sizes[start:stop]
        at = np.minimum(np.searchsorted(own, every), len(own) - 1)
        found.append(np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(part) - part))
        start = stop
    return np.concatenate(found)


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the number of the first set of its component."""
    root = np.full(len(sets), -1)
    tree = Tree(sets, percent)
    left = np.ones(len(sets), dtype=bool)
    for start in range(len(sets)):
        if not left[start]:
            continue
        left[start], root[start], open_ = False, start, [start]
        while open_:
            k = open_.pop()
            found = tree.search(k, left)
            if not len(found):
                continue
            sizes, own = tree.sizes[found], sets[k]
            shared = overlaps(own, [sets[j] for j in found], sizes)
            found = found[100 * shared >= percent * (sizes + len(own) - shared)]
            left[found], root[found] = False, start
            open_.extend(found.tolist())
    return root


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, part, tiles, node, text) to (block, part, tile, other, node, text), for each pair of tiles.

    Texts are dealt out and not their sets: a text is shorter than its set, and compresses.
    """
    for batch in pieces(batches, most=1 << 20):
        seen, rows = set(), []
        places = zip(*(batch.column(c).to_pylist() for c in ("block", "part", "tiles", "node")))
        for (block, part, tiles, node), text in zip(places, encoded(batch.column("text"))):
            if (block, part, node) in seen:
                continue
            seen.add((block, part, node))
            tile = node % tiles
            rows.extend((block, part, min(tile, other), max(tile, other), node, text)
                        for other in range(tiles))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             names=["block", "part", "tile", "other", "node", "text"])


def _linked(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Texts sorted by block, part and tiles to (a, b): a node and the first of its component there."""
    def solved(nodes: list[int], sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = np.array(nodes, np.int64)
        return own[linked(sets, percent)], own

    at, nodes, sets, done = None, [], [], []
    for batch in batches:
        for *here, node, data in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            if here != at:
                if nodes:
                    done.append(solved(nodes, sets))
                at, nodes, sets = here, [], []
            if not nodes or node != nodes[-1]:
                nodes.append(node)
                sets.append(shingles(data, words))
        if done:
            yield _roots(done)
            done = []
    if nodes:
        yield _roots([solved(nodes, sets)])


def _roots(done: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([d[k] for d in done]), pa.int64()) for k in (0, 1)], names=["a", "b"])


# --- texts of blocks ---------------------------------------------------------------------

def with_likely(texts: DataFrame, wanted: DataFrame, bits: int = FILTER_BITS, by: str = "text_hash") -> DataFrame:
    """`texts` with a flag `likely`, true wherever the hash `by` is one of `wanted`, and seldom elsewhere.

    A bitmap with a bit for each hash modulo `bits` is broadcast, in rows of 4 KB; its
    size does not depend on the data. When it fills up it only flags more rows.
    """
    at = F.pmod(F.col(by), F.lit(bits)) + 1
    bitmap = wanted.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bitmap", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return texts.withColumn("bucket", F.bitmap_bucket_number(at)).join(
        F.broadcast(bitmap), "bucket", "left").select(*texts.columns, F.coalesce(is_set, F.lit(False)).alias("likely"))


# --- the join ---------------------------------------------------------------------------

def _described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = [shingles(text, words) for text in encoded(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("doc_id"), batch.column("text_hash"), batch.column("row_hash"),
             pa.array(map(len, found), pa.int64()), pa.array(map(signature, found), pa.int64())],
            names=["doc", "doc_id", "text_hash", "row_hash", "n_shingles", "node"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    block_shingles: int = BLOCK_SHINGLES, company_sets: int = COMPANY_SETS) -> DataFrame:
    """doc_id, n_shingles, component_id, first, text_hash of every row of `docs`.

    Texts are linked when their sets of `words`-word shingles share at least `percent` percent of
    their union; component_id is the least doc_id that links reach (null ids only if there is
    no other), first tells the one row of a component that a filter keeps: the least doc_id,
    and of repeated rows one. A text without words, or null, is linked with nothing: it is its own
    component and kept. Other columns are ignored, an empty table gives an empty result.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text")).withColumn("row_hash", F.xxhash64("doc_id", "text_hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = written(mapped(
        texts.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text_hash", "row_hash", "text"),
        partial(_described, words=words),
        f"doc long, doc_id {kind}, text_hash long, row_hash long, n_shingles long, node long"))

    # Of texts with the same set one row stands for all.
    sets = written(nodes.filter("n_shingles > 0").groupBy("node").agg(
        F.min("row_hash").alias("row_hash"), F.max("n_shingles").alias("n_shingles")))
    own = with_likely(texts.select("row_hash", "text"), sets, by="row_hash").filter("likely")
    companies = reduce(DataFrame.unionByName, [
        written(mapped(mapped(own.select("text"), partial(_meetings, words=words, percent=percent, turn=turn), MEETING)
                       .repartition("key").sortWithinPartitions("key", "node"), _companies, COMPANY).distinct())
        for turn in range(TURNS)])
    met = sets.join(companies.select("node").distinct(), "node", "left_semi")
    meeting = with_likely(texts.select("row_hash", "text"), written(met.select("row_hash")), by="row_hash").filter("likely")
    pairs = joined(companies, meeting, words, percent, company_sets)
    blocks = components(pairs)

    # One text for each set of a block. A block too large for a task is first parted by size: linked
    # sets lie in the same band or in neighbours, so each set goes to its own and the next one's part.
    sets = blocks.join(sets, "node")
    bands = Bands(percent)
    bands.of(nodes.agg(F.coalesce(F.max("n_shingles"), F.lit(1))).first()[0])
    band = F.size(F.filter(F.array(*map(F.lit, bands.edges)), lambda edge: edge <= F.col("n_shingles"))) - 1
    large = F.col("total") > block_shingles
    parted = sets.join(sets.groupBy("root").agg(F.sum("n_shingles").alias("total")), "root").withColumn(
        "part", F.explode(F.when(large, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))))
    tiles = parted.groupBy("root", "part").agg(
        F.ceil(F.sum("n_shingles") / F.lit(block_shingles)).cast("int").alias("tiles"),
        F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    wanted = written(parted.join(tiles, ["root", "part"]).select(
        "row_hash", "node", F.col("root").alias("block"), "part", "tiles"))
    several = bool(wanted.filter("tiles > 1 OR part >= 0").head(1))
    members = with_likely(texts.select("row_hash", "text"), wanted, by="row_hash").filter("likely").join(wanted, "row_hash")
    dealt = mapped(members.select("block", "part", "tiles", "node", "text"), _tiled,
                   "block long, part int, tile int, other int, node long, text binary")
    at = ["block", "part", "tile", "other"]
    found = mapped(dealt.repartition(*at).sortWithinPartitions(*at, "node"),
                   partial(_linked, words=words, percent=percent), "a long, b long")
    if several:
        roots = components(found.filter("a <> b"))
    else:
        roots = written(found).select(F.col("b").alias("node"), F.col("a").alias("root"))

    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    full, empty = named.filter("n_shingles > 0"), named.filter("n_shingles = 0")
    least = full.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc")).alias("least"))
    return full.join(least, "root").select(
        "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("doc") == F.col("least.doc")).alias("first"), "text_hash").unionByName(empty.select(
            "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"),
            "text_hash"))


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` without near duplicates of kept ones, with the columns of `docs`.

    One row of each component stays. A row is known by its doc_id and a hash of its text.
    """
    found = written(near_duplicates(docs, **settings))
    stays = found.filter(F.col("first") & (F.col("n_shingles") > 0)).select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = with_likely(docs.select(row, F.col("doc_id").alias("id"), F.xxhash64(text).alias("text_hash")),
                       found.filter(~F.col("first")).select("text_hash"))
    # Only rows with the text of a dropped one are shuffled.
    kept = rows.filter("likely").alias("l").join(
        stays.alias("r"), F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.text_hash") == F.col("r.hash")),
        "left_semi")
    if found.filter("n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1").head(1):
        kept = kept.dropDuplicates(["id", "text_hash"])
    blank = ~F.regexp_like(F.coalesce(F.col("row.text").cast("string"), F.lit("")), F.lit(NOT_SPACE))
    rest = rows.filter(~F.col("likely") | blank)
    return kept.filter(~blank).unionByName(rest).select("row.*")


def op7_jaccard_join(spark, folder: str) -> DataFrame:
    """Every document with its component of links at 85% of 4-word shingles."""
    found = near_duplicates(table(spark, folder, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[place:place + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS place
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, s.size, t.size
    HAVING 100 * count(*) >= 85 * (s.size + t.size - count(*))),
reached AS (
    SELECT doc_id AS x, doc_id AS y FROM words
    UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
LEFT JOIN sizes USING (doc_id)
"""
