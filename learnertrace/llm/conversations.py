"""Repair of conversations whose turns were lost, emptied, repeated or given to the wrong role.

A conversation should read `(s?(ua)+)?` by the initials of its roles. Its turns, in order, are
aligned to each feasible length of that alternating string by edits with costs, and the cheapest
edits are its audit:

    K  keep a turn (0)                      R  give it the role user or assistant (2)
    D  delete it (3); the only edit of a blank or a repeated turn
    I  insert an empty turn of user or assistant (2)

A truncated turn that is not deleted costs 1 more. Of equally cheap audits the least in ASCII
is taken.

Method: Wagner-Fischer. Targets of all lengths end alike (.. u a u a), so the cost of turning the
turns from i on into the last r symbols holds for every length; one table has them all. Ukkonen:
with k turns left that may stay, r symbols cost at least 2 * |r - k| more than the unavoidable
edits, so only the cells within half of what an incumbent (a repair found in one walk) exceeds these
are computed. All lengths that reach the least cost are then traced together, letter by letter,
and compared as they go.

Texts never meet in memory: the table needs one byte a turn, for which only digests are
shuffled, and the repaired turns are a stream of sorted turns behind their audit. A task holds
the bytes, digests and audit of one conversation at a time, and of its table, where that is large,
every so many-th row (the rows between are computed again when the trace comes to them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from math import isqrt
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnertrace.llm.common import mapped, table, written

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FORCED, TRUNCATED = 4, 8

#: Cells of a table that are kept at once.
CELLS = 4 << 20

#: Conversations up to this many turns share what was found for the same bytes.
SHORT = 64

FAR = np.int64(1) << 40
SPACES = " \t\n\x0b\f\r"
AUDIT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _incumbent(codes: bytes) -> int:
    """The cost of a repair found in one walk: insert what lacks before u and a, rerole others."""
    cost, wanted, system, pairs = 0, USER, False, False
    for code in codes:
        role = code & 3
        if code & FORCED:
            cost += DELETE
            continue
        cost += bool(code & TRUNCATED)
        if role == SYSTEM and not system and not pairs:
            system = True
            continue
        if role in (SYSTEM, OTHER):
            cost += REROLE
        elif role != wanted:
            cost += INSERT
            wanted = role
        pairs, wanted = True, USER + ASSISTANT - wanted
    if wanted == ASSISTANT:
        cost += INSERT
    return cost + (2 * INSERT if system and not pairs else 0)


class _Table:
    """Rows of least costs: row i, column j is the cost of making the last r = left[i] + j - width
    symbols of the target from the turns i, i + 1, ...; `left` counts those that may stay."""

    def __init__(self, codes: bytes) -> None:
        self.codes, self.n = codes, len(codes)
        code = np.frombuffer(codes, np.uint8)
        may_stay = (code & FORCED) == 0
        self.left = np.zeros(self.n + 1, np.int64)
        self.left[:-1] = np.cumsum(may_stay[::-1])[::-1]
        least = DELETE * int((~may_stay).sum()) + int((may_stay & ((code & TRUNCATED) > 0)).sum())
        self.width = (_incumbent(codes) - least) // 2 + 1
        self.offsets = np.arange(-self.width, self.width + 1)
        self.steps = INSERT * np.arange(len(self.offsets))
        self.every = 1 if self.n * len(self.offsets) <= CELLS else isqrt(self.n)
        self.block, self.first = None, -1
        self._fill()

    def symbols(self, i: int) -> np.ndarray:
        """r of each column of row i."""
        return self.offsets + self.left[i]

    def _above(self, i: int, below: np.ndarray) -> np.ndarray:
        """Row i from row i + 1."""
        code = self.codes[i]
        if code & FORCED:
            return np.minimum(below + DELETE, FAR)
        r = self.symbols(i)
        row = below + (REROLE + bool(code & TRUNCATED))
        if code & 3 in (USER, ASSISTANT):
            row[(r & 1) == (code & 3 == ASSISTANT)] -= REROLE
        row[r < 1] = FAR
        row[:-1] = np.minimum(row[:-1], below[1:] + DELETE)
        row[r < 0] = FAR
        return np.minimum(np.minimum.accumulate(row - self.steps) + self.steps, FAR)

    def _fill(self) -> None:
        """From the last row to the first; every so many-th row stays."""
        r = self.symbols(self.n)
        row = np.where(r < 0, FAR, INSERT * r)
        self.kept = {self.n: row}
        #: Row i of a leading system turn -> least cost of all that keeps that turn.
        self.system: dict[int, int] = {}
        for i in range(self.n - 1, -1, -1):
            if self.codes[i] & (3 | FORCED) == SYSTEM:
                r = self.symbols(i + 1)
                behind = row[(r >= 2) & (r & 1 == 0)]
                if len(behind):
                    self.system[i] = DELETE * i + bool(self.codes[i] & TRUNCATED) + int(behind.min())
            row = self._above(i, row)
            if i % self.every == 0:
                self.kept[i] = row

    def row(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        start = i - i % self.every
        if self.first != start:
            last = min(start + self.every, self.n)
            rows = [self.kept[last]]
            for k in range(last - 1, start - 1, -1):
                rows.append(self._above(k, rows[-1]))
            self.block, self.first = rows[::-1], start
        return self.block[i - start]

    def audit(self) -> tuple[int, str]:
        """The least cost, and of all lengths' cheapest audits the least."""
        r, row, i = self.symbols(0), self.row(0), 0
        whole = (r >= 0) & (r & 1 == 0)
        least = int(row[whole].min(initial=FAR))
        least = min(least, *self.system.values()) if self.system else least
        # Columns of row i that the letters so far lead to; and whether a system turn may still come.
        here = whole & (row == least)
        leading = [k for k, cost in self.system.items() if cost == least]
        until, letters = max(leading, default=-1), []
        leading = set(leading)
        while i < self.n or not here[self.width]:
            row = self.row(i)
            below = self.row(i + 1) if i < self.n else None
            if i < self.n:
                code = self.codes[i]
                gone = np.full_like(row, FAR)
                if code & FORCED:
                    gone = below + DELETE
                else:
                    gone[:-1] = below[1:] + DELETE
                after = here & (gone == row)
                if after.any() or until > i:
                    if not code & FORCED:
                        after = np.concatenate(([False], after[:-1]))
                    letters.append("D")
                    here, i = after, i + 1
                    until = until if until >= i else -1
                    continue
            put = here.copy()
            put[0] = False
            put[1:] &= row[:-1] + INSERT == row[1:]
            if put.any():
                letters.append("I")
                here, until = np.concatenate((put[1:], [False])), -1
                continue
            same = np.zeros(len(row), bool)
            extra = bool(code & TRUNCATED)
            r = self.symbols(i)
            if not code & FORCED and code & 3 in (USER, ASSISTANT):
                fits = (r >= 1) & ((r & 1) == (code & 3 == ASSISTANT))
                same = here & fits & (below + extra == row)
            if until >= 0 and i in leading:
                r = self.symbols(i + 1)
                same |= (r >= 2) & (r & 1 == 0) & (below + (extra + DELETE * i) == least)
            if same.any():
                letters.append("K")
                here = same
            else:
                letters.append("R")
                here = here & (below + (extra + REROLE) == row)
            i, until = i + 1, -1
        return least, "".join(letters)


def _aligned(codes: bytes) -> tuple[int, str]:
    return _Table(codes).audit() if codes else (0, "")


_short = lru_cache(1 << 16)(_aligned)


def cheapest_audit(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a conversation's turns, one byte each: role, FORCED, TRUNCATED."""
    return _short(codes) if len(codes) <= SHORT else _aligned(codes)


def _streamed(batches: Iterator[pa.RecordBatch], fields: list[tuple], one) -> Iterator[pa.RecordBatch]:
    """What `one(key, rows)` yields for each run of rows with the same key, the first column.

    The rows are a stream. The first column of the result has the type of the key.
    """
    first = next(batches, None)
    if first is None:
        return
    rows = (row for batch in chain([first], batches)
            for row in zip(*(column.to_pylist() for column in batch.columns)))
    found = (row for key, group in groupby(rows, itemgetter(0)) for row in one(key, group))
    yield from _batched(found, pa.schema([("conv_id", first.schema.field(0).type), *fields]))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096,
             most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of rows and characters."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(zip(*held), schema)], schema=schema)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(value) for value in row if isinstance(value, str))
        if len(held) >= size or chars >= most:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def _initials(codes: bytes) -> int:
    """Neighbours other than s u, u a and a u."""
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    roles = [code & 3 for code in codes]
    return sum(pair not in legal for pair in zip(roles, roles[1:]))


def _judged(turns: Iterator[tuple]) -> tuple:
    """The audit columns of one conversation from (turn, code, digest); code -1 is no turn."""
    codes, seen, counts = bytearray(), set(), [0, 0, 0]
    numbers, low, high, last = 0, None, None, None
    for turn, code, digest in turns:
        if code < 0:
            continue
        if turn is not None:
            # Turns come in order.
            low, high = turn if low is None else low, turn
            numbers, last = numbers + (turn != last), turn
        blank, repeated = bool(code & FORCED), digest in seen
        seen.add(digest)
        if blank:
            counts[0] += 1
        elif repeated:
            counts[1] += 1
        elif code & TRUNCATED:
            counts[2] += 1
        role = code & 3
        codes.append(role | FORCED if blank or repeated else role | code & TRUNCATED)
    cost, audit = cheapest_audit(bytes(codes))
    gaps = 0 if low is None else high - low + 1 - numbers
    return gaps, *counts, _initials(codes), cost, audit


def _facts(role: Column, text: Column) -> tuple[Column, Column]:
    """A turn's byte, and a digest of its role and text."""
    rest = F.rtrim(text, F.lit(SPACES))
    initial = F.substring(role, 1, 1)
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
            .otherwise(OTHER)
            + F.when(rest == "", FORCED).when(F.right(rest, F.lit(1)).isin(".", "!", "?"), 0)
            .otherwise(TRUNCATED))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return code.cast("int"), digest


def _turns(turns: DataFrame) -> DataFrame:
    """The columns that count, a null role or text being one space, and a turn's byte and digest."""
    lost = F.col("lost") if "lost" in turns.columns else F.lit(False)
    plain = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), lost.alias("lost"))
    code, digest = _facts(F.col("role"), F.col("text"))
    return plain.withColumns({"code": F.when(F.col("lost"), -1).otherwise(code), "digest": digest})


#: Order of the turns of a conversation; nulls come first.
ORDER = ["turn", "role", "digest"]


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation of `turns` (conv_id, turn, role, text, and `lost` if it has it).

    Columns: conv_id, then

    * gaps: numbers missing between the smallest and the largest turn;
    * blank, duplicate, truncated: turns by their first fault (no character but white space; role
      and text of an earlier turn; the last character but white space is none of . ! ?);
    * illegal: neighbours whose roles' initials are not s u, u a or a u;
    * cost, audit: of the cheapest edits.

    Rows with `lost` true are no turns, but their conversation gets a row, with zeros and an empty
    audit if it has nothing else. A null role or text is one space. A null turn comes first and
    counts in no gap; a null conv_id is a conversation. Turns with the same number, repeated rows
    among them, follow in the order of role and of a digest of the text. Other columns are not read.
    Texts of any length: tasks get one byte and a digest of each. No rows give no rows.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    facts = _turns(turns).select("conv_id", "turn", "role", "digest", "code")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [*((name, pa.int64()) for name in COUNTS), ("audit", pa.string())]
        return _streamed(batches, fields, lambda key, rows: [
            (key, *_judged((turn, code, digest) for _, turn, _, digest, code in rows))])

    ordered = facts.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return mapped(ordered, judge, f"conv_id {kind}, {AUDIT}")


def repaired_turns(turns: DataFrame, judged: DataFrame) -> DataFrame:
    """The turns after the edits that `judged` (`audits` of the same turns) tells.

    Columns: conv_id, position (from 0), edit (K, R or I), role, text. The rows of a conversation lie
    together and in order within a partition. A conversation with nothing left has no rows.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _turns(turns).filter("code >= 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    heads = judged.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"))

    def edited(key, rows: Iterator[tuple]) -> Iterator[tuple]:
        audit = next(rows)[-1]
        begins, position = None, 0
        for letter in audit:
            role, text = None, ""
            if letter != "I":
                _, _, _, role, _, text = next(rows)
            if letter == "D":
                continue
            if begins is None:
                # Only a kept turn of the system stands before the first user.
                begins = 1 if letter == "K" and role.startswith("s") else 0
            if letter != "K":
                role = ("user", "assistant")[(position - begins) % 2]
            yield key, position, letter, role, text
            position += 1

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = [(name, pa.string()) for name in ("edit", "role", "text")]
        return _streamed(batches, [("position", pa.int64()), *strings], edited)

    both = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    return mapped(both, edit, f"conv_id {kind}, position long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's `role:text` lines; `repaired` as `repaired_turns` gives it."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def hashed(key, rows: Iterator[tuple]) -> Iterator[tuple]:
        lines = hashlib.sha256()
        for _, position, _, role, text in rows:
            lines.update(f"{chr(10) if position else ''}{role}:{text}".encode())
        yield key, lines.hexdigest()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _streamed(batches, [("repaired_sha256", pa.string())], hashed)

    return mapped(repaired, digest, f"conv_id {kind}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by a hash of conversation and number: some lost, emptied, without . ! ?,
    repeated or given to the user. Rows of lost turns stay, with `lost` true."""
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" "))
                             for name in ("conv_id", "turn")])
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    harm = F.crc32(F.encode(key, "UTF-8")) % 20
    changed = conversations.select(
        "conv_id", "turn", harm.alias("harm"),
        F.when(harm == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
    copies = F.explode(F.array_repeat(F.col("harm") == 0, F.when(F.col("harm") == 3, 2).otherwise(1)))
    return changed.select("conv_id", "turn", "role", "text", copies.alias("lost"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged, its faults, its cheapest audit and a digest of the repaired turns."""
    turns = damaged(table(spark, folder, "conversations"))
    judged = written(audits(turns))
    hashed = digests(repaired_turns(turns, judged)).withColumnRenamed("conv_id", "repaired_id")
    nothing = hashlib.sha256().hexdigest()
    return judged.join(hashed, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left").select(
        "conv_id", *COUNTS, "audit", F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
