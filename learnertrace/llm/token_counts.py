"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut into the pieces within which pairs may merge. Of each distinct piece the
bytes are the first symbols; the adjacent pair of the lowest rank is popped from a heap
again and again, its right symbol leaves the linked list, and the two new pairs go onto the
heap. The count is the number of first symbols less the number of merges; no identifier is
looked up. Counts of pieces are kept within a Python worker, since most repeat.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnertrace.llm.common import encoded, mapped, pieces, table

#: Unicode white space. Python's own class also has four control characters.
BLANK = r"\t-\r \x85\xa0  -     　"

#: Fixed value: how byte-level vocabularies cut a text into pieces.
PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")

#: A space before something that is not blank always begins a piece.
CHUNK = regex.compile(rf"(?= [^{BLANK}])", regex.V1)
MIXED = regex.compile(rf" [{BLANK}]| \Z")

#: Distinct stretches of text whose counts a worker keeps, and the longest that it keeps.
KEPT, KEPT_CHARS = 400_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: a visible Latin-1
    character for itself, the others in order from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """The merge ranks and special strings of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        merges = (tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                  for m in told["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        special = [x["content"] for x in told["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.letters = byte_letters()
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """The symbols that remain of one piece."""
        symbols: list[str | None] = [self.letters[b] for b in piece.encode()]
        rank, count = self.ranks.get, len(symbols)
        following, previous = [*range(1, count), -1], [*range(-1, count - 1)]
        heap = [(r, k, symbols[k], symbols[k + 1]) for k in range(count - 1)
                if (r := rank((symbols[k], symbols[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = following[left]
            if symbols[left] != a or right < 0 or symbols[right] != b:
                continue  # one of the two has merged with another neighbour
            symbols[left], symbols[right] = a + b, None
            count -= 1
            after = following[left] = following[right]
            if after >= 0:
                previous[after] = left
                if (r := rank((a + b, symbols[after]))) is not None:
                    heapq.heappush(heap, (r, left, a + b, symbols[after]))
            before = previous[left]
            if before >= 0 and (r := rank((symbols[before], a + b))) is not None:
                heapq.heappush(heap, (r, before, symbols[before], a + b))
        return count

    def _chunk(self, chunk: str) -> int:
        found = sum(map(self.merged, PIECE.findall(chunk)))
        if len(chunk) <= KEPT_CHARS:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[chunk] = found
        return found

    def _plain(self, text: str) -> int:
        if MIXED.search(text):
            chunks = CHUNK.split(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first, *map(" ".__add__, rest)]
        known, total = self.known.get, 0
        for chunk in chunks:
            count = known(chunk)
            total += self._chunk(chunk) if count is None else count
        return total

    def count(self, text: str) -> int:
        """Tokens of `text`; a special string in it counts as one."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@cache
def merges(path: str) -> Merges:
    """One table per file and Python worker."""
    return Merges(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs`.

    `path` is a byte-level vocabulary's file, in the same place on every machine. A null text
    counts as empty, and an empty text has no bytes and no tokens. Repeated rows are counted
    each; other columns are ignored; an empty table gives an empty result. Memory per task is that of a
    batch and the kept counts; a text of any length is counted whole, in a batch of its own where it is long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merges(path).count
        for batch in pieces(batches):
            texts = encoded(batch.column("text"))
            counts = [count(text.decode(errors="replace")) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", F.col("text").cast("string").alias("text")), run,
                  f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark, folder: str) -> DataFrame:
    """Every document with its number of tokens."""
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
