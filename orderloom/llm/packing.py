"""Best-fit-decreasing packing of token pieces into sequences of a fixed length.

Best fit decides by lengths alone, and a sequence of n tokens knows only n
different lengths. So the driver packs the histogram of lengths, whose size does
not depend on the data: a segment tree over remaining capacities finds the
tightest open bin, and all equal pieces that go the same way go at once. Each
piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, running_total, settings, spread
from orderloom.llm.tokens import groups, word_tokenizer

PIECE_FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"
TEXTS_PER_BATCH = "256"
PIECES_PER_BUCKET = 50_000


class Tightest:
    """A segment tree over capacities: the smallest one that fits and has open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any_open = np.zeros(2 * self.leaves, bool)

    def mark(self, room: int, is_open: bool) -> None:
        node = self.leaves + room
        self.any_open[node] = is_open
        while node > 1:
            node //= 2
            self.any_open[node] = self.any_open[2 * node] or self.any_open[2 * node + 1]

    def at_least(self, length: int) -> int | None:
        node = self.leaves + length
        if self.any_open[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any_open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any_open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Plan:
    """Pieces of one length with ranks from ``rank`` on go to bins from ``bin`` on,
    ``per_bin`` to each, the first at ``offset``. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    per_bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(_key(self.length, self.rank), _key(length, rank), side="right") - 1
        nth = rank - self.rank[row]
        return self.bin[row] + nth // self.per_bin[row], self.offset[row] + nth % self.per_bin[row] * length


def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (length.astype(np.int64) << 46) + rank


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Place ``counts[length]`` pieces of each length as best fit decreasing does.

    A piece that goes into a bin leaves it the tightest as long as another piece
    of that length fits, so each bin takes as many as it can before the next one.
    """
    tree, rooms, rows, bins = Tightest(capacity), [deque() for _ in range(capacity + 1)], [], 0

    def put_back(room: int, first: int, number: int) -> None:
        if room and number:
            rooms[room].append((first, number))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:
                room, first, number = capacity, bins, -(-left // (capacity // length))
                bins += number
            else:
                first, number = rooms[room].popleft()
                tree.mark(room, bool(rooms[room]))
            per_bin = room // length
            full = min(number, left // per_bin)
            for some, each in ((full, per_bin), (min(1, number - full), left - full * per_bin)):
                if some and 0 < each <= per_bin and left:
                    rows.append((length, rank, first, each, capacity - room))
                    put_back(room - each * length, first, some)
                    first, number = first + some, number - some
                    left, rank = left - some * each, rank + some * each
            put_back(room, first, number)
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*columns, bins)


def _pieces(path: str, separator: int, capacity: int, with_ids: bool):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, separator)
        for batch in batches:
            doc_ids = batch.column(0)
            for first, texts in groups(batch.column(1).to_pylist()):
                ids, ends = tokenizer.encode(texts)
                sizes = np.diff(ends, prepend=0)
                number = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(texts)), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                from_ = (ends - sizes)[doc] + start
                raw = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(from_.tolist(), length.tolist(), strict=True)]
                columns = [
                    doc_ids.take(pa.array(first + doc)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, separator: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids (whole text; null: empty) and the ``separator``.
    Only documents longer than ``capacity`` are cut. ``ids_crc32`` is that of the
    ids as little-endian unsigned 32-bit; ``with_ids`` adds them in that form.
    Pieces of one length take the places for that length in any order, that of a written
    table; rows that repeat are packed each. An empty table gives no rows; other columns are ignored.

    ``tokenizer`` is the file of a tokenizer that drops white space, on every
    executor. The driver sees one count per length, ``capacity`` at most.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = PIECE_FIELDS + (", ids binary" if with_ids else "")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        pieces = scratch.write(texts.mapInArrow(_pieces(tokenizer, separator, capacity, with_ids), fields), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_decreasing(counts, capacity)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            kept = batch.drop_columns(["_rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    # By their place in the written table, so that equal pieces are dealt out too.
    placed = pieces.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    bucket = spread(F.col("_file"), F.col("_row"), buckets=max(256, sum(counts.values()) // PIECES_PER_BUCKET))
    ranked = running_total(placed, ["length"], F.lit(1), bucket, ["_file", "_row"], "_rank")
    ranked = ranked.select(*pieces.columns, F.col("_rank").cast("long").alias("_rank"))
    return ranked.mapInArrow(place, fields + ", sequence_id long, offset long")
