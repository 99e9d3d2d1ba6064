"""Hard negatives for contrastive training, by slots between the scores of positives.

An anchor wants, below each of its positives, the best rows of other labels. The
windows of its positives overlap: all end at some positive's score and reach down to
a share of it. The positives' scores therefore cut the scores into disjoint slots, and
a window is a run of slots, cut at its lower end. Each task keeps the best few rows
per slot (the combiner); merged over all tasks, the slots from a positive's own one
downwards hold the answer of its window.

Anchors are a stated query set that meets all rows in blocks: a block of anchors, of
bounded size, goes to every task, and the rows stay where they are. What is shuffled
are the best few per task, anchor and slot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch

# Anchors that go to the tasks at a time, and at most this many bytes of them.
BLOCK = 4096
BLOCK_BYTES = 16 << 20
# Scores that a task holds at once, and entries it gathers before it drops the worse ones.
TILE = 1 << 21
PENDING = 1 << 20

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


@dataclass(frozen=True)
class Mining:
    """How many positives an anchor has, how many negatives each of them gets, and
    from which share of the positive's score (``low`` of ``of``) negatives count."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    of: int = 100

    def least(self, score: int) -> int:
        return -(-self.low * score // self.of)


def coded_rows(vectors: DataFrame, is_anchor: Column, scale: int, id: str, vector: str, label: Column) -> DataFrame:
    """Rows that take part: vec_id, label, code (whole numbers), anchor."""
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vectors.where(F.col(id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("code"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )


@dataclass(frozen=True)
class Block:
    """Some anchors: their ids, labels and codes."""

    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray


def _matrix(codes: list[np.ndarray], width: int) -> np.ndarray:
    if all(len(c) == width for c in codes):
        return np.array(codes, np.int64).reshape(len(codes), width)
    padded = np.zeros((len(codes), width), np.int64)
    for row, code in zip(padded, codes, strict=True):
        row[: len(code)] = code
    return padded


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact. The shorter vectors count as padded by zeros."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    largest = width * max(-int(rows.min()), int(rows.max())) * max(-int(anchors.min()), int(anchors.max()))
    if largest < 1 << 53:
        return rows.astype(float) @ anchors.T.astype(float)
    if largest < 1 << 63:
        return rows @ anchors.T
    raise ValueError("inner products of these vectors may exceed 64 bits; use a smaller scale")


class Best:
    """The ``k`` best entries of each group: highest score first, then smallest id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.worst = np.full(groups, np.iinfo(np.int64).min)
        self.kept = [np.empty((3, 0), np.int64)]
        self.pending = 0

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        able = score >= self.worst[group]
        entries = np.stack([group[able], score[able], vec_id[able]]).astype(np.int64)
        self.kept.append(entries)
        self.pending += entries.shape[1]
        if self.pending >= PENDING:
            self.shrink()

    def shrink(self) -> np.ndarray:
        group, score, vec_id = entries = np.concatenate(self.kept, axis=1)
        entries = entries[:, np.lexsort((vec_id, -score, group))]
        first = np.searchsorted(entries[0], entries[0])
        place = np.arange(entries.shape[1]) - first
        entries, place = entries[:, place < self.k], place[place < self.k]
        full = entries[:, place == self.k - 1]
        self.worst[full[0]] = full[1]
        self.kept, self.pending = [entries], 0
        return entries


def _tiles(batches: Iterable[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and labels of some rows, and their scores with all anchors of the block."""
    step = max(1, TILE // max(1, len(block.ids)))
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        lists = batch.column(2)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())
        codes = np.split(flat, ends[:-1]) if len(ends) else []
        for at in range(0, len(ids), step):
            some = codes[at : at + step]
            matrix = _matrix(some, max(map(len, some)))
            yield ids[at : at + step], labels[at : at + step], products(matrix, block.codes)


def _batch(block: Block, best: Best, slots: int) -> pa.RecordBatch:
    group, score, vec_id = best.shrink()
    return pa.RecordBatch.from_arrays(
        [pa.array(group // slots, pa.int32()), pa.array(group % slots, pa.int32()), pa.array(score), pa.array(vec_id)],
        ["anchor", "slot", "score", "vec_id"],
    )


Task = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def positives_task(block: Block, rule: Mining) -> Task:
    """Of the rows of a task, each anchor's best others of the same label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.ids), rule.positives)
        for ids, labels, scores in _tiles(batches, block):
            row, anchor = np.nonzero(
                (labels[:, None] == block.labels) & (ids[:, None] != block.ids) & (scores >= best.worst)
            )
            best.add(anchor, scores[row, anchor].astype(np.int64), ids[row])
        yield _batch(block, best, 1)

    return run


def negatives_task(block: Block, edges: np.ndarray, least: np.ndarray, rule: Mining) -> Task:
    """Of the rows of a task, each anchor's best of other labels in each slot.

    ``edges`` holds each anchor's distinct positive scores, descending, in ``edges[i]``;
    a slot takes scores up to its edge and above the next one. Unused ones hold the
    smallest number. ``least`` is the lowest score that any window takes.
    """
    slots = edges.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(edges.size, rule.negatives)
        for ids, labels, scores in _tiles(batches, block):
            row, anchor = np.nonzero(
                (labels[:, None] != block.labels) & (scores >= least) & (scores <= edges[:, 0])
            )
            score = scores[row, anchor].astype(np.int64)
            slot = (edges[anchor] >= score[:, None]).sum(1) - 1
            best.add(anchor * slots + slot, score, ids[row])
        yield _batch(block, best, slots)

    return run


def _blocks(anchors: DataFrame) -> Iterator[Block]:
    """The anchors in blocks; one partition at a time comes to the driver."""
    width = anchors.agg(F.max(F.size("code"))).first()[0] or 0
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, width))))
    rows = anchors.select("vec_id", "label", "code").toLocalIterator()
    while some := list(islice(rows, size)):
        yield Block(
            np.array([r["vec_id"] for r in some], np.int64),
            np.array([r["label"] for r in some], np.int64),
            _matrix([np.array(r["code"], np.int64) for r in some], width),
        )


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and slot over all tasks."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def _mine_block(rows: DataFrame, block: Block, rule: Mining) -> DataFrame | None:
    spark, schema = rows.sparkSession, "anchor int, slot int, score long, vec_id long"
    read = rows.select("vec_id", "label", "code")
    positives = _merged(read.mapInArrow(positives_task(block, rule), schema), rule.positives).collect()
    if not positives:
        return None

    none = np.iinfo(np.int64).min
    edges, least = np.full((len(block.ids), rule.positives), none), np.full(len(block.ids), np.iinfo(np.int64).max)
    scores: dict[int, list[int]] = {}
    for r in positives:
        scores.setdefault(r["anchor"], []).append(r["score"])
    for anchor, own in scores.items():
        cut = sorted(set(own), reverse=True)
        edges[anchor, : len(cut)] = cut
        least[anchor] = min(map(rule.least, own))

    slots = _merged(read.mapInArrow(negatives_task(block, edges, least, rule), schema), rule.negatives)
    entry = F.struct((-F.col("score")).alias("below"), "vec_id", "slot", "score")
    listed = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    wanted = spark.createDataFrame(
        [
            (r["anchor"], int(block.ids[r["anchor"]]), r["vec_id"], r["score"], int((edges[r["anchor"]] > r["score"]).sum()), rule.least(r["score"]))
            for r in positives
        ],
        "anchor int, anchor_id long, positive_id long, positive_score long, own_slot int, least long",
    )
    window = F.filter(
        "entries", lambda e: (e["slot"] >= F.col("own_slot")) & (e["score"] >= F.col("least"))
    )
    return (
        listed.join(F.broadcast(wanted), "anchor")
        .select("*", F.posexplode(F.slice(window, 1, rule.negatives)).alias("at", "negative"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).alias("rank"),
            F.col("negative.vec_id").alias("negative_id"),
            "positive_score",
            F.col("negative.score").alias("negative_score"),
        )
    )


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    label: Column | None = None,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    rule: Mining = Mining(),
) -> DataFrame:
    """The hard negatives of each anchor and positive, best first.

    Components are scaled and rounded down to whole numbers, so all scores (inner
    products) are exact. Positives are the anchor's best rows of its label, whose id is
    not the anchor's own; negatives are the best rows of other labels that score
    between a share of the positive's score and that score. Ties go to the smaller id.

    Rows with a null id, label, vector or component, or a component that is not finite,
    take no part. A shorter vector counts as padded by zeros, an empty one scores 0. Each
    row counts, so rows that share an id fill several places, and each of them that is
    an anchor has results of its own. Positives without a negative, an anchor without
    positives and an empty table give no rows. Other columns are ignored. Products
    beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    label = F.col("label") if label is None else label
    rows = scratch.write(coded_rows(vectors, is_anchor, scale, id, vector, label), "rows")
    parts = []
    for block in _blocks(rows.where("anchor")):
        mined = _mine_block(rows, block, rule)
        if mined is not None:
            parts.append(scratch.path("mined"))
            mined.write.parquet(parts[-1])
    return spark.read.schema(RESULT).parquet(*parts) if parts else spark.createDataFrame([], RESULT)
