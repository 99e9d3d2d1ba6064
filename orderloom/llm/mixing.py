"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equal length in words. Blocks go to sources by the
highest quotients target / (2k + 1), shard after shard, so every shard gets whole
blocks and each prefix of shards follows the targets. A source's blocks of all shards are
then filled from its documents in seeded order, again from the start when they run out;
which shard a document goes to is left to who writes them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, located, running_total

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` are dealt to the sources by code point, null last, and repeat.

    A target stops at ``most_repeats`` times its source. ``block_words`` is the
    unit of apportionment: a source's words are at most about half of it off.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    block_words: int = 8
    shards: int = 16
    seed: str = "mix"


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int


def targets(sources: Sequence[Source], mix: Mix) -> list[float]:
    """Weighted shares of all words, none above its limit, the excess shared again."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sources))]
    limits = [mix.most_repeats * s.size for s in sources]
    words, weight = sum(s.size for s in sources), sum(weights)
    result = [0.0] * len(sources)
    order = sorted(range(len(sources)), key=lambda i: (limits[i] / weights[i], i))
    for place, i in enumerate(order):
        if limits[i] * weight > weights[i] * words:
            for j in order[place:]:
                result[j] = weights[j] * (words / weight)
            break
        result[i] = float(limits[i])
        words, weight = words - limits[i], weight - weights[i]
    return result


def _seats_above(target: float, bar: float) -> int:
    """How many quotients target / (2k + 1) are above ``bar``."""
    seats = max(0, int((target / bar + 1) / 2))
    while target / (2 * seats + 1) > bar:
        seats += 1
    while seats and target / (2 * seats - 1) <= bar:
        seats -= 1
    return seats


def apportion(shares: Sequence[float], seats: int) -> list[int]:
    """The first ``seats`` quotients in falling order; ties go to the earlier share.

    Most seats follow from a bar below the lowest winning quotient, so the work
    depends on the number of shares and not on that of seats.
    """
    held = [0] * len(shares)
    if seats <= 0 or not any(shares):
        return held
    low, high = 0.0, max(shares) + 1
    for _ in range(200):
        bar = (low + high) / 2
        if bar <= low or bar >= high:
            break
        if sum(_seats_above(s, bar) for s in shares) > seats:
            low = bar
        else:
            high = bar
    held = [_seats_above(s, high) for s in shares]
    waiting = [(-s / (2 * h + 1), i) for i, (s, h) in enumerate(zip(shares, held, strict=True)) if s > 0]
    heapq.heapify(waiting)
    for _ in range(seats - sum(held)):
        _, i = heapq.heappop(waiting)
        held[i] += 1
        heapq.heappush(waiting, (-shares[i] / (2 * held[i] + 1), i))
    return held


def shard_quotas(shares: Sequence[float], seats: int, shards: int) -> list[list[int]]:
    """Blocks of each source in each shard; a shard takes the next highest quotients."""
    ends = [apportion(shares, seats * (n + 1) // shards) for n in range(shards)]
    starts = [[0] * len(shares), *ends[:-1]]
    return [[b - a for a, b in zip(before, after, strict=True)] for before, after in zip(starts, ends, strict=True)]


def code_point_order(sources: Iterable[Source]) -> list[Source]:
    return sorted(sources, key=lambda s: (s.name is None, (s.name or "").encode()))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies.

    ``size`` counts the words of the whole text (null: 0), ``target`` is that of
    the document's source, ``taken`` the words that the mix takes of it, repeats
    counted, at most ``most_repeats`` times its size; ``copies`` is taken / size
    rounded half up. Documents without words are never taken. Order within a source
    is by md5 of seed and doc_id, then doc_id and size, so reruns agree. Documents without
    id, which all have one md5, are dealt out by their place in the file. Repeated rows are
    documents of their own, and those that tie are equal. Other columns
    are ignored; an empty table gives no rows.

    The driver sees one row per source.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    return _mixed(located(docs.select("doc_id", "source", "text"), scratch), mix, scratch).drop("file", "row")


def _mixed(docs: DataFrame, mix: Mix, scratch: Scratch) -> DataFrame:
    """What ``mix_documents`` tells, with the file and row of each document."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    at = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws("#", at[0], at[1].cast("string")))
    place = F.md5(F.concat(F.lit(f"{mix.seed}:"), name))
    key = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), "source"))
    sizes = scratch.write(
        docs.select("doc_id", "source", size.alias("size"), place.alias("_place"), key.alias("_key"), *at), "sizes"
    )
    totals = sizes.groupBy("_key", "source").agg(F.sum("size").alias("size")).collect()
    keys = {r["source"]: r["_key"] for r in totals}
    sources = code_point_order(Source(r["source"], r["size"]) for r in totals)
    shares = targets(sources, mix)
    words = sum(s.size for s in sources)
    quotas = [sum(shard) for shard in zip(*shard_quotas(shares, words // mix.block_words, mix.shards), strict=True)]
    plan = spark.createDataFrame(
        [
            (keys[s.name], s.size, share, min(mix.most_repeats * s.size, blocks * mix.block_words))
            for s, share, blocks in zip(sources, shares, quotas, strict=True)
        ],
        "_key string, source_size long, target double, _words long",
    )
    first_hex = F.substring("_place", 1, 3)
    placed = running_total(sizes, ["_key"], F.col("size"), first_hex, ["_place", "doc_id", "size"], "_start")
    rounds = F.when(F.col("source_size") > 0, F.expr("_words div source_size")).otherwise(0)
    rest = F.when(F.col("source_size") > 0, F.expr("_words % source_size")).otherwise(0)
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_start")))
    taken = (rounds * F.col("size") + part).cast("long")
    return (
        placed.join(plan, "_key")
        .withColumn("taken", taken)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "taken",
            F.when(F.col("size") > 0, F.expr("(2 * taken + size) div (2 * size)")).otherwise(0).cast("int").alias("copies"),
            "file",
            "row",
        )
    )


def mixed_rows(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    A document taken in part, at most one per source, counts as often as its share
    rounds to. Each row has copies of its own, also where rows share an id or have none.
    """
    scratch = Scratch(docs.sparkSession, "mixed-rows")
    rows = located(docs, scratch)
    mixed = _mixed(rows, mix, scratch).where("copies > 0")
    copies = mixed.select(F.struct("file", "row").alias("_place"), F.col("copies").alias("_copies"))
    placed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_doc"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_place"),
    )
    joined = placed.join(copies, "_place")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")
