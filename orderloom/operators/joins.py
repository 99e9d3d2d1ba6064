"""Equi-join that holds when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sizing import small_enough_to_broadcast

# A key is hot when it holds more than 1/share of the rows, where the share is the
# number of shuffle partitions within these bounds, so that a hot key is one that
# would outgrow its partition. The sketch that finds such keys keeps SKETCH_ITEMS
# counters; its error is far below the smallest share. Sketches of the input
# partitions are merged in SKETCH_GROUPS tasks before the last task merges those.
HOT_SHARE = (64, 1000)
SKETCH_ITEMS = 10_000
SKETCH_GROUPS = 64

# A hot key must also fill its buckets. The partners of n rows are copied once per
# bucket and meet each of the n rows, so the copies are at most 1/ROWS_PER_BUCKET
# of what the join gives for that key.
ROWS_PER_BUCKET = 8

_LEFT_BUCKET, _RIGHT_BUCKET = "_left_bucket", "_right_bucket"
_COPIED, _MATCHED = "_copied", "_matched"


def hot_share(spark: SparkSession) -> int:
    least, most = HOT_SHARE
    return min(most, max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def default_buckets(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, *keys: str, min_rows: int = 0, share: int | None = None) -> DataFrame:
    """One row with an array per key column, in the struct ``hot``: its values that
    hold more than 1/share of the rows, and more than ``min_rows``.

    A mergeable frequent-items sketch reads the key columns once; only sketches are
    exchanged, in two levels, so the last task merges a fixed number of them. The
    arrays pick the physical route of a row and never its presence in a result, so
    an approximate count is enough.
    """
    share = share or hot_share(df.sparkSession)

    def is_hot(entry: Column) -> Column:
        large = (entry["count"] * share > F.col("total")) & (entry["count"] > min_rows)
        return entry["item"].isNotNull() & large

    def each(function: str, column: str) -> list[Column]:
        return [F.expr(f"{function}({column.format(i)}, {SKETCH_ITEMS})").alias(f"sketch_{i}") for i in range(len(keys))]

    items = [F.col(key).alias(f"item_{i}") for i, key in enumerate(keys)]
    grouped = df.select(*items, F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"))
    sketches = grouped.groupBy("part").agg(*each("approx_top_k_accumulate", "item_{}"), F.count(F.lit(1)).alias("rows"))
    # Grouped, because an empty partition has no sketch that could be merged.
    merged = sketches.groupBy((F.col("part") >= 0).alias("every")).agg(
        *each("approx_top_k_combine", "sketch_{}"), F.sum("rows").alias("total")
    )
    found = []
    for i, key in enumerate(keys):
        top = F.expr(f"approx_top_k_estimate(sketch_{i}, {share})")
        found.append(F.transform(F.filter(top, is_hot), lambda entry: entry["item"]).alias(key))
    listed = merged.select(F.struct(*found).alias("hot"))
    # One row, also where there are none; as a whole, so that joins share the scan.
    return listed.agg(F.array_max(F.collect_list("hot")).alias("hot"))


def _is_in(hot: DataFrame, key: str) -> Column:
    return F.coalesce(F.array_contains(hot.scalar()[key], F.col(key)), F.lit(False))


def _dealt(columns: Iterable[str], buckets: int) -> Column:
    """A bucket made of the row and its partition only: a task that runs again
    after an executor loss sends each row to the same bucket as before."""
    row = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])
    return F.pmod(row, F.lit(buckets)).cast("int")


def _one_or_every(every: Column, buckets: int) -> Column:
    return F.explode(
        F.when(every, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    *,
    left_keys: DataFrame | None = None,
    left_hot: DataFrame | None = None,
    right_keys: DataFrame | None = None,
    deal_by: Iterable[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner`` and ``left``, where ``left`` is
    the large side.

    A side within the broadcast limit (the left one only for an inner join) needs
    no shuffle of the other, so the plain join is returned and Spark broadcasts
    that side. Otherwise both sides are shuffled: the rows of a hot left key are
    dealt over ``buckets`` and the matching right rows are copied to each, while
    all other keys take one bucket and no copy. Left rows with a NULL key match
    nothing and are dealt out too.

    ``left_keys`` is a cheaper frame with about the same keys as ``left``, for
    when ``left`` is itself the result of a join; ``left_hot`` is what ``hot_keys``
    found, where several joins share it. ``right_keys`` asks for the same
    care of keys that repeat on the right; it must hold the keys of ``right``.
    ``deal_by`` names left columns that tell the rows of one key apart; without it
    all columns do, and none of them can be pruned before the join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join does inner and left joins, not {how!r}")
    spark = left.sparkSession
    broadcastable = (right, left) if how == "inner" else (right,)
    if any(small_enough_to_broadcast(spark, side) for side in broadcastable):
        return left.join(right, on, how)

    if how == "inner":
        left = left.where(F.col(on).isNotNull())
    right = right.where(F.col(on).isNotNull())
    buckets = buckets or default_buckets(spark)
    min_rows = buckets * ROWS_PER_BUCKET

    hot_left = left_hot or hot_keys(left if left_keys is None else left_keys, on, min_rows=min_rows)
    deal_left = F.col(on).isNull() | _is_in(hot_left, on)
    left = left.withColumn(_LEFT_BUCKET, F.when(deal_left, _dealt(deal_by or left.columns, buckets)).otherwise(F.lit(0)))
    right = right.withColumn(_LEFT_BUCKET, _one_or_every(_is_in(hot_left, on), buckets))
    if right_keys is None:
        return left.join(right, [on, _LEFT_BUCKET], how).drop(_LEFT_BUCKET)

    # A row of either side now has a place in a grid: dealt along one axis, copied
    # along the other. Any two rows of a key still meet in exactly one cell.
    hot_right = hot_keys(right_keys, on, min_rows=min_rows)
    right = right.withColumn(
        _RIGHT_BUCKET, F.when(_is_in(hot_right, on), _dealt(right.columns, buckets)).otherwise(F.lit(0))
    ).withColumn(_MATCHED, F.lit(True))
    left = left.withColumn(_COPIED, _is_in(hot_right, on)).withColumn(
        _RIGHT_BUCKET, _one_or_every(F.col(_COPIED), buckets)
    )
    joined = left.join(right, [on, _LEFT_BUCKET, _RIGHT_BUCKET], how)
    if how == "left":
        # The key of a copied row is on the right for certain, so a copy without a
        # match only fell into a cell that got no right row.
        joined = joined.where(~F.col(_COPIED) | F.col(_MATCHED).isNotNull())
    return joined.drop(_LEFT_BUCKET, _RIGHT_BUCKET, _COPIED, _MATCHED)
