"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types that an aggregate can keep in a fixed place of its hash table.
_FIXED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# A digest of this many bits stands behind the preferred value in a rank.
_DIGEST_BITS = 48


def keep_one(df: DataFrame, keys: list[str], columns: list[str], prefer: tuple[str, ...] = ()) -> DataFrame:
    """One whole row per key, reduced to ``keys`` and ``columns``.

    Spark's ``dropDuplicates`` keeps an arbitrary row, and may keep another one
    when a lost task is run again. Here the row greatest by ``prefer``, then by
    the remaining columns, is kept. It is an aggregate, so copies of a key
    collapse before the shuffle, however many there are.
    """
    ranked = [*prefer, *(c for c in columns if c not in prefer)]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*ranked)).alias("kept"))
        .select(*keys, *(F.col(f"kept.{c}").alias(c) for c in columns))
    )


def _as_whole_number(value: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, _WHOLE):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        # By the clock, whatever the session's time zone makes of it.
        seconds = F.unix_date(value.cast("date")).cast("long") * 86_400 + F.hour(value) * 3600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    return None


def keep_latest(df: DataFrame, keys: list[str], columns: list[str], by: str, labels: tuple[str, ...] = ()) -> DataFrame:
    """One whole row per key, the one with the greatest ``by``, without sorting.

    A sorting aggregate is what Spark plans where a buffer holds text or a struct. Here the
    buffers are numbers: ``by`` and a digest of the row make one rank, and every column is
    taken at the greatest rank, so a hash aggregate does it, in the map tasks and after the
    shuffle. Among equal ``by`` the digest decides, the same on every run; a NULL is below
    all values.

    ``labels`` are text columns of few distinct values, such as a status: they are numbered
    by a list of these values, which is made first and read by all tasks. Where another
    column is text, or ``by`` has no number, ``keep_one`` is used instead.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    number = _as_whole_number(F.col(by), kinds[by])
    if number is None or any(c not in labels and not isinstance(kind, _FIXED) for c, kind in kinds.items()):
        return keep_one(df, keys, columns, (by,))

    # The digest is one of the row as it came, so that the list of a label's values is not
    # made where the label is not used.
    digest = F.pmod(F.xxhash64(*columns), F.lit(1 << _DIGEST_BITS)).cast("decimal(38,0)")
    shift = F.lit(1 << _DIGEST_BITS).cast("decimal(15,0)")
    lowest = F.lit(-(1 << 62))
    rank = (F.coalesce(number, lowest).cast("decimal(20,0)") * shift).cast("decimal(38,0)") + digest
    coded = df.select(*keys, *columns, rank.cast("decimal(38,0)").alias("_rank"))
    values = {}
    for label in labels:
        listed = df.select(label).distinct().agg(F.array_sort(F.collect_list(label)).alias("all"))
        values[label] = listed.scalar()
        coded = coded.withColumn(label, F.array_position(values[label], F.col(label)))
    kept = coded.groupBy(*keys).agg(*(F.max_by(c, "_rank").alias(c) for c in columns))
    for label in labels:
        kept = kept.withColumn(label, F.when(F.col(label) > 0, F.get(values[label], (F.col(label) - 1).cast("int"))))
    return kept.select(*keys, *columns)
