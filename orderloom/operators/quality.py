"""Rules about rows, keys and references as Spark aggregates.

All rules of a suite are conditional counts in one pass over the table. Rules about
keys, that is membership and uniqueness, group the rows by key; a membership rule then
joins the distinct keys of both sides, never the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.joins import spread_join
from orderloom.session import scratch_path

References = Mapping[str, DataFrame]


def _is_nan(name: str) -> Column:
    """NaN, which schema inference may give for a missing number; for other types
    than floating ones Spark folds this to false."""
    return F.typeof(F.col(name)).isin("double", "float") & (F.col(name).cast("string") == "NaN")

_KNOWN = "_known"


@dataclass(frozen=True)
class NotNull:
    column: str
    kind = "not_null"

    @property
    def detail(self) -> str:
        return ""

    def broken(self) -> Column:
        return F.col(self.column).isNull() | _is_nan(self.column)


@dataclass(frozen=True)
class Between:
    """Bounds are part of the range unless the matching ``strict`` flag is set. A
    missing value, NULL or NaN, breaks no range."""

    column: str
    low: float | date | None = None
    high: float | date | None = None
    strict_low: bool = False
    strict_high: bool = False
    kind = "between"

    @property
    def detail(self) -> str:
        parts = []
        if self.low is not None:
            parts.append(f"{'>' if self.strict_low else '>='} {self.low}")
        if self.high is not None:
            parts.append(f"{'<' if self.strict_high else '<='} {self.high}")
        return " and ".join(parts)

    def broken(self) -> Column:
        value, outside = F.col(self.column), F.lit(False)
        if self.low is not None:
            low = F.lit(self.low)
            outside = outside | (value <= low if self.strict_low else value < low)
        if self.high is not None:
            high = F.lit(self.high)
            outside = outside | (value >= high if self.strict_high else value > high)
        return outside & ~_is_nan(self.column)


@dataclass(frozen=True)
class InReference:
    """Every non-NULL value occurs in ``reference_column`` of a reference frame."""

    column: str
    reference: str
    reference_column: str
    kind = "in_reference"

    @property
    def detail(self) -> str:
        return f"{self.reference}.{self.reference_column}"


@dataclass(frozen=True)
class Unique:
    """No two rows share their values in ``columns``. Rows with a NULL among these are
    not compared. All rows of a repeated key break the rule, the first one too."""

    columns: tuple[str, ...]
    kind = "unique"

    def __init__(self, *columns: str):
        if not columns:
            raise ValueError("a uniqueness rule needs a column")
        object.__setattr__(self, "columns", columns)

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    @property
    def detail(self) -> str:
        return ""


KeyRule = InReference | Unique
Rule = NotNull | Between | InReference | Unique


@dataclass(frozen=True)
class Suite:
    """A named list of rules; being immutable, it is the same on each run."""

    name: str
    rules: tuple[Rule, ...]


def rule_label(rule: Rule) -> str:
    return f"{rule.kind}:{rule.column}"


def _columns(rule: KeyRule) -> tuple[str, ...]:
    return rule.columns if isinstance(rule, Unique) else (rule.column,)


def _common_type(left: DataFrame, column: str, right: DataFrame, other: str) -> T.DataType:
    """The type in which Spark would compare the two columns."""
    kinds = left.schema[column].dataType, right.schema[other].dataType
    return kinds[0] if kinds[0] == kinds[1] else left.select(column).union(right.select(other)).schema[0].dataType


def _text(value: Column, kind: T.DataType) -> Column:
    """A value as text that is equal where the values are."""
    value = value.cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # one zero instead of two
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def _key(df: DataFrame, columns: tuple[str, ...], as_text: bool, kinds: list[T.DataType]) -> Column:
    """One value per key: the column itself, or text that tells all keys apart. NULL
    where a column is."""
    if not as_text:
        return F.col(columns[0]).cast(kinds[0])
    texts = [_text(F.col(c), kind) for c, kind in zip(columns, kinds, strict=True)]
    if len(texts) == 1:
        return texts[0]
    whole = F.lit(True)
    for text in texts:
        whole = whole & text.isNotNull()
    return F.when(whole, F.to_json(F.array(*texts)))


def _known_keys(rule: InReference, references: References) -> DataFrame:
    """The reference's keys, each once."""
    return (
        references[rule.reference]
        .select(F.col(rule.reference_column).alias(rule.column))
        .where(F.col(rule.column).isNotNull())
        .distinct()
    )


def _written(keys: DataFrame) -> DataFrame:
    """The keys as files, by whose size it shows whether rows must be shuffled to meet them."""
    spark = keys.sparkSession
    path = scratch_path(spark, "keys")
    keys.write.parquet(path)
    return spark.read.schema(keys.schema).parquet(path)


def unknown_keys(df: DataFrame, rule: InReference, references: References) -> DataFrame:
    """Keys of ``df`` that the reference lacks, each with its number of rows."""
    counter = F.count(F.lit(1)).alias("row_count")
    present = df.where(F.col(rule.column).isNotNull())
    return (
        present.groupBy(rule.column)
        .agg(counter)
        .join(_known_keys(rule, references), rule.column, "left_anti")
    )


def repeated_keys(df: DataFrame, rule: Unique) -> DataFrame:
    """Keys that several rows share, each with its number of rows. Rows collapse to one
    per key and task before they are shuffled."""
    present = df
    for column in rule.columns:
        present = present.where(F.col(column).isNotNull())
    return present.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def _grouped_keys(
    df: DataFrame, rules: dict[int, KeyRule], flags: dict[str, Column], references: References
) -> DataFrame:
    """One row per rule and key, with its number of rows as ``checked``, the sums of the
    flags on the rows of the first rule, and whether a reference knows the key.

    A row has an entry for each rule, so all rules share one scan, one grouping and, for
    the references, one join. Entries collapse to one per key and task before they are
    shuffled, so a hot key costs no more than another.
    """
    kinds: dict[int, list[T.DataType]] = {}
    for i, rule in rules.items():
        if isinstance(rule, InReference):
            kinds[i] = [_common_type(df, rule.column, references[rule.reference], rule.reference_column)]
        else:
            kinds[i] = [df.schema[c].dataType for c in rule.columns]
    # Keys of one type need no detour over text.
    as_text = any(len(k) > 1 for k in kinds.values()) or len({k[0].simpleString() for k in kinds.values()}) > 1

    first, columns = min(rules), [flag.alias(name) for name, flag in flags.items()]
    keys = {i: _key(df, _columns(rule), as_text, kinds[i]) for i, rule in rules.items()}
    if len(rules) == 1:
        entries = df.select(F.lit(first).alias("rule"), keys[first].alias("key"), *columns)
    else:
        listed = F.array(*(F.struct(F.lit(i).alias("rule"), key.alias("key")) for i, key in keys.items()))
        entries = df.select(*columns, F.inline(listed))
    lead = F.col("rule") == first
    grouped = entries.groupBy("rule", "key").agg(
        F.count(F.lit(1)).alias("checked"), *(F.count_if(F.col(name) & lead).alias(name) for name in flags)
    )
    known = None
    for i, rule in rules.items():
        if isinstance(rule, InReference):
            frame = references[rule.reference]
            key = _key(frame, (rule.reference_column,), as_text, kinds[i])
            found = frame.select(F.lit(i).alias("rule"), key.alias("key")).where(F.col("key").isNotNull())
            known = found if known is None else known.unionByName(found)
    if known is None:
        return grouped.withColumn(_KNOWN, F.lit(None).cast("boolean"))
    return grouped.join(known.distinct().withColumn(_KNOWN, F.lit(True)), ["rule", "key"], "left")


def evaluate(df: DataFrame, suite: Suite, asset: str, references: References | None = None) -> DataFrame:
    """One row per rule: how many rows were checked, how many broke it, and the
    verdict. The result has as many rows as the suite has rules.

    The table is read once, and so is each reference, however many rules there are:
    the counters of the column rules ride on the grouping by key.
    """
    references = references or {}
    by_key = {i: rule for i, rule in enumerate(suite.rules) if isinstance(rule, KeyRule)}
    flags = {f"broken_{i}": rule.broken() for i, rule in enumerate(suite.rules) if i not in by_key}

    if by_key:
        present = F.col("key").isNotNull()

        def rows(i: int, rule: KeyRule) -> Column:
            broken = F.col("checked") > 1 if isinstance(rule, Unique) else F.col(_KNOWN).isNull()
            return F.sum(F.when((F.col("rule") == i) & present & broken, F.col("checked")))

        sums = {"checked": F.sum(F.when(F.col("rule") == min(by_key), F.col("checked")))}
        sums |= {name: F.sum(name) for name in flags}
        sums |= {f"broken_{i}": rows(i, rule) for i, rule in by_key.items()}
        grouped = _grouped_keys(df, by_key, flags, references)
        counts = grouped.agg(*(F.coalesce(total, F.lit(0)).alias(name) for name, total in sums.items()))
    else:
        counts = df.agg(F.count(F.lit(1)).alias("checked"), *(F.count_if(f).alias(name) for name, f in flags.items()))

    results = [
        F.struct(
            F.lit(i + 1).alias("rule_no"),
            F.lit(rule.kind).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.lit(rule.detail).alias("detail"),
            F.col("checked").alias("element_count"),
            F.col(f"broken_{i}").alias("unexpected_count"),
        )
        for i, rule in enumerate(suite.rules)
    ]
    return (
        counts.select(F.array(*results).alias("results"))
        .select(F.inline("results"))
        .select(
            F.lit(suite.name).alias("suite"),
            F.lit(asset).alias("asset"),
            "rule_no",
            "rule",
            "column",
            "detail",
            "element_count",
            "unexpected_count",
            (F.col("unexpected_count") == 0).alias("success"),
        )
    )


def overall(results: DataFrame) -> DataFrame:
    """One row: whether every rule held. Without any result there is no success."""
    return results.agg(F.coalesce(F.bool_and("success"), F.lit(False)).alias("success"))


def failing_rows(df: DataFrame, suite: Suite, references: References | None = None) -> DataFrame:
    """The rows that break at least one rule, with the labels of those rules.

    Keys that are unknown or repeated are found first, and written; there are few of them
    as a rule, and then the rows meet them where they are. Otherwise they meet in a join
    that deals the rows of a hot key over several tasks.
    """
    references = references or {}
    given, columns, labels = df, df.columns, []
    for i, rule in enumerate(suite.rules):
        label = F.lit(rule_label(rule))
        if isinstance(rule, InReference):
            flag = f"_unknown_{i}"
            unknown = unknown_keys(given, rule, references).select(rule.column, F.lit(True).alias(flag))
            df = spread_join(df, _written(unknown), rule.column, "left")
            labels.append(F.when(F.col(flag), label))
        elif isinstance(rule, Unique):
            key, flag = f"_key_{i}", f"_repeated_{i}"
            kinds = [df.schema[c].dataType for c in rule.columns]
            keyed = df.withColumn(key, _key(df, rule.columns, len(kinds) > 1, kinds))
            counted = keyed.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
            repeated = counted.where("_rows > 1").select(key, F.lit(True).alias(flag))
            df = spread_join(keyed, _written(repeated), key, "left").drop(key)
            labels.append(F.when(F.col(flag), label))
        else:
            labels.append(F.when(rule.broken(), label))
    return (
        df.withColumn("broken_rules", F.array_compact(F.array(*labels)))
        .where(F.size("broken_rules") > 0)
        .select(*columns, "broken_rules")
    )
