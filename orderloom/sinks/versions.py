"""Parquet tables that stay readable while they change.

A table is a view over its parts. A part is a folder that one finished job has written
and that is never written again. Refresh, append, clustering and compaction all write new
parts beside the old ones and then replace the view, in one call to the catalog. Before
that call every reader sees the old table, after it the new one, and a job that dies
leaves a folder that nothing refers to. Parts that are no longer used stay for a while, so
that readers planned before the switch finish.

The list of parts, with rows, bytes and the range of the clustering column, is kept as a
property of the view, so it changes in the same call. One job at a time may change a
table; any number may read it.
"""

from __future__ import annotations

import json
import re
import time
import uuid
import zlib
from dataclasses import asdict, dataclass, field, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.session import delete_path, list_folder, path_bytes

# How long parts stay that were replaced, or that an unfinished job has left.
KEEP_OLD = timedelta(days=1)
# Clustered tables are cut into parts of about this size, and files within them.
PART_BYTES = 16 << 30
FILE_BYTES = 512 << 20
# Files of one part where the size is not known beforehand.
FILES_PER_PART = 64
# Appends leave parts of any size; compaction joins them up to this one.
COMPACT_BYTES = 1 << 30
# Appended tables are compacted once they have more parts than this.
MOST_PARTS = 50

_STATE = "orderloom.parts"
_PROPERTY_LENGTH = 3500
# Columns that rows have only while they are written.
PART, SPLIT = "orderloom_part", "orderloom_belongs"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(path: str) -> str:
    """A path as a pattern that stands for itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


@dataclass(frozen=True)
class Part:
    """A folder below the database's, with the range of the first clustering column as text."""

    path: str
    rows: int
    bytes: int
    low: str | None = None
    high: str | None = None


@dataclass(frozen=True)
class State:
    """What a table consists of. ``retired`` names parts of earlier states, with the time of
    their replacement in seconds. ``shares`` names a table of the same database that was
    written in the same job, to the same folders."""

    parts: tuple[Part, ...] = ()
    retired: tuple[tuple[str, float], ...] = ()
    columns: tuple[str, ...] = ()
    key: str | None = None
    shares: str | None = None

    @property
    def paths(self) -> set[str]:
        return {*(p.path for p in self.parts), *(path for path, _ in self.retired)}

    def to_text(self) -> str:
        # Hexadecimal, because Spark blots out properties in whose text it sees words such as "url".
        return zlib.compress(json.dumps(asdict(self)).encode()).hex()

    @classmethod
    def from_text(cls, text: str) -> "State":
        raw = json.loads(zlib.decompress(bytes.fromhex(text)))
        parts = tuple(Part(**p) for p in raw["parts"])
        retired = tuple((path, at) for path, at in raw["retired"])
        return cls(parts, retired, tuple(raw["columns"]), raw["key"], raw["shares"])


@dataclass(frozen=True)
class VersionedTable:
    """A table by its name; ``location`` is the folder of its database."""

    spark: SparkSession
    database: str
    table: str
    location: str = field(default="")

    def __post_init__(self) -> None:
        if not self.location:
            location = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
            object.__setattr__(self, "location", location)

    @property
    def folder(self) -> str:
        """Where the table's jobs write, below the database's folder."""
        return f"{self.table}-parts"

    def new_path(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"

    def path(self, part: Part | str) -> str:
        return f"{self.location}/{part if isinstance(part, str) else part.path}"

    def state(self) -> State | None:
        """The current state; None where there is no such table, or one of another kind."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        found = {r["key"]: r["value"] for r in rows if r["key"].startswith(f"{_STATE}.")}
        if not found:
            return None
        return State.from_text("".join(found[f"{_STATE}.{i}"] for i in range(len(found))))

    def known_state(self) -> State:
        state = self.state()
        if state is None:
            raise ValueError(f"{self.name} is not a table made of parts")
        return state

    def read(self, parts: tuple[Part, ...]) -> DataFrame:
        schema = self.spark.table(self.name).schema
        return self.spark.read.schema(schema).parquet(*(literal(self.path(p)) for p in parts))

    def switch(self, state: State) -> None:
        """Make ``state`` the table: the one step by which anything changes."""
        text = state.to_text()
        pieces = [text[i : i + _PROPERTY_LENGTH] for i in range(0, len(text), _PROPERTY_LENGTH)]
        properties = ", ".join(f"'{_STATE}.{i}' = '{piece}'" for i, piece in enumerate(pieces))
        columns = ", ".join(map(quoted, state.columns))
        paths = "{" + ",".join(literal(p.path) for p in state.parts) + "}"
        if self.spark.catalog.tableExists(self.name) and self.spark.catalog.getTable(self.name).tableType != "VIEW":
            # A table of another kind, from elsewhere, cannot be replaced by a view in one call.
            self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({properties})"
            f" AS SELECT {columns} FROM parquet.{quoted(f'{literal(self.location)}/{paths}')}"
        )

    def replace_parts(self, state: State, old: tuple[Part, ...], new: tuple[Part, ...], **changes) -> State:
        """Switch to a state in which ``new`` stand where the first of ``old`` stood."""
        gone, at = {p.path for p in old}, time.time()
        kept = [p for p in state.parts if p.path not in gone]
        first = next((i for i, p in enumerate(state.parts) if p.path in gone), len(state.parts))
        parts = (*kept[:first], *new, *kept[first:])
        # An empty part holds nothing but the schema, which any other part has too.
        filled = tuple(p for p in parts if p.rows) or parts[:1]
        retired = (*state.retired, *((p.path, at) for p in (*old, *parts) if p.path not in {f.path for f in filled}))
        changed = replace(state, parts=filled, retired=retired, **changes)
        self.switch(changed)
        return changed

    def remove_old(self, keep: timedelta = KEEP_OLD) -> None:
        """Delete the parts that were replaced longer ago than ``keep``, and folders of that
        age that no state refers to, as an unfinished job leaves them."""
        state = self.state()
        if state is None:
            return
        limit = time.time() - keep.total_seconds()
        for path, at in state.retired:
            if at <= limit:
                delete_path(self.spark, self.path(path))
        left = tuple(r for r in state.retired if r[1] > limit)
        if left != state.retired:
            self.switch(replace(state, retired=left))
        used = replace(state, retired=left).paths
        if state.shares:
            other = sibling(self, state.shares).state()
            used |= other.paths if other else set()
        folders = {path.split("/")[1] for path in used if path.startswith(f"{self.folder}/")}
        for name, changed in list_folder(self.spark, self.path(self.folder)):
            if name not in folders and changed <= limit:
                delete_path(self.spark, self.path(f"{self.folder}/{name}"))


def _free(df: DataFrame, *names: str) -> None:
    for name in names:
        if name in df.columns:
            raise ValueError(f"the name {name!r} is needed while the rows are written")


def sibling(table: VersionedTable, name: str) -> VersionedTable:
    return VersionedTable(table.spark, table.database, name, table.location)


def in_key_order(df: DataFrame, columns: tuple[str, ...], partitions: int | None = None, parts: int | None = None) -> DataFrame:
    """Rows in partitions whose ranges of ``columns`` follow each other, with the number
    of the part that a partition belongs to.

    One value may hold much of the table. A tie-breaker made of the row and of the input
    partition therefore extends the range key: a large value spans several files, and a
    set of equal rows is still cut by partition. It does not change when a task is run
    again. Without ``partitions`` their number is left to AQE, which merges small ranges;
    that is the compaction.
    """
    _free(df, PART, "_tie")
    tie = F.xxhash64(F.spark_partition_id(), *[F.col(quoted(c)) for c in df.columns])
    keys = [*(F.col(quoted(c)) for c in columns), F.col("_tie")]
    dealt = df.withColumn("_tie", tie)
    ranged = dealt.repartitionByRange(partitions, *keys) if partitions else dealt.repartitionByRange(*keys)
    number = F.spark_partition_id()
    part = F.floor(number * parts / partitions) if partitions and parts else F.floor(number / FILES_PER_PART)
    return ranged.drop("_tie").withColumn(PART, part.cast("int")).sortWithinPartitions(PART, *map(quoted, columns))


def _written(table: VersionedTable, df: DataFrame) -> tuple[Part, ...]:
    """One part with the rows of ``df``; their number is observed by the writing tasks."""
    path, written = table.new_path(), Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(table.path(path))
    return (Part(path, written.get["rows"], path_bytes(table.spark, table.path(path))),)


def _written_in_order(table: VersionedTable, ordered: DataFrame, key: str) -> tuple[Part, ...]:
    """The parts of rows in key order, each with its range of the first key."""
    spark, folder = table.spark, table.new_path()
    ordered.write.partitionBy(PART).parquet(table.path(folder))
    rows = []
    if list_folder(spark, table.path(folder)):
        found = spark.read.schema(ordered.schema).parquet(literal(table.path(folder))).groupBy(PART).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(quoted(key)).cast("string").alias("low"),
            F.max(quoted(key)).cast("string").alias("high"),
        )
        rows = sorted(found.collect())
    if not rows:
        return _written(table, ordered.drop(PART))
    paths = [f"{folder}/{PART}={r[PART]}" for r in rows]
    return tuple(
        Part(path, r["rows"], path_bytes(spark, table.path(path)), r["low"], r["high"])
        for path, r in zip(paths, rows, strict=True)
    )


def refresh(table: VersionedTable, df: DataFrame, cluster_by: tuple[str, ...] = (), keep: timedelta = KEEP_OLD) -> int:
    """Replace rows and schema of the table; the number of rows."""
    state = table.state() or State()
    new = _written_in_order(table, in_key_order(df, cluster_by), cluster_by[0]) if cluster_by else _written(table, df)
    columns, key = tuple(df.columns), cluster_by[0] if cluster_by else None
    table.replace_parts(state, state.parts, new, columns=columns, key=key)
    table.remove_old(keep)
    return sum(p.rows for p in new)


def refresh_split(
    table: VersionedTable,
    others: VersionedTable,
    df: DataFrame,
    belongs: Column,
    columns: tuple[str, ...],
    other_columns: tuple[str, ...],
    keep: timedelta = KEEP_OLD,
) -> tuple[int, int]:
    """Refresh two tables in one pass over ``df``: ``table`` with the rows for which
    ``belongs`` holds, ``others`` with the rest; the number of rows of each."""
    spark, folder, written = table.spark, table.new_path(), Observation()
    _free(df, SPLIT)
    marked = df.withColumn(SPLIT, F.coalesce(belongs, F.lit(False)))
    counts = (F.count_if(SPLIT).alias("kept"), F.count_if(~F.col(SPLIT)).alias("rest"))
    marked.observe(written, *counts).write.partitionBy(SPLIT).parquet(table.path(folder))
    for target, other, side, name, chosen in (
        (others, table, "false", "rest", other_columns),
        (table, others, "true", "kept", columns),
    ):
        path, rows = f"{folder}/{SPLIT}={side}", written.get[name]
        if not rows:
            df.limit(0).write.parquet(table.path(path))
        part = Part(path, rows, path_bytes(spark, table.path(path)))
        state = target.state() or State()
        target.replace_parts(state, state.parts, (part,), columns=chosen, key=None, shares=other.table)
    for target in (table, others):
        target.remove_old(keep)
    return written.get["kept"], written.get["rest"]


def append(table: VersionedTable, df: DataFrame, most_parts: int = MOST_PARTS, keep: timedelta = KEEP_OLD) -> int:
    """Add rows with the table's columns; the number of rows. Once the table has more than
    ``most_parts`` parts, small ones are put together."""
    state = table.state()
    if state is None:
        return refresh(table, df, keep=keep)
    if set(df.columns) != set(state.columns):
        raise ValueError(f"{table.name} has the columns {', '.join(state.columns)}")
    kinds = table.spark.table(table.name).schema
    new = _written(table, df.select(*(F.col(quoted(c)).cast(kinds[c].dataType).alias(c) for c in state.columns)))
    if state.key:
        key = quoted(state.key)
        low, high = table.read(new).agg(F.min(key).cast("string"), F.max(key).cast("string")).first()
        new = tuple(replace(p, low=low, high=high) for p in new)
    state = table.replace_parts(state, (), new)
    if not state.key and len(state.parts) > most_parts:
        compact(table, keep=keep)
    return new[0].rows


def _joined(units: list[list[Part]], most_bytes: int) -> list[list[Part]]:
    """Neighbouring units put together as long as they stay within ``most_bytes``, so that
    no two neighbours of the result would fit together."""
    joined: list[list[Part]] = []
    for unit in units:
        if joined and sum(p.bytes for p in (*joined[-1], *unit)) <= most_bytes:
            joined[-1] = joined[-1] + unit
        else:
            joined.append(unit)
    return joined


def compact(table: VersionedTable, most_bytes: int = COMPACT_BYTES, keep: timedelta = KEEP_OLD) -> int:
    """Put small parts together, in the order in which they came; how many were rewritten.

    Larger parts stay as they are. Each group is switched on its own, so a job that
    dies has done part of the work and lost none.
    """
    state, rewritten = table.known_state(), 0
    for group in _joined([[p] for p in state.parts], most_bytes):
        if len(group) > 1:
            new = _written(table, table.read(tuple(group)).hint("rebalance"))
            state = table.replace_parts(state, tuple(group), new)
            rewritten += len(group)
    table.remove_old(keep)
    return rewritten


def _overlapping(table: VersionedTable, state: State) -> list[list[Part]]:
    """The parts by key, those in one list whose ranges reach into each other. Ranges
    that only touch are apart: a value that spans parts is at the edge of both."""
    kind = table.spark.table(table.name).schema[state.key].dataType
    ends = [(i, p.low, p.high) for i, p in enumerate(state.parts)]
    typed = table.spark.createDataFrame(ends, "nr int, low string, high string").select(
        "nr", F.col("low").cast(kind).alias("low"), F.col("high").cast(kind).alias("high")
    )
    units: list[list[Part]] = []
    reach = None
    for row in typed.orderBy("low", "high", "nr").collect():
        part = state.parts[row["nr"]]
        if row["low"] is not None and reach is not None and row["low"] < reach:
            units[-1].append(part)
        else:
            units.append([part])
        if row["high"] is not None and (reach is None or row["high"] > reach):
            reach = row["high"]
    return units


def cluster(
    table: VersionedTable, columns: tuple[str, ...], part_bytes: int = PART_BYTES, keep: timedelta = KEEP_OLD
) -> int:
    """Bring the table into the order of ``columns`` by rewriting only parts that overlap
    others or are small; how many parts were rewritten.

    A sweep over the parts' ranges finds the groups. A table that was not clustered by
    the first of ``columns`` before is rewritten whole, one that is in order not at all.
    """
    state = table.known_state()
    if state.key != columns[0]:
        groups = [list(state.parts)]
    else:
        groups = [g for g in _joined(_overlapping(table, state), part_bytes) if len(g) > 1]
    for group in groups:
        size = sum(p.bytes for p in group)
        parts = max(1, round(size / part_bytes))
        partitions = max(parts, -(-size // min(FILE_BYTES, part_bytes)))
        ordered = in_key_order(table.read(tuple(group)), columns, partitions, parts)
        new = _written_in_order(table, ordered, columns[0])
        state = table.replace_parts(state, tuple(group), new, key=columns[0])
    table.remove_old(keep)
    return sum(map(len, groups))
