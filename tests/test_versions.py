"""Tables that stay readable while they are refreshed, appended to, compacted and clustered."""

import datetime
import glob
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from orderloom.config import Layers
from orderloom.session import scratch_path
from orderloom.sinks import (
    append_table,
    cluster_table,
    compact_table,
    create_database,
    drop_table,
    refresh_table,
    remove_old_versions,
    versions,
)
from orderloom.sinks.versions import Part, State, VersionedTable
from orderloom.sources import list_columns, read_table

NOW = timedelta(0)


@pytest.fixture
def db(spark, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    made = Layers.with_suffix(name, scratch_path(spark, "layers"))
    create_database(spark, made.gold, made.database_path(made.gold))
    return made.gold


def ids(df):
    return sorted(r.id for r in df.collect())


def folder(spark, db, table):
    made = VersionedTable(spark, db, table)
    return made.path(made.folder).removeprefix("file:")


def data_files(spark, db, table):
    return glob.glob(f"{folder(spark, db, table)}/**/*.parquet", recursive=True)


def parts(spark, db, table):
    return VersionedTable(spark, db, table).state().parts


# ---- refresh


def test_a_reader_planned_before_the_switch_finishes(spark, db):
    refresh_table(spark.range(1000), db, "t")
    planned = read_table(spark, db, "t")
    planned._jdf.queryExecution().executedPlan()
    streamed = read_table(spark, db, "t").toLocalIterator()
    next(streamed)
    refresh_table(spark.range(3).selectExpr("id AS n", "'x' AS name"), db, "t")
    assert planned.count() == 1000 and len(list(streamed)) == 999
    assert read_table(spark, db, "t").columns == ["n", "name"] and read_table(spark, db, "t").count() == 3


@pytest.mark.parametrize("step", ["write", "measure", "switch", "clean"])
def test_a_crash_at_any_step_leaves_a_readable_table(spark, db, monkeypatch, step):
    refresh_table(spark.range(5), db, "t", keep=NOW)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "write":
            broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
        else:
            broken = spark.range(7)
            target = {"measure": (versions, "path_bytes"), "switch": (VersionedTable, "switch"), "clean": (versions, "delete_path")}
            patch.setattr(*target[step], lost)
        with pytest.raises(Exception, match="lost"):
            refresh_table(broken, db, "t", keep=NOW)
        assert ids(read_table(spark, db, "t")) == list(range(7 if step == "clean" else 5))
    assert refresh_table(spark.range(2), db, "t", keep=NOW) == 2
    assert ids(read_table(spark, db, "t")) == [0, 1]
    # What the crash has left goes as well.
    assert len(os.listdir(folder(spark, db, "t"))) == 1


def test_old_versions_stay_for_a_given_age(spark, db):
    for n in (1, 2, 3):
        refresh_table(spark.range(n), db, "t", keep=timedelta(hours=1))
    assert len(os.listdir(folder(spark, db, "t"))) == 3
    remove_old_versions(spark, db, "t", timedelta(minutes=30))
    assert len(os.listdir(folder(spark, db, "t"))) == 3
    remove_old_versions(spark, db, "t", NOW)
    assert len(os.listdir(folder(spark, db, "t"))) == 1 and read_table(spark, db, "t").count() == 3


def test_a_table_can_be_made_from_itself(spark, db):
    refresh_table(spark.range(10), db, "t")
    refresh_table(read_table(spark, db, "t").where("id % 2 = 0"), db, "t", keep=NOW)
    assert ids(read_table(spark, db, "t")) == [0, 2, 4, 6, 8]


def test_a_plain_table_is_taken_over(spark, db):
    spark.range(4).write.saveAsTable(f"{db}.t")
    assert refresh_table(spark.range(2), db, "t") == 2 and ids(read_table(spark, db, "t")) == [0, 1]


def test_names_types_and_empty_tables(spark, db):
    odd = spark.sql("SELECT 1 AS `a b`, 'x' AS `back``tick`, TIMESTAMP_NTZ '2024-01-02 03:04:05.678901' AS t, CAST(1.5 AS DECIMAL(9,3)) AS d")
    assert refresh_table(odd, db, "t") == 1
    assert read_table(spark, db, "t").dtypes == odd.dtypes and read_table(spark, db, "t").collect() == odd.collect()
    assert [r.column_name for r in list_columns(spark, db).collect()] == odd.columns
    assert refresh_table(odd.limit(0), db, "t", cluster_by=("d",)) == 0
    assert read_table(spark, db, "t").dtypes == odd.dtypes and read_table(spark, db, "t").count() == 0
    append_table(odd, db, "t")
    assert read_table(spark, db, "t").count() == 1
    drop_table(spark, db, "t")
    assert not spark.catalog.tableExists(f"{db}.t") and not os.path.exists(folder(spark, db, "t"))


def test_a_folder_whose_name_is_a_pattern(spark, db):
    create_database(spark, f"{db}_odd", f"{scratch_path(spark, 'layers')}/a{{b,c}}[d]*")
    for _ in range(2):
        refresh_table(days(spark, 0, 20), f"{db}_odd", "t", cluster_by=("order_date",))
    append_table(days(spark, 3, 5), f"{db}_odd", "t")
    assert cluster_table(spark, f"{db}_odd", "t", "order_date", keep=NOW) == 2
    assert read_table(spark, f"{db}_odd", "t").count() == 880


def test_other_tables_are_not_touched(spark, db):
    spark.range(4).write.saveAsTable(f"{db}.t")
    for change in (lambda: compact_table(spark, db, "t"), lambda: cluster_table(spark, db, "t", "id")):
        with pytest.raises(ValueError):
            change()
    assert ids(read_table(spark, db, "t")) == [0, 1, 2, 3]


def test_a_long_list_of_parts_survives_as_text():
    state = State(tuple(Part(f"p{i}/part={i}", i, i, "it's", None) for i in range(500)), (("a", 1.5),), ("x", "ü`"), "x")
    assert State.from_text(state.to_text()) == state


# ---- appends and compaction


def test_many_appends_leave_few_files_and_every_row_once(spark, db):
    for n in range(60):
        append_table(spark.range(n, n + 1).coalesce(1), db, "t", most_parts=8)
        assert len(parts(spark, db, "t")) <= 9
    assert ids(read_table(spark, db, "t")) == list(range(60))
    assert len(read_table(spark, db, "t").inputFiles()) <= 9
    remove_old_versions(spark, db, "t", NOW)
    assert len(data_files(spark, db, "t")) <= 9 and read_table(spark, db, "t").count() == 60


def test_compaction_leaves_large_parts_and_planned_readers_alone(spark, db):
    refresh_table(spark.range(50_000), db, "t")
    (large,) = parts(spark, db, "t")
    for n in range(5):
        append_table(spark.range(n), db, "t")
    planned = read_table(spark, db, "t")
    planned._jdf.queryExecution().executedPlan()
    assert compact_table(spark, db, "t", most_bytes=large.bytes) == 4
    assert parts(spark, db, "t")[0] == large and len(parts(spark, db, "t")) == 2
    assert planned.count() == read_table(spark, db, "t").count() == 50_010
    assert compact_table(spark, db, "t", most_bytes=large.bytes) == 0


def test_a_failed_compaction_loses_nothing(spark, db, monkeypatch):
    for n in range(6):
        append_table(spark.range(n, n + 1), db, "t")
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_table(spark, db, "t")
    assert ids(read_table(spark, db, "t")) == list(range(6))
    assert compact_table(spark, db, "t", keep=NOW) == 6 and ids(read_table(spark, db, "t")) == list(range(6))


def test_appended_rows_take_the_tables_order_and_types(spark, db):
    refresh_table(spark.sql("SELECT 1 AS id, CAST(2 AS BIGINT) AS n"), db, "t")
    append_table(spark.sql("SELECT 4 AS n, 3 AS id"), db, "t")
    assert sorted(map(tuple, read_table(spark, db, "t").collect())) == [(1, 2), (3, 4)]
    assert read_table(spark, db, "t").dtypes == [("id", "int"), ("n", "bigint")]
    with pytest.raises(ValueError):
        append_table(spark.sql("SELECT 4 AS n, 3 AS other"), db, "t")


# ---- clustering


def days(spark, first, last, rows=40):
    """Some rows for each day of a range, as a table arrives: in no order."""
    made = spark.range((last - first) * rows).selectExpr(
        f"date_add(DATE '2018-01-01', CAST({first} + id % {last - first} AS INT)) AS order_date",
        "id", "repeat(sha2(CAST(id AS STRING), 512), 3) AS text",
    )
    return made.repartition(3)


def date(n):
    return (datetime.date(2018, 1, 1) + timedelta(days=n)).isoformat()


def test_clustering_rewrites_only_what_overlaps(spark, db):
    refresh_table(days(spark, 0, 90), db, "t")
    size = parts(spark, db, "t")[0].bytes
    assert cluster_table(spark, db, "t", "order_date", part_bytes=size // 6) == 1
    first = parts(spark, db, "t")
    assert 5 <= len(first) <= 8 and sum(p.rows for p in first) == 3600
    assert all(a.high <= b.low for a, b in zip(first, first[1:]))
    # In order already: nothing to do.
    assert cluster_table(spark, db, "t", "order_date", part_bytes=size // 6) == 0
    assert parts(spark, db, "t") == first

    # A day within the range: its part alone is written again, with the new rows.
    middle = next(p for p in first if p.low < date(45) < p.high or p.low == date(45))
    append_table(days(spark, 45, 46, 300), db, "t")
    touched = cluster_table(spark, db, "t", "order_date", part_bytes=size // 6)
    after = parts(spark, db, "t")
    reached = [p for p in first if p.low < date(45) < p.high]
    assert touched == 1 + len(reached) if reached else touched <= 3
    assert {p.path for p in first if not p.low <= date(45) <= p.high} <= {p.path for p in after}
    assert middle.path not in {p.path for p in after} or not reached
    assert cluster_table(spark, db, "t", "order_date", part_bytes=size // 6) == 0

    # A day behind the end is small: it joins the last part if that has room, or stays.
    append_table(days(spark, 120, 121, 5), db, "t")
    cluster_table(spark, db, "t", "order_date", part_bytes=size // 6)
    final = parts(spark, db, "t")
    assert [p.path for p in final[: len(after) - 1]] == [p.path for p in after[:-1]]
    assert cluster_table(spark, db, "t", "order_date", part_bytes=size // 6) == 0
    assert read_table(spark, db, "t").count() == 3600 + 300 + 5
    assert read_table(spark, db, "t").where(f"order_date = DATE '{date(45)}'").count() == 340


def test_a_value_that_spans_parts_does_not_make_them_overlap(spark, db):
    one = days(spark, 10, 11, 3000)
    refresh_table(one.unionByName(days(spark, 0, 30)), db, "t")
    size = parts(spark, db, "t")[0].bytes
    cluster_table(spark, db, "t", "order_date", part_bytes=size // 5)
    assert sum(p.low <= date(10) <= p.high for p in parts(spark, db, "t")) > 1
    assert cluster_table(spark, db, "t", "order_date", part_bytes=size // 5) == 0


def test_a_crash_while_clustering_keeps_every_row(spark, db, monkeypatch):
    refresh_table(days(spark, 0, 30), db, "t", cluster_by=("order_date",))
    append_table(days(spark, 3, 5), db, "t")
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            cluster_table(spark, db, "t", "order_date")
    assert read_table(spark, db, "t").count() == 1280
    assert cluster_table(spark, db, "t", "order_date", keep=NOW) == 2
    assert read_table(spark, db, "t").count() == 1280


def test_columns_with_everyday_names_are_kept(spark, db):
    rows = spark.range(30).selectExpr("id AS part", "id % 3 AS belongs", "id AS `order`")
    refresh_table(rows, db, "t", cluster_by=("order",))
    append_table(rows, db, "t")
    cluster_table(spark, db, "t", "belongs", "part")
    assert sorted(map(tuple, read_table(spark, db, "t").collect())) == sorted((i, i % 3, i) for i in [*range(30)] * 2)
    with pytest.raises(ValueError):
        refresh_table(rows.withColumn(versions.PART, F.lit(1)), db, "t", cluster_by=("order",))


def test_missing_and_changed_keys(spark, db):
    rows = spark.range(100).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS k", "id", "CAST(id AS STRING) AS s")
    refresh_table(rows, db, "t", cluster_by=("k",))
    append_table(rows.where("k IS NULL"), db, "t")
    assert cluster_table(spark, db, "t", "k") == 2 and cluster_table(spark, db, "t", "k") == 0
    assert cluster_table(spark, db, "t", "s", "k") == 1 and cluster_table(spark, db, "t", "s") == 0
    assert read_table(spark, db, "t").count() == 134
