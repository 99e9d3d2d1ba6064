"""Lines that do not fit their dataset, the guard against repeated references, and dedupe without sorting."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from orderloom.config import Layers, RawDataset, RunConfig
from orderloom.operators.dedupe import keep_latest, keep_one
from orderloom.plans import bronze, silver
from orderloom.plans.staged_run import run_stages
from orderloom.session import scratch_path
from orderloom.sinks import remove_old_versions, versions
from orderloom.sources import read_raw_csv_with_rejects, read_table
from orderloom.workload import mapping
from test_tables import raw_folder, write

LINES = (
    "order_id,customer_id,amount\n"
    "1,a,1.50\n"
    "2,b\n"
    "3,c,2.50,more\n"
    "4,d,much\n"
    "five,e,1\n"
    "\n"
    '6,"f,g",\n'
    "7,h,9\n"
)
SCHEMA = "order_id int, customer_id string, amount double"


@pytest.fixture
def layers(spark, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return Layers.with_suffix(name.lower(), scratch_path(spark, "layers"))


def load(spark, tmp_path, layers, text=LINES, schema=SCHEMA):
    root = write(tmp_path, "orders.csv", text)
    return bronze.ingest_all(spark, root, (RawDataset("orders", "orders.csv", schema),), layers, rejects=True)


def test_rows_and_rejects_are_all_lines(spark, tmp_path, layers):
    assert load(spark, tmp_path, layers) == {"orders": 3, "orders_rejects": 4}
    kept, rejected = (read_table(spark, layers.bronze, t) for t in ("orders", "orders_rejects"))
    assert sorted((r.order_id, r.customer_id, r.amount) for r in kept.collect()) == [(1, "a", 1.5), (6, "f,g", None), (7, "h", 9.0)]
    assert {r.rejected_line for r in rejected.collect()} == {"2,b", "3,c,2.50,more", "4,d,much", "five,e,1"}
    assert kept.columns == ["order_id", "customer_id", "amount", "ingestion_timestamp", "source_file"]
    assert rejected.columns == ["rejected_line", "ingestion_timestamp", "source_file"]
    assert {r.source_file.rpartition("/")[2] for r in rejected.collect()} == {"orders.csv"}


def test_types_inferred_from_all_lines_reject_by_number_of_fields(spark, tmp_path, layers):
    assert load(spark, tmp_path, layers, schema=None) == {"orders": 5, "orders_rejects": 2}
    assert dict(read_table(spark, layers.bronze, "orders").dtypes)["order_id"] == "string"


def test_no_line_or_every_line_rejected(spark, tmp_path, layers):
    assert load(spark, tmp_path, layers, "order_id,customer_id,amount\n1,a,2\n") == {"orders": 1, "orders_rejects": 0}
    assert read_table(spark, layers.bronze, "orders_rejects").count() == 0
    assert load(spark, tmp_path, layers, "order_id,customer_id,amount\nx\n") == {"orders": 0, "orders_rejects": 1}
    assert read_table(spark, layers.bronze, "orders").count() == 0
    assert load(spark, tmp_path, layers, "order_id,customer_id,amount\n") == {"orders": 0, "orders_rejects": 0}


def test_rejected_lines_are_a_column_of_the_scan(spark, tmp_path):
    root = write(tmp_path, "orders.csv", LINES)
    df = read_raw_csv_with_rejects(spark, root, RawDataset("orders", "orders.csv", SCHEMA))
    assert sorted((r.order_id or 0, r.rejected_line) for r in df.collect() if r.rejected_line) == [
        (0, "five,e,1"), (2, "2,b"), (3, "3,c,2.50,more"), (4, "4,d,much")
    ]


def test_two_tables_of_one_job_are_cleaned_without_harm(spark, tmp_path, layers, monkeypatch):
    now = datetime.timedelta(0)
    load(spark, tmp_path, layers)
    whole = versions.VersionedTable.switch

    def orders_only(table, state):
        if table.table == "orders_rejects":
            raise RuntimeError("lost")
        whole(table, state)

    # The rejects are switched first; a crash there leaves both tables old.
    with monkeypatch.context() as patch:
        patch.setattr(versions.VersionedTable, "switch", orders_only)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path, layers, "order_id,customer_id,amount\n1,a,2\n")
    for table in ("orders", "orders_rejects"):
        remove_old_versions(spark, layers.bronze, table, now)
    assert read_table(spark, layers.bronze, "orders").count() == 3
    assert read_table(spark, layers.bronze, "orders_rejects").count() == 4

    # Between the two switches: rejects new, orders old; neither loses its files.
    def rejects_only(table, state):
        if table.table == "orders":
            raise RuntimeError("lost")
        whole(table, state)

    with monkeypatch.context() as patch:
        patch.setattr(versions.VersionedTable, "switch", rejects_only)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path, layers, "order_id,customer_id,amount\n1,a,2\nx\n")
    for table in ("orders", "orders_rejects"):
        remove_old_versions(spark, layers.bronze, table, now)
    assert read_table(spark, layers.bronze, "orders").count() == 3
    assert [r.rejected_line for r in read_table(spark, layers.bronze, "orders_rejects").collect()] == ["x"]


# ---- repeated references


def test_repeated_references_stop_the_run(spark, tmp_path, layers):
    root = raw_folder(tmp_path)
    write(tmp_path, "customers.csv", "customer_id,customer_unique_id\nc1,u1\nc1,u2\nc2,u3\n")
    stopped = run_stages(spark, RunConfig(root, layers=layers, unique_references=True))
    assert stopped.branch == "quarantine" and not stopped.verdict.success and "silver.orders" not in stopped.rows
    set_aside = read_table(spark, layers.quarantine, "customers").collect()
    assert sorted((r.customer_unique_id, r.broken_rules) for r in set_aside) == [("u1", ["unique:customer_id"]), ("u2", ["unique:customer_id"])]
    assert read_table(spark, layers.quality, "runs").where("NOT success").count() == 1

    # Without the guard they fan out, as in any join.
    assert run_stages(spark, RunConfig(root, layers=layers)).rows["silver.orders"] == 4
    write(tmp_path, "customers.csv", "customer_id,customer_unique_id\nc1,u1\nc2,u3\n,u4\n,u5\n")
    done = run_stages(spark, RunConfig(root, layers=layers, unique_references=True, rejects=True))
    assert done.branch == "gold" and done.rows["silver.orders"] == 2 and done.rows["bronze.orders_rejects"] == 0


# ---- dedupe


def latest(rows):
    best = {}
    for key, number, label, when in rows:
        old = best.get(key)
        if old is None or (when is not None and (old[2] is None or when > old[2])):
            best[key] = (number, label, when)
    return best


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
def test_the_latest_row_of_each_key_is_kept_whole(spark, kind):
    rng, rows = random.Random(5), []
    for key in range(60):
        days = rng.sample([None, *range(-400, 30_000, 97)], rng.randint(1, 6))
        rows += [(f"k{key}", rng.randint(-9, 9), rng.choice(["new", "paid", None, ""]), day) for day in days]
    rows += rows[::3]
    rng.shuffle(rows)
    whens = {"date": "date_add(DATE '1970-01-01', CAST(w AS INT))", "bigint": "w"}
    when = whens.get(kind, f"CAST(date_add(DATE '1970-01-01', CAST(w AS INT)) AS {kind}) + INTERVAL '3:04:05.000007' HOUR TO SECOND")
    given = spark.createDataFrame(rows, "k string, n int, label string, w bigint").selectExpr("k", "n", "label", f"{when} AS t", "w")
    kept = keep_latest(given.select("k", "n", "label", "t").repartition(5), ["k"], ["n", "label", "t"], "t", ("label",))
    assert kept.columns == ["k", "n", "label", "t"] and kept.schema["label"].dataType.simpleString() == "string"
    wanted = {k: (n, label) for k, (n, label, _) in latest(rows).items()}
    assert {r.k: (r.n, r.label) for r in kept.collect()} == wanted and kept.count() == len(wanted)


def test_equal_times_are_decided_alike_on_every_run_and_rows_stay_whole(spark):
    rows = [("k", n, f"l{n}", 5) for n in range(40)]
    seen = set()
    for parts in (1, 3, 7):
        given = spark.createDataFrame(rows, "k string, n int, label string, t bigint").repartition(parts)
        (row,) = keep_latest(given, ["k"], ["n", "label", "t"], "t", ("label",)).collect()
        assert row.label == f"l{row.n}"
        seen.add(row)
    assert len(seen) == 1


def test_other_types_take_the_sorting_way(spark):
    given = spark.createDataFrame([("k", "a", 1), ("k", "b", 2)], "k string, name string, t bigint")
    assert [tuple(r) for r in keep_latest(given, ["k"], ["name", "t"], "t").collect()] == [("k", "b", 2)]
    assert keep_latest(given.limit(0), ["k"], ["name", "t"], "t", ("name",)).collect() == []
    by_text = keep_latest(given, ["k"], ["name", "t"], "name", ("name",)).collect()
    assert by_text == keep_one(given, ["k"], ["name", "t"], ("name",)).collect()


def test_clean_orders_do_not_sort(shuffled_joins, sf_dir):
    clean = silver.clean_orders(mapping.damaged_orders(shuffled_joins, sf_dir))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "Sort " not in plan
    assert clean.select(F.count_distinct("order_id")).first()[0] == clean.count()
